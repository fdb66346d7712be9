"""Which micro-batches were read: names ``<stream>-<number>``, kept as ranges of numbers by stream.

Batches are known by name and not by time, so one that becomes visible late is still found, whatever its times say. The
ledger grows with streams and gaps, not with batches.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

Ledger = Mapping[str, list[list[int]]]


def parsed(name: str) -> tuple[str, int]:
    stream, _, number = name.rpartition("-")
    return stream, int(number)


def unread(ledger: Ledger, names: Iterable[str]) -> list[str]:
    """The names that the ledger has not, in order of stream and number."""

    def known(name: str) -> bool:
        stream, number = parsed(name)
        return any(a <= number <= b for a, b in ledger.get(stream, ()))

    return sorted((n for n in set(names) if not known(n)), key=parsed)


def noted(ledger: Ledger, names: Iterable[str]) -> dict[str, list[list[int]]]:
    """The ledger with these batches too."""
    numbers: dict[str, list[list[int]]] = {s: [list(r) for r in ranges] for s, ranges in ledger.items()}
    for name in names:
        stream, number = parsed(name)
        numbers.setdefault(stream, []).append([number, number])
    for stream, ranges in numbers.items():
        joined: list[list[int]] = []
        for a, b in sorted(ranges):
            if joined and a <= joined[-1][1] + 1:
                joined[-1][1] = max(b, joined[-1][1])
            else:
                joined.append([a, b])
        numbers[stream] = joined
    return numbers

"""Matches of patterns with their places, as column expressions: start and end in code points, end exclusive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import bind, prefix_sums

# Code points of a block by which places in a long text are reached.
BLOCK = 512
SPAN = "struct<start:bigint,end:bigint,value:string>"


def find(text: Column, pattern: str, when: Column | None = None, block: int = 256) -> Column:
    """All matches, leftmost and non-overlapping, as an array of (start, end, value).

    The same pattern cuts the text into the pieces between matches; lengths summed up give the places. ``when``
    is a cheap test without which there is no match. Patterns must not match the empty string. A smaller ``block`` is
    for patterns that match at every word.
    """
    none = F.array().cast(f"array<{SPAN}>")

    def placed(matches: Column) -> Column:
        between = F.slice(F.split(text, pattern, -1), 1, F.size(matches))
        steps = F.zip_with(between, matches, lambda b, m: (F.length(b) + F.length(m)).cast("bigint"))
        before = prefix_sums(steps, block)
        return F.zip_with(
            F.zip_with(before, between, lambda a, b: a + F.length(b)),
            matches,
            lambda start, m: F.struct(start.alias("start"), (start + F.length(m)).alias("end"), m.alias("value")),
        ).cast(f"array<{SPAN}>")

    found = bind(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda matches: F.when(F.size(matches) == 0, none).otherwise(placed(matches)),
    )
    return found if when is None else F.when(when, found).otherwise(none)


def written(kind: str, spans: Column) -> Column:
    """kind:start:end of each span."""
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))


def blocks_of(text: Column) -> Column:
    """The text in blocks of ``BLOCK`` code points, so that a place is found without counting from the beginning."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}+"), F.lit(0))


def piece(blocks: Column, start: Column, length: Column) -> Column:
    """``length`` code points from ``start`` on, from the blocks that hold them."""
    first = F.floor(start / BLOCK).cast("int")
    count = F.floor((start + length - 1) / BLOCK).cast("int") - first + 1
    held = F.array_join(F.slice(blocks, first + 1, F.greatest(count, F.lit(0))), "")
    return F.when(length > 0, F.substring(held, (start - first * BLOCK + 1).cast("int"), length.cast("int"))).otherwise("")


def _rewritten(text: Column, spans: Column, instead: Callable[[Column, Column], Column]) -> Column:
    """The text with ``instead(span, end of all before)`` in place of what sorted spans cover: one pass, whatever their number."""

    def of(given: Column) -> Column:
        """From a struct of blocks, spans and the greatest end before each."""
        blocks, own = given["blocks"], given["spans"]
        parts = F.zip_with(own, given["before"], lambda s, at: F.concat(piece(blocks, at, F.greatest(s["start"] - at, F.lit(0))), instead(s, at)))
        last = F.greatest(F.element_at(own, -1)["end"], F.element_at(given["before"], -1))
        return F.concat(F.array_join(parts, ""), piece(blocks, last, given["size"] - last))

    def with_ends(own: Column) -> Column:
        before = prefix_sums(F.transform(own, lambda s: s["end"]), combine=F.greatest)
        return bind(F.struct(blocks_of(text).alias("blocks"), own.alias("spans"), before.alias("before"), F.length(text).cast("bigint").alias("size")), of)

    return F.when(F.size(spans) == 0, text).otherwise(bind(spans, with_ends))


def replaced(text: Column, spans: Column) -> Column:
    """The text with each (start, end, by) of sorted, non-overlapping spans replaced."""
    return _rewritten(text, spans, lambda s, at: s["by"])


def masked(text: Column, spans: Column) -> Column:
    """The text with spaces in place of what sorted spans (start, end) cover, overlapping or not; places stay."""
    return _rewritten(text, spans, lambda s, at: F.repeat(F.lit(" "), F.greatest(s["end"] - F.greatest(s["start"], at), F.lit(0)).cast("int")))


def without_overlaps(spans: Column) -> Column:
    """Of sorted spans those that begin at or after the end of all before."""

    def add(acc: Column, s: Column) -> Column:
        clear = s["start"] >= acc["at"]
        return F.struct(
            F.when(clear, s["end"]).otherwise(acc["at"]).alias("at"),
            F.when(clear, F.concat(acc["out"], F.array(s))).otherwise(acc["out"]).alias("out"),
        )

    kind = "struct<at:bigint,out:array<struct<start:bigint,end:bigint,by:string>>>"
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint,by:string>>").alias("out"))
    return F.aggregate(spans, start.cast(kind), lambda acc, s: add(acc, s).cast(kind), lambda acc: acc["out"])

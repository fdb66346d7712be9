"""Quality rules as a short-circuit cascade.

Each rule's cost (seconds a document) and selectivity (share of documents it rejects) are measured on a
bounded sample; rules then run in the order of rejection per cost, and a document leaves at the first rule
that rejects it. The order changes what a run costs, never what it decides.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind, stored, text_of, words_of

# Rows, about, on which costs and selectivities are estimated, and timed runs of each rule over them. They decide the
# order of the rules only.
SAMPLE_ROWS = 2_000
TIMED_RUNS = 3


def n_words(text: Column) -> Column:
    return F.size(words_of(text)).cast("bigint")


def word_chars(text: Column) -> Column:
    """Code points inside words."""
    return F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("bigint")


def n_symbols(text: Column) -> Column:
    return (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("bigint")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier one."""
    return bind(lines_with_words(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint")


def n_repeat_words(text: Column) -> Column:
    """Words in three-word windows that the text holds twice or more, the first included.

    Windows are compared by 64-bit hash within one text. Only texts with a repeated window are sorted.
    """

    def windows(w: Column) -> Column:
        n = F.size(w) - 2
        zipped = F.arrays_zip(F.slice(w, 1, n).alias("a"), F.slice(w, 2, n).alias("b"), F.slice(w, 3, n).alias("c"))
        return F.transform(zipped, lambda x: F.xxhash64(x["a"], x["b"], x["c"]))

    def repeated_at(h: Column) -> Column:
        """Sorted positions of windows that occur again."""
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def neighbours(s: Column) -> Column:
            none = F.array(F.lit(None).cast("struct<h:bigint,i:int>"))
            trio = F.arrays_zip(
                F.concat(none, F.slice(s, 1, F.size(s) - 1)).alias("before"), s.alias("this"), F.concat(F.slice(s, 2, F.size(s) - 1), none).alias("after")
            )
            again = lambda x: (x["this"]["h"].eqNullSafe(x["before"]["h"])) | (x["this"]["h"].eqNullSafe(x["after"]["h"]))
            return F.sort_array(F.transform(F.filter(trio, again), lambda x: x["this"]["i"]))

        return bind(ordered, neighbours)

    def covered(p: Column) -> Column:
        gaps = F.zip_with(F.slice(p, 2, F.size(p)), F.slice(p, 1, F.size(p) - 1), lambda b, a: F.least(b - a, F.lit(3)))
        return F.aggregate(gaps, F.lit(3), lambda acc, g: acc + g)

    def of_hashes(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(bind(repeated_at(h), covered))

    of_words = lambda w: F.when(F.size(w) < 4, F.lit(0)).otherwise(bind(windows(w), of_hashes))
    return bind(words_of(text), of_words).cast("bigint")


METRICS: dict[str, Callable[[Column], Column]] = {
    "n_words": n_words,
    "word_chars": word_chars,
    "n_symbols": n_symbols,
    "n_dup_lines": n_dup_lines,
    "n_repeat_words": n_repeat_words,
}


@dataclass(frozen=True)
class Rule:
    """Rejects a document by some of its metrics; both forms of the condition say the same."""

    name: str
    metrics: tuple[str, ...]
    sql: str  # over the metrics, true: rejected

    def over(self, metric: Callable[[str], Column]) -> Column:
        """The condition where ``metric`` gives the column or expression of each metric."""
        packed = F.struct(*[metric(m).alias(m) for m in self.metrics])
        return bind(packed, lambda x: _conditions[self.name](x))


# Written as functions of a struct of metrics, so that a rule computes what it needs and nothing else.
_conditions: dict[str, Callable[[Column], Column]] = {
    "too_short": lambda x: x["n_words"] < 50,
    "repetitive": lambda x: 100 * x["n_repeat_words"] > 50 * x["n_words"],
    "odd_word_length": lambda x: (x["word_chars"] < 2 * x["n_words"]) | (x["word_chars"] > 20 * x["n_words"]),
    "symbols": lambda x: 10 * x["n_symbols"] > 3 * x["n_words"],
    "same_lines": lambda x: (x["n_dup_lines"] >= 10) & (2 * x["n_dup_lines"] * 20 > x["n_words"]),
}

RULES = (
    Rule("too_short", ("n_words",), "n_words < 50"),
    Rule("repetitive", ("n_words", "n_repeat_words"), "100 * n_repeat_words > 50 * n_words"),
    Rule("odd_word_length", ("n_words", "word_chars"), "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    Rule("symbols", ("n_words", "n_symbols"), "10 * n_symbols > 3 * n_words"),
    Rule("same_lines", ("n_words", "n_dup_lines"), "n_dup_lines >= 10 AND 40 * n_dup_lines > n_words"),
)


def estimate(docs: DataFrame, rules: Sequence[Rule] = RULES, rows: int = SAMPLE_ROWS) -> list[dict]:
    """Seconds a document and share of rejected documents of each rule, on a sample of about ``rows`` rows.

    Rows are drawn at random inside the scan, from all partitions alike, and stored. Rules take turns in running over them
    alone: once untimed, so that what a run has to compile is there, then ``TIMED_RUNS`` times, of which the least counts,
    less the least of a run without rules.
    """
    share = min(1.0, rows / max(docs.count(), 1))
    sample = stored(docs.select(text_of().alias("text")).sample(share, 7), "rule-sample").coalesce(8).cache()
    n = max(sample.count(), 1)
    conditions = [F.length("text") < 0, *[rule.over(lambda m: METRICS[m](F.col("text"))) for rule in rules]]

    def timed(condition: Column) -> tuple[float, int]:
        began = time.perf_counter()
        hits = sample.agg(F.sum(condition.cast("bigint")).alias("hits")).first()["hits"]
        return time.perf_counter() - began, hits or 0

    runs = [[timed(c) for c in conditions] for _ in range(1 + TIMED_RUNS)][1:]
    sample.unpersist()
    idle, *seconds = [min(run[i][0] for run in runs) for i in range(len(conditions))]
    return [
        {"rule": rule, "cost": max(s - idle, 1e-4) / n, "selectivity": hits / n}
        for rule, s, (_, hits) in zip(rules, seconds, runs[0][1:], strict=True)
    ]


def ordered(estimates: list[dict]) -> list[Rule]:
    """Rules by rejection per cost, the greatest first; ties by name."""
    return [e["rule"] for e in sorted(estimates, key=lambda e: (-e["selectivity"] / e["cost"], e["rule"].name))]


def cascade(rules: Sequence[Rule], metric: Callable[[str], Column]) -> Column:
    """Name of the first rule that rejects, null if none does; later rules are not evaluated."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(rule.over(metric), F.lit(rule.name)).otherwise(verdict)
    return verdict


def walked(frame: DataFrame, order: Sequence[Rule]) -> DataFrame:
    """``frame``, which has ``__text``, with ``__rejected_by`` and a column ``__<metric>`` for each metric of the rules.

    Rule by rule: a metric is computed once, at the first rule that needs it, and only for documents that no rule
    before has rejected; it is null for those that have left.
    """
    frame, known = frame.withColumn("__rejected_by", F.lit(None).cast("string")), set()
    for rule in order:
        fresh = [m for m in rule.metrics if m not in known]
        known.update(fresh)
        still = F.col("__rejected_by").isNull()
        frame = frame.withColumns({f"__{m}": F.when(still, METRICS[m](F.col("__text"))) for m in fresh})
        told = cascade([rule], lambda m: F.col(f"__{m}"))
        frame = frame.withColumn("__rejected_by", F.coalesce("__rejected_by", told))
    return frame


def judged(docs: DataFrame, rules: Sequence[Rule] = RULES, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents with ``rejected_by``; a document leaves at the first rule that rejects it.

    Null text counts as empty and is rejected as too short. Repeated rows get the same verdict, columns
    beside ``text`` are passed on (one named rejected_by is replaced; names that begin with two underscores are
    taken), an empty table stays empty.
    """
    found = walked(docs.withColumn("__text", text_of()), ordered(estimate(docs, rules, rows)))
    kept = [c for c in docs.columns if c.lower() != "rejected_by"]
    return found.select(*kept, F.col("__rejected_by").alias("rejected_by"))


def measured(docs: DataFrame, rules: Sequence[Rule] = RULES, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, all metrics and ``rejected_by``, which the cascade decides.

    What the cascade has computed for a document is taken from it; metrics that it did not reach are computed after the verdict.
    """
    found = walked(docs.select("doc_id", text_of().alias("__text")), ordered(estimate(docs, rules, rows)))
    late = lambda m: METRICS[m](F.col("__text"))
    whole = [(F.coalesce(f"__{m}", late(m)) if f"__{m}" in found.columns else late(m)).alias(m) for m in METRICS]
    return found.select("doc_id", *whole, F.col("__rejected_by").alias("rejected_by"))

"""Mixing sources to target weights by entropy balancing.

Document rates r are as close as possible to one (in the entropy of a rate between 0 and the limit) under one
constraint per source: sum of rate * words = target. The dual of that convex problem has one multiplier per
source and gives exponentially tilted rates, r = limit * e / (e + limit - 1) with e = exp(multiplier * words / mean words).
Newton iterations on the dual run over a histogram (source, words, documents), so a pass over texts happens
once and an iteration is an aggregate over distinct sizes. Rates are rounded to copies systematically in the
order of size: however many documents a source has, what it takes misses its target by a few documents at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.paging import numbered
from .common import WORD, stored, text_of

WEIGHTS = (3, 1, 2)  # of the sources in code point order, repeating
SHARE = 1.5  # words to take, of all words
LIMIT = 2  # copies of a document, and words of a source, at most
ROUNDS = 40
TOLERANCE = 1e-7  # of a source's target, at which its multiplier is done
ONE = 1 << 24  # rates are rounded to fixed point: their sums are exact in any order
BLOCK = 4096  # documents of one source and size that are counted through in one group


def source_key(source: Column) -> Column:
    """A key without nulls that sorts as the sources by code point, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """key, source_size, n and target from key, source_size and n of each source.

    Targets share ``share`` of all words by weight and stop at ``limit`` times the source; the excess is shared
    anew among the others until none is above. Only sums come to the driver.
    """
    placed = numbered(sizes, "key")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    weighted = stored(placed.withColumn("weight", weight), "sources")
    goal = share * float(weighted.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    top = limit * F.col("source_size").cast("double")
    while True:
        at_top = F.col("weight") * level >= top
        row = weighted.agg(
            F.sum(F.when(at_top, top)).alias("fixed"),
            F.sum(F.when(~at_top, F.col("weight"))).alias("free"),
            F.count_if(at_top).alias("full"),
        ).first()
        if row["full"] == full or not row["free"]:
            break
        full, level = row["full"], max(0.0, goal - (row["fixed"] or 0.0)) / row["free"]
    target = F.when(F.col("weight") * level >= top, top).otherwise(F.col("weight") * level)
    return weighted.select("key", "source_size", "n", target.alias("target"))


def rate(multiplier: Column, size: Column, mean: Column, limit: float = LIMIT) -> Column:
    """The tilted rate, between 0 and the limit and 1 at a multiplier of 0; equal inputs give equal bits."""
    e = F.exp(F.least(F.greatest(multiplier * size / mean, F.lit(-60.0)), F.lit(60.0)))
    return limit * e / (e + (limit - 1))


def solve(cells: DataFrame, targets: DataFrame, limit: float = LIMIT) -> DataFrame:
    """key, multiplier and mean of every source: safeguarded Newton iterations on the dual.

    One iteration is one distributed aggregate for all sources; its result, a row per source, is written to
    the shared folder, which cuts the lineage. A step that leaves the bracket found so far is halved into it. Sources that take all
    of their limit, or nothing, need no multiplier (null).
    """
    inner = (F.col("target") > 0) & (F.col("target") < limit * F.col("source_size"))
    state = stored(
        targets.filter(inner).select(
            "key", "target", (F.col("source_size") / F.col("n")).alias("mean"), F.lit(0.0).alias("multiplier"),
            F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"), F.lit(1.0).alias("gap"),
        ),
        "multipliers",
    )
    for _ in range(ROUNDS):
        if not state.filter(F.col("gap") > TOLERANCE).head(1):
            break
        r = rate(F.col("multiplier"), F.col("size"), F.col("mean"), limit)
        words = F.col("docs") * F.col("size")
        # Fixed point keeps the sums the same in whatever order tasks deliver them.
        exact = lambda x: F.sum(F.round(x * ONE).cast("decimal(38,0)")).cast("double") / ONE
        slope = words * F.col("size") / F.col("mean") * r * (1 - r / limit)
        sums = cells.join(state.select("key", "multiplier", "mean"), "key").groupBy("key").agg(
            exact(words * r).alias("taken"), exact(slope).alias("slope")
        )
        over = F.col("taken") > F.col("target")
        low, high = F.when(over, F.col("low")).otherwise(F.col("multiplier")), F.when(over, F.col("multiplier")).otherwise(F.col("high"))
        newton = F.col("multiplier") + F.when(F.col("slope") > 0, (F.col("target") - F.col("taken")) / F.col("slope"))
        middle = F.when(F.abs(low) == 1e6, F.col("multiplier") - 4).when(F.abs(high) == 1e6, F.col("multiplier") + 4).otherwise((low + high) / 2)
        inside = newton.isNotNull() & (newton > low) & (newton < high) & (F.abs(newton - F.col("multiplier")) <= 8)
        moved = F.when(inside, newton).otherwise(middle)
        gap = F.abs(F.col("taken") - F.col("target")) / F.col("target")
        state = stored(
            state.drop("gap").join(sums, "key").select(
                "key", "target", "mean", F.when(gap <= TOLERANCE, F.col("multiplier")).otherwise(moved).alias("multiplier"),
                low.alias("low"), high.alias("high"), gap.alias("gap"),
            ),
            "multipliers",
        )
    return state.select("key", "multiplier", "mean")


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, key, size, source_size, target, rate, copies (0 … limit), taken (words).

    Null text counts as empty; a document without words has size 0 and takes none. A null source is one of its
    own, the last. Repeated rows take copies each; which of several documents of one source, size and doc_id gets a copy
    does not matter, all other choices follow from doc_id, so reruns agree. Columns beside doc_id, text and
    source are ignored, an empty table gives an empty result. A source of a third of all rows is one row
    per size in the histogram, and its documents are counted through in groups of about 4,096.
    """
    sized = stored(
        docs.select(
            F.col("doc_id"), source_key(F.col("source")).alias("key"), F.regexp_count(text_of(), F.lit(WORD)).cast("bigint").alias("size")
        ),
        "sizes",
    )
    cells = stored(sized.groupBy("key", "size").agg(F.count(F.lit(1)).alias("docs")), "histogram")
    sources = cells.groupBy("key").agg(F.sum(F.col("docs") * F.col("size")).alias("source_size"), F.sum("docs").alias("n"))
    targets = stored(source_targets(sources, weights, share, limit), "targets")
    tilt = solve(cells, targets, limit)
    # A source that takes its whole limit has no finite multiplier: all of its documents do.
    plain = F.when(F.col("target") > 0, F.lit(float(limit))).otherwise(0.0)
    rates = (
        cells.join(targets, "key").join(tilt, "key", "left")
        .withColumn("rate", F.when(F.col("multiplier").isNull(), plain).otherwise(rate(F.col("multiplier"), F.col("size"), F.col("mean"), limit)))
        .withColumn("step", F.round(F.col("rate") * ONE).cast("bigint"))
        .withColumn("groups", F.ceil(F.col("docs") / BLOCK))
    )
    rates = stored(rates.select("key", "size", "docs", "source_size", "target", "rate", "step", "groups"), "rates")
    group = F.pmod(F.xxhash64("doc_id"), F.col("groups"))
    placed = sized.join(rates.drop("docs"), ["key", "size"]).withColumn("group", group)
    # Rates of all earlier documents of the source: by size, then group, then doc_id.
    groups = placed.groupBy("key", "size", "group").agg(F.count(F.lit(1)).alias("docs"), F.first("step").alias("step"))
    earlier = Window.partitionBy("key").orderBy("size", "group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.select("key", "size", "group", F.coalesce(F.sum(F.col("docs") * F.col("step")).over(earlier), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("key", "size", "group").orderBy("doc_id")) - 1
    at = F.col("before") + rank * F.col("step") + ONE // 2
    copies = F.shiftright(at + F.col("step"), 24) - F.shiftright(at, 24)
    counted = placed.join(offsets, ["key", "size", "group"]).withColumn("copies", copies.cast("bigint"))
    return counted.select(
        "doc_id", "key", "size", "source_size", "target", "rate", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def mixture(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """The mixed documents, all columns: each as often as it has copies.

    Documents meet their copies by doc_id, source and size. Rows that share all three share their copies too:
    the first of them (by text) take one more than the others where it does not come out even.
    """
    chosen = mixed(docs, weights, share, limit).groupBy("doc_id", "key", "size").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("n"))
    chosen = stored(chosen, "copies").select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"), F.col("size").alias("__size"), F.col("copies").alias("__copies"), F.col("n").alias("__n"))
    own = docs.withColumn("__key", source_key(F.col("source"))).withColumn("__size", F.regexp_count(text_of(), F.lit(WORD)).cast("bigint"))
    met = own.join(
        chosen.filter("__copies > 0"),
        own["doc_id"].eqNullSafe(chosen["__id"]) & (own["__key"] == chosen["__key"]) & (own["__size"] == chosen["__size"]),
    ).drop(chosen["__key"]).drop(chosen["__size"])
    single = met.filter("__n = 1").withColumn("__take", F.col("__copies"))
    order = Window.partitionBy("__id", "__key", "__size").orderBy("text")
    several = met.filter("__n > 1").withColumn("__rank", F.row_number().over(order) - 1)
    share_of = F.floor(F.col("__copies") / F.col("__n")) + (F.col("__rank") < F.col("__copies") % F.col("__n")).cast("bigint")
    several = several.withColumn("__take", share_of).drop("__rank")
    out = single.unionByName(several).filter("__take > 0")
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__take")))).select(*docs.columns)

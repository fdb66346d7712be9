"""Personal data, and terms that give it away.

Patterns find e-mail addresses, IP addresses, card and telephone numbers: the protected entities. Around each
mention the terms are gathered, and over the whole corpus their co-occurrence says how much a term
discloses of an entity: pointwise mutual information over the entity's information content,

    disclosure(t, e) = log2(p(t, e) / (p(t) p(e))) / -log2(p(e)),

one if the term occurs near this entity only, about zero if it is independent of it. Probabilities are shares of
term positions. Terms beyond one threshold are generalised, beyond a higher one removed, wherever they occur: a term
that gives an entity away does so far from a mention, and in documents without one, as well.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind, stored, text_of
from .spans import blocks_of, find, masked, piece, replaced, without_overlaps, written

KINDS = ("email", "ip", "card", "phone")
# The given patterns. Possessive repetition and the look-behind keep them linear and free of recursion in
# very long runs of one class; a match begins at the beginning of such a run or where the last one ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

# Every run of letters (with their marks) and digits outside of base spans: what is common is for the score to say.
TERM = r"[\p{L}\p{M}\p{N}]++"
WINDOW = 128  # code points before and after a mention that are its context in the estimate; not a bound of what is reported
SUPPORT = 3  # co-occurrences below which nothing is said about a term
GENERALISE, REMOVE = 0.8, 0.95
# Candidate or telling terms of this measured size (bytes of text, and what a row takes beside) are sent to all tasks;
# beyond it terms are counted first, or all their places are shuffled.
BROADCAST_BYTES, TERM_BYTES = 32 << 20, 64
# Stands between the fields of a context: neither terms nor entities hold it.
MARK = "\u0001"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """The check of card numbers, over a string of digits."""
    back = F.reverse(number)
    each = F.transform(F.sequence(F.lit(1), F.length(number)), lambda i: F.substring(back, i, F.lit(1)).cast("int"))
    doubled = F.transform(each, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """The matches of each kind that pass its test."""
    n = lambda s: F.length(digits(s["value"]))
    card_ok = lambda s: F.when(n(s).between(16, 19), luhn(digits(s["value"]))).otherwise(False)
    return {
        "email": find(text, EMAIL, F.contains(text, F.lit("@"))),
        "ip": F.filter(find(text, IP, F.contains(text, F.lit("."))), lambda s: s["value"].rlike(rf"^{PART}(?:\.{PART}){{3}}$")),
        "card": F.filter(find(text, CARD), card_ok),
        "phone": F.filter(find(text, PHONE, F.contains(text, F.lit("+"))), lambda s: n(s).between(8, 15)),
    }


def contexts(text: Column, spans: dict[str, Column]) -> Column:
    """(entity, term) of the terms around all mentions, each place once; the text is masked.

    A term that the window's edge may have cut is left out. Addresses count without regard to case, numbers
    by their digits.
    """

    def entity(kind: str, s: Column) -> Column:
        return F.concat(F.lit(f"{kind}:"), F.lower(s["value"]) if kind in ("email", "ip") else digits(s["value"]))

    def around(blocks: Column, kind: str, s: Column) -> Column:
        begin = F.greatest(s["start"] - WINDOW, F.lit(0))
        left = piece(blocks, begin, s["start"] - begin)
        right = piece(blocks, s["end"], F.lit(WINDOW))

        def terms(name: Column, side: Column, offset: Column, whole) -> Column:
            place = lambda t: (t["start"] + offset).cast("string")
            return F.transform(F.filter(find(side, TERM, block=16), whole), lambda t: F.concat_ws(MARK, place(t), F.lower(t["value"]), name))

        return bind(
            entity(kind, s),
            lambda name: F.concat(
                terms(name, left, begin, lambda t: (t["start"] > 0) | (begin == 0)), terms(name, right, s["end"], lambda t: t["end"] < WINDOW)
            ),
        )

    def of(blocks: Column) -> Column:
        kinds = [F.flatten(F.transform(spans[kind], partial(around, blocks, kind))) for kind in KINDS]
        return F.concat(*kinds)

    def parted(c: Column) -> Column:
        fields = F.split(c, MARK)
        return F.struct(fields[2].alias("entity"), fields[1].alias("term"))

    # Strings are told apart by hashing, where structs would be compared pair by pair.
    return F.transform(F.array_distinct(bind(blocks_of(text), of)), parted)


def mentions(docs: DataFrame) -> DataFrame:
    """doc_id, a row number, spans of each kind, their contexts, the text without the spans, and its number of terms; written once."""
    found = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), text_of().alias("text"), F.xxhash64(text_of()).alias("hash"))
    found = found.select("*", *[c.alias(k) for k, c in base_spans(F.col("text")).items()])
    places = F.sort_array(F.concat(*[F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))) for k in KINDS]))
    found = found.withColumn("places", places).withColumn("masked", masked(F.col("text"), F.col("places")))
    near = contexts(F.col("masked"), {k: F.col(k) for k in KINDS})
    mentioned = sum((F.size(k) for k in KINDS), F.lit(0)) > 0
    return stored(
        found.select(
            "doc_id", "row", "hash", *KINDS,
            F.when(mentioned, near).alias("contexts"), "masked", F.regexp_count("masked", F.lit(TERM)).cast("bigint").alias("n_terms"),
        ),
        "mentions",
    )


def fits_memory(terms: DataFrame) -> bool:
    """Whether a stored table of terms is measured to be small enough to be sent to all tasks."""
    return (terms.agg(F.sum(F.octet_length("term") + TERM_BYTES)).first()[0] or 0) <= BROADCAST_BYTES


def disclosing(found: DataFrame, support: int = SUPPORT, threshold: float = GENERALISE) -> DataFrame:
    """(entity, term, disclosure) from the whole corpus, for terms at or beyond the threshold.

    All counts are combined in every task before they meet. Terms of the corpus are counted where they are
    candidates: those that co-occur often enough with some entity.
    """
    near = found.select(F.explode("contexts").alias("c")).select("c.entity", "c.term")
    pairs = near.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("together"))
    pairs = stored(pairs, "pairs")
    entities = pairs.groupBy("entity").agg(F.sum("together").alias("mentioned"))
    pairs = pairs.filter(F.col("together") >= support)
    candidates = stored(pairs.select("term").distinct(), "candidates")
    terms = found.select(F.explode(F.regexp_extract_all("masked", F.lit(TERM), F.lit(0))).alias("term")).select(F.lower("term").alias("term"))
    if fits_memory(candidates):
        terms = terms.join(F.broadcast(candidates), "term", "left_semi")
    totals = terms.groupBy("term").agg(F.count(F.lit(1)).alias("total"))
    n = F.lit(float(found.agg(F.coalesce(F.sum("n_terms"), F.lit(0))).first()[0] or 1))
    information = -F.log2(F.col("mentioned") / n)
    mutual = F.log2(F.col("together") * n / (F.col("total") * F.col("mentioned")))
    disclosure = F.when(information > 0, mutual / information).otherwise(0.0)
    scored = pairs.join(entities, "entity").join(totals, "term").select("entity", "term", disclosure.alias("disclosure"))
    return scored.filter(F.col("disclosure") >= threshold)


def occurrences(found: DataFrame, telling: DataFrame) -> DataFrame:
    """(row, start, end, disclosure) of every place of a telling term (term, disclosure) in all texts.

    Places meet one row per term. If these are few they are sent to all tasks; else both sides meet by plain
    exchanges, whose large partitions adaptive execution splits.
    """
    places = found.select("row", F.explode(find(F.col("masked"), TERM, block=32)).alias("t"))
    places = places.select("row", F.lower("t.value").alias("term"), "t.start", "t.end")
    few = fits_memory(telling)
    return places.join(F.broadcast(telling) if few else telling, "term").select("row", "start", "end", "disclosure")


def personal_data(docs: DataFrame, support: int = SUPPORT, threshold: float = GENERALISE) -> DataFrame:
    """One row per document: doc_id, row, hash (of the text), spans (start, end, value) of each kind, and ``terms`` (start, end, disclosure).

    Null text counts as empty and has none; repeated rows are treated each; columns besides doc_id and text are
    ignored; an empty table gives an empty result. A term is reported wherever it occurs outside of base spans, with the
    most that it discloses of any entity. An entity or term that a third of all documents mention is one row
    per task where counts meet.
    """
    found = mentions(docs)
    telling = disclosing(found, support, threshold).groupBy("term").agg(F.max("disclosure").alias("disclosure"))
    hits = occurrences(found, stored(telling, "disclosing"))
    terms = hits.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "disclosure"))).alias("terms"))
    none = F.array().cast("array<struct<start:bigint,end:bigint,disclosure:double>>")
    return found.join(terms, "row", "left").select("doc_id", "row", "hash", *KINDS, F.coalesce("terms", none).alias("terms"))


def span_texts(found: DataFrame) -> tuple[Column, Column]:
    """Base spans, and all spans, as kind:start:end, comma-joined: by kind as listed, then start."""
    base = [written(k, found[k]) for k in KINDS]
    return F.array_join(F.concat(*base), ","), F.array_join(F.concat(*base, written("term", found["terms"])), ",")


def sanitised(docs: DataFrame, support: int = SUPPORT, threshold: float = GENERALISE) -> DataFrame:
    """All columns, with personal data replaced by its kind, and telling terms by [term] or nothing.

    Documents meet their spans by doc_id and the text's hash, whatever made their rows, so rows that repeat get the same text.
    """
    text = text_of()
    found = personal_data(docs, support, threshold)
    keyed = found.withColumnRenamed("doc_id", "__id").withColumnRenamed("hash", "__hash")

    def by(array: Column, what) -> Column:
        return F.transform(array, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), what(s).alias("by")))

    def fixed(kind: str) -> Column:
        return by(F.col(kind), lambda s: F.lit(f"[{kind}]"))

    terms = by(F.col("terms"), lambda s: F.when(s["disclosure"] >= REMOVE, F.lit("")).otherwise(F.lit("[term]")))
    spans = keyed.select("__id", "__hash", without_overlaps(F.sort_array(F.concat(*map(fixed, KINDS), terms))).alias("__spans")).dropDuplicates(["__id", "__hash"])
    own = docs.withColumn("__hash", F.xxhash64(text))
    met = own.join(spans, own["doc_id"].eqNullSafe(spans["__id"]) & (own["__hash"] == spans["__hash"])).drop(spans["__hash"])
    return met.withColumn("text", F.when(F.size("__spans") > 0, replaced(text, F.col("__spans"))).otherwise(F.col("text"))).select(*docs.columns)

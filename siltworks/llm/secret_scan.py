"""Secrets, and credentials that come in several parts.

Patterns find assignments, access identifiers and hexadecimal keys. Other strings are only *weak* candidates: names
of accounts, random-looking words, addresses of services. Parts are linked by an interval join within
documents: a weak candidate is reported if parts that complete it begin within its scope; a key needs an identifier,
an identifier a key, an endpoint both. One string is one part: a name that overlaps a match of a base kind, and a key
that overlaps such a match or a name, is no candidate, so nothing completes itself. An endpoint may hold other parts,
as addresses do in their queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, text_of
from .spans import find

KINDS = ("assign", "access", "hex")
ASSIGN = r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
# A run of the class is at least so long, or else no match: the same as taking runs and dropping short ones.
HEX = r"[0-9a-f]{24,}+"
WEAK = ("name", "key", "endpoint")
NAME = r"""(?i:user_?name|user|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}+"""
# A sign of equality ends a key as padding, but may as well stand before one, as in NAME=value.
KEY = r"(?:\G|(?<![A-Za-z0-9+/_-]))[A-Za-z0-9+/_-]{16,}+={0,2}+"
ENDPOINT = r"""https?://[^\x20\x09-\x0D"'<>]++"""
# What each kind is a part of a credential as.
PARTS = {"access": "identifier", "name": "identifier", "assign": "secret", "hex": "secret", "key": "secret", "endpoint": "endpoint"}
SCOPE = 300  # code points between the beginnings of parts that belong together


def all_spans(text: Column) -> dict[str, Column]:
    """Matches of each kind: the base kinds that pass their tests, and the weak ones."""
    low = F.lower(text)
    named = low.rlike("password|passwd|secret|token|api_?key")
    value = lambda s: F.regexp_extract(s["value"], ASSIGN, 1)
    mixed = lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]")
    return {
        "assign": F.filter(find(text, ASSIGN, named), lambda s: F.length(value(s)) >= 6),
        "access": F.filter(find(text, ACCESS, F.contains(text, F.lit("AKIA"))), lambda s: s["end"] - s["start"] >= 20),
        "hex": find(text, HEX),
        "name": find(text, NAME, low.rlike("user|login|account|client|access")),
        "key": F.filter(find(text, KEY), mixed),
        "endpoint": find(text, ENDPOINT, F.contains(text, F.lit("://"))),
    }


def parts(docs: DataFrame) -> DataFrame:
    """doc_id, a row number, and (kind, start, end) of all matches; written once."""
    found = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), text_of().alias("text"))
    kinds = all_spans(F.col("text"))
    found = found.select("doc_id", "row", *[c.alias(k) for k, c in kinds.items()])

    def plain(kind: str) -> Column:
        return F.transform(F.col(kind), lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    return stored(found.select("doc_id", "row", F.concat(*map(plain, kinds)).alias("spans")), "parts")


def apart(each: DataFrame) -> DataFrame:
    """Without names that overlap a base match, and keys that overlap a base match or a name that stays.

    In order of beginnings: something that began no later and ends within or beyond, or begins within.
    """
    order = Window.partitionBy("row").orderBy("start")
    so_far, from_here = order.rangeBetween(Window.unboundedPreceding, 0), order.rangeBetween(0, Window.unboundedFollowing)

    def met(strong: Column) -> Column:
        before = F.max(F.when(strong, F.col("end"))).over(so_far) > F.col("start")
        after = F.min(F.when(strong, F.col("start"))).over(from_here) < F.col("end")
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    base = F.col("kind").isin(*KINDS)
    named = each.withColumn("stays", (F.col("kind") != "name") | ~met(base)).filter("stays")
    keyed = named.withColumn("stays", (F.col("kind") != "key") | ~met(base | (F.col("kind") == "name")))
    return keyed.filter("stays").drop("stays")


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(row, kind, start, end) of the weak candidates that complementary parts complete.

    The interval join goes by blocks as wide as the scope. Of each block only the first and last beginning of
    each part are kept, which is all that a candidate in the same or a neighbouring block asks for: a candidate
    meets three rows at most, however many parts a document has.
    """
    of = F.create_map(*[F.lit(x) for pair in PARTS.items() for x in pair])
    some = found.filter(F.exists("spans", lambda s: s["kind"].isin(*WEAK)))
    each = apart(some.select("row", F.explode("spans").alias("s")).select("row", "s.*")).withColumn("part", of[F.col("kind")])
    each = each.withColumn("block", F.floor(F.col("start") / scope))
    ends = [
        f(F.when(F.col("part") == p, F.col("start"))).alias(f"{p}_{name}")
        for p in ("identifier", "secret") for name, f in (("first", F.min), ("last", F.max))
    ]
    blocks = each.groupBy("row", "block").agg(*ends)
    weak = each.filter(F.col("kind").isin(*WEAK)).withColumn("at", F.explode(F.array(*[F.col("block") + d for d in (-1, 0, 1)])))
    near = lambda p: (F.col(f"{p}_last") >= F.col("start") - scope) & (F.col(f"{p}_first") <= F.col("start") + scope)
    met = weak.join(blocks.withColumnRenamed("block", "at"), ["row", "at"]).groupBy("row", "kind", "part", "start", "end").agg(
        F.coalesce(F.max(near("identifier")), F.lit(False)).alias("has_identifier"), F.coalesce(F.max(near("secret")), F.lit(False)).alias("has_secret")
    )
    whole = ((F.col("part") == "identifier") | F.col("has_identifier")) & ((F.col("part") == "secret") | F.col("has_secret"))
    return met.filter(whole).select("row", "kind", "start", "end")


def secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per document: doc_id, row, ``base`` and ``spans``, arrays of (start, kind number, kind, end) by start, then kind.

    ``spans`` are the base ones and the weak candidates that are linked. Null text counts as empty and has none;
    repeated rows are treated each; columns besides doc_id and text are ignored; an empty table gives an empty result.
    """
    found = parts(docs)
    number = F.create_map(*[F.lit(x) for i, k in enumerate((*KINDS, *WEAK)) for x in (k, i)])
    packed = lambda s: F.struct(s["start"].alias("start"), number[s["kind"]].alias("number"), s["kind"].alias("kind"), s["end"].alias("end"))
    more = linked(found, scope).groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more"))
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    joined = found.join(more, "row", "left").select("doc_id", "row", base.alias("base"), F.coalesce("more", none).alias("more"))
    ordered = lambda c: F.sort_array(F.transform(c, packed))
    return joined.select("doc_id", "row", ordered(F.col("base")).alias("base"), ordered(F.concat("base", "more")).alias("spans"))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

"""Structure repair of conversations: cheapest edits as a shortest path, found by an auction.

The lattice of a conversation has a node for each place between rows and each state of the wanted form
``(s?(ua)+)?``; arcs keep, rerole or delete the next row, or insert one, at integer costs. The *auction* holds a price
for every node and a path from the origin: its last node's price rises to what the best arc offers, and the path
contracts by it; or the price is met already, and the path extends along that arc. Prices never exceed what is left
to pay, so when the path reaches its end they prove it shortest, and every cheapest path runs on *tight* arcs, whose
price difference is their cost. Tracing those in the order of the letters gives the least of the cheapest audits.

Rows are range-partitioned by conversation and order, so a conversation of any length is spread over tasks. It is
solved in segments of at most ``SEGMENT`` rows; one that has several gets for each segment the costs and the order of
audits between all pairs of states, and groups of ``FAN`` segments are solved the same way, level by level, as
lattices of states alone; choices then go down the levels. Only the digest of a whole repaired conversation is
sequential: rows stream through one task in order, with constant memory beside the audit itself.

Defined results: null ids, turns, roles and texts count as one space (a null id is a conversation of its own, null
turns come first); an empty role has no legal initial; rows of one turn are ordered by role, then by a digest of the
text; a conversation without rows has an empty audit; other columns are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shuffle_partitions, whole_numbers
from .common import SPACE, WORD, stored

SEGMENT, FAN = 128, 64
KEEP_TRUNCATED, REROLE, DELETE, INSERT = 1, 2, 3, 2
# States: nothing yet, after system, after user, after assistant.
STATES = 4
KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
MADE = (2, 2, 3, 2)
ROLES = {2: "user", 3: "assistant"}
# What a row costs at least, by its code: blank, duplicate, initials (capital: truncated), end.
LEAST = {"b": DELETE, "d": DELETE, "o": REROLE, "O": DELETE, "S": 1, "U": 1, "A": 1}

Arcs = list[list[tuple]]


def auction(arcs: Arcs, prices: list[int], origin: int, target: int) -> int:
    """The cost of the cheapest path; ``prices``, at most each arc's cost plus its head's price, end up proving it.

    The target must be within reach, and cycles must cost something.
    """
    path = [origin]
    while (node := path[-1]) != target:
        best, head = None, -1
        for _, cost, to in arcs[node]:
            offer = cost + prices[to]
            if best is None or offer < best:
                best, head = offer, to
        if best is not None and best <= prices[node]:
            path.append(head)
        else:
            prices[node] = float("inf") if best is None else best
            if len(path) > 1:
                path.pop()
    return prices[origin] - prices[target]


def traced(arcs: Arcs, prices: list[int], origin: int, target: int) -> list[tuple]:
    """The arcs of the path over tight arcs whose letters come first in order."""
    dead, path, at = set(), [], [(origin, iter(sorted(arcs[origin])))]
    while at[-1][0] != target:
        node, rest = at[-1]
        for arc in rest:
            if arc[2] not in dead and prices[node] == arc[1] + prices[arc[2]]:
                path.append(arc)
                at.append((arc[2], iter(sorted(arcs[arc[2]]))))
                break
        else:
            dead.add(node)
            at.pop()
            path.pop()
    return path


def row_lattice(codes: str) -> tuple[Arcs, list[int]]:
    """Arcs (letter, cost, head) of some rows, and prices to begin with: what the rows ahead cost at least."""
    arcs: Arcs = []
    for i, code in enumerate(codes):
        low, late = code.lower(), KEEP_TRUNCATED if code.isupper() else 0
        for state in range(STATES):
            here = [("I", INSERT, STATES * i + MADE[state])]
            ahead = STATES * (i + 1)
            if code == "$":
                if state in (0, 3):
                    here.append(("", 0, ahead))
            else:
                here.append(("D", DELETE, ahead + state))
                if code not in "bd":
                    here.append(("R", REROLE + late, ahead + MADE[state]))
                    if low in KEPT[state]:
                        here.append(("K", late, ahead + KEPT[state][low]))
            arcs.append(here)
    return arcs + [[]] * STATES, falling([LEAST.get(c, 0) for c in codes])


def group_lattice(tables: list[list[int]]) -> tuple[Arcs, list[int]]:
    """The same of groups of rows, given each one's costs and ranks between states."""
    arcs: Arcs = []
    for i, table in enumerate(tables):
        for a in range(STATES):
            ends = [(table[16 + 4 * a + b], table[4 * a + b], STATES * (i + 1) + b) for b in range(STATES)]
            arcs.append([arc for arc in ends if arc[1] >= 0])
    return arcs + [[]] * STATES, falling([min(c for c in t[:16] if c >= 0) for t in tables])


def falling(least: list[int]) -> list[int]:
    prices, total = [0] * STATES, 0
    for cost in reversed(least):
        total += cost
        prices += [total] * STATES
    return prices[::-1]


def within_reach(arcs: Arcs, origin: int) -> set[int]:
    seen, left = {origin}, [origin]
    while left:
        for _, _, head in arcs[left.pop()]:
            if head not in seen:
                seen.add(head)
                left.append(head)
    return seen


def all_pairs(arcs: Arcs, prices: list[int]) -> list[int]:
    """Costs from each state before the rows to each after them (-1: none), and ranks of the least words from each."""
    costs, ranks, last = [-1] * 16, [0] * 16, len(arcs) - STATES
    for a in range(STATES):
        reach, words = within_reach(arcs, a), []
        for b in range(STATES):
            if last + b in reach:
                own = list(prices)
                costs[4 * a + b] = auction(arcs, own, a, last + b)
                words.append(([arc[0] for arc in traced(arcs, own, a, last + b)], b))
        for rank, (_, b) in enumerate(sorted(words)):
            ranks[4 * a + b] = rank
    return costs + ranks


def between(arcs: Arcs, prices: list[int], entry: int, leave: int) -> tuple[int, list[tuple]]:
    target = len(arcs) - STATES + leave
    cost = auction(arcs, prices, entry, target)
    return cost, traced(arcs, prices, entry, target)


def mapped(df: DataFrame, schema: str, function) -> DataFrame:
    """Rows that ``function`` makes of each row, given as a dictionary."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [r for row in batch.to_pylist() for r in function(row)]
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in made], schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(T._parse_datatype_string(schema))
    return df.mapInArrow(run, schema)


def or_space(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults put in by a checksum of conversation and turn: dropped, emptied, stripped, repeated, reroled."""
    kind = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn")).cast("binary")) % 20
    text = or_space("text")
    return (
        conversations.select(
            "conv_id", "turn",
            F.when(kind == 4, "user").otherwise(or_space("role")).alias("role"),
            F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
            F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("__copies"),
        )
        .withColumn("__copies", F.explode(F.array_repeat(F.lit(1), F.col("__copies"))))
        .drop("__copies")
    )


def ordered(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Stored rows and an end mark of each conversation, with ``pos``: 0, 1, 2 … in order of all."""
    spark = rows.sparkSession
    conv = F.coalesce(F.concat(F.lit("+"), F.col("conv_id").cast("string")), F.lit("-"))
    role, text = or_space("role"), or_space("text")
    marks = ids.select("conv_id").distinct().select("conv_id", *[F.lit(None).cast(t).alias(n) for n, t in (("turn", "bigint"), ("role", "string"), ("text", "string"))], F.lit(True).alias("end"))
    both = rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"), F.lit(False).alias("end")).unionByName(marks)
    keyed = both.withColumn("conv", conv).withColumn("digest", F.sha2("text", 256))
    order = ["conv", "end", "turn", "role", "digest"]
    placed = stored(
        keyed.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "conversation-rows"
    )
    part = F.shiftright("at", 33).cast("int")
    starts, total = [], 0
    for r in sorted(placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()):
        starts.append((r["part"], total))
        total += r["n"]
    first = F.broadcast(whole_numbers(spark, starts, "part int, first bigint"))
    return placed.withColumn("part", part).join(first, "part").withColumn("pos", F.col("first") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).drop("part", "first", "at")


def segments(rows: DataFrame, size: int) -> DataFrame:
    """conv, seg and ``codes``, a letter for each of a segment's rows, from rows of ``ordered``."""
    blank = ~F.col("text").rlike(WORD)
    full = F.col("text").rlike(r"[.!?]" + SPACE + r"*\z")
    initial = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("o")
    key = F.sha2(F.concat(F.length("conv").cast("string"), F.lit(":"), "conv", F.length("role").cast("string"), F.lit(":"), "role", "digest"), 256)
    code = F.when(F.col("end"), "$").when(blank, "b").when(full, initial).otherwise(F.upper(initial))
    small = rows.select("conv", "pos", key.alias("key"), code.alias("code"))
    first = small.filter("code NOT IN ('$', 'b')").groupBy("key").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("key", "first")
    # Stored, so that the join has plain exchanges on both sides (or a measured broadcast) and a hot text's rows are split.
    known = small.join(stored(first, "first-places"), "key", "left").withColumn("code", F.when(F.col("pos") > F.col("first"), "d").otherwise(F.col("code")))
    letters = F.transform(F.array_sort(F.collect_list(F.struct("pos", "code"))), lambda x: x["code"])
    return stored(known.groupBy("conv", F.floor(F.col("pos") / size).alias("seg")).agg(F.array_join(letters, "").alias("codes")), "segments")


def states_at(segs: DataFrame, fan: int) -> DataFrame:
    """conv, seg, and the states before and after each segment on the least cheapest path, for conversations of several."""
    table = "conv string, node bigint, costs array<int>"
    level = stored(mapped(segs, table, lambda r: [(r["conv"], r["seg"], all_pairs(*row_lattice(r["codes"])))]), "level")
    groups: list[DataFrame] = []
    while (level.groupBy("conv").count().agg(F.max("count")).first()[0] or 0) > 1:
        children = F.array_sort(F.collect_list(F.struct("node", "costs"))).alias("children")
        groups.append(stored(level.groupBy("conv", F.floor(F.col("node") / fan).alias("node")).agg(children), "groups"))
        level = stored(mapped(groups[-1], table, lambda r: [(r["conv"], r["node"], all_pairs(*group_lattice([c["costs"] for c in r["children"]])))]), "level")
    chosen = level.select("conv", "node", F.lit(0).alias("entry"), F.lit(0).alias("leave"))

    def down(row: dict) -> Iterator[tuple]:
        arcs, prices = group_lattice([c["costs"] for c in row["children"]])
        at = row["entry"]
        for child, arc in zip(row["children"], between(arcs, prices, row["entry"], row["leave"])[1]):
            yield row["conv"], child["node"], at, arc[2] % STATES
            at = arc[2] % STATES

    for group in reversed(groups):
        chosen = stored(mapped(group.join(chosen, ["conv", "node"]), "conv string, node bigint, entry int, leave int", down), "chosen")
    return chosen.withColumnRenamed("node", "seg")


def audited(rows: DataFrame, size: int = SEGMENT, fan: int = FAN) -> DataFrame:
    """conv, seg, codes, entry (the state before), cost and audit of each segment of rows of ``ordered``."""
    segs = segments(rows, size)
    counts = segs.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    single = segs.join(counts.filter("n = 1"), "conv", "left_semi").select("*", F.lit(0).alias("entry"), F.lit(0).alias("leave"))
    several = stored(segs.join(counts.filter("n > 1"), "conv", "left_semi"), "several")
    both = single.unionByName(several.join(states_at(several, fan), ["conv", "seg"]))

    def solved(row: dict) -> Iterator[tuple]:
        cost, path = between(*row_lattice(row["codes"]), row["entry"], row["leave"])
        yield row["conv"], row["seg"], row["codes"], row["entry"], cost, "".join(arc[0] for arc in path)

    return mapped(both, "conv string, seg bigint, codes string, entry int, cost bigint, audit string", solved)


class Repair:
    """Edits of one conversation's rows as they come, segment by segment."""

    def __init__(self):
        self.state, self.edits, self.codes = 0, iter(""), iter("")

    def segment(self, row: dict) -> None:
        self.state, self.edits, self.codes = row["entry"], iter(row["audit"]), iter(row["codes"])

    def row(self, row: dict) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the rows that take this one's place."""
        code = next(self.codes)
        for edit in self.edits:
            if edit == "I":
                self.state = MADE[self.state]
                yield edit, ROLES[self.state], ""
                continue
            if edit == "K":
                self.state = KEPT[self.state][code.lower()]
                yield edit, row["role"], row["text"]
            elif edit == "R":
                self.state = MADE[self.state]
                yield edit, ROLES[self.state], row["text"]
            return


def streamed(rows: DataFrame, audits: DataFrame, size: int) -> DataFrame:
    """Each segment's audit, then its rows."""
    text = [(n, F.lit(None).cast(t)) for n, t in (("codes", "string"), ("entry", "int"), ("cost", "bigint"), ("audit", "string"))]
    own = rows.select("conv", F.floor(F.col("pos") / size).alias("seg"), "pos", "conv_id", "turn", "role", "text", "end", *[c.alias(n) for n, c in text])
    marks = audits.select(
        "conv", "seg", F.lit(-1).cast("bigint").alias("pos"), F.lit(None).cast(rows.schema["conv_id"].dataType).alias("conv_id"), F.lit(None).cast("bigint").alias("turn"),
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(False).alias("end"), "codes", "entry", "cost", "audit",
    )
    return own.unionByName(marks)


def repaired(conversations: DataFrame, size: int = SEGMENT, fan: int = FAN) -> DataFrame:
    """conv_id, place (ascending in a conversation), role, text and edit (K, R, I) of each row of the repaired conversations."""
    rows = ordered(conversations, conversations)
    schema = T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType), *T._parse_datatype_string("place bigint, role string, text string, edit string")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair = Repair()
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if row["pos"] < 0:
                    repair.segment(row)
                else:
                    found += [(row["conv_id"], 4 * row["pos"] + i, role, text, edit) for i, (edit, role, text) in enumerate(repair.row(row))]
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate(kinds)], names=schema.names)

    from pyspark.sql.pandas.types import to_arrow_type

    kinds = [to_arrow_type(f.dataType) for f in schema]
    together = streamed(rows, audited(rows, size, fan), size)
    return together.repartition("conv", "seg").sortWithinPartitions("conv", "seg", "pos").mapInArrow(run, schema)


def reports(rows: DataFrame, ids: DataFrame, size: int = SEGMENT, fan: int = FAN) -> DataFrame:
    """A row for every conversation of ``ids``: conv_id, faults of its ``rows``, cost and audit of the repair, digest of the result."""
    placed = ordered(rows, ids)
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    fields = ", ".join(f"{n} bigint" for n in names) + ", audit string, repaired_sha256 string"
    schema = T.StructType([T.StructField("conv_id", placed.schema["conv_id"].dataType), *T._parse_datatype_string(fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        report = Report()
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if row["pos"] < 0:
                    report.segment(row)
                elif not row["end"]:
                    report.row(row)
                else:
                    found.append((row["conv_id"], *report.ended(row)))
                    report = Report()
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate(kinds)], names=schema.names)

    from pyspark.sql.pandas.types import to_arrow_type

    kinds = [to_arrow_type(f.dataType) for f in schema]
    together = streamed(placed, audited(placed, size, fan), size)
    return together.repartition("conv").sortWithinPartitions("conv", "seg", "pos").mapInArrow(run, schema)


class Report:
    """What one conversation's rows add up to, row after row."""

    def __init__(self):
        self.repair, self.digest, self.any = Repair(), hashlib.sha256(), False
        self.audit: list[str] = []
        self.cost = self.illegal = self.turns = 0
        self.counts = {"b": 0, "d": 0, "t": 0}
        self.before = self.first = self.last = None

    def segment(self, row: dict) -> None:
        self.repair.segment(row)
        self.audit.append(row["audit"])
        self.cost += row["cost"]
        for code in row["codes"]:
            kind = "t" if code.isupper() else code
            if kind in self.counts:
                self.counts[kind] += 1

    def row(self, row: dict) -> None:
        initial = row["role"][:1]
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        if row["turn"] is not None and row["turn"] != self.last:
            self.first = row["turn"] if self.first is None else self.first
            self.last = row["turn"]
            self.turns += 1
        self.edited(row)

    def edited(self, row: dict) -> None:
        for _, role, text in self.repair.row(row):
            self.digest.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
            self.any = True

    def ended(self, row: dict) -> tuple:
        self.edited(row)
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return gaps, self.counts["b"], self.counts["d"], self.counts["t"], self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest()

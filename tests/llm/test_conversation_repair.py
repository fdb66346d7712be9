"""Repair of conversations against a plain program over all states."""

import hashlib
import random
import re
import zlib

import pytest

from siltworks.llm import conversation_repair as repair
from siltworks.llm.queries import ORACLES, QUERIES

from .helpers import SF, needs_tables

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SPACE = " \t\n\x0b\x0c\r"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def broken(rows):
    """Damage by the stated checksum, plainly."""
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        for _ in range({0: 0, 3: 2}.get(kind, 1)):
            yield conv, turn, "user" if kind == 4 else role, text


def cheapest(rows):
    """(cost, audit, repaired) of (role, text, fault) rows: all ways kept by the state they lead to."""
    best = {"": (0, "", ())}

    def insert(best):
        for _ in range(3):
            for state, (cost, audit, out) in list(best.items()):
                made = "a" if state == "u" else "u"
                one = (cost + 2, audit + "I", out + ({"u": "user:", "a": "assistant:"}[made],))
                if made not in best or one[:2] < best[made][:2]:
                    best[made] = one
        return best

    for role, text, fault in rows:
        after = {}

        def offer(state, one):
            if state not in after or one[:2] < after[state][:2]:
                after[state] = one

        for state, (cost, audit, out) in insert(best).items():
            offer(state, (cost + 3, audit + "D", out))
            if fault not in ("blank", "duplicate"):
                late = fault == "truncated"
                if (state, role[:1]) in NEXT:
                    offer(NEXT[state, role[:1]], (cost + late, audit + "K", (*out, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    if (state, new[0]) in NEXT:
                        offer(new[0], (cost + 2 + late, audit + "R", (*out, f"{new}:{text}")))
        best = after
    return min(x[:3] for s, x in insert(best).items() if s in ("", "a"))


def expected(ids, rows):
    found = []
    for conv in set(ids):
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
        seen, faults, marked = set(), {"blank": 0, "duplicate": 0, "truncated": 0}, []
        for _, _, role, text in own:
            fault = "blank" if not text.strip(SPACE) else "duplicate" if (role, text) in seen else "" if text.strip(SPACE)[-1] in ".!?" else "truncated"
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            marked.append((role, text, fault))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, out = cheapest(marked)
        found.append((conv, gaps, *faults.values(), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()))
    return found


def same(got, rows, want):
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert got.columns == NAMES
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


@needs_tables
def test_query_on_whole_table(spark):
    from checks.compare import differences, duck

    assert differences(QUERIES["op12_conversation_repair"](spark, SF), duck(SF), ORACLES["op12_conversation_repair"]) is None
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    same(QUERIES["op12_conversation_repair"](spark, SF), rows, expected([r[0] for r in rows], list(broken(rows))))


def invented(seed, n=400):
    rng = random.Random(seed)
    roles = ["user", "user", "assistant", "assistant", "system", "tool", "", None, "umpire"]
    texts = ["Yes.", "No!", "Why?", "cut", "", " \n", "Ends. ", "東京", None, "é."]
    rows = [(rng.choice([1, 2, 3, None, -5]), rng.choice([None, *range(30)]), rng.choice(roles), f"{rng.choice(texts) or ''}{rng.choice(['', rng.randint(0, 20)])}") for _ in range(n)]
    return rows + [(7, 0, "user", None), (8, None, None, None), (2**62, 2**40, "assistant", "x." * 50_000), rows[0], rows[0]]


@pytest.mark.parametrize("size, fan", [(128, 64), (4, 2), (1, 3)])
def test_segments_and_levels(spark, size, fan):
    rows = invented(size)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS seg", "'y' AS code", "1 AS n")
    same(repair.reports(repair.damaged(df), df, size, fan), rows, expected([r[0] for r in rows], list(broken(rows))))


def test_one_long_conversation_over_tasks(spark):
    rng = random.Random(3)
    rows = [(1, i, rng.choice(["user", "assistant", "system"]), f"{rng.choice(['a.', 'b', ''])}{rng.randint(0, 900)}") for i in range(3000)]
    plain = [(c, t, r, x) for c, t, r, x in rows]
    same(repair.reports(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(rows, SCHEMA), 32, 8), rows, expected([1], plain))


def test_auction_proves_its_cost():
    rng = random.Random(9)
    for _ in range(300):
        codes = "".join(rng.choice("bdsuaoSUAO") for _ in range(rng.randint(0, 12))) + "$"
        arcs, prices = repair.row_lattice(codes)
        target = len(arcs) - repair.STATES
        cost = repair.auction(arcs, prices, 0, target)
        assert all(prices[i] <= c + prices[j] for i, here in enumerate(arcs[:-4]) for _, c, j in here)
        path = repair.traced(arcs, prices, 0, target)
        fault = {"b": "blank", "d": "duplicate"}
        marked = [(c.lower(), "", fault.get(c, "truncated" if c.isupper() else "")) for c in codes[:-1]]
        assert (cost, "".join(a[0] for a in path)) == cheapest(marked)[:2]


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "There."), (1, 2, "assistant", ""), (None, None, "assistant", "Yes.")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = [(r["conv_id"], r["role"], r["text"], r["edit"]) for r in repair.repaired(df).orderBy("conv_id", "place").collect()]
    assert got == [(None, "user", "", "I"), (None, "assistant", "Yes.", "K"), (1, "user", "Hi.", "K"), (1, "assistant", "There.", "R")]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert repair.reports(repair.damaged(df), df).collect() == [] and repair.repaired(df).collect() == []

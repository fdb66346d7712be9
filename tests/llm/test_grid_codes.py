"""Vector codes against plain integers, and that cells leave out only dominated entries."""

import hashlib
import math
import random

import numpy as np
import pytest

from siltworks.llm import grid_codes as codes
from siltworks.llm.queries import ORACLES, QUERIES

from .helpers import SF, needs_tables

SCHEMA = "vec_id bigint, embedding array<double>, label int"
MOST = (1 << 63) - 1


def expected(rows, parts=8, entries=16, rounds=6):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x * 4096) for x in r[1])]
    length = -(-max((len(r[1]) for r in kept), default=0) // parts)
    kept = [(i, [math.floor(x * 4096) for x in v] + [0] * (parts * length - len(v)), label) for i, v, label in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = lambda v, p: v[p * length : (p + 1) * length]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]

    def nearest(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(entry, cut(v, p))), e) for e, entry in enumerate(books[p]))

    for _ in range(rounds):
        found = []
        for p in range(parts):
            own = [[] for _ in books[p]]
            for _, v, _ in kept:
                own[nearest(p, v)[1]].append(cut(v, p))
            found.append([[sum(c) // len(group) for c in zip(*group)] if group else old for group, old in zip(own, books[p])])
        books = found
    rows = []
    for i, v, label in kept:
        best = [nearest(p, v) for p in range(parts)]
        rows.append((i, "".join(f"{e:02x}" for _, e in best), min(sum(d for d, _ in best), MOST), label))
    totals = {}
    for r in rows:
        totals[r[3]] = totals.get(r[3], 0) + r[2]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((r[0], r[1], r[2], min(totals[r[3]], MOST)) for r in rows), key=str), digest


def got(df, **kw):
    found = codes.compress(df, **kw)
    rows = codes.label_errors(found.coded).select("vec_id", "code", "error", "label_error").collect()
    return sorted(map(tuple, rows), key=str), found.digest()


@needs_tables
def test_query_and_sql_on_whole_tables(spark):
    from checks.compare import differences, duck

    assert differences(QUERIES["op11_vector_codes"](spark, SF), duck(SF), ORACLES["op11_vector_codes"]) is None


def awkward(n=120, length=16, scale=0.2):
    rng = random.Random(n + length)
    vector = lambda: [rng.gauss(0, scale) for _ in range(length)]
    rows = [(rng.randint(-50, 50), vector(), rng.choice([None, 1, 2])) for _ in range(n)]
    rows += [rows[0], rows[0], (5, None, 1), (6, [None, *vector()[1:]], 1), (7, [math.nan, *vector()[1:]], 1), (8, [math.inf, *vector()[1:]], 2), (None, vector(), None)]
    return rows


@pytest.mark.parametrize(
    "rows, kw",
    [
        (awkward(), {}),
        (awkward(40, 13), {}),
        (awkward(30, 16)[:9], {}),
        (awkward(50, 16) + [(1, [0.5] * 5, 2), (2, [], 3)], {}),
        (awkward(60, 8, 1e30) + awkward(20, 8), {}),
        ([(i, [1e303, -1e303, 0.0] * 3, 1) for i in range(3)] + [(4, [1e305, 0.0], 1)] + awkward(20, 9), {}),
        (awkward(80, 12), {"parts": 3, "entries": 5, "rounds": 2}),
        ([(i, [], 1) for i in range(3)], {}),
        ([(i, [0.25] * 8, 1) for i in range(40)], {}),
    ],
)
def test_against_plain_integers(spark, rows, kw):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS code", "1 AS part", "2 AS v")
    assert got(df, **kw) == expected(rows, **kw)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert got(df) == ([], hashlib.sha256(b"").hexdigest())


def test_cells_leave_out_only_dominated_entries(monkeypatch):
    rng = np.random.default_rng(1)
    points = rng.integers(-3000, 3000, (4000, 4))
    book = tuple(tuple(int(x) for x in p) for p in points[:16])
    for bound in (codes.CACHED_CELLS, 10):
        monkeypatch.setattr(codes, "CACHED_CELLS", bound)
        grid = codes.Grid((book,))
        for low in range(0, 4000, 500):
            entries, least = grid.nearest(0, points[low : low + 500])
            plain = ((points[low : low + 500, None, :] - np.array(book)) ** 2).sum(axis=2)
            assert (entries == plain.argmin(axis=1)).all() and (least == plain.min(axis=1)).all()
        assert grid.evaluated < 16 * grid.parts * 0.8


def test_equal_hashes_of_other_cells(monkeypatch):
    """With all hashes equal, parts of other cells than the remembered one are compared with every entry."""
    points = np.random.default_rng(2).integers(-3000, 3000, (500, 4))
    book = tuple(tuple(int(x) for x in p) for p in points[:16])
    grid = codes.Grid((book,))
    monkeypatch.setattr(codes.np.random, "default_rng", lambda _: type("R", (), {"integers": staticmethod(lambda *a: np.zeros(4, np.uint64))})())
    entries, _ = grid.nearest(0, points)
    plain = ((points[:, None, :] - np.array(book)) ** 2).sum(axis=2)
    assert (entries == plain.argmin(axis=1)).all()


def test_decoded(spark):
    rows = awkward(40, 16)
    found = codes.compress(spark.createDataFrame(rows, SCHEMA), rounds=1)
    for r in codes.decoded(found).collect():
        parts = [found.codebooks[p][int(r["code"][2 * p : 2 * p + 2], 16)] for p in range(8)]
        assert np.allclose(r["approximate"], np.concatenate(parts) / 4096)


def test_limbs():
    for x in (0, 1, -1, 2**40, -(2**40) - 5, 3**200, -(7**99)):
        assert sum(d << (40 * i) for i, d in enumerate(codes.limbs(x))) == x

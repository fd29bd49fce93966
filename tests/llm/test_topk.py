import math
import random

import numpy as np
import pytest

from stepledger.llm import topk


def brute(rows, k=5, every=50):
    """Every row is a candidate, and a query of its own."""
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (q, a) in enumerate(good):
        if q is None or q % every:
            continue
        scores = sorted((-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b)))), i is None, i or 0) for m, (i, b) in enumerate(good) if m != n and len(b) == len(a))
        out += [(q, n + 1, None if none else i, -s) for n, (s, none, i) in enumerate(scores[:k])]
    return sorted(out, key=str)


def run(spark, rows, **kw):
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, rank int, score int").repartition(5)
    return sorted((tuple(r) for r in topk.search(frame, **kw).collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(400)]  # scores reach beyond a million
    rows += [(i, rows[50][1]) for i in range(400, 480)]  # many equal scores
    rows += [(500, None), (501, [1.0, None] + [0.0] * 6), (502, [float("nan")] * 8), (503, [float("inf")] + [0.0] * 7), (None, [1.0] * 8), (7, [0.0] * 8), (7, [0.0] * 8), (100, [3.0] * 8), (100, [-3.0] * 8), (9, [9.0] * 8), (9, [8.0] * 8), (None, [0.0] * 8), (550, [1.0, 2.0]), (600, []), (601, [])]
    return rows


def test_matches_brute_force(spark, rows):
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("seed", range(6))
def test_bins_find_the_kth_values(seed):
    """Rounds of histograms against sorting, without Spark, over parts of the vectors."""
    rng = np.random.default_rng(seed)
    v = np.floor(256 * rng.normal(0, rng.choice([0.1, 0.3, 1.0, 3e6]), (500, 64)))
    v[100:160] = v[50]
    parts = [topk.Part(np.arange(a, a + 125), np.arange(a, a + 125), v[a : a + 125]) for a in range(0, 500, 125)]
    row = np.arange(0, 500, 50)
    bound = min(int((np.abs(v) + 1).__pow__(2).sum(axis=1).max()) + 1, 2**63)
    low, need, bits = np.full(10, max(-bound, -(2**63))), np.full(10, 5), min(2 * bound, 2**64 - 1).bit_length()
    while bits:
        shift = max(0, bits - topk.BIN_BITS)
        queries = topk.Part(row, row, v[row], low=low, need=need)
        total = np.zeros((10, 1 << (bits - shift)), dtype=np.int64)
        for part in parts:
            q, b, n = topk.bin_counts(queries, part, shift, 1 << (bits - shift))
            np.add.at(total, (q, b), n)
        above = np.cumsum(total[:, ::-1], axis=1)[:, ::-1]
        at = np.array([np.flatnonzero(above[q] >= need[q])[-1] for q in range(10)])
        need = need - (above - total)[np.arange(10), at]
        low, bits = low + (at << shift), shift
    ints = [[int(x) for x in r] for r in v]
    for q, least in zip(row, low, strict=True):
        found = sorted((max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(ints[q], ints[i], strict=True)))) for i in range(500) if i != q), reverse=True)
        assert least == found[4]


def test_plan_does_not_grow_with_queries(spark, rows):
    def size(every):
        frame = spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<double>")
        return len(topk.search(frame, every=every, block_queries=2)._jdf.queryExecution().optimizedPlan().toString().split("\n"))

    assert size(1) == size(50)


def test_sql_gives_the_same_rows(spark, rows):
    import duckdb
    import pyarrow as pa

    some = [(i, v) for i, v in rows if v is None or len(v) == 8]
    con = duckdb.connect()
    con.register("embeddings", pa.table({"vec_id": pa.array([i for i, _ in some], pa.int64()), "embedding": pa.array([v for _, v in some], pa.list_(pa.float64()))}))
    assert sorted(con.execute(topk.ORACLE_SQL).fetchall(), key=str) == brute(some)


def test_blocks_of_queries_and_few_candidates(spark, rows):
    assert run(spark, rows, block_queries=3) == brute(rows)
    assert run(spark, rows[:4]) == brute(rows[:4])
    assert run(spark, rows[:1]) == brute(rows[:1]) == []


def test_huge_components(spark):
    rows = [(i, [x, 1.0, -x]) for i, x in enumerate([1e4, -3e9, 5e16, 1e30, -1e30, 2e9, 7.0])]
    assert run(spark, rows, every=1, k=3) == brute(rows, every=1, k=3)


def test_floats_and_empty_table(spark):
    frame = spark.createDataFrame([(0, [0.1, -0.1]), (1, [0.3, 0.7])], "vec_id long, embedding array<float>")
    import struct

    def f(x):
        return struct.unpack("f", struct.pack("f", x))[0]

    rows = [(0, [f(0.1), f(-0.1)]), (1, [f(0.3), f(0.7)])]
    assert [tuple(r) for r in topk.search(frame).collect()] == brute(rows)
    out = topk.search(frame.limit(0))
    assert out.count() == 0 and out.columns == ["query_id", "rank", "vec_id", "score"]

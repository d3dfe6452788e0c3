"""Exact top-k search (op1) against a plain ranking."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from accmine.llm import topk_search as T
from accmine.llm.queries import QUERIES


def plain(rows, is_query, k):
    ok = [(i, [math.floor(64 * float(c)) for c in v]) for i, v in rows
          if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for q, a in ok:
        if is_query(q):
            score = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(score)]
    return sorted(out)


def run(spark, rows, k=20, **kw):
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, e array<float>, score int, v int")
    return sorted(tuple(r) for r in T.top_k(df, "vec_id", "e", F.col("id") % 5 == 0, k, **kw)
                  .select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("kw", [{}, {"query_block": 3, "candidate_block": 17}, {"query_block": 7, "candidate_block": 40}])
def test_equals_plain_ranking(spark, kw):
    rng = np.random.default_rng(4)
    scale = np.exp(rng.normal(size=(120, 1)))                        # lengths differ, so slices are pruned
    v = (rng.normal(size=(120, 20)) * scale).astype(np.float32)
    v[30:60] = v[30]                                                 # one common vector: ties go to the smaller id
    rows = [(int(i), [float(c) for c in x]) for i, x in enumerate(v)]
    assert run(spark, rows, 7, **kw) == plain(rows, lambda q: q % 5 == 0, 7)


def test_block_prunes_and_stays_exact():
    rng = np.random.default_rng(6)
    x = np.floor(rng.normal(size=(5000, 24)) * np.linspace(30, 0.5, 24) * np.exp(rng.normal(size=(5000, 1)))).astype(np.int64)
    q = x[::500]
    axes = np.linalg.eigh(x.T.astype(float) @ x)[1][:, ::-1]
    r, i, s = T.block_top_k(np.arange(0, 5000, 500), q, np.arange(5000), x, axes, 9, slice_rows=256, steps=(4, 8))
    for k in range(len(q)):
        score = x @ q[k]
        order = [j for j in np.lexsort((np.arange(5000), -score)) if j != k * 500][:9]
        assert i[r == k].tolist() == order and s[r == k].tolist() == score[order].tolist()


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (5, [0.5]), (5, [0.5]), (10, []), (1, None), (2, [float("nan"), 1.0]), (3, [float("inf")]),
            (4, [None, 1.0]), (None, [1.0]), (6, [-1.0, 0.25, 3.0]), (7, [1e30])]
    ok = [r for r in rows if r[0] in (0, 5, 10, 6)]
    got = run(spark, rows, 3)
    assert [g for g in got if g[0] in (0, 10)] == [p for p in plain(ok, lambda q: q in (0, 10), 3)]
    # each of the two equal query rows gets its own ranking
    assert [g for g in got if g[0] == 5] == sorted(2 * [p for p in plain(ok[:2] + ok[3:], lambda q: q == 5, 3)])
    assert run(spark, rows[:1]) == [] and run(spark, []) == [] and run(spark, [(1, [1.0]), (2, [1.0])]) == []


def test_query_returns_twenty_each(spark, sf_dir):
    rows = QUERIES["op1_topk_search"](spark, sf_dir).collect()
    table = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in rows) == plain(table, lambda q: q % 20 == 0, 20)


def test_long_vectors_score_exactly_as_far_as_a_long_goes(spark):
    big = [(0, [4e7, 0.0]), (5, [2.0, 0.0]), (10, [2.0 ** 57 - 2.0 ** 34, 1.0]), (11, [-2.0 ** 56, 3.0]), (12, [2.0 ** 40, -5.5]), (13, [1e30, 0.0]), (15, [0.25, 2.0 ** 50]),
           (16, [2.0 ** 57, 0.0]), (17, [-2.0 ** 57, 0.0])]
    fit = [(i, v) for i, v in big if i not in (13, 16)]           # a component of 2^63 does not fit, -2^63 neither: its size is refused
    want = [w for w in plain([r for r in fit if r[0] != 17], lambda q: q % 5 == 0, 99) if -(2 ** 63) <= w[3] < 2 ** 63]
    ranks = {}
    ranked = []
    for q, _, i, s in want:
        ranks[q] = ranks.get(q, 0) + 1
        ranked.append((q, ranks[q], i, s))
    got = run(spark, big, 99)
    assert got == ranked and (0, 1, 5, 327_680_000_000) in [(q, 1, i, s) for q, _, i, s in got if q == 0 and i == 5]
    assert run(spark, big, 2, query_block=2, candidate_block=3) == [r for r in ranked if r[1] <= 2]


def test_short_candidates_are_not_sent(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(2000, 8)) * np.exp(-np.arange(2000) / 150)[:, None]          # lengths fall off quickly
    rows = [(int(i), [float(np.float32(c)) for c in x]) for i, x in enumerate(v)]
    assert run(spark, rows, 5, query_block=50, candidate_block=100) == plain(rows, lambda q: q % 5 == 0, 5)
    longest = np.array([9.0, 4.0, 1.0, 0.5])
    import pyarrow as pa
    b = pa.RecordBatch.from_pydict({"row": [1, 2, 3, 4], "least": pa.array([8, None, -5, 100], pa.int64()), "len": [2.0, 2.0, 2.0, 2.0]})
    assert next(T._reach(longest)([b])).column("reach").to_pylist() == [1, 3, 3, -1]

"""Mixing: quotas against the one-seat-at-a-time definition, targets against repeated resharing, odd tables against SQL."""

import random

import duckdb
import pytest

from accmine.llm import mixing
from accmine.llm.queries import QUERIES, SQL


def write(spark, tmp_path, name, rows, schema):
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")


def seats_one_by_one(weights, caps, seats):
    won = [0] * len(weights)
    for _ in range(seats):
        best = max((w / (2 * s + 1), -k) for k, (w, s, c) in enumerate(zip(weights, won, caps)) if s < c and w > 0)
        won[-best[1]] += 1
    return won


def test_quotas_follow_the_highest_quotients(spark):
    rnd = random.Random(3)
    groups, rows = {}, []
    for g in range(12):
        n = rnd.choice([1, 2, 5, 30])
        weights = [rnd.choice([0, 1, 3, 7, rnd.randrange(1, 4000), 10 ** 6]) for _ in range(n)]
        if not any(weights):
            weights[0] = 5
        seats = rnd.choice([0, 1, n // 2, n, 3 * n, 1000])
        caps = [rnd.choice([seats, seats, seats + 5])] * n
        groups[f"g{g}"] = seats_one_by_one(weights, caps, seats)
        rows += [(f"g{g}", k, w, c, seats) for k, (w, c) in enumerate(zip(weights, caps))]
    df = spark.createDataFrame(rows, "g string, k long, w long, c long, s long")
    got = {(r.g, r.k): r.quota for r in mixing.sainte_lague(df, ["g"], ["k"], "w", "c", "s").collect()}
    assert got == {(g, k): q for g, won in groups.items() for k, q in enumerate(won)}


def test_a_full_party_gets_its_cap_and_no_more(spark):
    df = spark.createDataFrame([("a", 100, 4, 20), ("b", 50, 40, 20), ("c", 0, 9, 20)], "k string, w long, c long, s long")
    got = {r.k: r.quota for r in mixing.sainte_lague(df, [], ["k"], "w", "c", "s").collect()}
    assert got["a"] == 4 and got["c"] == 0 and got["b"] <= 20


def reshared(sizes, weights, mix, most):
    """Targets by the plain rule: share by weight, stop who is above, reshare, until none is above."""
    full = set()
    while True:
        left = mix - sum(most * sizes[k] for k in full)
        weight = sum(w for k, w in enumerate(weights) if k not in full)
        share = [most * sizes[k] if k in full else left * w / weight for k, w in enumerate(weights)]
        above = {k for k in range(len(sizes)) if share[k] > most * sizes[k]} - full
        if not above:
            return share
        full |= above


@pytest.mark.parametrize("sizes", [[10, 20, 30, 1000], [5, 5, 5], [0, 0, 7, 1], [1, 10, 100, 1000, 10000, 100000], [3]])
def test_targets_are_reshared_until_none_is_above(spark, sizes):
    df = spark.createDataFrame([(f"0s{k}", s) for k, s in enumerate(sizes)], "key string, source_size long")
    got = {r.key: r.target for r in mixing.targets(df).collect()}
    want = reshared(sizes, [mixing.WEIGHTS[k % 3] for k in range(len(sizes))], 1.5 * sum(sizes), 2)
    for k, t in enumerate(want):
        assert got[f"0s{k}"] == pytest.approx(t, rel=1e-12, abs=1e-12)


def test_odd_tables_equal_the_sql(spark, tmp_path):
    rnd = random.Random(1)
    docs = [(k, " ".join("w" * rnd.randrange(1, 9) for _ in range(rnd.randrange(0, 300))), rnd.choice(["a", "b", "b", "b", "é", None]))
            for k in range(150)]
    docs += [(7, None, "a"), (7, None, "a"), (None, "no id here", "z"), (None, "", None), (900, "x y " * 40_000, "long"),
             (901, "\t nbsp is\u000bno space   here\n", ""), (902, "same row", "b"), (902, "same row", "b")]
    write(spark, tmp_path, "documents", [(*d, 1) for d in docs], "doc_id long, text string, source string, size long")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(SQL["op12_mix_sources"]).fetchall()
    got = [tuple(r) for r in QUERIES["op12_mix_sources"](spark, str(tmp_path)).collect()]
    key = lambda r: tuple("" if v is None else str(v) for v in r)
    assert sorted(got, key=key) == sorted(want, key=key) and len(got) == len(docs)
    assert all(0 <= r[4] <= 2 * r[1] for r in got)


def test_words_taken_come_near_the_targets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mixed = mixing.mix_sources(docs).join(docs.select("doc_id", "source"), "doc_id")
    again = {r.doc_id: r.taken for r in mixing.mix_sources(docs.repartition(9)).collect()}
    by = {}
    for r in mixed.collect():
        by.setdefault(r.source, [r.target, r.source_size, 0])[2] += r.taken
        assert again[r.doc_id] == r.taken <= 2 * r.size
    words = sum(b[1] for b in by.values())
    assert sum(b[0] for b in by.values()) == pytest.approx(1.5 * words)
    for target, size, taken in by.values():
        assert target <= 2 * size and abs(taken - target) <= max(0.01 * target, 2 * mixing.BLOCK_WORDS)


def test_a_hot_source_is_cut_into_shards(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat('word ', cast(id % 50 AS int)) AS text",
                                        "if(id % 3 < 2, 'hot', concat('s', id % 5)) AS source")
    few = mixing.mix_sources(docs, shard_docs=100).collect()
    hot = [r for r in few if r.source_size == max(x.source_size for x in few)]
    assert abs(sum(r.taken for r in hot) - hot[0].target) <= 0.01 * hot[0].target and len(few) == 3000


def test_no_documents_and_no_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix_sources(empty).collect() == []
    blank = spark.createDataFrame([(1, " ", "a"), (2, None, None)], empty.schema)
    assert sorted(tuple(r) for r in mixing.mix_sources(blank).collect()) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]

"""Filter audit: the min-plus figures against filters applied one after another, whole tables against SQL."""

import random
from itertools import permutations

import duckdb
import numpy as np

from accmine.llm import filter_audit
from accmine.llm.queries import QUERIES, SQL


def by_hand(masks, n):
    """Apply the filters one after another to a list of (mask, good, toxic)."""
    out, removed_by = {}, [0] * n
    for order in permutations(range(n)):
        left = list(masks)
        for step, f in enumerate(order, 1):
            gone = [m for m in left if m[0] >> f & 1]
            left = [m for m in left if not m[0] >> f & 1]
            failing = sum(m[0] >> f & 1 for m in masks)
            removed_by[f] += len(gone)
            out[order, step] = [len(left), len(gone), failing - len(gone), sum(m[0] == 1 << f for m in masks),
                                sum(m[1] for m in gone), sum(m[2] for m in gone)]
    return {k: v + [removed_by[k[0][k[1] - 1]]] for k, v in out.items()}


def test_every_order_and_step():
    rnd = random.Random(5)
    for n in (1, 3, 5):
        masks = [(rnd.randrange(1 << n), rnd.random() < 0.3, rnd.random() < 0.2) for _ in range(200)]
        table = np.zeros((1 << n, 3), np.int64)
        for m in masks:
            table[m[0]] += [1, m[1], m[2]]
        ranked = filter_audit.removal_ranks(n)
        got, want = filter_audit.audit_part(table, ranked), by_hand(masks, n)
        for k, order in enumerate(map(tuple, ranked[0].tolist())):
            for step in range(1, n + 1):
                assert [v[k, step - 1] for v in got.values()] == want[order, step]


def test_no_counts_give_zeros():
    got = filter_audit.audit_part(np.zeros((8, 3), np.int64), filter_audit.removal_ranks(3))
    assert all(not v.any() and v.shape == (6, 3) for v in got.values())


def test_odd_tables_equal_the_sql(spark, tmp_path):
    rnd = random.Random(2)
    words = ["alpha", "beta", "Gamma", "DELTA", "x", "y#"]
    texts = [" ".join(rnd.choice(words[:rnd.randrange(1, 7)]) for _ in range(rnd.choice([0, 3, 199, 200, 400]))) for _ in range(40)]
    docs = [(k, rnd.choice(texts), rnd.choice(["a", "a", "b", None, ""])) for k in range(160)]
    docs += [(None, texts[0], "a"), (None, texts[0], "a"), (3, texts[1], "b"), (3, texts[1], "c"), (500, None, "a"), (501, "", "a"),
             (502, "Long " * 50_000, "b"), (503, "ÀÉ É Ü ab c d", "b"), (504, "A" * 51 + "b" * 2449, "b"), (505, "A" * 50 + "b" * 2450, "b")]
    spark.createDataFrame([(*d, "junk") for d in docs], "doc_id long, text string, source string, part string").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(k, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for k in range(0, 170, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (9999, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    got = sorted(tuple(r) for r in QUERIES["op13_filter_audit"](spark, str(tmp_path)).collect())
    assert got == sorted(con.execute(SQL["op13_filter_audit"]).fetchall()) and len(got) == 4 * 600


def test_no_documents_and_no_labels(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit_filters(docs, labels).collect() == []
    one = spark.createDataFrame([(1, "a b", None)], docs.schema)
    rows = filter_audit.audit_filters(one, labels).collect()
    assert len(rows) == 600 and {r.part for r in rows} == {""}
    assert {(r.filter_order[r.step - 1], r.shapley) for r in rows} == {("A", 120), ("B", 0), ("C", 0), ("D", 0), ("E", 0)}

"""Context-tree weighting (op9) against its definition, evaluated node by node."""

import functools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from accmine.llm import ctw as W
from accmine.llm.queries import QUERIES


class Plain:
    """The mixture by its recursive definition, over dictionaries."""

    def __init__(self, train, depth):
        self.depth, self.count = depth, {}
        for t in train:
            for ctx, path in self.steps(t):
                for so_far, bit in path:
                    for d in range(depth + 1):
                        self.count.setdefault((ctx[depth - d:], so_far), [0, 0])[bit] += 1
        self.children = {}
        for c, p in self.count:
            if c:
                self.children.setdefault((c[1:], p), []).append((c, p))
        self.weighted = functools.cache(self._weighted)

    def steps(self, text):
        s = b"\xff" * self.depth + text.translate(W.LOWER_AZ) + b"\xff"
        for i in range(self.depth, len(s)):
            yield s[i - self.depth:i], [((1 << j) | (s[i] >> (8 - j)), s[i] >> (7 - j) & 1) for j in range(8)]

    def kt(self, node):
        a, b = self.count[node]
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def _weighted(self, node):
        if len(node[0]) == self.depth:
            return self.kt(node)
        longer = sum(map(self.weighted, self.children[node]))
        return math.log(.5) + float(np.logaddexp(self.kt(node), longer))

    def score(self, text):
        total = 0.0
        for ctx, path in self.steps(text):
            for so_far, bit in path:
                p, rest = 0.0, 1.0
                for d in range(self.depth + 1):
                    node = (ctx[self.depth - d:], so_far)
                    if node not in self.count:
                        break
                    share = 1.0 if d == self.depth else math.exp(math.log(.5) + self.kt(node) - self.weighted(node))
                    a, b = self.count[node]
                    p += rest * share * (b + .5) / (a + b + 1)
                    rest *= 1 - share
                p += rest / 2
                total += math.log10(p if bit else 1 - p)
        return total


def base(train, text):
    split = lambda t: t.translate(W.LOWER_AZ).split() + [None]
    count = {}
    for t in train:
        for w in split(t):
            count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    toks = split(text)
    return len(toks), sum(w in count for w in toks), n, sum(math.log10((count.get(w, 0) + 1) / (n + v + 1)) for w in toks)


def sample(seed, n=40):
    rng = random.Random(seed)
    syl = ["ba", "Do", "é", "ti ", "k", " ", "\n", "zu"]
    return [(i, "".join(rng.choices(syl, k=rng.randint(0, 25)))) for i in range(n)]


@pytest.mark.parametrize("depth, kw", [
    (2, {}), (5, {"buckets": 3}), (3, {"block_bytes": 64}), (2, {"cell_entries": 5, "block_bytes": 64, "group_lists": 2}),
    (4, {"cell_entries": 5, "buckets": 3}), (5, {"cell_entries": 20, "block_bytes": 16, "group_lists": 2, "buckets": 5})])
def test_scores_equal_the_definition(spark, depth, kw):
    rows = sample(depth) + [(100, None), (101, ""), (3, "ba ba"), (102, "ÿ\x00 never seen"), (None, "ba Do"), (103, "zu " * 2000)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, block string, train int")
    learned = [(t or "").encode() for i, t in rows if i is not None and i % 3]
    model = Plain(learned, depth)
    got = W.score_documents(df, F.col("doc_id") % 3 != 0, depth=depth, **kw).collect()
    assert len(got) == len(rows)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append((t or "").encode())
    for r in got:
        options = []
        for t in texts[r.doc_id]:
            n, known, total, b = base(learned, t)
            options.append((n, known, total, round(b, 8), round(model.score(t), 3)))
        assert (r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 8), round(r.score, 3)) in options
        assert r.train == (r.doc_id is not None and r.doc_id % 3 != 0)


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "ab c"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: (r.n_tokens, r.n_known, r.train_tokens, r.base_score, round(r.score, 5))
           for r in W.score_documents(df, F.lit(False)).collect()}
    half = 8 * math.log10(0.5)
    assert got == {1: (3, 0, 0, 0.0, round(5 * half, 5)), 2: (1, 0, 0, 0.0, round(half, 5))}
    assert W.score_documents(df.where("false"), F.lit(True)).count() == 0


def test_cells_split_hot_context():
    """All strings of one bucket: cells by the third byte hold whole subtrees, words go by hash."""
    third = np.arange(256, dtype=np.int64)
    keys = (third << 24) | (0x6162 << 8) | 0x63
    assert len(set(W.context_bucket(keys, 256).tolist())) == 1
    assert (W.cells_of(W.GRAM, keys, 256) == third).all()
    words = [b"w%d" % i for i in range(1000)]
    assert np.bincount(W.cells_of(W.WORD, words, 4)).min() > 150


def test_many_lists_meet_in_small_groups(spark, tmp_path, monkeypatch):
    """No group sums more lists than its size asks for, and a group is sent what it asked for: no explode of the model."""
    plans = []
    kept = W.staged
    monkeypatch.setattr(W, "staged", lambda df, name, **kw: plans.append(name) or kept(df, name, **kw))
    df = spark.range(64, numPartitions=16).selectExpr("id as doc_id", "concat('ba zu ', id) as text")
    out = W.score_documents(df, F.lit(True), group_lists=4)
    assert plans.count("ctw-sums") == 2 and plans.count("ctw-cells") == 1
    assert len({r.train_tokens for r in out.collect()}) == 1
    assert out.count() == 64


def test_hash_table_finds_every_key():
    keys = np.unique(np.random.default_rng(1).integers(0, 2 ** 48, 5000))
    t = W.HashTable(keys)
    assert (t.find(keys[::-1]) == np.arange(len(keys))[::-1]).all()
    assert len(W.HashTable(keys[:0]).find(keys[:0])) == 0


def test_packed_lists_round_trip():
    keys = np.sort(np.random.default_rng(2).integers(0, 2 ** 48, 100))
    for k, v in ((keys, np.arange(100)), (keys[:0], np.zeros(0, np.int64)), (keys, np.linspace(-9, 0, 100).astype(np.float32)),
                 ([b"a", "é".encode()], np.array([3, 2 ** 40])), ([], np.zeros(0, np.int64))):
        got_k, got_v = W.unpack(W.pack(k, v))
        assert list(got_k) == list(k) and got_v.tolist() == v.tolist() and got_v.dtype == v.dtype


def test_log_gamma():
    n = np.array([0, 1, 5, 255, 256, 257, 10 ** 6])
    for shift, table in ((0.5, W._LG_HALF), (1.0, W._LG_ONE)):
        assert np.allclose(W._lgamma(n, shift, table), [math.lgamma(x + shift) for x in n.tolist()], rtol=1e-13)


def test_query(spark, sf_dir):
    rows = QUERIES["op9_ctw_score"](spark, sf_dir).collect()
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    train = [t.encode() for i, t in text.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    assert len(rows) == len(text)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
    for r in rows[:20]:
        n, known, total, b = base(train, text[r.doc_id].encode())
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total) and math.isclose(r.base_score, b, rel_tol=1e-12)

"""Toxicity (op2), quality (op6) and license scans (op8): parts, held-out accuracy, odd tables."""

import json
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from accmine.llm import license_scan as L
from accmine.llm import quality as Q
from accmine.llm import toxicity as T
from accmine.llm.common import crc_mod
from accmine.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def held_out(spark, name, label, mod, rest):
    got = {r.doc_id: r for r in QUERIES[name](spark, SF).collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % mod == rest) for r in got.values())
    lab = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    pairs = [(got[i].predicted, got[i].score, y) for i, y in lab.items() if got[i].held_out]
    return np.array(pairs)


def test_toxicity_held_out(spark):
    p = held_out(spark, "op2_toxicity", "toxic", 3, 1)
    assert (p[:, 0] == p[:, 2]).mean() >= 0.93
    assert (p[:, 0] == (p[:, 1] >= 0.7)).all()


def test_quality_held_out(spark):
    p = held_out(spark, "op6_quality", "quality", 5, 0)
    assert (p[:, 0] == p[:, 2]).mean() >= 0.95
    assert p[p[:, 2] == 1, 0].mean() >= 0.98          # clean documents stay


def test_label_model_learns_accuracies_and_discounts_repeats():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.2
    good = [np.where(rng.random(4000) < a, np.where(y, 1, -1), np.where(y, -1, 1)) for a in (0.9, 0.85, 0.8)]
    noise = rng.choice([-1, 0, 1], 4000)
    votes = np.column_stack([*good, noise, *[noise] * 5]).astype(np.int8)      # six copies of a useless voter
    seen = np.where(rng.random(4000) < 0.1, ~y, y)
    p = T.label_model(votes, seen)
    assert ((p > 0.5) == y).mean() > 0.93


def test_lexicon_words_decide_before_beginnings():
    lex = T.group_lexicons([("foobar", 9, 0), ("foob*", 8, 1), ("xyz*", 20, 0)])
    assert lex == {"foobar": 1, "foob*": 1, "xyz*": 0}
    assert T.lexicon_of(b"foobaz", lex) == 1 and T.lexicon_of(b"xyz", lex) == -1 and T.lexicon_of(b"xyzz", lex) == 0
    x = T.features(["Foobar xyzz, XYZZ!", "", "clean"], lex, 2, {})
    assert x.tolist() == [[2, 1, 3, 2, 3], [0, 0, 0, 0, 0], [0, 0, 0, 0, 1]]


ODD = [(1, "fine words here and there", "k"), (2, None, "k"), (3, "", "k"), (3, "", "k"), (None, "fine", "k"), (4, "bad " * 4000, "k")]


@pytest.mark.parametrize("mod, label", [(T, "toxic"), (Q, "quality")])
def test_odd_tables(spark, mod, label):
    docs = spark.createDataFrame(ODD, "doc_id long, text string, label string")
    kind = f"doc_id long, {label} int, text int"
    lab = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (4, 0, 0), (None, 1, 0), (77, 1, 0), (2, None, 0)], kind)
    for rows in (lab, lab.where("false"), lab.where("doc_id = 4")):
        model = mod.train_model(docs, rows, F.lit(True), label)
        got = mod.score_documents(docs, model).collect()
        assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got) and got[0].label == "k"
        assert len({r.score for r in got if not r.text}) == 1
    assert mod.score_documents(docs.where("false"), model).count() == 0


def test_sample_is_bounded_and_leaves_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    n = labels.where(crc_mod("doc_id", 3) != 1).count()
    assert T.labelled_sample(docs, labels, "toxic", crc_mod("doc_id", 3) != 1, "doc_id", "text", 10 ** 6).count() == n
    assert T.labelled_sample(docs, labels, "toxic", F.lit(True), "doc_id", "text", 50).count() == 50


def test_votes_tie_and_weigh_by_similarity():
    texts = ["aa bb cc"] * 3 + ["1 | 2 | 3 |"] * 3
    x = Q.term_shares(texts, {})
    model = Q.fit(x, np.array([1, 1, 0, 0, 0, 0], np.float32))
    s = Q.vote(Q.term_shares(["dd ee ff", "7 | 8 | 9 |", ""], {}), model, neighbours=1)
    assert s[0] == pytest.approx(2 / 3) and s[1] == pytest.approx(0) and s[2] == pytest.approx(1 / 3)


def test_two_models_in_one_session_do_not_mix(spark):
    docs = spark.createDataFrame([(k, f"{'badword ' * 3 if k % 2 else 'goodword '} and {'nicely ' * 3 if k % 3 else 'rudeword ' * 3} said") for k in range(240)],
                                 "doc_id long, text string")
    lab = lambda m: docs.selectExpr("doc_id", f"cast(doc_id % {m} = 1 as int) AS toxic")
    models = [T.train_model(docs, lab(m), F.lit(True)) for m in (2, 3)]
    want = [T.score_texts([r.text for r in docs.orderBy("doc_id").collect()], m, {}) for m in models]
    for k in range(8):
        got = T.score_documents(docs, models[k % 2]).orderBy("doc_id").collect()
        assert np.allclose([r.score for r in got], want[k % 2])


def test_the_sample_has_one_row_for_each_id(spark):
    docs = spark.range(3000).selectExpr("if(id < 2500, 7, id) AS doc_id", "concat('text ', id % 11) AS text", "'x' AS label", "'y' AS t")
    lab = docs.select("doc_id").distinct().withColumn("toxic", F.lit(1))
    got = T.labelled_sample(docs, lab, "toxic", F.lit(True), "doc_id", "text", 10 ** 6).collect()
    assert len(got) == 501
    assert T.labelled_sample(docs, lab, "toxic", F.lit(True), "doc_id", "text", 10).count() == 10


def test_lexicon_size_is_a_parameter(spark):
    docs = spark.createDataFrame([(k, "vile nasty rotten foul" if k % 2 else "calm plain kind mild") for k in range(60)], "doc_id long, text string")
    lab = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) AS toxic")
    assert len(T.train_model(docs, lab, F.lit(True), max_entries=3).lexicon) == 3 < len(T.train_model(docs, lab, F.lit(True)).lexicon)


def test_label_model_against_bayes_by_hand():
    """Voters that are independent given the label: the posterior is the product of their likelihood ratios."""
    rng = np.random.default_rng(5)
    y = rng.random(60_000) < 0.3
    hit = [(0.8, 0.1), (0.6, 0.2), (0.7, 0.3)]
    v = np.column_stack([np.where(rng.random(len(y)) < np.where(y, a, b), 1, -1) for a, b in hit]).astype(np.int8)
    got = T.label_model(v, y)
    odds = np.log(0.3 / 0.7) + sum(np.where(v[:, k] == 1, np.log(a / b), np.log((1 - a) / (1 - b))) for k, (a, b) in enumerate(hit))
    assert np.abs(got - 1 / (1 + np.exp(-odds))).mean() < 0.05


def test_vote_against_every_neighbour_by_hand():
    rng = np.random.default_rng(6)
    x = rng.random((300, Q.WIDTH)).astype(np.float32) * (rng.random((300, Q.WIDTH)) < 0.05)
    y = (rng.random(300) < 0.5).astype(np.float32)
    model = Q.fit(x, y)
    got = Q.vote(x[:40], model, neighbours=7)
    z = x @ model.axes
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    for r in range(40):
        cos = z @ z[r]
        near = np.flatnonzero(cos >= np.sort(cos)[-7] - Q.TIE)          # ties of the seventh vote too
        w = np.maximum(cos[near], 0)
        assert got[r] == pytest.approx((w @ y[near]) / w.sum(), abs=1e-3)


# ------------------------------------------------------------------- licenses ---

def notices(text, **kw):
    vocab, coded = L.prepare(kw.pop("templates", L.TEMPLATES))
    code = np.array([vocab.get(w, 0) for w in L.bench_words(text.encode())], np.int32)
    return L.scan_words(code, coded, kw.get("min_coverage", L.MIN_COVERAGE), L.STRETCH)


def test_patience_parts():
    assert L.increasing([(0, 3), (1, 1), (2, 2), (3, 0), (4, 5)]) == [(1, 1), (2, 2), (4, 5)]
    assert L.align(list("abcd"), list("xabycdz")) == [(0, 1), (1, 2), (2, 4), (3, 5)]
    assert L.align(list("aa"), list("ba")) == [(1, 1)] and L.align([], list("a")) == []


@pytest.mark.parametrize("name", sorted(L.TEMPLATES))
def test_every_template_is_found_whole_and_edited(name):
    t = L.TEMPLATES[name]
    around = "the work of the version and license in the under "
    for text in (t, around * 3 + t + " " + around * 2, t.upper(), t.replace(" ", "\n  * ")):
        best = max(notices(text), key=lambda n: (n[1], n[3] - n[2]))
        assert (best[0], best[1]) == (name, 1.0)
    words = t.split()
    if len(words) >= 10:
        del words[len(words) // 2]
        assert any(n[0] == name and 0.8 <= n[1] < 1 for n in notices("x " + " ".join(words)))


def test_repeats_and_no_findings():
    t = L.TEMPLATES["MIT"]
    assert [n[0] for n in notices(f"{t} {t} between {t}")] == ["MIT"] * 3
    assert notices("the work is under the sun; version 3 of the story") == [] and notices("") == []


def test_scan_operator(spark):
    rows = [(1, "a. " + L.TEMPLATES["GPL-3.0"]), (1, "a. " + L.TEMPLATES["GPL-3.0"]), (2, None), (3, ""), (4, "word " * 20000 + L.TEMPLATES["CC-BY-NC-4.0"])]
    docs = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, notices int")
    rows = L.scan_licenses(docs).withColumnRenamed("notices", "own").withColumnRenamed("notices_", "notices").collect()
    assert {r.own for r in rows} == {7}                            # a column of that name stays
    got = {(r.doc_id, tuple((n.license, n.coverage, n.start, n.end) for n in r.notices)) for r in rows}
    assert got == {(1, (("GPL-3.0", 1.0, 1, 13),)), (2, ()), (3, ()), (4, (("CC-BY-NC-4.0", 1.0, 20000, 20007),))}
    assert L.scan_licenses(docs.where("false")).count() == 0
    assert all(r.notices_ == [] for r in L.scan_licenses(docs, templates={}).collect())


def test_license_query_finds_the_planted_lines(spark):
    lines = {"GPL-3.0": "licensed under the GNU General Public License, version 3.", "MIT": "Released under the MIT License.",
             "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.", "Apache-2.0": "Licensed under the Apache License, Version 2.0."}
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op8_license_scan"](spark, SF).collect():
        want = sorted(k for k, v in lines.items() if v in text[r.doc_id])
        assert r.licenses == ",".join(want) and r.n_notices == len(json.loads(r.notices))
        assert r.best_coverage == (1.0 if want else 0.0)


def test_many_notices_in_one_text_are_sorted_out_quickly():
    import time
    rng = np.random.default_rng(3)
    found = [(f"t{k % 7}", 1.0, int(a), int(a) + int(n), int(n)) for k, (a, n) in enumerate(zip(rng.integers(0, 400_000, 60_000), rng.integers(3, 40, 60_000)))]
    began = time.time()
    kept = L.best_apart(found)
    assert time.time() - began < 5
    assert all(a[3] <= b[2] for a, b in zip(kept, kept[1:]))
    some, plain = found[:800], []
    for f in sorted(some, key=lambda f: (-f[4], -f[1], f[0], f[2])):
        if all(f[3] <= g[2] or g[3] <= f[2] for g in plain):
            plain.append(f)
    assert L.best_apart(some) == sorted((f[:4] for f in plain), key=lambda f: f[2])


def longest_common(a, b):
    best = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for k, y in enumerate(b):
            last, best[k + 1] = best[k + 1], last + 1 if x == y else max(best[k], best[k + 1])
    return best[-1]


def test_alignment_against_the_longest_common_subsequence():
    rng = np.random.default_rng(9)
    words = [f"w{k}" for k in range(60)]
    for _ in range(60):
        a = [words[k] for k in rng.permutation(60)[:40]]
        b = [w for w in a if rng.random() < 0.85]
        for _ in range(8):
            b.insert(int(rng.integers(0, len(b) + 1)), words[int(rng.integers(0, 60))])
        pairs = L.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert 0.85 * longest_common(a, b) <= len(pairs) <= longest_common(a, b)


def test_whole_license_texts_from_a_table(spark):
    rng = np.random.default_rng(2)
    long_a, long_b = (" ".join(f"{w}{k}" for k in rng.integers(0, 5000, 900)) for w in ("clause", "grant"))
    table = spark.createDataFrame([("A", long_a), ("B", long_b), ("A", "short"), (None, "x"), ("C", None)], "name string, text string")
    words = long_a.split()
    edited = words[:300] + ["extra"] * 20 + words[330:]
    docs = spark.createDataFrame([(1, "before " * 50 + " ".join(edited) + " after"), (2, " ".join(words[:300])), (3, f"{long_b}\n{long_a}")],
                                 "doc_id long, text string")
    got = {r.doc_id: [(n.license, n.coverage >= 0.9) for n in r.notices] for r in L.scan_licenses(docs, templates=table).collect()}
    assert got == {1: [("A", True)], 2: [], 3: [("B", True), ("A", True)]}
    with pytest.raises(ValueError):
        L.load_templates(table, max_bytes=100)

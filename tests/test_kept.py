"""What is kept up to date: citations and counts, stream state and coverage; landed headers; the feed's check."""

import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from accmine import schemas
from accmine.operators import dedup, incremental, summarize
from accmine.sinks import feed_check, feeds
from accmine.sinks.citations import CitationStore
from accmine.sinks.feed_check import Piece, document_faults, fits
from accmine.sources.corpus import read_articles, read_findings_csv
from accmine.sources.headers import entity_headers, read_responses, rejected_headers
from accmine.streaming.ingest import append_keyed, ingest_corpus, stream_coverage


def bag(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


# -------------------------------------------------------------- citation store ---

def test_kept_counts_equal_a_full_recomputation(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("accmine.sinks.citations.MAX_CHANGES", 2)
    rnd = random.Random(3)
    ids = [f"pmc:PMC{n}" for n in (1, 5, 999_999, 1_000_000, 7_000_000)] + ["PMC5", "x", "pmc:x", "", "pmc:", None]
    store, seen = CitationStore(spark, str(tmp_path / "s")), None
    for k in range(4):
        rows = [(rnd.choice(ids), rnd.choice(["syn1", "syn2", "syn3", "", None]), rnd.choice(["a", "b", None]), f"f{rnd.randrange(3)}")
                for _ in range(60)]
        batch = spark.createDataFrame(rows, schemas.FINDINGS)
        seen = batch if seen is None else seen.unionByName(batch)
        assert store.add(batch, f"b{k}") and not store.add(batch, f"b{k}")
        if k in (0, 3):
            assert bag(store.citations(), "synid", "pmcid", "n_articles") == bag(summarize.citations_by_id(seen), "synid", "pmcid", "n_articles")
            assert bag(store.doc_counts()) == bag(summarize.doc_counts(seen))
            assert bag(store.summary()) == bag(summarize.summary(seen)) and bag(store.combine_stats()) == bag(dedup.combine_stats(seen))


def test_a_batch_rewrites_only_its_blocks(spark, tmp_path):
    store = CitationStore(spark, str(tmp_path / "s"))
    put = lambda name, *ids: store.add(spark.createDataFrame([(i, "syn1", "c", "f") for i in ids], schemas.FINDINGS), name)
    put("a", "pmc:PMC1", "pmc:PMC1000001", "pmc:PMC2000001")
    before = {p["block"]: p["path"] for p in store.table.manifest()["parts"] if p["kind"] == "block"}
    put("b", "pmc:PMC1000002")
    after = {p["block"]: p["path"] for p in store.table.manifest()["parts"] if p["kind"] == "block"}
    assert {b for b in after if after[b] != before[b]} == {1} and store.summary().first().documents == 4
    assert len(CitationStore(spark, str(tmp_path / "none")).citations().collect()) == 0


# -------------------------------------------------------------- landed headers ---

def test_headers_last_one_counts_and_bad_ones_are_rejected(spark, tmp_path):
    (tmp_path / "1.json").write_text(
        '{"results": [{"id": "syn1", "name": "old", "benefactorId": 5, "createdOn": "2020"}, {"id": "syn2", "other": {"a": [1]}}]}\n'
        '{"results": [{"id": "syn1", "name": "older in place", "benefactorId": "7"}, {"name": "nameless"}, {"id": ""}]}\n')
    (tmp_path / "2.json").write_text('{"results": [{"id": "syn1", "name": "new", "benefactorId": null}]}\n{"message": "denied"}\n{"results": [\n\n[]\n')
    r = read_responses(spark, str(tmp_path))
    assert bag(entity_headers(r)) == [("syn1", "new", None, None), ("syn2", None, None, None)]
    assert sorted(x.reason for x in rejected_headers(r).collect()) == ["no JSON", "no id", "no id", "no results", "no results"]
    only = read_responses(spark, str(tmp_path), glob="1.*")
    assert bag(entity_headers(only))[0] == ("syn1", "older in place", 7, None)


# ------------------------------------------------------------------ feed check ---

def feed(n):
    out = ["<?xml version='1.0' encoding='UTF-8'?>", "<database>", "  <name>N &amp; &lt;</name>", "  <description>D</description>",
           "  <release>r</release>", "  <release_date>r</release_date>", f"  <entry_count>{n}</entry_count>", "  <entries>"]
    for k in range(n):
        out += [f'    <entry id="syn{k:03d}">', "      <name>a</name>", "      <description>a</description>"]
        if k % 2:
            out += ["      <dates>", '        <date type="submission" value="2024" />', "      </dates>"]
        out += ["      <cross_references>", *[f'        <ref dbname="PMC" dbkey="PMC{j}" />' for j in range(k % 4)], "      </cross_references>",
                "      <additional_fields>", '        <field name="x">y</field>', '        <field name="z"></field>', "      </additional_fields>",
                "    </entry>"]
    return out + ["  </entries>", "</database>"]


def faults(lines, *cuts):
    from types import SimpleNamespace
    edges, rows = [0, *sorted(cuts), len(lines)], []
    for a, b in zip(edges, edges[1:]):
        p = Piece()
        for x in lines[a:b]:
            p.line(x)
        rows.append(SimpleNamespace(**p.row("s", a)))
    return document_faults(rows)


def test_any_cut_of_a_whole_document_is_whole():
    lines, rnd = feed(7), random.Random(1)
    for _ in range(200):
        assert faults(lines, *rnd.sample(range(len(lines) + 1), rnd.randrange(0, 9))) == []
    assert faults(feed(0), 4) == []


def test_any_lost_doubled_or_moved_line_is_found_wherever_the_cuts_are():
    lines, rnd = feed(4), random.Random(2)
    free = [k for k, x in enumerate(lines) if "<ref " in x or "<field " in x or x.startswith("<?xml")]
    for k in range(len(lines)):
        if k in free:
            continue
        broken = lines[:k] + lines[k + 1:]
        twice = lines[:k] + [lines[k]] + lines[k:]
        for text in (broken, twice):
            assert faults(text, *rnd.sample(range(len(text)), 3)), lines[k]
    swapped = lines[:]
    swapped[9], swapped[10] = swapped[10], swapped[9]
    assert faults(swapped, 10)
    assert fits("entry", ["name", "description", "cross_references"]) == "<entry> lacks <additional_fields>"


def test_damage_of_a_written_feed_is_reported(spark, tmp_path):
    def written(name, lines, shards=3):
        df = spark.createDataFrame([(f"{k:06d}", 0, "", x) for k, x in enumerate(lines)], "k0 string, k1 int, k2 string, line string")
        path = str(tmp_path / name)
        feeds.write_search_feed(df, path, shards)
        return path, feed_check.write_manifest(spark, path).collect()

    state = lambda p: {r.check: r.ok for r in feed_check.check_feed(spark, p).collect()}
    path, shards = written("good", feed(30))
    assert state(path) == {"shards": True, "document": True, "entry_count": True}
    assert [s.offset for s in sorted(shards, key=lambda s: s.shard)] == [0, *(sum(s.bytes for s in sorted(shards, key=lambda s: s.shard)[:k]) for k in (1, 2))]
    assert all(os.path.getsize(f"{path}/{s.shard}") == s.bytes for s in shards)
    assert feeds.read_feed_lines(spark, path).count() == len(feed(30))              # the manifest is no shard
    lines = feed(30)
    assert state(written("count", [x.replace(">30<", ">31<") for x in lines])[0]) == {"shards": True, "document": True, "entry_count": False}
    assert state(written("open", [x for x in lines if x != "  </entries>"])[0])["document"] is False
    middle = sorted(s.shard for s in shards)[1]
    os.remove(f"{path}/{middle}")
    got = {r.check: (r.ok, r.detail) for r in feed_check.check_feed(spark, path).collect()}
    assert got["shards"] == (False, f"{middle}: missing") and not got["entry_count"][0]


# ---------------------------------------------------------------------- streams ---

def csv(folder, name, *rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("pmcid,synid,context\n" + "".join(",".join(r) + "\n" for r in rows))


def test_keyed_state_equals_first_batch_wins_over_restarts(spark, tmp_path):
    inbox, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    stored = spark.createDataFrame([("pmc:PMC9",), ("pmc:PMC9",)], "pmcid string")
    run = lambda: append_keyed(spark, inbox, out, ck, stored=stored)
    read = lambda: bag(spark.read.parquet(out), "pmcid", "synid", "source_file")
    csv(inbox, "r.PMC20_PMC29.xml.gz.csv", ("pmc:PMC1", "syn20", "c"), ("pmc:PMC1", "syn21", "c"), ("pmc:PMC2", "syn20", "c"), ("pmc:PMC9", "syn20", "c"))
    csv(inbox, "r.PMC10_PMC19.xml.gz.csv", ("pmc:PMC1", "syn10", "c"), ("", "syn11", "c"))
    run()
    first = [("pmc:PMC1", "syn10", "PMC10_PMC19.xml.gz"), ("pmc:PMC2", "syn20", "PMC20_PMC29.xml.gz")]
    assert [r for r in read() if r[0]] == first
    csv(inbox, "r.PMC1_PMC5.xml.gz.csv", ("pmc:PMC1", "syn1", "c"), ("pmc:PMC3", "syn3", "c"), ("", "syn33", "c"))
    run()
    want = read()
    assert [r for r in want if r[0]] == [*first, ("pmc:PMC3", "syn3", "PMC1_PMC5.xml.gz")] and [r[1] for r in want if not r[0]] == ["syn11"]
    shutil.rmtree(os.path.join(out, "batch=1"))                       # a crash after the rows: the commit of batch 1 is lost
    os.remove(os.path.join(ck, "commits", "1"))
    crc = os.path.join(ck, "commits", ".1.crc")
    if os.path.exists(crc):
        os.remove(crc)
    run()
    assert read() == want


def test_stream_coverage_and_rejects_by_default(spark, tmp_path):
    inbox, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    os.makedirs(inbox)
    good = '<article a="1"><article-id pub-id-type="pmc">1</article-id><body>syn1234567</body></article>'
    for name, text in (("PMC1_PMC9.xml", good + '<article a="2"><p></article>'), ("PMC10_PMC19.xml", "words " + good)):
        with open(os.path.join(inbox, name), "w") as fh:
            fh.write(text)
        ingest_corpus(spark, inbox, out, ck)
    assert bag(stream_coverage(spark, out), "source_file", "articles", "parsed", "findings") == [("PMC10_PMC19.xml", 1, 1, 1), ("PMC1_PMC9.xml", 2, 1, 1)]
    assert bag(spark.read.parquet(f"{out}-rejects"), "source_file") == [("PMC1_PMC9.xml",)]
    assert spark.read.parquet(out).count() == 2


# --------------------------------------------------------------- headers of files ---

@pytest.mark.parametrize("before, articles", [
    ("", 1), ("plain words first ", 1), ("a < b is not > a tag ", 1), ("<?xml version='1.0'?><!DOCTYPE x><articles>", 1), ("﻿", 1),
    ("rest of another</p></article>\n", 1), ("<!-- a > b -->", 1)])
def test_what_stands_before_the_first_article_is_ignored(spark, tmp_path, before, articles):
    (tmp_path / "PMC1_PMC9.xml").write_text(f'{before}<article v="1" w=\'2\'>x</article>')
    assert bag(read_articles(spark, str(tmp_path)), "xml") == [('<article v="1" w=\'2\'>x</article>',)] * articles


@pytest.mark.parametrize("text", ['<article v="1">cut', '<article v="1', "<article v=", "<article >x</article>", '<article v=1>x</article>',
                                  '<article\n v>x</article>'.replace("\n", " ")])
def test_odd_and_cut_off_articles_stay(spark, tmp_path, text):
    (tmp_path / "PMC1_PMC9.xml").write_text(text + '<article a="2"></article>')
    assert read_articles(spark, str(tmp_path)).count() == 2


def test_a_data_row_that_looks_like_a_header_is_data(spark, tmp_path):
    (tmp_path / "r.PMC1_PMC2.xml.gz.csv").write_text('pmcid,synid,context\npmc:PMC1,syn1,"cols x,pmcid,synid"\npmcid,synid,context\n')
    (tmp_path / "r.PMC3_PMC4.xml.gz.csv").write_text('﻿context,pmcid\nc,pmc:PMC3\n')
    (tmp_path / "r.PMC5_PMC6.xml.gz.csv").write_text("")
    got = bag(read_findings_csv(spark, str(tmp_path)))
    assert got == sorted([("pmc:PMC1", "syn1", "cols x,pmcid,synid", "PMC1_PMC2.xml.gz"), ("pmcid", "synid", "context", "PMC1_PMC2.xml.gz"),
                          ("pmc:PMC3", None, "c", "PMC3_PMC4.xml.gz")], key=str)


def test_the_batch_order_is_numbered_without_one_window(spark):
    df = spark.range(50).select(F.concat(F.lit("f"), F.col("id") % 7).alias("source_file"))
    assert bag(incremental.batch_order(df)) == [(f"f{k}", k) for k in range(7)]


# ------------------------------------------------------------------ one shuffle, one mining ---

def test_counts_are_kept_over_many_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("accmine.sinks.citations.BUCKET_ROWS", 7)
    ids = [None, "", "pmc:", "x", "PMC5", "pmc:PMC5", *(f"pmc:PMC{n}" for n in range(10, 40))]
    rows = [(ids[k % len(ids)], f"syn{k % 5}", f"c{k % 4}", f"f{k % 3}") for k in range(400)]
    store, batch = CitationStore(spark, str(tmp_path / "s")), lambda r: spark.createDataFrame(r, schemas.FINDINGS)
    for k in range(3):
        store.add(batch(rows[k * 100:k * 100 + 200]), f"b{k}")
    seen = batch([r for k in range(3) for r in rows[k * 100:k * 100 + 200]])
    assert bag(store.citations(), "synid", "pmcid", "n_articles") == bag(summarize.citations_by_id(seen), "synid", "pmcid", "n_articles")
    assert bag(store.summary()) == bag(summarize.summary(seen)) and bag(store.combine_stats()) == bag(dedup.combine_stats(seen))


def test_a_batch_meets_its_blocks_in_one_shuffle(spark, tmp_path):
    store = CitationStore(spark, str(tmp_path / "s"))
    own = spark.createDataFrame([("syn1", "pmc:PMC1", b"d", "f", 1, 0)], "synid string, pmcid string, digest binary, source_file string, rows bigint, block bigint")
    old = own.drop("source_file").where("rows > 5")
    plan = store._merged(old, own, {0: 1})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and "hashpartitioning(block" in plan

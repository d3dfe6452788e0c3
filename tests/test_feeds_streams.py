"""Sinks and streams: written feeds read back, stream results equal batch results, entry contract."""

import glob
import os
import xml.etree.ElementTree as ET

from accmine.operators import enrich
from accmine.plans import queries as Q
from accmine.session import scratch_path
from accmine.sinks import feeds


def test_search_feed_document(spark):
    pairs = spark.createDataFrame([("syn2", "PMC9"), ("syn1", "PMC3"), ("syn1", "PMC1"), ("syn3", "PMC4")],
                                  "synid string, pmcid string")
    cache = spark.createDataFrame([("syn1", "A & B", "A & B", "2024-01-02", "Portal", None),
                                   ("syn2", "C", "C", "", "Portal", "https://p/2")],
                                  "id string, name string, description string, created_on string, "
                                  "repository string, portal_link string")
    cfg = enrich.PortalConfig(entity_url="https://r/{id}")
    entries = enrich.search_entries(pairs, cache, cfg)
    path = scratch_path(spark, "test-search")
    feeds.write_search_feed(feeds.search_feed_lines(entries, pairs, "DB", "d", "2026-01-01"), path, partitions=3)
    text = "".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(os.path.join(path, "part-*"))))
    root = ET.fromstring(text.encode("utf-8"))
    assert root.find("entry_count").text == "2"
    ents = root.findall("entries/entry")
    assert [e.get("id") for e in ents] == ["syn1", "syn2"]
    assert [r.get("dbkey") for r in ents[0].findall("cross_references/ref")] == ["PMC1", "PMC3"]
    assert ents[0].find("name").text == "A & B" and ents[0].find("dates/date").get("value") == "2024-01-02"
    assert ents[1].find("dates") is None
    fields = {f.get("name"): f.text for f in ents[0].findall("additional_fields/field")}
    assert fields == {"repository": "Portal", "full_dataset_link": "https://r/syn1"}


def test_link_feed_shape(spark, sf_dir):
    path = scratch_path(spark, "test-links")
    rows = feeds.link_rows(Q.fx.findings_v(spark, sf_dir), 7)
    feeds.write_link_feed(rows, path)
    part = sorted(glob.glob(os.path.join(path, "part-*")))[0]
    link = ET.parse(part).getroot().find("link")
    assert link.get("providerId") == "7"
    assert [c.tag for c in link] == ["resource", "record"]
    assert [c.tag for c in link.find("resource")] == ["url", "title"]
    assert [c.tag for c in link.find("record")] == ["source", "id"]


def bag(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_ingest_equals_batch(spark, sf_dir):
    assert bag(Q.QUERIES["stream_ingest"](spark, sf_dir)) == bag(Q.QUERIES["xml_mine"](spark, sf_dir))


def test_stream_append_equals_batch(spark, sf_dir):
    a = Q.QUERIES["stream_append"](spark, sf_dir).select("pmcid", "synid", "context", "source_file")
    b = Q.QUERIES["first_batch_wins"](spark, sf_dir).select("pmcid", "synid", "context", "source_file")
    assert bag(a) == bag(b)


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["doc_id", "pmcid", "synid", "context"] and df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_append_batch_replay_is_idempotent(spark):
    from accmine.streaming.ingest import append_batch, init_results_table
    path = scratch_path(spark, "replay")
    init_results_table(spark.createDataFrame([("pmc:PMC1", "syn1")], "pmcid string, synid string"), path)
    b = spark.createDataFrame([("pmc:PMC1", "syn2", "c", "A.xml.gz"), ("pmc:PMC2", "syn3", "c", "A.xml.gz"),
                               ("pmc:PMC2", "syn4", "c", "B.xml.gz")],
                              "pmcid string, synid string, context string, source_file string")
    append_batch(spark, b, 0, path)
    once = bag(spark.read.parquet(path).select("pmcid", "synid", "batch"))
    append_batch(spark, b, 0, path)  # replay of the same micro-batch
    assert bag(spark.read.parquet(path).select("pmcid", "synid", "batch")) == once
    assert [r for r in once if r[2] == "0"] == [("pmc:PMC2", "syn3", "0")]


def test_validate_feed(spark, sf_dir):
    rows = feeds.link_rows(Q.fx.findings_v(spark, sf_dir), 7)
    good, bad = scratch_path(spark, "fe-good"), scratch_path(spark, "fe-bad")
    feeds.write_link_feed(rows, good)
    feeds.link_structs(rows).withColumnRenamed("record", "invalid_element").write.format("xml") \
        .option("rootTag", "links").option("rowTag", "link").save(bad)
    n = rows.count()
    assert tuple(feeds.validate_feed(spark, good).first()) == (n, n, 0, n)
    assert tuple(feeds.validate_feed(spark, bad).first()) == (n, 0, n, 0)


def test_feed_lines_have_their_place(spark, sf_dir):
    rows = sorted((r.n, r.line) for r in Q.QUERIES["search_feed_order"](spark, sf_dir).collect())
    assert [n for n, _ in rows] == list(range(len(rows)))
    root = ET.fromstring("\n".join(line for _, line in rows).encode())
    ids = [e.get("id") for e in root.findall("entries/entry")]
    assert ids == sorted(ids) and root.find("entry_count").text == str(len(ids))


def test_stream_options_and_rejects(spark, tmp_path):
    import gzip
    from accmine.operators.mine import AccessionPattern
    from accmine.streaming.ingest import ingest_corpus
    (tmp_path / "in").mkdir()
    with gzip.open(tmp_path / "in" / "PMC1_PMC9.xml.gz", "wt") as fh:
        fh.write('<article a="1"><article-id pub-id-type="pmc">1</article-id><body><p>xx GSE123 yy</p></body></article>'
                 '<article a="2"><body><p>open</body></article><article a="3"><body>gse999 cut o')
    out, bad, ck = (str(tmp_path / n) for n in ("out", "bad", "ck"))
    ingest_corpus(spark, str(tmp_path / "in"), out, ck, window=2, case_rule="fold", pattern=AccessionPattern("gse", 3, 5), rejects_path=bad)
    assert [tuple(r) for r in spark.read.parquet(out).select("pmcid", "synid", "context").collect()] == [("pmc:PMC1", "gse123", "x GSE123 y")]
    assert sorted(r.reason.split(":")[0] for r in spark.read.parquet(bad).collect()) == ["ParseError"] * 2


def test_append_without_duplicate_check(spark):
    from accmine.streaming.ingest import append_batch, init_results_table
    path = scratch_path(spark, "no-check")
    init_results_table(spark.createDataFrame([("pmc:PMC1", "syn1")], "pmcid string, synid string"), path)
    b = spark.createDataFrame([("pmc:PMC1", "syn2", "c", "A.xml.gz")], "pmcid string, synid string, context string, source_file string")
    append_batch(spark, b, 0, path, check_duplicates=False)
    append_batch(spark, b, 1, path)
    assert spark.read.parquet(path).groupBy("batch").count().count() == 2


def test_a_stream_refuses_swapped_columns(spark, tmp_path):
    import pytest
    from accmine.streaming.ingest import append_results, init_results_table
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.PMC1_PMC2.xml.gz.csv").write_text("synid,pmcid,context\nsyn1,pmc:PMC1,c\n")
    init_results_table(spark.createDataFrame([("pmc:PMC9", "syn9")], "pmcid string, synid string"), str(tmp_path / "t"))
    with pytest.raises(Exception, match="(?i)header"):
        append_results(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "ck"))


def test_append_reads_its_files_once_and_lists_them_with_few_tasks(spark, tmp_path, monkeypatch):
    from accmine.streaming import ingest
    inbox, results, seen, real = tmp_path / "in", str(tmp_path / "t"), [], ingest.append_batch
    for k in range(40):                              # more folders than the driver lists itself
        folder = inbox / f"source_file=PMC{k}_PMC{k}.xml.gz"
        folder.mkdir(parents=True)
        (folder / "part-0.csv").write_text(f"pmcid,synid,context\npmc:PMC{k},syn{k},c\npmc:PMC99,syn{k},c\n,syn{k},\n")
    (inbox / "out.PMC10_PMC10.xml.gz.csv").write_text("pmcid,synid,context\npmc:PMC99,syn100,c\npmc:PMC3,syn3,c\n")  # the same name once more
    (inbox / "no name.csv").write_text("pmcid,synid,context\npmc:PMC200,syn200,\"a \"\"b\"\", c\"\n")
    ingest.init_results_table(spark.createDataFrame([("pmc:PMC5", "syn1")], "pmcid string, synid string"), results)

    def kept(session, batch, *args):
        files = batch.inputFiles()
        seen.append((bool(files) and not any(f.endswith(".csv") for f in files), batch.columns))
        real(session, batch, *args)

    tasks, real_stream = [], ingest.findings_by_path
    monkeypatch.setattr(ingest, "append_batch", kept)
    monkeypatch.setattr(ingest, "findings_by_path", lambda s, *a: (tasks.append(int(s.conf.get(ingest.LISTING_TASKS))), real_stream(s, *a))[1])
    before = spark.conf.get(ingest.LISTING_TASKS)
    ingest.append_results(spark, str(inbox), results, str(tmp_path / "ck"))
    assert seen == [(True, ["pmcid", "synid", "context", "source_file"])]
    assert tasks[0] <= 4 * spark.sparkContext.defaultParallelism and spark.conf.get(ingest.LISTING_TASKS) == before
    got = spark.read.parquet(results).where("batch <> 'initial'").select("pmcid", "synid", "context", "source_file")
    name = "PMC{0}_PMC{0}.xml.gz".format
    want = [(f"pmc:PMC{k}", f"syn{k}", "c", name(k)) for k in range(40) if k not in (3, 5)]
    want += [("pmc:PMC3", "syn3", "c", name(10)), ("pmc:PMC99", "syn0", "c", name(0)), (None, "syn0", None, name(0)),
             ("pmc:PMC200", "syn200", 'a "b", c', "no%20name.csv")]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))

"""What one task, one call or the driver holds does not grow with the input."""

import glob
import gzip
import os
from types import SimpleNamespace

import pandas as pd
from pyspark.sql import functions as F

from accmine.operators import dedup
from accmine.plans import queries
from accmine.session import brief_shuffles, scratch_path
from accmine.sinks import feed_check, feeds
from accmine.sources import corpus
from accmine.streaming import ingest

FLAT_LINKS = "provider_id long, url string, title string, source string, record_id string"


def test_a_feed_shard_is_read_in_pieces(spark, tmp_path, monkeypatch):
    texts = {"part-00000": "a\n\n" + "x" * 50 + "\nlast\n\n", "part-00001": "".join(f"line {k}\n" for k in range(100)) + "no end"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    seen, stage = [], feeds.stage
    monkeypatch.setattr(feeds, "stage", lambda df, path: (seen.append(df.rdd.getNumPartitions()), stage(df, path))[1])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        got = sorted(map(tuple, feeds.read_feed_document(spark, str(tmp_path)).collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [(n, k, x) for n, t in sorted(texts.items()) for k, x in enumerate(t.removesuffix("\n").split("\n"))]
    assert seen and seen[0] > 2


class Handle:
    """A state handle that notes how often state was written."""

    def __init__(self):
        self.value, self.writes = None, 0

    def getValueState(self, name, schema):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value, self.writes = value, self.writes + 1


def test_one_state_value_serves_many_articles(spark):
    ids = [f"pmc:PMC{k}" for k in range(ingest.STATE_IDS)] + ["pmc:PMCx", None]
    blocks = spark.createDataFrame([(i,) for i in ids], "pmcid string").select(ingest.state_block(F.col("pmcid")).alias("b")).collect()
    assert {r.b for r in blocks[:-2]} == {0} and all(r.b < 0 for r in blocks[-2:])
    frame = lambda file: pd.DataFrame({"pmcid": ids, "synid": "syn1", "context": "c", "source_file": file})
    first, handle = ingest.FirstBatch(), Handle()
    first.init(handle)
    first.handleInitialState((0,), pd.DataFrame({"pmcid": ["pmc:PMC5"]}), None)
    first.handleInitialState((0,), pd.DataFrame({"pmcid": ["pmc:PMC7"]}), None)
    out = pd.concat(first.handleInputRows((0,), iter([frame("b"), frame("a"), frame("c")]), None))
    won = out[out["winner"]]
    assert handle.writes == 3 and len(won) == len(ids) - 2 and set(won["source_file"]) == {"a"} and won["pmcid"].isna().sum() == 1
    assert len(out) == 3 * len(won) and list(first.handleInputRows((0,), iter([frame("0")]), None)) == []


def test_link_feed_files_are_bounded(spark, tmp_path):
    path = f"{tmp_path}/links"
    rows = feeds.link_rows(spark.range(50).select(F.concat(F.lit("pmc:PMC"), "id").alias("pmcid"), F.lit("syn1").alias("synid")).coalesce(1), 7)
    feeds.write_link_feed(rows, path, links_per_file=20)
    assert sorted(map(tuple, feeds.flatten_links(feeds.read_link_feed(spark, path)).collect())) == sorted(map(tuple, rows.collect()))
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) >= 3 and all(open(f"{path}/{f}").read().count("<record>") <= 20 for f in files)
    assert feeds.LINKS_PER_FILE <= 1_000_000


def test_a_compressed_link_feed_is_the_same_feed(spark, tmp_path):
    rows = spark.createDataFrame([(7, f"https://r/syn{k}?a&b<", "View \u00e9", "PMC", f"PMC{k}") for k in range(50)], FLAT_LINKS).coalesce(1)
    feeds.write_link_feed(rows, f"{tmp_path}/plain", links_per_file=20)
    feeds.write_link_feed(rows, f"{tmp_path}/gz", links_per_file=20, compression="gzip")
    bad = feeds.link_structs(rows).withColumnRenamed("record", "invalid_element")
    feeds.write_link_structs(bad, f"{tmp_path}/gz", mode="append", compression="gzip")
    texts = {n: sorted(f for f in os.listdir(f"{tmp_path}/{n}") if f.startswith("part-")) for n in ("plain", "gz")}
    assert len(texts["plain"]) == 3 and len(texts["gz"]) == 4 and all(f.endswith(".xml.gz") for f in texts["gz"])
    packed = {gzip.open(f"{tmp_path}/gz/{f}", "rt", encoding="utf-8").read() for f in texts["gz"]}
    assert {open(f"{tmp_path}/plain/{f}", encoding="utf-8").read() for f in texts["plain"]} < packed
    assert tuple(feeds.validate_feed(spark, f"{tmp_path}/gz").first()) == (100, 50, 50, 50)


def used(spark, monkeypatch, query, d) -> tuple[list, dict]:
    """The query's rows, and the bytes of the files below each folder that it asked for, by name."""
    made = []
    monkeypatch.setattr(queries, "scratch_path", lambda s, name: made.append((name, scratch_path(s, name))) or made[-1][1])
    rows = queries.QUERIES[query](spark, d).collect()
    return rows, {n: sum(os.path.getsize(f) for f in glob.glob(f"{p.removeprefix('file:')}/part-*")) for n, p in made}


def test_both_validated_feeds_come_from_one_search_for_links_and_are_small(spark, sf_dir, monkeypatch):
    found, distinct = [], feeds.distinct_links
    monkeypatch.setattr(feeds, "distinct_links", lambda r: found.append(distinct(r)) or found[-1])
    rows, size = used(spark, monkeypatch, "feed_validate", sf_dir)
    n = found[0].count()
    assert sorted(map(tuple, rows)) == [("bad", False, n, 0), ("good", True, n, n)]
    assert len(found) == 1 and size["link-rows"] and 0 < size["links-good"] + size["links-bad"] < 60 * n   # 560 bytes of XML


def test_the_link_feed_is_small_on_disk(spark, sf_dir, monkeypatch):
    rows, size = used(spark, monkeypatch, "link_feed", sf_dir)
    want = feeds.link_rows(queries.fx.findings_v(spark, sf_dir), queries.PROVIDER_ID, queries.CFG)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, want.collect()))
    assert 0 < size["links"] < 30 * len(rows)       # 280 bytes of XML a link


def test_reference_lines_are_folded_in_bulk(spark, tmp_path, monkeypatch):
    ref = '        <ref dbname="PMC" dbkey="PMC%d &gt; x" />'
    odd = ["<cross_references>", '<ref a="1"></ref>', '  <ref a="1" /> text', '<ref a="<" />', '<ref a="1" /><ref />', "</cross_references>", "</entry>", "<ref/>", ""]
    lines = [x for k, o in enumerate(odd) for x in (o, *[ref % n for n in range(k % 4)])]
    (tmp_path / "part-00000").write_text("".join(f"{x}\n" for x in lines))
    want = feed_check.Piece()
    for x in lines:
        want.line(x)
    monkeypatch.setattr(feed_check.Piece, "line", lambda self, text, line=feed_check.Piece.line: (_ for _ in ()).throw(ValueError(text)) if "dbkey" in text else line(self, text))
    got = feed_check.pieces(spark, str(tmp_path)).collect()
    assert [r.asDict() for r in got] == [want.row("part-00000", 0)]
    noted = feed_check.write_manifest(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in noted] == [("part-00000", want.bytes, want.lines, 0)]


def damaged(n: int) -> dict[str, list[str]]:
    """Middle parts of feeds in which every entry is damaged in the same way."""
    entry = ['<entry id="syn%07d">', "<name>a</name>", "<description>a</description>", "<cross_references>", '<ref a="1" />', "</cross_references>",
             "<additional_fields>", '<field name="x">y</field>', "</additional_fields>", "</entry>"]
    lacking = {x: [y for y in entry if y != x] for x in (entry[0], "</cross_references>", "<cross_references>", "</entry>")}
    lacking["both"] = entry[1:-1]
    lacking["counted"] = [*entry, "<entry_count>5</entry_count>"]
    return {name: [x % k if "%" in x else x for k in range(n) for x in lines] for name, lines in lacking.items()}


def folded(lines: list[str]) -> dict:
    piece = feed_check.Piece()
    for x in lines:
        piece.line(x)
    return piece.row("s", 0)


def test_the_state_of_a_damaged_piece_does_not_grow_with_it():
    few, many = ({k: folded(v) for k, v in damaged(n).items()} for n in (100, 3000))
    for name, row in many.items():
        assert len(str(row)) < len(str(few[name])) + 100 < 10_000, name
        assert row["lines"] == 30 * few[name]["lines"] and row["entries"] == 30 * few[name]["entries"]


def test_pieces_nested_or_closed_too_deep_are_faulty_and_the_rest_of_the_report_stays():
    head = ["<database>", "<name>a</name>", "<description>a</description>", "<release>a</release>", "<release_date>a</release_date>",
            "<entry_count>90</entry_count>", "<entries>"]
    faults = lambda *parts: feed_check.document_faults([SimpleNamespace(**folded(x)) for x in parts])
    for name, middle in damaged(90).items():
        for parts in ([head, middle, ["</entries>", "</database>"]], [[*head, *middle], ["</entries>", "</database>"]],
                      [head, middle[:300], middle[300:], ["</entries>"], ["</database>"]]):
            assert faults(*parts), name
    deep = lambda n: [f"<entry id=\"syn{k:03d}\">" for k in range(n)]
    closed = ["</entry>"] * 40
    assert faults(deep(40), closed)[-1] == "s from byte 0: closes more than 16 elements of others"
    assert faults(deep(40), closed[:16], closed[:1])[-1] == "s from byte 0: </entry> closes an element more than 16 levels out"
    assert faults(deep(40), closed[:16])[-1] == "end: 24 elements are open" and faults(deep(40))[-1] == "end: <entry> is open"
    assert folded(["<x>"] * 100 + ["</x>"] * 100)["fault"] == "<x> holds elements"


def test_a_checked_feed_and_what_it_shuffled_go_before_the_next(spark, sf_dir, monkeypatch):
    there, made, write = [], [], feeds.write_search_feed
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def written(rows, path, **kw):
        there.append((sum(os.path.exists(p.removeprefix("file:")) for p in made), spark.conf.get(key)))
        made.append(path)
        write(rows, path, **kw)

    monkeypatch.setattr(feeds, "write_search_feed", written)
    rows = {(r.feed, r.check): r.ok for r in queries.QUERIES["feed_check"](spark, sf_dir).collect()}
    assert there == [(0, "true")] * 4 and not any(os.path.exists(p.removeprefix("file:")) for p in made)
    assert spark.conf.get(key) == "false"
    assert sorted(k for k, ok in rows.items() if not ok) == [("miscounted", "entry_count"), ("missing shard", "shards"), ("open entry", "document")]
    assert len(rows) == 10


def test_brief_shuffles_leave_no_files(spark, tmp_path):
    kept = lambda: spark._jvm.org.apache.spark.SparkEnv.get().shuffleManager().shuffleBlockResolver().getStoredShuffles().size()
    wide = lambda name: spark.range(1000).repartition(3, "id").write.parquet(f"{tmp_path}/{name}")
    before = kept()
    with brief_shuffles(spark):
        wide("a")
    assert kept() <= before
    assert spark.read.parquet(f"{tmp_path}/a").count() == 1000


def test_combined_rows_and_statistics_share_one_staged_table(spark, monkeypatch):
    rows = [("pmc:PMC1", "syn1", "c", "b"), ("pmc:PMC1", "syn1", "c", "a"), ("pmc:PMC1", "syn1", None, "b"), (None, "syn2", "c", None)]
    batches = spark.createDataFrame(rows, "pmcid string, synid string, context string, source_file string")
    combined, stats = dedup.combine(batches)
    assert sorted(map(tuple, combined.collect()), key=str) == sorted(map(tuple, dedup.combine_dedup(batches).collect()), key=str)
    assert stats.collect() == dedup.combine_stats(batches).collect()
    assert "distinct-rows" in "".join(combined.inputFiles()) and "distinct-rows" in "".join(stats.inputFiles())


def test_the_audit_reads_only_groups_of_extensions_that_occur(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("a,b\n")
    (tmp_path / "b.txt").write_bytes(b"\xff\xfe text")
    seen, checked = [], corpus._checked_in_pieces
    monkeypatch.setattr(corpus, "_checked_in_pieces", lambda s, p, endings, *a: (seen.append(list(endings)), checked(s, p, endings, *a))[1])
    got = {r.path.rsplit("/", 1)[1]: r.reason for r in corpus.audit_files(spark, str(tmp_path)).collect()}
    assert got == {"a.csv": "extension", "b.txt": "type"} and seen == [[".txt"]]

"""Committed versions, the index of stored articles, and the incremental job on top of them."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from accmine import jobs, schemas
from accmine.operators import article_index, incremental
from accmine.sinks.results import ResultsTable
from accmine.sinks.versions import Conflict, VersionedTable
from accmine.sources.tables import read_entity_meta, read_results

ROW = "pmcid string, synid string, context string, source_file string"


def rows(spark, *r):
    return spark.createDataFrame([(p, s, f"at {s}", f) for p, s, f in r], ROW)


def bag(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def table(spark, root, *ids):
    out = ResultsTable(spark, str(root))
    for group in ids:
        batch = rows(spark, *[(i, "syn1111111", "f") for i in group])
        out.append(lambda lookup: incremental.new_rows(batch, lookup))
    return out


# -------------------------------------------------------------------- versions ---

def test_readers_see_the_last_commit(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    assert t.versions() == [] and t.read(schemas.FINDINGS).collect() == []
    t.replace(rows(spark, ("a", "s", "f")), {"k": 1})
    t.write(rows(spark, ("lost", "s", "f")))                                  # a crash before the commit
    assert bag(t.read(schemas.FINDINGS), "pmcid") == [("a",)]
    t.replace(rows(spark, ("b", "s", "f")))
    assert bag(t.read(schemas.FINDINGS), "pmcid") == [("b",)] and bag(t.read(schemas.FINDINGS, 0), "pmcid") == [("a",)]
    assert t.manifest()["properties"] == {"k": 1} and t.versions() == [0, 1]


def test_of_two_writers_one_has_to_repeat(spark, tmp_path):
    a, b = (VersionedTable(spark, str(tmp_path / "t")) for _ in range(2))
    base = b.manifest()
    a.replace(rows(spark, ("a", "s", "f")))
    with pytest.raises(Conflict):
        b.commit(base, [{"path": b.write(rows(spark, ("b", "s", "f")))}])
    assert bag(a.read(schemas.FINDINGS), "pmcid") == [("a",)]
    assert not [n for n, _ in a.files.names(f"{a.root}/_log") if n.startswith(".v") and not n.endswith(".crc")]


def test_an_append_repeats_after_a_faster_writer(spark, tmp_path):
    t = ResultsTable(spark, str(tmp_path / "t"))
    other, calls = ResultsTable(spark, str(tmp_path / "t")), []

    def make(lookup):
        if not calls:
            other.append(lambda lookup: rows(spark, ("pmc:PMC1", "syn7777777", "g")))
        calls.append(1)
        return incremental.new_rows(rows(spark, ("pmc:PMC1", "syn1111111", "f"), ("pmc:PMC2", "syn1111111", "f")), lookup)

    t.append(make, "PMC5")
    assert len(calls) == 2 and t.position() == "PMC5"
    assert bag(t.read(), "pmcid", "synid") == [("pmc:PMC1", "syn7777777"), ("pmc:PMC2", "syn1111111")]


def test_old_versions_and_lost_writes_are_removed(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    paths = [t.replace(rows(spark, (str(k), "s", "f"))) for k in range(4)]
    lost = t.write(rows(spark, ("lost", "s", "f")))
    assert t.vacuum(keep=2) == []                                             # too young
    assert sorted(t.vacuum(keep=2, older_than_s=0)) == sorted([*paths[:2], lost])
    assert t.versions() == [2, 3] and bag(t.read(schemas.FINDINGS), "pmcid") == [("3",)]


def test_the_cache_is_found_and_a_bad_one_reads_as_empty(spark, tmp_path):
    root = str(tmp_path / "meta")
    cache = spark.createDataFrame([("syn1", "n", "d", "", "r", None)], schemas.ENTITY_META)
    assert read_entity_meta(spark, root).count() == 0
    path = VersionedTable(spark, root).replace(cache)
    assert read_entity_meta(spark, root).count() == read_entity_meta(spark, path).count() == 1
    for name in os.listdir(path):
        if name.endswith(".parquet"):
            os.remove(os.path.join(path, f".{name}.crc"))
            with open(os.path.join(path, name), "w") as fh:
                fh.write("{}")
    assert read_entity_meta(spark, root).collect() == []


# ------------------------------------------------------------- index of articles ---

IDS = [f"pmc:PMC{n}" for n in (1, 2, 999_999, 1_000_000, 5_000_001, 123_456_789_012)] + ["x", "", None, "pmc:PMC", "PMC7", "pmc:PMC-1", "pmc:PMC" + "9" * 30]


def test_blocks_of_any_id(spark):
    df = spark.createDataFrame([(i,) for i in IDS], "pmcid string").select("pmcid", article_index.block_of(F.col("pmcid")).alias("b"))
    got = {r.pmcid: r.b for r in df.collect()}
    assert [got[i] for i in IDS[:6]] == [0, 0, 0, 1, 5, 123_456] and got["PMC7"] == 0
    assert all(-article_index.OTHER_BLOCKS <= got[i] < 0 for i in ("x", "", None, "pmc:PMC", "pmc:PMC-1", IDS[-1]))


def test_lookup_equals_the_scan(spark, tmp_path):
    numbers = [f"pmc:PMC{n}" for n in range(0, 3_000_000, 1_501)]
    t = table(spark, tmp_path / "t", numbers[::3] + IDS[:4], numbers[1::3] + [None, "x"], [*IDS[4:6], "z"])
    batch = rows(spark, *[(i, "syn2222222", "g") for i in numbers + IDS + [f"pmc:PMC{n}" for n in range(50, 2_000_000, 1_999)]])
    by_index = incremental.new_rows(batch, t.lookup(t.base()))
    by_scan = incremental.new_rows(batch, t.read())
    stored = {r.pmcid for r in t.read().collect()}
    want = sorted((r.pmcid for r in batch.collect() if r.pmcid not in stored), key=str)
    assert [r[0] for r in bag(by_index, "pmcid")] == [r[0] for r in bag(by_scan, "pmcid")] == want and None in stored
    assert len([f for f in t.table.manifest()["parts"]]) == 3


def test_new_articles_read_only_matching_blocks(spark, tmp_path):
    t = table(spark, tmp_path / "t", [f"pmc:PMC{n}" for n in range(0, 9_000_000, 300_000)], ["pmc:PMC20000001", "pmc:PMC20000009"])
    def read_for(*ids):
        df = spark.createDataFrame([(i,) for i in ids], "pmcid string")
        return {f.split("block=")[1].split("/")[0] for f in article_index.stored_articles(t.table, df, t.base()["parts"]).inputFiles()
                if "block=" in f}
    assert read_for("pmc:PMC30000000", "pmc:PMC20000010") == set()             # no block, and outside the block's range
    assert read_for("pmc:PMC600000", "pmc:PMC30000000") == {"0"}
    assert read_for("pmc:PMC20000009") == {"20"}
    unknown = [f"pmc:PMC{n}" for n in range(20_000_002, 20_000_008)]           # in range: the filter turns them away
    assert read_for(*unknown) == set()


def test_parts_are_compacted_and_keep_their_articles(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("accmine.sinks.results.MAX_PARTS", 3)
    t = table(spark, tmp_path / "t", *[[f"pmc:PMC{n}", f"pmc:PMC{n + 1}"] for n in range(0, 12, 2)])
    assert len(t.table.manifest()["parts"]) <= 4
    assert bag(t.read(), "pmcid") == sorted((f"pmc:PMC{n}",) for n in range(12))
    again = incremental.new_rows(rows(spark, ("pmc:PMC3", "syn1111111", "f"), ("pmc:PMC77", "syn1111111", "f")), t.lookup(t.base()))
    assert bag(again, "pmcid") == [("pmc:PMC77",)]


def test_a_plain_folder_is_adopted(spark, tmp_path):
    root = str(tmp_path / "t")
    rows(spark, ("pmc:PMC1", "syn1111111", "f")).select("pmcid", "synid", "context").write.parquet(root)
    assert read_results(spark, root).count() == 1
    jobs.update_results(spark, rows(spark, ("pmc:PMC1", "syn2222222", "f"), ("pmc:PMC2", "syn2222222", "f")), root)
    assert bag(read_results(spark, root), "pmcid", "synid") == [("pmc:PMC1", "syn1111111"), ("pmc:PMC2", "syn2222222")]


# --------------------------------------------------------------- incremental job ---

def put(folder, name, *articles):
    os.makedirs(folder, exist_ok=True)
    with gzip.open(os.path.join(folder, name), "wt") as fh:
        for number, syn in articles:
            fh.write(f'<article v="1"><front><article-meta><article-id pub-id-type="pmc">{number}</article-id></article-meta>'
                     f"</front><body><p>data {syn}</p></body></article>")


@pytest.mark.parametrize("slice_size", [1, 2, 1000])
def test_the_first_file_by_name_wins_whatever_the_slices(spark, tmp_path, slice_size):
    corpus, root = str(tmp_path / "in"), str(tmp_path / "results")
    put(corpus, "PMC900_PMC999.xml.gz", (950, "syn1111111"), (951, "syn1111111"))
    put(corpus, "PMC1000_PMC1999.xml.gz", (950, "syn2222222"), (1500, "syn2222222"))
    put(corpus, "PMC20_PMC29.xml.gz", (951, "syn3333333"), (20, "syn3333333"))
    new = jobs.run_incremental(spark, corpus, root, files_per_slice=slice_size)
    want = [("pmc:PMC1500", "syn2222222"), ("pmc:PMC20", "syn3333333"), ("pmc:PMC950", "syn2222222"), ("pmc:PMC951", "syn3333333")]
    assert bag(new, "pmcid", "synid") == bag(read_results(spark, root), "pmcid", "synid") == want
    assert ResultsTable(spark, root).position() == "PMC1000"
    assert jobs.run_incremental(spark, corpus, root).count() == 0


def test_a_failed_run_keeps_its_slices_and_passes_over_no_file(spark, tmp_path, monkeypatch):
    corpus, root = str(tmp_path / "in"), str(tmp_path / "results")
    for lo in (1000, 900, 20):
        put(corpus, f"PMC{lo}_PMC{lo + 9}.xml.gz", (lo, "syn1111111"))
    mine, calls = jobs.mine_corpus, []

    def failing(*args, **kw):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return mine(*args, **kw)

    monkeypatch.setattr(jobs, "mine_corpus", failing)
    with pytest.raises(RuntimeError):                                         # by name: 1000, 20, 900
        jobs.run_incremental(spark, corpus, root, files_per_slice=1)
    t = ResultsTable(spark, root)
    assert t.position() == "PMC20" and t.read().count() == 2
    monkeypatch.setattr(jobs, "mine_corpus", mine)
    assert bag(jobs.run_incremental(spark, corpus, root), "pmcid") == [("pmc:PMC900",)] and t.position() == "PMC1000"


def test_a_missing_id_is_stored_once(spark):
    batches = rows(spark, (None, "syn1111111", "b"), (None, "syn2222222", "a"), ("p", "syn3333333", "b"), (None, "syn4444444", "a"))
    none, some = rows(spark).select("pmcid"), rows(spark, (None, "s", "f")).select("pmcid")
    assert bag(incremental.first_batch_wins(batches, none), "synid") == [("syn2222222",), ("syn3333333",), ("syn4444444",)]
    assert bag(incremental.first_batch_wins(batches, some), "synid") == bag(incremental.new_rows(batches, some), "synid") == [("syn3333333",)]
    assert incremental.new_rows(batches, none).count() == 4


def test_scratch_of_a_job_goes_at_its_end_unless_it_fails(spark, tmp_path):
    from accmine.session import job_scratch, scratch_path
    from accmine.sinks.tables import stage
    made = []
    with job_scratch(spark):
        made.append(scratch_path(spark, "a"))
        assert stage(spark.range(3), made[0]).count() == 3
        with job_scratch(spark):
            made.append(scratch_path(spark, "b"))
            stage(spark.range(3), made[1])
    with pytest.raises(RuntimeError):
        with job_scratch(spark):
            made.append(scratch_path(spark, "c"))
            stage(spark.range(3), made[2])
            raise RuntimeError
    assert [os.path.exists(p.removeprefix("file:")) for p in made] == [False, False, True]
    assert made[1].startswith(made[0].rsplit("/", 1)[0]) and "/job-" not in scratch_path(spark, "d")


def test_the_weekly_run_goes_on_with_staged_findings(spark, tmp_path, monkeypatch):
    corpus, read, real = str(tmp_path / "in"), [], incremental.first_batch_wins
    for lo in (20, 900, 1000):
        put(corpus, f"PMC{lo}_PMC{lo + 9}.xml.gz", (lo, "syn1111111"))
    monkeypatch.setattr(incremental, "first_batch_wins", lambda found, *a, **kw: (read.extend(found.inputFiles()), real(found, *a, **kw))[1])
    assert jobs.run_incremental(spark, corpus, str(tmp_path / "results"), out_path=str(tmp_path / "out")).count() == 3
    assert read and not any("/findings/" in f for f in read)
    assert jobs.current(spark, str(tmp_path / "out")).count() == 3


def test_an_id_meets_the_filter_once(spark, tmp_path):
    ids = spark.createDataFrame([(f"pmc:PMC{n}", 1000) for n in range(1000)], "pmcid string, n bigint")
    masked = article_index._masked(ids)
    assert masked.count() == 1000 and masked.where("bit_count(mask) not between 1 and 5 or word < 0 or word >= 254").isEmpty()


def test_a_part_of_another_filter_is_told_by_its_ranges(spark, tmp_path):
    t = table(spark, tmp_path / "t", ["pmc:PMC1", "pmc:PMC9"], ["pmc:PMC2000001"])
    older = [{k: v for k, v in p.items() if k != "filter"} for p in t.base()["parts"]]
    df = spark.createDataFrame([(i,) for i in ("pmc:PMC1", "pmc:PMC5", "pmc:PMC2000009")], "pmcid string")
    hit = article_index.stored_articles(t.table, df, older)
    assert [r.pmcid for r in hit.collect()] == ["pmc:PMC1"] and len({f.split("block=")[1][0] for f in hit.inputFiles() if "block=" in f}) == 1

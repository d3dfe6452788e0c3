"""End-to-end jobs: mining runs, the incremental run, combining batches, exports."""

import glob
import gzip
import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from accmine import jobs, session
from accmine.plans import queries as Q
from accmine.session import scratch_path
from accmine.sources import fixtures as fx
from accmine.sources.corpus import corpus_files, write_corpus
from accmine.sources.tables import read_results, read_watermark

COLS = ("source_file", "pmcid", "synid", "context")


def bag(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def art(n, *ids, broken=False):
    return (f'<article v="1"><front><article-meta><article-id pub-id-type="pmc">{n}</article-id></article-meta></front>'
            f'<body>{"".join(f"<p>data {i}</p>" for i in ids)}</body>{"<" if broken else ""}</article>\n')


class Inbox:
    def __init__(self, root):
        self.corpus, self.results, self.position, self.out = (str(root / n) for n in ("corpus", "results", "position", "out"))

    def put(self, name, *articles, folder=""):
        path = os.path.join(self.corpus, folder)
        os.makedirs(path, exist_ok=True)
        with gzip.open(os.path.join(path, name), "wt", encoding="utf-8") as fh:
            fh.write("".join(articles))

    def run(self, spark, **kw):
        return jobs.run_incremental(spark, self.corpus, self.results, self.position, self.out, **kw)


@pytest.fixture()
def inbox(tmp_path):
    return Inbox(tmp_path)


def test_mine_update_export(spark, sf_dir):
    corpus, out = scratch_path(spark, "job-corpus"), scratch_path(spark, "job-out")
    write_corpus(fx.articles_xml_v(spark, sf_dir), corpus)
    found = jobs.mine_corpus(spark, corpus, out, keep_rejects=True)
    obs = Observation("mine")
    plain = jobs.mine_corpus(spark, corpus, scratch_path(spark, "job-out2"), metrics=obs)
    gated = jobs.mine_corpus(spark, corpus, scratch_path(spark, "job-out3"))
    docs = fx.table(spark, sf_dir, "documents")
    assert obs.get["articles"] == docs.count() and obs.get["parsed"] == docs.where("lang <> 'de'").count()
    want = bag(Q.QUERIES["xml_mine"](spark, sf_dir), *COLS)
    assert bag(found, *COLS) == bag(plain, *COLS) == bag(gated, *COLS) == bag(jobs.current(spark, out), *COLS) == want
    bad = jobs.current(spark, out, "rejects")
    assert bad.count() == docs.where("lang = 'de'").count() and bad.where(F.col("reason").isNull()).count() == 0

    results, position = f"{out}/results", f"{out}/position"
    first = jobs.update_results(spark, found, results, watermark_path=position)
    assert first.count() == found.count()
    assert jobs.update_results(spark, found, results).count() == 0           # the same batch again: nothing new
    assert read_results(spark, results).count() == found.count()
    assert read_watermark(spark, position).startswith("PMC")

    stored = read_results(spark, results)
    jobs.export_links(spark, stored, f"{out}/feeds", 42)
    assert spark.read.option("header", True).csv(f"{out}/feeds/resources").count() == found.count()
    version = jobs.export_search(spark, stored, fx.entity_v(spark, sf_dir), fx.catalog_v(spark, sf_dir),
                                 fx.app_v(spark, sf_dir), f"{out}/cache", f"{out}/search")
    assert spark.read.parquet(version).count() > 0
    assert glob.glob(os.path.join(out.removeprefix("file://"), "search", "part-*"))


def test_resume_and_slices(spark, inbox):
    for lo in (1, 11, 21):
        inbox.put(f"PMC{lo}_PMC{lo + 9}.xml.gz", art(lo, f"syn555000{lo}0"), art(lo + 1, f"syn555000{lo}1"))
    assert inbox.run(spark, max_files=2, files_per_slice=1).count() == 4 and read_watermark(spark, inbox.position) == "PMC11"
    assert bag(inbox.run(spark), "pmcid") == [("pmc:PMC21",), ("pmc:PMC22",)]     # resumes at PMC11, inclusive
    assert read_watermark(spark, inbox.position) == "PMC21" and inbox.run(spark).count() == 0
    assert read_results(spark, inbox.results).count() == 6


def test_a_corpus_without_mentions_moves_on(spark, inbox):
    inbox.put("PMC1_PMC9.xml.gz", art(1, "nothing"))
    assert inbox.run(spark, keep_rejects=True).count() == 0
    assert read_watermark(spark, inbox.position) == "PMC1"
    assert jobs.current(spark, inbox.out).count() == 0 and jobs.current(spark, inbox.out, "rejects").count() == 0
    inbox.put("PMC10_PMC19.xml.gz", art(10, "syn5550010"))
    assert bag(inbox.run(spark), "pmcid") == [("pmc:PMC10",)]


def test_an_empty_folder_writes_no_position(spark, inbox):
    os.makedirs(inbox.corpus)
    assert inbox.run(spark).count() == 0 and read_watermark(spark, inbox.position) is None


def test_the_position_never_moves_back_or_vanishes(spark, inbox):
    name = lambda *n: spark.createDataFrame([(x,) for x in n], "file_name string")
    jobs.move_watermark(spark, inbox.position, name("PMC50_PMC59.xml.gz", "PMC9_PMC9.xml.gz"))
    for older in (name("PMC1_PMC9.xml.gz"), name("notes.txt"), name("x").where("false")):
        jobs.move_watermark(spark, inbox.position, older)
        assert read_watermark(spark, inbox.position) == "PMC50"
    jobs.move_watermark(spark, inbox.position, name("PMC100_PMC109.xml.gz"))
    assert read_watermark(spark, inbox.position) == "PMC100"


def test_one_archive_in_two_folders_is_read_once(spark, inbox):
    for folder in ("a", "b"):
        inbox.put("PMC1_PMC9.xml.gz", art(1, "syn5550001", "syn5550002"), folder=folder)
    assert inbox.run(spark).count() == 2
    assert [len(r.paths) for r in corpus_files(spark, inbox.corpus).collect()] == [1]


def test_sidecars_are_no_archives(spark, inbox):
    inbox.put("PMC1_PMC9.xml.gz", art(1, "syn5550001"))
    for name in ("PMC90_PMC99.xml.gz.md5", "PMC80_PMC89.filelist.csv", "PMC70_PMC79.xml"):
        with open(os.path.join(inbox.corpus, name), "w") as fh:
            fh.write(art(90, "syn5550090"))
    assert bag(inbox.run(spark), "pmcid") == [("pmc:PMC1",)] and read_watermark(spark, inbox.position) == "PMC1"
    assert bag(corpus_files(spark, inbox.corpus, ".xml"), "file_name") == [("PMC70_PMC79.xml",)]


def test_what_holds_is_the_latest_run_of_a_file(spark, inbox):
    inbox.put("PMC1_PMC9.xml.gz", art(1, "syn5550001"), art(2, "x", broken=True))
    inbox.put("PMC10_PMC19.xml.gz", art(10, "syn5550010"), art(11, "x", broken=True))
    jobs.mine_corpus(spark, inbox.corpus, inbox.out, keep_rejects=True)
    inbox.put("PMC1_PMC9.xml.gz", art(1, "withdrawn"))
    jobs.mine_corpus(spark, os.path.join(inbox.corpus, "PMC1_PMC9.xml.gz"), inbox.out, keep_rejects=True)
    assert bag(jobs.current(spark, inbox.out), "source_file", "synid") == [("PMC10_PMC19.xml.gz", "syn5550010")]
    assert bag(jobs.current(spark, inbox.out, "rejects"), "source_file") == [("PMC10_PMC19.xml.gz",)]


def test_findings_are_few_files(spark, inbox):
    for lo in range(1, 9):
        inbox.put(f"PMC{lo}0_PMC{lo}9.xml.gz", *[art(lo * 10 + k, f"syn55500{lo}{k}") for k in range(9)])
    found = jobs.mine_corpus(spark, inbox.corpus, inbox.out, partitions=16)
    assert found.count() == 72 and len(found.inputFiles()) == 8


def test_combine(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    (src / "r.PMC5_PMC6.xml.gz.csv").write_text('pmcid,synid,context\npmc:PMC5,syn1,"say ""x"", a \\"\npmc:PMC6,syn2,c\n')
    (src / "r.PMC1_PMC2.xml.gz.csv").write_text('synid,context,pmcid\nsyn2,c,pmc:PMC6\nsyn2,c,pmc:PMC6\n')
    stats = jobs.combine_batches(spark, str(src), out).first().asDict()
    assert stats == {"rows_before": 4, "rows_after": 2, "unique_synids": 2, "files": 2}
    got = spark.read.option("header", True).option("escape", '"').csv(f"{out}/combined")
    assert bag(got, "pmcid", "synid", "context", "source_file") == [
        ("pmc:PMC5", "syn1", 'say "x", a \\', "PMC5_PMC6.xml.gz"), ("pmc:PMC6", "syn2", "c", "PMC1_PMC2.xml.gz")]
    assert spark.read.parquet(f"{out}/stats").count() == 1


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())

"""Plan shape and skew: what the optimizer does with the operators."""

import pytest

from accmine.operators import dedup, incremental, joins, summarize
from accmine.plans import queries as Q
from accmine.sinks import feeds
from accmine.sources import fixtures as fx


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_mining_plan_is_native_and_pruned(spark, sf_dir):
    df = Q.QUERIES["mention_context"](spark, sf_dir)
    p = plan(df)
    assert "EvalPython" not in p and "PythonUDF" not in p
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_coverage_parses_once(spark, sf_dir):
    assert plan(Q.QUERIES["coverage_audit"](spark, sf_dir)).count("ArrowEvalPython") == 1


def test_aggregates_over_rows_are_hash_aggregates(spark):
    df, _ = hot(spark, 60)
    assert "SortAggregate" not in plan(dedup.combine_dedup(df)) + plan(dedup.combine_stats(df))
    assert "SortAggregate" not in plan(incremental.first_batch_wins(df, df.select("pmcid").where("false")))
    assert plan(dedup.combine_stats(df)).count("Expand") == 0


SMALL = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
         "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
         "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16",
         "spark.sql.files.maxPartitionBytes": "20k", "spark.sql.files.openCostInBytes": "1k"}


@pytest.fixture()
def low_thresholds(spark):
    old = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark, n=30000):
    """One article, and one id, hold a third of all rows, spread over several batch files."""
    rows = [(f"pmc:PMC{0 if k % 3 == 0 else k}", f"syn{1000000 if k % 3 == 1 else 1000000 + k}", f"context number {k}",
             f"PMC{k % 5 * 10}_PMC{k % 5 * 10 + 9}.xml.gz") for k in range(n)]
    return spark.createDataFrame(rows, "pmcid string, synid string, context string, source_file string").repartition(8), rows


def bag(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_new_rows_split_a_hot_article(spark, low_thresholds):
    df, rows = hot(spark)
    stored = spark.createDataFrame([("pmc:PMC4",), ("pmc:PMC7",)], "pmcid string")
    out = incremental.new_rows(df, stored)
    assert len(out.collect()) == len([r for r in rows if r[0] not in ("pmc:PMC4", "pmc:PMC7")])
    assert "skew=true" in plan(out)


def test_first_batch_wins_splits_a_hot_article(spark, low_thresholds):
    df, rows = hot(spark)
    stored = spark.createDataFrame([("pmc:PMC7",)], "pmcid string")
    first = {}
    for p, _, _, f in rows:
        first[p] = min(first.get(p, f), f)
    out = incremental.first_batch_wins(df, stored)
    assert sorted(map(tuple, out.collect())) == sorted(r for r in rows if r[3] == first[r[0]] and r[0] != "pmc:PMC7")
    assert "skew=true" in plan(out)


def test_citations_split_a_hot_id(spark, low_thresholds):
    df, rows = hot(spark)
    out = summarize.citations_by_id(df)
    got = {r.synid: r.n_articles for r in out.collect()}
    assert got["syn1000000"] == len({r[0] for r in rows if r[1] == "syn1000000"})
    assert "skew=true" in plan(out)


def test_pairs_skip_missing_keys(spark):
    rows = [("pmc:PMC1", "syn1"), ("PMC1", "syn1"), ("pmc:", "syn1"), ("", "syn1"), (None, "syn1"), ("pmc:PMC2", ""), ("pmc:PMC2", None),
            (None, None), ("pmc:pmc:X", "syn2")]
    df = spark.createDataFrame(rows, "pmcid string, synid string")
    assert bag(summarize.citation_pairs(df), "synid", "pmcid") == [("syn1", "PMC1"), ("syn2", "pmc:X")]
    # the link feed checks the stored id, so a bare prefix is a link with an empty article
    assert bag(dedup.distinct_links(df), "synid", "pmcid") == [("syn1", ""), ("syn1", "PMC1"), ("syn2", "pmc:X")]


def test_an_empty_feed_is_written(spark, tmp_path):
    lines = spark.createDataFrame([], "k0 string, k1 int, k2 string, line string")
    feeds.write_search_feed(lines, f"{tmp_path}/feed", staging=f"{tmp_path}/staged")
    assert feeds.read_feed_lines(spark, f"{tmp_path}/feed").collect() == []


def test_hot_rows_combine(spark):
    df, rows = hot(spark, 3000)
    again = df.unionByName(df.withColumn("source_file", df.source_file.substr(1, 4)))
    assert dedup.combine_dedup(again).count() == len({r[:3] for r in rows})


def test_catalogue_follows_its_table(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/supplier.parquet").where("s_suppkey % 5 <> 0").count()
    own = fx.catalog_v(spark, sf_dir).where("length(id) = 9").select("id").distinct().count()
    assert own == n > 0
    big = fx.catalog_v(spark, "/root/testdata/sf0.01").where("length(id) = 9").select("id").distinct().count()
    assert big > n


def test_spread_looks_at_the_listing_only(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    wide = joins.spread(docs, ["doc_id"])
    assert len(tracker.getJobIdsForGroup(None)) == before
    assert wide.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    docs.repartition(8).write.option("compression", "gzip").json(str(tmp_path / "z"))
    gz = spark.read.text(str(tmp_path / "z"))
    tasks, size = joins.scan_tasks(gz, splittable=False)
    assert tasks == 8 and size > 0
    wide = joins.spread(gz, ["value"], splittable=False, expansion=6.0, task_bytes=size // 3)
    assert wide.rdd.getNumPartitions() == -(-int(size * 6.0) // (size // 3))
    assert joins.spread(gz, ["value"], splittable=False) is gz
    assert joins.scan_tasks(spark.range(5)) is None

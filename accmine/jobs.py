"""End-to-end batch jobs: the runs a user of the original tool performs, as Spark jobs.

* ``mine_corpus``     corpus files -> findings of the run (one folder per corpus file) + rejects
* ``update_results``  findings batches -> append unseen articles to the results table + watermark
* ``run_incremental`` resume, mine, append, move the watermark
* ``combine_batches`` findings CSV batches -> one deduplicated table + statistics
* ``export_links``    results -> link feed (XML) and resource list (CSV)
* ``export_search``   results + entities + catalogue -> refreshed metadata cache + search feed

Mining runs are kept side by side (``findings/run=…``, ``rejects/run=…``) with the list of files that each
run processed (``files/run=…``, written last). What holds for a file is what the latest run that
processed it found, also if that is nothing: see ``current``.
"""

from __future__ import annotations

import time
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from . import schemas
from .functions.fixed import CONTEXT_WINDOW, CORPUS_SUFFIX
from .functions.text import source_file_from_path
from .operators import dedup, enrich, incremental, summarize
from .operators.articles import findings_from_articles
from .operators.joins import spread
from .operators.mine import DEFAULT_PATTERN, AccessionPattern
from .operators.ordering import with_ordinal
from .operators.parse import parse_articles
from .session import job_scratch, scratch_path
from .sinks import feeds
from .sinks.results import ResultsTable
from .sinks.tables import stage
from .sinks.versions import VersionedTable
from .sources.corpus import corpus_files, read_articles, read_findings_csv
from .sources.tables import read_entity_meta, read_watermark

FILES_PER_SLICE = 1000    # file names that the driver holds at once


def new_run() -> str:
    """A name for a run; later runs sort after earlier ones."""
    return f"r{time.time_ns():020d}"


def mine_corpus(spark: SparkSession, corpus_path, out_path: str, window: int = CONTEXT_WINDOW,
                case_rule: str = "reference", pattern: AccessionPattern = DEFAULT_PATTERN,
                partitions: int | None = None, glob: str | None = None, keep_rejects: bool = False,
                metrics: Observation | None = None, run: str | None = None, staged: bool = False) -> DataFrame:
    """Mine every article of the corpus (a folder, a file or a list of files) and return the run's findings
    as written below ``out_path/findings/run=…``.

    When only findings are wanted, articles that cannot hold an id are left out before the Python parse (see
    ``parse.may_hold_id``; the findings are the same). With ``keep_rejects`` every article is parsed, once:
    the parse is staged (text, and the raw XML of articles that failed) and the findings and
    ``out_path/rejects/run=…`` are made from it. With ``metrics`` (an ``Observation``) the job also reports
    articles seen / parsed / with an id while it runs, without an extra pass (V4 live counts).

    With ``staged`` the findings returned are the table staged for that write, which lasts as long as the caller's
    ``job_scratch``: the files below ``findings/`` are many, and a job that goes on need not list and open them."""
    run = run or new_run()
    raw = read_articles(spark, corpus_path, glob=glob)
    audited = keep_rejects or metrics is not None
    keep = ("source_file", "xml") if keep_rejects else ("source_file",)
    parsed = parse_articles(raw, "xml", keep, partitions, None if audited else pattern.prefix)
    if metrics is not None:
        parsed = parsed.observe(metrics, F.count(F.lit(1)).alias("articles"),
                                F.count_if(F.col("ok")).alias("parsed"),
                                F.count_if(F.col("pmc_id").isNotNull()).alias("with_id"))
    if keep_rejects:
        parsed = stage(parsed.select("source_file", "ok", "reason", "pmc_id", "text",
                                     F.when(~F.col("ok"), F.col("xml")).alias("xml")), scratch_path(spark, "parsed"))
        (parsed.where(~F.col("ok")).select("source_file", "xml", "reason").hint("rebalance")
               .write.mode("overwrite").parquet(f"{out_path}/rejects/run={run}"))
    found = findings_from_articles(parsed, ("source_file",), window, case_rule, pattern)
    found = stage(found.select("pmcid", "synid", "context", "source_file"), scratch_path(spark, "found"))
    # findings are few beside the text and their files many, so tasks share the files out, not the bytes: gathered
    # by corpus file, whatever the number of parse tasks
    (spread(found, ["source_file"], spark.sparkContext.defaultParallelism)
          .write.mode("overwrite").partitionBy("source_file").parquet(f"{out_path}/findings/run={run}"))
    listing = spark.read.format("binaryFile")
    listing = listing.option("pathGlobFilter", glob) if glob else listing
    (listing.load(corpus_path).select(source_file_from_path("path").alias("source_file")).distinct()
            .write.mode("overwrite").parquet(f"{out_path}/files/run={run}"))
    return found if staged else spark.read.schema(schemas.FINDINGS).parquet(f"{out_path}/findings/run={run}")


def current(spark: SparkSession, out_path: str, what: str = "findings") -> DataFrame:
    """The findings (or ``"rejects"``) that hold now: for every file those of the latest run that processed
    it. A file that was mined again and has none any more has none."""
    schema = {"findings": schemas.FINDINGS, "rejects": schemas.REJECTS}[what]
    with_run = StructType([*schema.fields, StructField("run", StringType())])
    latest = (spark.read.schema(schemas.RUN_FILES).parquet(f"{out_path}/files")
                   .groupBy("source_file").agg(F.max("run").alias("run")))
    rows = spark.read.schema(with_run).parquet(f"{out_path}/{what}")
    return rows.join(latest, ["source_file", "run"], "left_semi").select(*schema.fieldNames())


def move_watermark(spark: SparkSession, path: str, processed: DataFrame) -> None:
    """Write the highest start id of the processed files (column ``file_name``, K8) unless a higher one is
    there; without a file with a range nothing is written. The position never moves back."""
    row = incremental.watermark(processed).first()
    old = read_watermark(spark, path)
    if row is None or (old is not None and int(old[3:]) >= row.start_pmc):
        return
    stamp = datetime.now(timezone.utc).isoformat()
    (spark.createDataFrame([(row.last_processed_pmc_id, row.start_pmc, stamp)], schemas.WATERMARK).coalesce(1)
          .write.mode("append").parquet(path))


def update_results(spark: SparkSession, findings: DataFrame, results_path: str,
                   check_duplicates: bool = True, watermark_path: str | None = None,
                   processed: DataFrame | None = None, position: str | None = None) -> DataFrame:
    """Append findings of articles not yet stored to the results table (J2 + J1 + K3) and return the
    appended rows. Batches are the ``source_file`` values; the first batch by name wins an article. Stored
    articles are looked up in the table's index; rows and ``position`` are committed together.

    With ``watermark_path`` a position table of its own moves over the ``processed`` files (column
    ``file_name``; default: the files with findings)."""
    results = ResultsTable(spark, results_path)
    with job_scratch(spark):
        new = results.append(lambda lookup: incremental.first_batch_wins(findings, lookup, check_duplicates=check_duplicates), position)
    if watermark_path:
        if processed is None:
            processed = findings.select(F.col("source_file").alias("file_name")).distinct()
        move_watermark(spark, watermark_path, processed)
    return results.rows(new)


def run_incremental(spark: SparkSession, corpus_path: str, results_path: str, watermark_path: str | None = None,
                    out_path: str | None = None, max_files: int | None = None, suffix: str = CORPUS_SUFFIX,
                    files_per_slice: int = FILES_PER_SLICE, **mine_args) -> DataFrame:
    """The weekly run as one batch job: resume from the saved position, mine the corpus files from there on
    (at most ``max_files``, in id order), append findings of unseen articles, and move the position after
    the files are done. Returns the appended rows.

    The files of a run are taken in slices, so the driver never holds more than ``files_per_slice`` names.
    Slices follow the order in which the first batch wins, that of the names, so the rows do not depend on the
    slices. The position is that of the results table, committed with each slice's rows: the highest start
    among the files done below which none is left, so a failed run keeps the slices before and repeats none
    but those above it. ``watermark_path`` names a position table of its own, moved once at the end.

    The resume is inclusive, so the last file is mined again; the articles found stored are dropped.
    (``streaming.ingest`` gives the same with a checkpoint instead of a position.)"""
    out_path = out_path or f"{results_path.rstrip('/')}-mined"
    results = ResultsTable(spark, results_path)
    files = incremental.file_catalog(corpus_files(spark, corpus_path, suffix))
    start = read_watermark(spark, watermark_path) if watermark_path else results.position()
    if start is not None:
        files = files.where(F.col("start_pmc") >= int(start[3:]))
    picked = stage(with_ordinal(incremental.resume_files(files, max_files=max_files), ["file_name"]), scratch_path(spark, "corpus-files"))
    n, appended = picked.count(), []
    for at in range(0, n, files_per_slice):
        now = picked.where(F.col("ordinal").between(at, at + files_per_slice - 1)).select("paths").collect()
        rest = picked.where(F.col("ordinal") >= at + files_per_slice).agg(F.min("start_pmc")).first()[0]
        done = picked.where(F.col("ordinal") < at + files_per_slice)
        done = done if rest is None else done.where(F.col("start_pmc") < rest)
        reached = done.agg(F.max("start_pmc")).first()[0]
        with job_scratch(spark):
            found = mine_corpus(spark, [p for r in now for p in r.paths], out_path, staged=True, **mine_args)
            appended += results.append(lambda lookup: incremental.first_batch_wins(found, lookup),  # noqa: B023 (called at once)
                                       None if reached is None else f"PMC{reached}")
    if watermark_path and n:
        move_watermark(spark, watermark_path, picked.select("file_name"))
    return results.rows(appended)


def combine_batches(spark: SparkSession, in_path: str, out_path: str, glob: str = "*.csv",
                    source_file: bool = True) -> DataFrame:
    """Findings CSV batches of a folder -> one deduplicated CSV table below ``out_path/combined``
    and a row of statistics (A4), returned and written below ``out_path/stats``. Rows equal in all but their
    batch keep the first batch by name; without ``source_file`` the batch is not written."""
    with job_scratch(spark):
        combined, stats = dedup.combine(read_findings_csv(spark, in_path, glob))
        feeds.write_csv(combined if source_file else combined.drop("source_file"), f"{out_path}/combined")
        return stage(stats, f"{out_path}/stats")


def export_links(spark: SparkSession, results: DataFrame, out_dir: str, provider_id: int,
                 cfg: enrich.PortalConfig = enrich.PortalConfig()) -> None:
    """Link feed (one well-formed XML document per task) and resource list CSV."""
    feeds.write_link_feed(feeds.link_rows(results, provider_id, cfg), f"{out_dir}/links")
    feeds.write_csv(feeds.resource_rows(results, provider_id, cfg), f"{out_dir}/resources")


def refresh_metadata(spark: SparkSession, pairs: DataFrame, entities: DataFrame, portals: DataFrame, cache_root: str,
                     cfg: enrich.PortalConfig = enrich.PortalConfig(), refresh: bool = False, cache_path: str | None = None) -> str:
    """Refresh the metadata cache at ``cache_root`` (J5): read its committed version (or ``cache_path``), add the
    cited ids that it lacks, and commit the result. Returns the new version's folder."""
    new = enrich.refresh_cache(pairs, read_entity_meta(spark, cache_path or cache_root), entities, portals, cfg, refresh)
    return VersionedTable(spark, cache_root).replace(new)


def export_search(spark: SparkSession, results: DataFrame, entities: DataFrame, catalog: DataFrame,
                  apps: DataFrame, cache_root: str, out_path: str, cache_path: str | None = None,
                  refresh: bool = False, name: str = "Datasets",
                  description: str = "Datasets cited in articles",
                  cfg: enrich.PortalConfig = enrich.PortalConfig(), partitions: int | None = None) -> str:
    """Refresh the metadata cache below ``cache_root`` (see ``refresh_metadata``) and write the search feed.
    Returns the folder of the new cache version."""
    with job_scratch(spark):
        portals = stage(enrich.portal_table(catalog, apps, cfg), scratch_path(spark, "portals"))
        pairs = stage(summarize.citation_pairs(results), scratch_path(spark, "cited-pairs"))
        version = refresh_metadata(spark, pairs, entities, portals, cache_root, cfg, refresh, cache_path)
        entries = stage(enrich.search_entries(pairs, read_entity_meta(spark, version), cfg), scratch_path(spark, "entries"))
        lines = feeds.search_feed_lines(entries, pairs, name, description, date.today().isoformat())
        feeds.write_search_feed(lines, out_path, partitions, staging=scratch_path(spark, "feed-lines"))
        return version

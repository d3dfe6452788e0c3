"""Incremental runs as Structured Streaming.

The checkpoint replaces the saved "last processed id": a file is processed once,
a failed micro-batch is retried, and every micro-batch writes to its own
``batch_id=N`` folder with overwrite, so a replay replaces its own output.
``trigger(availableNow=True)`` gives the weekly-job behaviour: process what is
new, then stop.
"""

from __future__ import annotations

import json
import sys
from contextlib import contextmanager

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from .. import schemas
from ..functions.fixed import ARTICLE_OPEN, CONTEXT_WINDOW
from ..functions.text import source_file_from_path
from ..operators.article_index import article_number
from ..operators.articles import coverage_of, findings_from_articles, findings_of, with_findings
from ..operators.incremental import first_batch_wins
from ..operators.mine import DEFAULT_PATTERN, AccessionPattern
from ..operators.parse import parse_articles
from ..session import scratch_path
from ..sinks.tables import stage
from ..sources.corpus import articles_from_records

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # workers need no installed package


LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTINGS_PER_CORE = 4


@contextmanager
def shared_listing(spark: SparkSession):
    """A stream lists the folders of its inbox, and the files of a micro-batch, as jobs of a task a path (up to
    10,000): with many small files that takes longer than the work. Streams started inside list with a few
    tasks a core, each many paths."""
    old = spark.conf.get(LISTING_TASKS)
    spark.conf.set(LISTING_TASKS, str(min(int(old), LISTINGS_PER_CORE * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(LISTING_TASKS, old)


def corpus_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                  tag_prefix: str = ARTICLE_OPEN) -> DataFrame:
    r = spark.readStream.option("lineSep", tag_prefix)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    recs = r.text(path).select(F.col("_metadata.file_path").alias("_path"), "value")
    return articles_from_records(recs, tag_prefix)


def ingest_corpus(spark: SparkSession, in_path: str, out_path: str, checkpoint: str,
                  partitions: int | None = None, max_files_per_trigger: int | None = None,
                  window: int = CONTEXT_WINDOW, case_rule: str = "reference",
                  pattern: AccessionPattern = DEFAULT_PATTERN, rejects_path: str | None = None,
                  audit: bool = True):
    """Mine new corpus files into ``out_path/batch_id=N`` (parquet); returns the finished query.

    The mining options are those of the batch job. Every article is parsed and mined, once: those that do not parse go
    to ``rejects_path/batch_id=N`` (default: ``<out_path>-rejects``) with their XML and reason, and each
    micro-batch writes its coverage by file (V4) to ``<out_path>-coverage/batch_id=N``; a replay writes
    both anew. Without ``audit`` neither is kept, and only articles that can hold an id are parsed.

    Gzip files are one task each, so a micro-batch should hold at least as many files as the
    cluster has cores: by default a run takes everything that landed since the last one.
    ``max_files_per_trigger`` bounds a micro-batch when a backlog is larger than one job should be."""
    rejected = rejects_path or f"{out_path.rstrip('/')}-rejects"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if audit or rejects_path:
            parsed = parse_articles(batch, "xml", ("source_file", "xml"), partitions=partitions)
            mined = with_findings(parsed.withColumn("xml", F.when(~F.col("ok"), F.col("xml"))), window, case_rule, pattern)
            mined = stage(mined, scratch_path(spark, "stream-parsed"))
            (mined.where(~F.col("ok")).select("source_file", "xml", "reason")
                   .write.mode("overwrite").parquet(f"{rejected}/batch_id={batch_id}"))
            (coverage_of(mined).hint("rebalance")
             .write.mode("overwrite").parquet(f"{out_path.rstrip('/')}-coverage/batch_id={batch_id}"))
            f = findings_of(mined)
        else:
            parsed = parse_articles(batch, "xml", ("source_file",), partitions=partitions, only_ids=pattern.prefix)
            f = findings_from_articles(parsed, ("source_file",), window, case_rule, pattern)
        (f.select("pmcid", "synid", "context", "source_file").hint("rebalance")
          .write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}"))

    with shared_listing(spark):
        q = (corpus_stream(spark, in_path, max_files_per_trigger).writeStream
             .foreachBatch(write_batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    return q


def stream_coverage(spark: SparkSession, out_path: str) -> DataFrame:
    """Coverage by file over all micro-batches of ``ingest_corpus`` (V4); a file's articles are counted in the
    micro-batch that read it."""
    rows = spark.read.parquet(f"{out_path.rstrip('/')}-coverage")
    counts = [c for c in rows.columns if c not in ("source_file", "batch_id")]
    return rows.groupBy("source_file").agg(*[F.sum(c).cast("bigint").alias(c) for c in counts])


def findings_by_path(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New findings with the path of their file (``_path``), from which ``source_file`` follows."""
    # a file whose header names other columns, or the same in another order, stops the stream
    r = (spark.readStream.schema(schemas.FINDINGS_CSV).option("header", True).option("escape", '"')
              .option("enforceSchema", False))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True).csv(path)
    return df.select("pmcid", "synid", "context", F.col("_metadata.file_path").alias("_path"))


def findings_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    df = findings_by_path(spark, path, max_files_per_trigger)
    return df.select("pmcid", "synid", "context", source_file_from_path("_path").alias("source_file"))


def staged_findings(spark: SparkSession, batch: DataFrame) -> DataFrame:
    """A micro-batch of ``findings_by_path`` as pmcid, synid, context, source_file: its CSV files are read once, into a
    staged table, and a name is taken from each path, not from that of each row."""
    rows = stage(batch, scratch_path(spark, "append-batch"))
    paths = rows.select(F.col("_path").alias("_p")).distinct()
    files = stage(paths.select("_p", source_file_from_path("_p").alias("source_file")), scratch_path(spark, "append-files"))
    return rows.join(files, F.col("_path") == F.col("_p")).select("pmcid", "synid", "context", "source_file")


def append_results(spark: SparkSession, in_path: str, results_path: str, checkpoint: str,
                   max_files_per_trigger: int | None = None, check_duplicates: bool = True):
    """Append findings of unseen articles to the results table at ``results_path``.

    The table is a folder of ``batch=…`` parquet partitions. Each micro-batch keeps the first
    batch file per article (J2), drops articles stored by *other* batches (J1) and overwrites its
    own partition, so a replay after a failure gives the same rows. Without ``check_duplicates`` stored
    articles are appended again; inside a micro-batch the first file of an article still wins."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        append_batch(spark, staged_findings(spark, batch), batch_id, results_path, check_duplicates)

    with shared_listing(spark):
        q = (findings_by_path(spark, in_path, max_files_per_trigger).writeStream
             .foreachBatch(write_batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    return q


def append_batch(spark: SparkSession, batch: DataFrame, batch_id, results_path: str,
                 check_duplicates: bool = True) -> None:
    """One micro-batch of T2: keep the first batch file per article, drop articles stored by
    *other* batches, overwrite this batch's own partition. Running it again for the same
    ``batch_id`` (a replay after a failure) leaves the table exactly as one run would."""
    stored = spark.read.parquet(results_path).where(F.col("batch") != F.lit(str(batch_id)))
    rows = first_batch_wins(batch, stored.select("pmcid"), check_duplicates=check_duplicates)
    rows.write.mode("overwrite").parquet(f"{results_path}/batch={batch_id}")


def init_results_table(initial: DataFrame, results_path: str) -> None:
    """Create the results table with the rows stored so far (partition ``batch=initial``)."""
    cols = [F.col(c) if c in initial.columns else F.lit(None).cast("string").alias(c)
            for c in schemas.FINDINGS.fieldNames()]
    initial.select(*cols).write.mode("overwrite").parquet(f"{results_path}/batch=initial")


# ------------------------------------------------------- first batch as state ---

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_OUT = "pmcid string, synid string, context string, source_file string, winner boolean"


STATE_IDS = 1024          # article numbers whose state is one value
OTHER_STATES = 4096       # values for ids without a number, by hash


def state_block(pmcid: Column) -> Column:
    """The group whose state has an article: neighbouring numbers share one, ids without a number (and null) go
    by hash below zero."""
    return F.coalesce(F.floor(article_number(pmcid) / STATE_IDS), F.lit(-1) - F.pmod(F.xxhash64(pmcid), F.lit(OTHER_STATES))).cast("bigint")


class FirstBatch(StatefulProcessor):
    """The articles seen so far, as state: one value for each block of articles (``state_block``), so a call into
    Python and its state serve many articles. A new article's rows pass while no file before theirs was seen, and
    a last row names the winner, so no article's rows are held in memory; the rows of the winner are picked when
    the micro-batch is written."""

    def init(self, handle) -> None:
        self.seen = handle.getValueState("seen", "ids string")

    def _known(self) -> set:
        return set(json.loads(self.seen.get()[0])) if self.seen.exists() else set()

    def _add(self, known: set, ids) -> None:
        self.seen.update((json.dumps([*known, *ids]),))

    def handleInputRows(self, key, rows, timerValues):
        known, winners = self._known(), {}
        for frame in rows:
            ids = frame["pmcid"].astype(object).where(frame["pmcid"].notna(), None)
            new = [i not in known for i in ids]
            frame, ids = frame[new], ids[new]
            names = frame["source_file"].fillna("")
            for i, name in zip(ids, names):
                if i not in winners or name < winners[i]:
                    winners[i] = name
            keep = [name <= winners[i] for i, name in zip(ids, names)]
            if any(keep):
                yield frame[keep].assign(winner=False)[["pmcid", "synid", "context", "source_file", "winner"]]
        if winners:
            self._add(known, winners)
            yield pd.DataFrame({"pmcid": list(winners), "synid": None, "context": None, "source_file": list(winners.values()), "winner": True})

    def handleInitialState(self, key, initialState, timerValues) -> None:
        known = self._known()                    # a block's stored articles may come in several frames
        self._add(known, {None if pd.isna(i) else i for i in initialState["pmcid"]} - known)

    def close(self) -> None:
        pass


def append_keyed(spark: SparkSession, in_path: str, results_path: str, checkpoint: str,
                 max_files_per_trigger: int | None = None, stored: DataFrame | None = None):
    """T2 with the articles as state: like ``append_results``, but what is stored is known from the stream's own
    state (RocksDB), so a micro-batch reads no results. ``stored`` (pmcid) are the articles of the table when
    the stream first starts. State and output are tied to the micro-batch: a replay starts from the state
    before it and overwrites its own ``batch=…`` partition."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        out = stage(batch, scratch_path(spark, "keyed-batch"))           # the stateful step runs once
        winners = stage(out.where("winner").select(F.col("pmcid").alias("_id"), F.col("source_file").alias("_first")),
                        scratch_path(spark, "keyed-winners"))
        rows = out.where("not winner").join(winners, F.col("pmcid").eqNullSafe(F.col("_id")))
        (rows.where(F.coalesce("source_file", F.lit("")) <= F.col("_first")).select("pmcid", "synid", "context", "source_file")
             .write.mode("overwrite").parquet(f"{results_path}/batch={batch_id}"))

    before = stored if stored is not None else spark.createDataFrame([], "pmcid string")
    before = before.select("pmcid").distinct().withColumn("block", state_block(F.col("pmcid")))
    old = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        with shared_listing(spark):
            found = findings_stream(spark, in_path, max_files_per_trigger).withColumn("block", state_block(F.col("pmcid")))
            keyed = found.groupBy("block").transformWithStateInPandas(FirstBatch(), _OUT, "append", "none", initialState=before.groupBy("block"))
            q = (keyed.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
            q.awaitTermination()
    finally:
        spark.conf.unset(STATE_STORE) if old is None else spark.conf.set(STATE_STORE, old)
    return q

"""The training-data pipeline: documents in, cleaned and encoded documents out.

Each stage calls one training-data operator on all that the stage before kept, and its decisions take
effect. ``run`` writes each stage's rows as Parquet below ``spark.checkpoint.dir`` and reads them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accmine.llm import byte_bpe, decontaminate, quality, simhash, toxicity
from accmine.llm.common import crc_mod, free_name, read
from accmine.session import job_scratch, scratch_path


def _keep(docs: DataFrame, scored, condition) -> DataFrame:
    """Rows of ``docs`` whose score meets the condition; the score's column is dropped again."""
    name = free_name(docs, "score")
    return scored(name).where(condition(F.col(name))).drop(name)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject. It learns from the labelled documents outside
    its held-out third."""
    model = toxicity.train_model(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), crc_mod("doc_id", 3) != 1)
    return _keep(docs, lambda c: toxicity.score_documents(docs, model, out_col=c), lambda s: s < toxicity.THRESHOLD)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject. It learns from the labelled documents outside
    its held-out fifth."""
    model = quality.train_model(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), crc_mod("doc_id", 5) != 0)
    return _keep(docs, lambda c: quality.score_documents(docs, model, out_col=c), lambda s: s >= quality.THRESHOLD)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return simhash.keep_one(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the benchmark's passages: occurring windows are cut out of the texts."""
    return decontaminate.remove_contamination(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, with its token ids, their number, and digests of the ids and of the decoded bytes. A column of
    the documents that has one of these names stays, and the new one gets an underscore."""
    names = {c: free_name(docs, c) for c in ("n_tokens", "ids_sha256", "decoded_sha256", "ids")}
    bpe = free_name(docs, "bpe")
    out = byte_bpe.round_trip_digests(docs, out_col=bpe, keep_ids=True)
    return out.select(*docs.columns, *[F.col(f"{bpe}.{c}").alias(n) for c, n in names.items()])


STAGES = [("toxicity", drop_toxic), ("quality", drop_low_quality), ("near_duplicates", drop_near_duplicates),
          ("decontamination", remove_benchmark), ("byte_bpe", encode)]

ORACLE_SQL = None      # label models, neighbour votes, fingerprints and merges are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        with job_scratch(spark):           # what a stage staged for itself goes when its rows are written
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

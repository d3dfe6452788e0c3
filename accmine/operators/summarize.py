"""Aggregates over findings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import ARTICLE_CURIE_PREFIX
from ..functions.text import strip_curie
from ..session import scratch_path
from ..sinks.tables import stage


def citation_pairs(results: DataFrame) -> DataFrame:
    """Distinct (synid, pmcid) with the ``pmc:`` prefix stripped first and empty keys skipped.
    Citations stay as rows (never one array per id), so a heavily cited id cannot overload a task."""
    # asked of the stored id, not of the stripped one: a filter on that would repeat its expression (null: not kept)
    ok = (F.col("synid") != "") & (F.col("pmcid") != "") & (F.col("pmcid") != ARTICLE_CURIE_PREFIX)
    return results.where(ok).select("synid", strip_curie("pmcid").alias("pmcid")).distinct()


def citations_by_id(results: DataFrame) -> DataFrame:
    """synid, pmcid, n_articles: each citing article of an id plus the id's article count (A1).

    Pairs and counts are staged, so the join's inputs are plain shuffles and a heavily cited id is split."""
    spark = results.sparkSession
    pairs = stage(citation_pairs(results), scratch_path(spark, "citation-pairs"))
    counts = stage(pairs.groupBy("synid").agg(F.count(F.lit(1)).alias("n_articles")), scratch_path(spark, "citation-counts"))
    return pairs.join(counts, "synid")


def summary(findings: DataFrame, doc_col: str = "pmcid") -> DataFrame:
    """documents, mentions, unique_ids (A5)."""
    return findings.agg(F.count_distinct(doc_col).alias("documents"),
                        F.count(F.lit(1)).alias("mentions"),
                        F.count_distinct("synid").alias("unique_ids"))


def top_ids(findings: DataFrame, k: int = 10) -> DataFrame:
    """The k most mentioned ids, ties by id (A6). The limit is the feature: TakeOrderedAndProject."""
    return (findings.groupBy("synid").agg(F.count(F.lit(1)).alias("mentions"))
                    .orderBy(F.desc("mentions"), F.asc("synid")).limit(k))


def doc_counts(findings: DataFrame, doc_col: str = "pmcid") -> DataFrame:
    """Mentions and distinct ids per document."""
    return findings.groupBy(doc_col).agg(F.count(F.lit(1)).alias("mentions"),
                                         F.count_distinct("synid").alias("unique_ids"))

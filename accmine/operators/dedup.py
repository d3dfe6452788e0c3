"""Deduplication (A2, A3, A7), combine statistics (A4) and batch union (U1). All are aggregates with
map-side partial aggregation, so a hot key is pre-reduced before the shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip_curie
from ..session import scratch_path
from ..sinks.tables import stage
from .incremental import batch_order


def distinct_links(results: DataFrame) -> DataFrame:
    """Distinct (article, id) pairs for the link feed (A2, F3). Rows lacking either key are
    skipped *before* the ``pmc:`` prefix is stripped, as the feed writer does."""
    ok = (F.col("pmcid") != "") & (F.col("synid") != "")       # null is not kept
    return results.where(ok).select(strip_curie("pmcid").alias("pmcid"), "synid").distinct()


def _groups(batches: DataFrame, order: DataFrame, batch_col: str) -> DataFrame:
    """Distinct rows (all columns but the batch; nulls are equal) with the ordinal of their first batch and
    the number of rows."""
    keys = [c for c in batches.columns if c != batch_col]
    numbered = batches.join(order, F.col(batch_col).eqNullSafe(F.col("batch"))).select(*keys, "ordinal")
    return numbered.groupBy(*keys).agg(F.min("ordinal").alias("ordinal"), F.count(F.lit(1)).alias("rows"))


def combine_dedup(batches: DataFrame, batch_col: str = "source_file") -> DataFrame:
    """Rows equal in every column but the batch keep the first batch by name (A3); nulls compare equal."""
    order = batch_order(batches, batch_col)
    return _first_batches(_groups(batches, order, batch_col), order, batches.columns, batch_col)


def _first_batches(groups: DataFrame, order: DataFrame, columns, batch_col: str) -> DataFrame:
    return groups.join(order, "ordinal").withColumnRenamed("batch", batch_col).select(*columns)


def combine_stats(batches: DataFrame, batch_col: str = "source_file") -> DataFrame:
    """rows_before, rows_after, unique_synids, files (A4) as one row, from one pass over the batches: the
    distinct rows carry their counts, and the files are the rows of the batch order."""
    order = batch_order(batches, batch_col)
    return _stats(_groups(batches, order, batch_col), order)


def combine(batches: DataFrame, batch_col: str = "source_file") -> tuple[DataFrame, DataFrame]:
    """``combine_dedup`` and ``combine_stats`` of the same batches: both come from the distinct rows, which are
    found once and staged."""
    order = batch_order(batches, batch_col)
    groups = stage(_groups(batches, order, batch_col), scratch_path(batches.sparkSession, "distinct-rows"))
    return _first_batches(groups, order, batches.columns, batch_col), _stats(groups, order)


def _stats(groups: DataFrame, order: DataFrame) -> DataFrame:
    none = F.lit(None).cast("bigint")
    rows = groups.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_before"), F.count(F.lit(1)).alias("rows_after"),
        F.count_distinct("synid").alias("unique_synids"), none.alias("files"))
    files = order.agg(none.alias("rows_before"), none.alias("rows_after"), none.alias("unique_synids"),
                      F.count("batch").alias("files"))
    return rows.unionByName(files).agg(
        *[F.max(c).alias(c) for c in ("rows_before", "rows_after", "unique_synids", "files")])


def first_per_document(findings: DataFrame, doc_col: str = "pmcid", order_col: str = "pos") -> DataFrame:
    """One finding per id per document, the first in text order (A7, opt-in)."""
    rest = [c for c in findings.columns if c not in (doc_col, "synid", order_col)]
    first = F.min_by(F.struct(order_col, *rest), F.col(order_col))
    return (findings.groupBy(doc_col, "synid").agg(first.alias("f"))
                    .select(doc_col, "synid", *[F.col(f"f.{c}").alias(c) for c in (order_col, *rest)]))


def union_batches(frames: list[DataFrame]) -> DataFrame:
    """Batches with differing columns stacked by name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

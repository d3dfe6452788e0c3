"""Places in a global order without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sinks.tables import stage

ROWS_PER_TASK = 100_000
ONE_TASK = 10_000         # so few rows are numbered by one task: the same places with fewer jobs


def with_ordinal(df: DataFrame, order, ordinal: str = "ordinal", sums: dict[str, str] | None = None,
                 rows_per_task: int = ROWS_PER_TASK, one_task: int = ONE_TASK) -> DataFrame:
    """``df`` plus ``ordinal``, each row's place (from 0) in the order of the columns ``order``, and for each
    ``name: column`` of ``sums`` the sum of the column over all rows before it.

    The rows are dealt into ranges of about ``rows_per_task`` rows and numbered inside each range; only one
    row of totals for each range is gathered to place the ranges behind each other. Rows that are equal in
    all of ``order`` share a range, so the order should tell rows apart. Rows and ranges are written tables."""
    spark, sums = df.sparkSession, sums or {}
    rows = stage(df, scratch_path(spark, "to-order"))
    n, zero = rows.count(), F.lit(0).cast("bigint")
    if n <= one_task:
        before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        places = [F.count(F.lit(1)).over(before).alias(ordinal),
                  *[F.coalesce(F.sum(c).over(before), zero).alias(k) for k, c in sums.items()]]
        return rows.select("*", *places)
    parts = -(-n // rows_per_task)
    placed = stage(rows.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()),
                   scratch_path(spark, "ranges"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_n_{k}") for k, c in sums.items()])
    starts = totals.select("_range", *[F.coalesce(F.sum(c).over(before), zero).alias(f"_at{c[2:]}") for c in totals.columns[1:]])
    local = [F.count(F.lit(1)).over(inside).alias("_k"), *[F.sum(c).over(inside).alias(f"_k_{k}") for k, c in sums.items()]]
    numbered = placed.select("*", *local).join(starts, "_range")
    out = [(F.coalesce(f"_k{s}", zero) + F.col(f"_at{s}")).alias(name) for name, s in
           [(ordinal, ""), *[(k, f"_{k}") for k in sums]]]
    return stage(numbered.select(*df.columns, *out), scratch_path(spark, "ordered"))

"""Keeping the results table current.

Joins on the article id meet hot articles (one article with a large share of all rows). Spark splits such a
key only if both inputs of the join are plain shuffles, so what an aggregate makes is staged first.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import CORPUS_FILE_RANGE, CORPUS_SUFFIX, LISTING_HREF
from ..functions.text import file_range
from ..session import scratch_path
from ..sinks.tables import stage
from .ordering import with_ordinal


def _staged(df: DataFrame, name: str) -> DataFrame:
    return stage(df, scratch_path(df.sparkSession, name))


def _stored(results, ids: DataFrame) -> DataFrame:
    """Those of the batch's distinct ``ids`` that are stored. ``results`` is the stored table, which is only
    scanned (a semi join with the ids), or a function that looks the ids up (``article_index``)."""
    if callable(results):
        return results(ids)
    wanted = ids.select(F.col("pmcid").alias("_id"))
    return results.select("pmcid").join(wanted, F.col("pmcid").eqNullSafe(F.col("_id")), "left_semi").distinct()


def _without(rows: DataFrame, hit: DataFrame) -> DataFrame:
    return rows.join(hit.select(F.col("pmcid").alias("_id")), F.col("pmcid").eqNullSafe(F.col("_id")), "left_anti")


def new_rows(findings: DataFrame, results, check_duplicates: bool = True) -> DataFrame:
    """Findings of articles not yet in ``results`` (J1). An article already stored is skipped as a
    whole, even if it brings new ids. A missing id is an id like any other: stored once, it is stored.

    ``results`` is the stored table or a lookup function (see ``_stored``). What is found, at most the batch's
    articles, is staged, and the anti join against it is a join of two plain inputs, so a hot article of the
    batch is split over tasks."""
    if not check_duplicates:
        return findings
    hit = _staged(_stored(results, findings.select("pmcid").distinct()), "stored-articles")
    return _without(findings, hit)


def batch_order(batches: DataFrame, batch_col: str = "source_file") -> DataFrame:
    """(batch, ordinal) of the distinct batch names in name order: one row for each file. Comparing numbers
    instead of names keeps the aggregates over all rows hash aggregates."""
    return with_ordinal(batches.select(F.col(batch_col).alias("batch")).distinct(), ["batch"])


def first_batch_wins(batches: DataFrame, results, batch_col: str = "source_file", check_duplicates: bool = True) -> DataFrame:
    """Batches appended one after another, each checked against what is stored.

    An article in several batches keeps only the rows of its first batch (file-name order), and none at all
    if it was stored before (``results``: see ``new_rows``). The first batch of each article is a partial
    aggregate, staged once for the lookup and the rest; less the stored articles it is staged again, and the join
    that keeps its rows, of the batches as they are read and this table, splits hot articles."""
    order = batch_order(batches, batch_col)
    numbered = batches.join(order, F.col(batch_col).eqNullSafe(F.col("batch"))).drop("batch")
    first = _staged(numbered.groupBy("pmcid").agg(F.min("ordinal").alias("first")), "first-batches")
    if check_duplicates:
        first = _staged(_without(first, _stored(results, first.select("pmcid"))), "new-articles")
    first = first.withColumnRenamed("pmcid", "_id")
    # ``<=`` against the minimum means ``==`` without becoming a second join key
    return (numbered.join(first, F.col("pmcid").eqNullSafe(F.col("_id"))).where(F.col("ordinal") <= F.col("first"))
            .select(*batches.columns))


def listed_files(pages: DataFrame, html_col: str = "html", suffix: str = CORPUS_SUFFIX) -> DataFrame:
    """File names that listing pages link to (S3): hrefs that end in the archive's suffix, so checksums and
    file lists beside the archives are left out."""
    hrefs = pages.select(F.explode(F.regexp_extract_all(html_col, F.lit(LISTING_HREF), F.lit(1))).alias("file_name"))
    return hrefs.where(F.col("file_name").endswith(suffix)).distinct()


def file_catalog(names: DataFrame, name_col: str = "file_name") -> DataFrame:
    """Corpus file names -> file_name, start_pmc, end_pmc, start_id and any further columns (a path); names
    without a range are dropped (S2, X11)."""
    rest = [c for c in names.columns if c != name_col]
    return (names.select(F.col(name_col).alias("file_name"), file_range(name_col).alias("r"), *rest)
                 .where(F.col("r.start_pmc").isNotNull() & F.col("r.end_pmc").isNotNull())
                 .select("file_name", "r.start_pmc", "r.end_pmc", "r.start_id", *rest))


def resume_point(files: DataFrame, start_from: str | None) -> int | None:
    """Numeric start id from ``start_from``: a range name, a bare ``PMC…`` id, or an exact file name.
    The exact-name form looks up that file's start (one tiny filtered lookup)."""
    if not start_from:
        return None
    m = re.search(CORPUS_FILE_RANGE, start_from) or re.search(r"PMC(\d+)", start_from)
    if m:
        return int(m.group(1))
    hit = files.where(F.col("file_name") == start_from).select("start_pmc").limit(1).collect()
    return hit[0][0] if hit else None


def resume_files(files: DataFrame, start_from: str | None = None, max_files: int | None = None) -> DataFrame:
    """Files in id order from the resume point on, at most ``max_files`` (F1, F2).

    A resume point past the last file gives no files (the original restarted from the first)."""
    n = resume_point(files, start_from)     # None (no or unknown start): from the beginning
    out = files if n is None else files.where(F.col("start_pmc") >= F.lit(n))
    out = out.orderBy("start_pmc", "file_name")
    return out.limit(max_files) if max_files else out


def watermark(processed_files: DataFrame, updated_at: str | None = None) -> DataFrame:
    """At most one row: the highest starting id over all processed files (K8), by number not by string."""
    r = file_range("file_name")
    agg = (processed_files.select(r.alias("r")).where(F.col("r.start_pmc").isNotNull())
           .agg(F.max("r.start_pmc").alias("start_pmc")))
    cols = [F.concat(F.lit("PMC"), F.col("start_pmc").cast("string")).alias("last_processed_pmc_id"),
            "start_pmc"]
    if updated_at is not None:
        cols.append(F.lit(updated_at).alias("updated_at"))
    return agg.where(F.col("start_pmc").isNotNull()).select(*cols)

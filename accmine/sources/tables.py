"""Readers for the driver's parquet tables and for the library's own tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..sinks.versions import VersionedTable, is_versioned

_READS: dict[tuple[int, str], tuple[SparkSession, DataFrame]] = {}
MEMO_TABLES = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input table, read once per session: a DataFrame is an immutable plan, so reusing it
    skips repeated file listing and footer reads (the inputs are not rewritten while a job runs)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    if key not in _READS:  # the session is kept in the value, so its id cannot be reused
        if len(_READS) >= MEMO_TABLES:
            _READS.clear()
        _READS[key] = (spark, spark.read.parquet(path))
    return _READS[key][1]


def forget() -> None:
    """Drop the plans kept so far."""
    _READS.clear()


def _missing(exc: Exception) -> bool:
    return "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Results table (S5), empty when there is none yet: its committed version, or a plain folder of Parquet
    files. Callers select only what they need; pruning reaches the scan."""
    if is_versioned(spark, path):
        return VersionedTable(spark, path).read(schemas.RESULTS)
    try:
        return spark.read.schema(schemas.RESULTS).parquet(path)
    except Exception as exc:
        if not _missing(exc):
            raise
    return spark.createDataFrame([], schemas.RESULTS)


def read_entity_meta(spark: SparkSession, path: str | None) -> DataFrame:
    """Metadata cache (S8): the committed version of a versioned table, or a folder of one. A missing cache
    reads as empty with the same schema. So does what cannot be read of a bad one: files that are no Parquet are
    passed over, and their ids count as not cached, so a refresh fetches them again."""
    if path:
        paths = [path]
        if is_versioned(spark, path):
            paths = [p["path"] for p in VersionedTable(spark, path).manifest()["parts"]]
        try:
            if paths:
                return spark.read.schema(schemas.ENTITY_META).option("ignoreCorruptFiles", True).parquet(*paths)
        except Exception as exc:  # missing path -> empty cache, like a missing JSON file
            if not _missing(exc):
                raise
    return spark.createDataFrame([], schemas.ENTITY_META)


def read_watermark(spark: SparkSession, path: str | None) -> str | None:
    """The saved resume point (``PMC…``), or None when there is none yet: the highest one written."""
    if not path:
        return None
    try:
        row = (spark.read.schema(schemas.WATERMARK).parquet(path)
                    .orderBy(F.desc("start_pmc")).select("last_processed_pmc_id").first())
    except Exception as exc:  # no watermark written yet
        if not _missing(exc):
            raise
        return None
    return row[0] if row else None

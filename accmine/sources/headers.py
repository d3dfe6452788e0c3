"""Entity headers as they were landed (S7): responses of a header service, one JSON object a line.

A response holds a list ``results`` of about 100 headers. The lines are parsed as VARIANT, so a header may hold
whatever else the service sends. A line that is no such response is rejected as a whole, a header without
an id by itself; of several headers for an id the last counts (by file name, then place).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_responses(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(file, at, line_no, line): landed lines with what orders them inside a file."""
    r = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    meta = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at")]
    lines = r.text(path).select(*meta, F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line"))
    return lines.where(F.trim("line") != "")


def _parsed(responses: DataFrame) -> DataFrame:
    body = F.try_parse_json("line")
    return responses.withColumn("results", F.try_variant_get(body, "$.results", "array<variant>"))


def _headers(responses: DataFrame) -> DataFrame:
    one = _parsed(responses).select("file", "at", "line_no", F.posexplode("results").alias("pos", "h"))
    got = [F.try_variant_get("h", f"$.{name}", kind).alias(col) for name, kind, col in
           (("id", "string", "id"), ("name", "string", "name"), ("benefactorId", "bigint", "benefactor_id"),
            ("createdOn", "string", "created_on"))]
    return one.select("file", "at", "line_no", "pos", *got)


def entity_headers(responses: DataFrame) -> DataFrame:
    """(id, name, benefactor_id, created_on) of every id in the responses, its last header."""
    h = _headers(responses).where(F.coalesce("id", F.lit("")) != "")
    last = F.max_by(F.struct("name", "benefactor_id", "created_on"), F.struct("file", "at", "line_no", "pos"))
    return h.groupBy("id").agg(last.alias("h")).select("id", "h.name", "h.benefactor_id", "h.created_on")


def rejected_headers(responses: DataFrame) -> DataFrame:
    """(file, reason, text) of lines that are no response, and of headers without an id."""
    bad = _parsed(responses).where(F.col("results").isNull()).select(
        "file", F.when(F.try_parse_json("line").isNull(), F.lit("no JSON")).otherwise(F.lit("no results")).alias("reason"),
        F.col("line").alias("text"))
    nameless = (_parsed(responses).select("file", F.explode("results").alias("h"))
                .where(F.coalesce(F.try_variant_get("h", "$.id", "string"), F.lit("")) == "")
                .select("file", F.lit("no id").alias("reason"), F.to_json("h").alias("text")))
    return bad.unionByName(nameless)


def read_entity_headers(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    return entity_headers(read_responses(spark, path, glob))

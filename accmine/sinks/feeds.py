"""Feeds and tables written from findings (K1-K7).

Every writer is a distributed write: no feed is assembled on the driver or in a
single task. The search feed is written as ordered line shards whose
concatenation in file-name order is the whole document.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions.fixed import (LINK_RECORD_SOURCE, RESOURCE_ATTRIBUTE, RESOURCE_DB, RESOURCE_SUBJECT_TYPE,
                               SEARCH_DATE_TYPE, SEARCH_FIELD_LINK, SEARCH_FIELD_REPOSITORY,
                               SEARCH_XREF_DBNAME)
from ..functions.text import xml_attr, xml_text
from ..operators.dedup import distinct_links
from ..operators.enrich import PortalConfig
from ..session import scratch_path
from .tables import stage

LINK_TITLE = "View data"
RESOURCE_URL = "https://repository.example.org/#!{id}"


def _url(template: str, id_col: str) -> Column:
    return F.replace(F.lit(template), F.lit("{id}"), F.col(id_col))


# ----------------------------------------------------------- link feed ------

def link_rows(results: DataFrame, provider_id: int, cfg: PortalConfig = PortalConfig(),
              title: str = LINK_TITLE) -> DataFrame:
    """Flat link rows: one per distinct (article, id) pair (K4 content)."""
    pairs = distinct_links(results)
    return pairs.select(F.lit(provider_id).cast("bigint").alias("provider_id"),
                        _url(cfg.entity_url, "synid").alias("url"), F.lit(title).alias("title"),
                        F.lit(LINK_RECORD_SOURCE).alias("source"), F.col("pmcid").alias("record_id"))


def link_structs(rows: DataFrame) -> DataFrame:
    """Nested shape of ``<link providerId><resource><url/><title/></resource><record><source/><id/></record></link>``."""
    return rows.select(F.col("provider_id").alias("_providerId"),
                       F.struct("url", "title").alias("resource"),
                       F.struct("source", F.col("record_id").alias("id")).alias("record"))


LINKS_PER_FILE = 200_000      # some 50 MB of XML; the reader gives each file to one task


def write_link_structs(structs: DataFrame, path: str, mode: str = "overwrite", links_per_file: int = LINKS_PER_FILE,
                       compression: str = "none") -> None:
    """Each task writes well-formed ``<links>`` documents of at most ``links_per_file`` links. A link is some 280 bytes
    of XML, most of them markup: ``compression="gzip"`` writes the same documents as ``.xml.gz``, which
    ``read_link_feed`` reads as well."""
    (structs.write.mode(mode).format("xml").option("rootTag", "links").option("rowTag", "link")
        .option("maxRecordsPerFile", links_per_file).option("compression", compression).save(path))


def write_link_feed(rows: DataFrame, path: str, mode: str = "overwrite", links_per_file: int = LINKS_PER_FILE,
                    compression: str = "none") -> None:
    """The link feed as documents of a bounded size: XML files are not split when they are read."""
    write_link_structs(link_structs(rows), path, mode, links_per_file, compression)


LINK_SCHEMA = StructType([
    StructField("_providerId", LongType()),
    StructField("resource", StructType([StructField("url", StringType()), StructField("title", StringType())])),
    StructField("record", StructType([StructField("source", StringType()), StructField("id", StringType())])),
])


def read_link_feed(spark, path: str, xsd_path: str | None = None) -> DataFrame:
    """Read a link feed back (declared schema, no inference pass); with ``xsd_path`` rows failing
    the schema land in ``_corrupt_record`` (V3)."""
    schema = LINK_SCHEMA
    if xsd_path:
        schema = StructType(LINK_SCHEMA.fields + [StructField("_corrupt_record", StringType())])
    r = spark.read.format("xml").option("rowTag", "link").schema(schema)
    if xsd_path:
        # shipped to every executor; the option then names the file, not a local path
        try:
            spark.sparkContext.addFile(xsd_path)
        except Exception:  # Spark Connect
            spark.addArtifacts(xsd_path, file=True)
        r = (r.option("rowValidationXSDPath", os.path.basename(xsd_path)).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", "_corrupt_record"))
    return r.load(path)


def row_valid() -> Column:
    """A feed row passed the schema. ``providerId`` is required by the schema, so naming it is
    equivalent, and keeps a second column in every plan (Spark rejects plans that read only the
    corrupt-record column, which pruning would otherwise produce for a bare ``count()``)."""
    return F.col("_corrupt_record").isNull() & F.col("_providerId").isNotNull()


def validate_feed(spark, path: str, xsd_path: str | None = None) -> DataFrame:
    """One row: links, valid, invalid, with_record for a written link feed checked against the
    schema (V3).
    The failing rows themselves are ``read_link_feed(spark, path, xsd).where(_corrupt_record
    is not null)`` (select another column with it: Spark rejects queries that use only the
    corrupt-record column)."""
    r = read_link_feed(spark, path, xsd_path or LINKS_XSD)
    ok = row_valid()
    return r.agg(F.count(F.lit(1)).alias("links"), F.count_if(ok).alias("valid"),
                 F.count_if(~ok).alias("invalid"), F.count("record.id").alias("with_record"))


def flatten_links(feed: DataFrame) -> DataFrame:
    return feed.select(F.col("_providerId").cast("bigint").alias("provider_id"),
                       F.col("resource.url").alias("url"), F.col("resource.title").alias("title"),
                       F.col("record.source").alias("source"), F.col("record.id").cast("string").alias("record_id"))


# ------------------------------------------------------- resource list ------

def resource_rows(results: DataFrame, provider_id: int, cfg: PortalConfig = PortalConfig(),
                  url_template: str = RESOURCE_URL) -> DataFrame:
    """PrId, DB, UID (the stored article id, prefix kept), URL, SubjectType, Attribute (K5).
    One row per finding, no dedup; rows without an article id are dropped."""
    return (results.where(F.col("pmcid").isNotNull())
                   .select(F.lit(provider_id).cast("bigint").alias("PrId"), F.lit(RESOURCE_DB).alias("DB"),
                           F.col("pmcid").alias("UID"), _url(url_template, "synid").alias("URL"),
                           F.lit(RESOURCE_SUBJECT_TYPE).alias("SubjectType"),
                           F.lit(RESOURCE_ATTRIBUTE).alias("Attribute")))


def write_csv(df: DataFrame, path: str, partition_by: str | None = None, mode: str = "overwrite") -> None:
    """Header CSV (K1, K2, K5). With ``partition_by`` one folder per batch value; re-running a batch
    with dynamic partition overwrite replaces only that batch's folder."""
    w = df.write.mode(mode).option("header", True).option("escape", '"')   # quotes inside a field are doubled
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(partition_by)
    w.csv(path)


# ---------------------------------------------------------- search feed -----

def search_feed_lines(entries: DataFrame, pairs: DataFrame, name: str, description: str,
                      release: str) -> DataFrame:
    """Physical lines of the search feed with sort keys (k0 = entry id, k1 = line kind, k2 = article).

    Entries come from ``operators.enrich.search_entries``; cross references come straight from
    the (synid, pmcid) pair rows, so no per-id array is ever built and a heavily cited id is
    spread over several tasks by the range partitioning of the writer."""
    n_entries = entries.agg(F.count(F.lit(1)).alias("n"))
    head_txt = ["<?xml version='1.0' encoding='UTF-8'?>", "<database>",
                f"  <name>{_esc(name)}</name>", f"  <description>{_esc(description)}</description>",
                f"  <release>{_esc(release)}</release>", f"  <release_date>{_esc(release)}</release_date>"]
    head_lines = [F.lit(t) for t in head_txt] + [
        F.concat(F.lit("  <entry_count>"), F.col("n").cast("string"), F.lit("</entry_count>")),
        F.lit("  <entries>")]
    head = n_entries.select(F.posexplode(F.array(*head_lines)).alias("k1", "line")).select(
        F.lit("").alias("k0"), "k1", F.lit("").alias("k2"), "line")
    i6, i8 = " " * 6, " " * 8
    dated = F.col("created").isNotNull()
    parts = [
        F.concat(F.lit('    <entry id="'), xml_attr("id"), F.lit('">')),
        F.concat(F.lit(i6 + "<name>"), xml_text("name"), F.lit("</name>")),
        F.concat(F.lit(i6 + "<description>"), xml_text("description"), F.lit("</description>")),
        F.when(dated, F.lit(i6 + "<dates>")),
        F.when(dated, F.concat(F.lit(i8 + f'<date type="{SEARCH_DATE_TYPE}" value="'), xml_attr("created"),
                               F.lit('" />'))),
        F.when(dated, F.lit(i6 + "</dates>")),
        F.lit(i6 + "<cross_references>"),
        None,  # 7: one line per citing article, from ``pairs``
        F.lit(i6 + "</cross_references>"),
        F.lit(i6 + "<additional_fields>"),
        F.concat(F.lit(i8 + f'<field name="{SEARCH_FIELD_REPOSITORY}">'), xml_text("repository"), F.lit("</field>")),
        F.concat(F.lit(i8 + f'<field name="{SEARCH_FIELD_LINK}">'), xml_text("full_link"), F.lit("</field>")),
        F.lit(i6 + "</additional_fields>"),
        F.lit("    </entry>"),
    ]
    body = entries.select(F.col("id").alias("k0"), F.posexplode(F.array(
        *[p if p is not None else F.lit(None).cast("string") for p in parts])).alias("k1", "line"))
    body = body.where(F.col("line").isNotNull()).select("k0", "k1", F.lit("").alias("k2"), "line")
    refs = (pairs.join(entries.select(F.col("id").alias("synid")), "synid", "left_semi")
                 .select(F.col("synid").alias("k0"), F.lit(7).alias("k1"), F.col("pmcid").alias("k2"),
                         F.concat(F.lit(i8 + f'<ref dbname="{SEARCH_XREF_DBNAME}" dbkey="'),
                                  xml_attr("pmcid"), F.lit('" />')).alias("line")))
    tail = n_entries.select(F.posexplode(F.array(F.lit("  </entries>"), F.lit("</database>"))).alias("k1", "line"))
    tail = tail.select(F.lit(LAST_KEY).alias("k0"), "k1", F.lit("").alias("k2"), "line")
    return head.unionByName(body).unionByName(refs).unionByName(tail)


LAST_KEY = "\uffff"  # sorts after every entry id
SHARD_BYTES = 128 << 20
IDLE_SHARD_BYTES = 4 << 20    # shards are made as small as this while the cluster has cores without one


def _esc(s: str) -> str:
    return s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def write_search_feed(lines: DataFrame, path: str, partitions: int | None = None,
                      staging: str | None = None, shard_bytes: int = SHARD_BYTES, least: int = 1) -> None:
    """Range-partition the lines by (entry, kind, article) and sort inside each shard: the shards
    in file-name order, concatenated, are the whole document. Each shard is written by its own
    task; a long entry may continue in the next shard. ``partitions`` defaults to one shard for each
    ``shard_bytes`` of text, and for a short text to a shard for each core that gets some megabytes, but to no
    fewer than ``least``.

    Range partitioning samples its input in a separate job. With ``staging`` (a folder in shared
    storage) the lines are written there once and the sample and the write read that table,
    instead of computing the enrichment twice."""
    bytes_of = F.coalesce(F.sum(F.octet_length("line") + 1), F.lit(0)).alias("bytes")
    if staging and partitions is None:       # counted while they are written
        seen = Observation()
        lines, size = stage(lines.observe(seen, bytes_of), staging), seen.get.get("bytes") or 0
    elif staging:
        lines = stage(lines, staging)
    elif partitions is None:
        size = lines.agg(bytes_of).first()[0]
    if partitions is None:
        cores = lines.sparkSession.sparkContext.defaultParallelism
        partitions = max(1, least, -(-size // shard_bytes), min(cores, size // IDLE_SHARD_BYTES))
    (lines.repartitionByRange(partitions, "k0", "k1", "k2")
          .sortWithinPartitions("k0", "k1", "k2").select("line")
          .write.mode("overwrite").text(path))


def read_feed_lines(spark, path: str) -> DataFrame:
    """The physical lines of a written text feed (order within the document is not kept)."""
    return spark.read.text(path).select(F.col("value").alias("line"))


def read_feed_document(spark, path: str) -> DataFrame:
    """(shard, line_no, line): the lines with their place in the document, shards in file-name order and
    lines numbered from 0 inside each (F5). A shard is read in pieces by several tasks: each line is staged with
    its place in its piece's task, and one row for each piece puts the pieces of a shard behind each other."""
    shard = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    lines = spark.read.option("lineSep", "\n").text(path).select(
        shard.alias("shard"), F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_n"),
        F.col("value").alias("line"))
    lines = stage(lines, scratch_path(spark, "feed-pieces"))
    before = Window.partitionBy("shard").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    pieces = lines.groupBy("shard", "_at").agg(F.count(F.lit(1)).alias("lines"), F.min("_n").alias("_first"))
    starts = pieces.select("shard", "_at", (F.coalesce(F.sum("lines").over(before), F.lit(0)) - F.col("_first")).alias("_start"))
    return lines.join(F.broadcast(starts), ["shard", "_at"]).select(
        "shard", (F.col("_start") + F.col("_n")).alias("line_no"), "line")


LINKS_XSD = os.path.join(os.path.dirname(__file__), "links.xsd")

"""File sources: article corpus (S1, S2), findings CSV (S4), raw files.

Corpus files are read by Spark's text source with the article's start tag as record separator, so each
record is one article (what stands before the first start tag is no article) and the file is streamed,
never held whole. A record without its closing tag is an article that was cut off: it keeps no closing
tag, so it does not parse and lands in the rejects. Gzip files cannot be split (one task per file);
``parse_articles`` spreads the articles right after the scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import schemas
from ..functions.fixed import (ALLOWED_EXTENSIONS, ARTICLE_CLOSE, ARTICLE_OPEN, CORPUS_FILE_RANGE, CORPUS_SUFFIX,
                               MAGIC_GZIP, MAGIC_MARKUP, MAGIC_PDF, MAX_INPUT_BYTES)
from ..functions.text import decode_text, decoded_with, source_file_from_path
from ..session import scratch_path
from ..sinks.tables import stage


# what follows an article's start tag: attributes up to its end, or to the end of a file cut off inside the tag
_TAG_REST = r"""(?s)\A(?:\s*|\s*[^\s<>="'/]+\s*=[^<>]*)/?>"""
_TAG_CUT = r"""(?s)\A\s*[^\s<>="'/]+\s*=[^<>]*\z"""
_TAG_ANY = r"(?s)\A[^<]*>"


def articles_from_records(records: DataFrame, tag_prefix: str = ARTICLE_OPEN) -> DataFrame:
    """Text records split at the start tag -> source_file, xml (start tag put back, up to the closing tag if
    there is one). A record goes on with the tag's attributes, whole or cut off by the end of the file, or at
    least closes a tag before another one opens and has the article's closing tag; other records are what stood
    before a file's first article, markup or not, and are ignored. (Only a text there that itself begins like
    an attribute, ``name=``, is still taken for an article, and rejected.)"""
    end = F.instr("value", ARTICLE_CLOSE)
    body = F.when(end > 0, F.substring("value", F.lit(1), end + F.lit(len(ARTICLE_CLOSE) - 1))).otherwise(F.col("value"))
    v = F.col("value")
    own = v.rlike(_TAG_REST) | ((end > 0) & v.rlike(_TAG_ANY)) | v.rlike(_TAG_CUT)
    return (records.where(own)
                   .select(source_file_from_path("_path").alias("source_file"), F.concat(F.lit(tag_prefix), body).alias("xml")))


def read_articles(spark: SparkSession, path, tag_prefix: str = ARTICLE_OPEN,
                  glob: str | None = None) -> DataFrame:
    """Article corpus scan (S1): ``.xml`` or ``.xml.gz`` files (gzip by suffix) -> source_file, xml.
    ``path`` is a folder, a file, or a list of files."""
    r = spark.read.option("lineSep", tag_prefix)
    if glob:
        r = r.option("pathGlobFilter", glob)
    recs = r.text(path).select(F.col("_metadata.file_path").alias("_path"), "value")
    return articles_from_records(recs, tag_prefix)


def corpus_files(spark: SparkSession, path, suffix: str = CORPUS_SUFFIX, glob: str | None = None) -> DataFrame:
    """(file_name, paths) of the archives below a folder (S2); only the listing is read. An archive is a file
    whose name ends in the suffix, or a ``source_file=<name>`` folder of part files; checksums and file
    lists beside them are left out. A name found in several folders is the same archive and counts once
    (the first folder)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    base = F.element_at(F.split("path", "/"), -1)
    files = r.load(path).select("path", base.alias("base"), F.regexp_replace("path", "/[^/]*$", "").alias("folder"),
                                source_file_from_path("path").alias("file_name"))
    own = F.when(F.col("base").rlike(CORPUS_FILE_RANGE), F.col("base").endswith(suffix)).otherwise(
        F.col("base").startswith("part-") & F.col("file_name").endswith(suffix))
    folders = files.where(own).groupBy("file_name", "folder").agg(F.array_sort(F.collect_list("path")).alias("paths"))
    return folders.groupBy("file_name").agg(F.min_by("paths", "folder").alias("paths"))


def write_corpus(articles: DataFrame, path: str, compression: str = "gzip", mode: str = "overwrite") -> None:
    """Stage articles as corpus files, one file per ``source_file`` value and write (used for
    tests and for re-compressing a landed corpus). A corpus file covers a bounded id range,
    so one writer per file is the archive's own layout; ``mode='append'`` lands a later delivery
    beside the earlier files."""
    (articles.select("source_file", "xml").repartition("source_file")
             .write.mode(mode).partitionBy("source_file").option("compression", compression).text(path))


def read_findings_csv(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """Findings batches written as header CSV (S4) -> pmcid, synid, context, source_file.

    Columns go by the header's names, whatever their order; quotes inside a field are doubled; a column that
    a file lacks is null. The header is a file's first line, found as the first line of the piece that begins the
    file, so a data row that looks like one stays data. Files whose headers differ are read apart (one read
    for each distinct header, normally one). No types are inferred; the batch comes from the file's folder or
    name."""
    where = {"pathGlobFilter": glob, "recursiveFileLookup": True}
    lines = (spark.read.options(**where).text(path)
                  .select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("at"),
                          F.monotonically_increasing_id().alias("n"), "value").where(F.col("at") == 0))
    heads = lines.groupBy("f").agg(F.min_by("value", "n").alias("head"))
    heads = heads.select("f", F.split(F.regexp_replace("head", r'["\r\x{FEFF}]', ""), ",").alias("names"))
    heads = stage(heads, scratch_path(spark, "csv-heads"))                    # one row a file
    variants = [r.names for r in heads.select("names").distinct().collect()] or [schemas.FINDINGS_CSV.fieldNames()]
    parts = []
    for cols in variants:
        unique = [c if c not in cols[:k] else f"{c}_{k}" for k, c in enumerate(cols)]
        schema = StructType([StructField(c or f"_{k}", StringType()) for k, c in enumerate(unique)])
        df = (spark.read.schema(schema).options(**where).option("header", True).option("escape", '"').csv(path)
                   .withColumn("_f", F.col("_metadata.file_path")))
        if len(variants) > 1:
            own = heads.where(F.col("names") == F.lit(cols)).select(F.col("f").alias("_f"))
            df = df.join(own, "_f", "left_semi")
        have = [F.col(c) if c in cols else F.lit(None).cast("string").alias(c) for c in schemas.FINDINGS_CSV.fieldNames()]
        parts.append(df.select(*have, source_file_from_path("_f").alias("source_file")))
    return reduce(DataFrame.unionByName, parts)


def read_text_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Plain-text files with encoding fallback (S9): path, text, encoding (UTF-8, else Latin-1)."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    b = r.load(path)
    return b.select("path", decode_text("content").alias("text"), decoded_with("content").alias("encoding"))


# byte between the pieces in which a file of an extension is checked; it is part of no other character. Markup has
# it often even where it has no line ends.
_PIECE_ENDS = {".xml": ">", ".html": ">"}
_LINE_END = "\n"


def _glob_of(endings) -> str:
    """File-name pattern of some extensions, in any case."""
    return "*.{%s}" % ",".join("".join(f"[{c.lower()}{c.upper()}]" for c in e.lstrip(".")) for e in endings)


def _is_magic(head_hex):
    return head_hex.startswith(MAGIC_GZIP) | head_hex.startswith(MAGIC_PDF) | head_hex.startswith(MAGIC_MARKUP)


def _not_text(value):
    return ~F.is_valid_utf8(value) | (F.instr(value, "\u0000") > 0)


def _checked_in_pieces(spark: SparkSession, path: str, endings, piece_end: str, max_bytes: int) -> DataFrame:
    """(_file, magic, bad, bytes) of the files with these extensions: whether the first bytes are a known
    type's, whether a piece is no text, and the bytes seen. Large files are split over tasks and none is held.

    The reader drops a byte order mark; it shows as bytes that are missing, and means that the file's first bytes
    are no known type's."""
    pieces = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", _glob_of(endings)).option("lineSep", piece_end)
                   .text(path).where(F.col("_metadata.file_size") <= max_bytes)
                   .select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("at"),
                           F.col("_metadata.file_size").alias("size"), F.monotonically_increasing_id().alias("n"), "value"))
    magic = _is_magic(F.hex(F.substring(F.col("value").cast("binary"), 1, 4))).cast("int")
    first = F.when(F.col("at") == 0, F.col("n"))
    facts = pieces.select("_file", "size", first.alias("first"), magic.alias("magic"), _not_text(F.col("value")).cast("int").alias("bad"),
                          (F.octet_length("value") + 1).cast("bigint").alias("bytes"))
    seen = facts.groupBy("_file").agg(F.min_by("magic", "first").alias("magic"), F.max("bad").alias("bad"),
                                      (F.max("size") - F.sum("bytes") + 1).alias("missing"))     # 0, 1 with an end behind the last
    return seen.select("_file", ((F.col("missing") < 2) & (F.col("magic") == 1)).alias("magic"), (F.col("bad") == 1).alias("bad"))


def audit_files(spark: SparkSession, path: str, max_bytes: int = MAX_INPUT_BYTES,
                allowed=ALLOWED_EXTENSIONS) -> DataFrame:
    """Input validation (V1): path, length, ext, accepted, reason — checks in the order size, extension, type.

    Oversize files and files of other extensions are judged from the listing alone. The others are read in
    pieces that end at a line or tag end: a file is UTF-8 if all its pieces are, as an ASCII byte is part of no
    longer character. Only ``.gz`` files, which the line reader would unpack, are loaded one at a time. Spark
    lists no empty files: they have no row."""
    ext = F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1))
    src = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    listing = src.load(path).select("path", "length", ext.alias("ext"), F.col("_metadata.file_path").alias("_file"))
    by_name = F.when(F.col("length") > max_bytes, F.lit("size")).when(~F.col("ext").isin(*allowed), F.lit("extension"))
    refused = listing.select("path", "length", "ext", by_name.alias("reason")).where(F.col("reason").isNotNull())

    def judged(files: DataFrame, ok) -> DataFrame:
        return files.select("path", "length", "ext", F.when(ok, F.lit("ok")).otherwise(F.lit("type")).alias("reason"))

    out = [refused]
    packed = [e for e in allowed if e == ".gz"]
    if packed:
        small = src.option("pathGlobFilter", _glob_of(packed)).load(path).where(F.col("length") <= max_bytes)
        as_text = F.col("content").cast("string")  # a view of the bytes, not a copy
        out.append(judged(small.withColumn("ext", ext), _is_magic(F.hex(F.substring("content", 1, 4))) | ~_not_text(as_text)))
    # only extensions that occur: each group that is read lists the whole folder again
    there = {r.ext for r in listing.where(F.col("ext").isin(*allowed) & (F.col("length") <= max_bytes)).select("ext").distinct().collect()}
    plain = [e for e in allowed if e not in packed and e in there]
    groups = {}
    for e in plain:
        groups.setdefault(_PIECE_ENDS.get(e, _LINE_END), []).append(e)
    seen = [_checked_in_pieces(spark, path, endings, end, max_bytes) for end, endings in groups.items()]
    if seen:
        wanted = listing.where(F.col("ext").isin(*plain) & (F.col("length") <= max_bytes))
        checked = wanted.join(reduce(DataFrame.unionByName, seen), "_file", "left")
        out.append(judged(checked, F.coalesce(F.col("magic"), F.lit(False)) | ~F.coalesce(F.col("bad"), F.lit(False))))
    return (reduce(DataFrame.unionByName, out)
            .select("path", "length", "ext", (F.col("reason") == "ok").alias("accepted"), "reason"))

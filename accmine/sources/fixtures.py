"""Views built from the driver's tables (the tables hold no accession ids of their own).

Each view is a plain DataFrame plan over the whole source table, so its size
grows with the scale factor. The DuckDB oracle builds the same views in SQL.
"""

from __future__ import annotations

import functools
import inspect

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import xml_text
from ..operators.joins import spread
from .tables import table


def _s(c):
    return F.col(c).cast("string")


_VIEWS: dict = {}
MEMO_VIEWS = 64


def forget() -> None:
    """Drop the plans kept so far."""
    _VIEWS.clear()


def view(fn):
    """Build each view once per session and arguments (DataFrames are immutable plans); the
    same object used twice in one query also lets Spark reuse its exchanges."""
    sig = inspect.signature(fn)

    @functools.wraps(fn)
    def wrapper(spark, d, *args, **kw):
        bound = sig.bind(spark, d, *args, **kw)
        bound.apply_defaults()
        key = (id(spark), fn.__name__) + tuple(v for k, v in bound.arguments.items() if k != "spark")
        if key not in _VIEWS:  # the session is kept in the value, so its id cannot be reused
            if len(_VIEWS) >= MEMO_VIEWS:
                _VIEWS.clear()
            _VIEWS[key] = (spark, fn(*bound.args, **bound.kwargs))
        return _VIEWS[key][1]
    return wrapper


@view
def findings_v(spark: SparkSession, d: str) -> DataFrame:
    """One finding per lineitem: article = order, id = part, file = block of 1000 orders."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    li = spread(li, ["l_orderkey", "l_linenumber"])  # narrow ints only; a no-op on a wide scan
    block = F.col("l_orderkey") - F.col("l_orderkey") % 1000
    syn = F.concat(F.lit("syn"), (F.lit(1000000) + F.col("l_partkey")).cast("string"))
    return li.select(
        F.concat(F.lit("pmc:PMC"), _s("l_orderkey")).alias("pmcid"),
        syn.alias("synid"),
        F.concat(F.lit("data at "), syn, F.lit(" row "), _s("l_linenumber")).alias("context"),
        F.concat(F.lit("PMC"), block.cast("string"), F.lit("_PMC"), (block + 999).cast("string"),
                 F.lit(".xml.gz")).alias("source_file"),
    )


def _article_num(pmcid="pmcid"):
    return F.substring(F.col(pmcid), 8, 1 << 30).cast("bigint")


@view
def batches_v(spark: SparkSession, d: str) -> DataFrame:
    """findings_v plus an earlier batch file that repeats every fifth article."""
    f = findings_v(spark, d)
    early = f.where(_article_num() % 5 == 0).select(
        "pmcid", "synid", "context", F.lit("PMC0_PMC0.xml.gz").alias("source_file"))
    return f.unionByName(early)


@view
def results_v(spark: SparkSession, d: str) -> DataFrame:
    """Pairs already stored in the results table: every third article."""
    return findings_v(spark, d).where(_article_num() % 3 == 0).select("pmcid", "synid").distinct()


@view
def entity_v(spark: SparkSession, d: str) -> DataFrame:
    """Entity headers; parts with key ending in 7 have none (they are inaccessible)."""
    p = table(spark, d, "part").select("p_partkey", "p_name", "p_size")
    return p.where(F.col("p_partkey") % 10 != 7).select(
        F.concat(F.lit("syn"), (F.lit(1000000) + F.col("p_partkey")).cast("string")).alias("id"),
        F.col("p_name").alias("name"),
        (F.lit(900000) + F.col("p_partkey") % 50).alias("benefactor_id"),
        F.concat(F.lit("2024-01-"), F.lpad((F.lit(1) + F.col("p_size") % 28).cast("string"), 2, "0"),
                 F.lit("T00:00:00.000Z")).alias("created_on"),
    )


@view
def gaps_v(spark: SparkSession, d: str) -> DataFrame:
    """findings_v where some articles lack their id or the ids of their findings (null or empty)."""
    n = _article_num() % 50
    return findings_v(spark, d).select(
        F.when(n == 1, F.lit(None)).when(n == 2, F.lit("")).otherwise(F.col("pmcid")).alias("pmcid"),
        F.when(n == 3, F.lit("")).when(n == 4, F.lit(None)).otherwise(F.col("synid")).alias("synid"),
        "context", "source_file")


@view
def catalog_v(spark: SparkSession, d: str) -> DataFrame:
    """Catalogue rows in order (``ord``): four in five suppliers, some of them again later with another app
    and without a link, and some parts that name an app nobody knows."""
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey").where(F.col("s_suppkey") % 5 != 0)
    sid = F.concat(F.lit("syn"), (F.lit(900000) + F.col("s_suppkey")).cast("string")).alias("id")
    a = s.select(
        sid, F.concat(F.lit("app"), _s("s_nationkey")).alias("app_id"),
        F.when(F.col("s_suppkey") % 4 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("https://portal.example.org/"), _s("s_suppkey"))).alias("link"),
        F.col("s_suppkey").cast("bigint").alias("ord"))
    again = s.where(F.col("s_suppkey") % 7 == 3).select(
        sid, F.concat(F.lit("app"), (F.col("s_nationkey") + 1).cast("string")).alias("app_id"),
        F.lit(None).cast("string").alias("link"), (F.col("s_suppkey") + 1000000000).cast("bigint").alias("ord"))
    p = table(spark, d, "part").select("p_partkey").where(F.col("p_partkey") % 100 == 3)
    b = p.select(
        F.concat(F.lit("syn"), (F.lit(1000000) + F.col("p_partkey")).cast("string")).alias("id"),
        F.lit("app99").alias("app_id"), F.lit(None).cast("string").alias("link"),
        (F.col("p_partkey") + 2000000000).cast("bigint").alias("ord"))
    return a.unionByName(again).unionByName(b)


@view
def app_v(spark: SparkSession, d: str) -> DataFrame:
    """App names in order (``ord``); some apps had another name before."""
    s = table(spark, d, "supplier").select("s_nationkey").where(F.col("s_nationkey") % 5 != 0).distinct()
    app = F.concat(F.lit("app"), _s("s_nationkey")).alias("app_id")
    now = s.select(app, F.concat(F.lit("Portal "), _s("s_nationkey")).alias("friendly_name"), F.lit(1).alias("ord"))
    before = s.where(F.col("s_nationkey") % 3 == 1).select(
        app, F.concat(F.lit("Zz portal "), _s("s_nationkey")).alias("friendly_name"), F.lit(0).alias("ord"))
    return now.unionByName(before)


@view
def listing_v(spark: SparkSession, d: str) -> DataFrame:
    """Listing pages of the corpus files: an archive, its checksum and the parent folder on each."""
    name = corpus_file_of("doc_id")
    return table(spark, d, "documents").select(name.alias("name")).distinct().select(F.concat(
        F.lit('<a href="../">..</a> <a href="'), "name", F.lit('">'), "name", F.lit('</a> <a href="'), "name",
        F.lit('.md5">md5</a>')).alias("html"))


@view
def article_text_v(spark: SparkSession, d: str, upper_second: bool = False,
                   repeat_first: bool = False) -> DataFrame:
    """Documents with two ids written in after the 40th character.

    ``upper_second`` writes the second id in upper case (for the case rule);
    ``repeat_first`` mentions the first id once more at the end (for per-document dedup)."""
    doc = table(spark, d, "documents").select("doc_id", "text", "lang")
    first = F.concat(F.lit(" syn"), (F.lit(1000000) + F.col("doc_id")).cast("string"))
    second = F.concat(F.lit(" and SYN" if upper_second else " and syn"),
                      (F.lit(2000000) + F.col("doc_id") % 7).cast("string"), F.lit(", "))
    text = F.concat(F.substring("text", 1, 40), first, second, F.substring("text", 41, 1 << 30))
    if repeat_first:
        text = F.concat(text, F.lit(" Again"), first, F.lit("."))
    return doc.select("doc_id", "lang", text.alias("text"))


@view
def copied_articles_v(spark: SparkSession, d: str) -> DataFrame:
    """The articles again, each with a shorter text, in files numbered ten times higher from 1,000 on: of
    PMC900_PMC999 and its copy PMC10000_PMC10099 the copy comes first by name, of others the original."""
    a = articles_xml_v(spark, d)
    block = (F.col("doc_id") - F.col("doc_id") % 100) * 10 + 1000
    name = F.concat(F.lit("PMC"), block.cast("string"), F.lit("_PMC"), (block + 99).cast("string"), F.lit(".xml.gz"))
    shorter = F.regexp_replace("xml", r"(?s)<body><p>.*? syn", "<body><p>copied syn")
    return a.select("doc_id", "lang", name.alias("source_file"), shorter.alias("xml"))


def corpus_file_of(doc_id) -> F.Column:
    c = F.col(doc_id)
    block = c - c % 100
    return F.concat(F.lit("PMC"), block.cast("string"), F.lit("_PMC"), (block + 99).cast("string"),
                    F.lit(".xml.gz"))


@view
def articles_xml_v(spark: SparkSession, d: str) -> DataFrame:
    """Article XML per document, in the layout of full-text archive files.

    The id element varies with the language so that every id rule is exercised:
    en ``pub-id-type="pmc"`` with ``PMC…``; fr ``pmcid`` with the bare number; es no
    id element (the id is found in a ``self-uri``); de has a mis-nested tag and is
    ill-formed (it must land in the rejects)."""
    a = article_text_v(spark, d)
    num = F.col("doc_id").cast("string")
    idel = (F.when(F.col("lang") == "fr",
                   F.concat(F.lit('<article-id pub-id-type="pmcid">'), num, F.lit("</article-id>")))
             .when(F.col("lang") == "es", F.concat(F.lit("<self-uri>PMC"), num, F.lit("</self-uri>")))
             .otherwise(F.concat(F.lit('<article-id pub-id-type="pmc">PMC'), num, F.lit("</article-id>"))))
    body_close = F.when(F.col("lang") == "de", F.lit("</body></p>")).otherwise(F.lit("</p></body>"))
    xml = F.concat(
        F.lit('<article xmlns:xlink="http://www.w3.org/1999/xlink" article-type="research-article">'),
        F.lit("<front><article-meta>"), idel,
        F.lit("<title-group><article-title>Document "), num,
        F.lit("</article-title></title-group></article-meta></front><body><p>"),
        xml_text("text"), body_close, F.lit("</article>"))
    return a.select("doc_id", "lang", corpus_file_of("doc_id").alias("source_file"), xml.alias("xml"))

"""Article pipeline: parsed articles -> findings, rejects and coverage (X2 + X4-X9, V2, V4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import ARTICLE_CURIE_PREFIX, CONTEXT_WINDOW
from .mine import DEFAULT_PATTERN, AccessionPattern, count_findings, extract_mentions, findings_array, findings_from_mentions


def findings_from_articles(parsed: DataFrame, keep=("source_file",), window: int = CONTEXT_WINDOW,
                           case_rule: str = "reference",
                           pattern: AccessionPattern = DEFAULT_PATTERN) -> DataFrame:
    """Parsed articles -> pmcid, synid, context (+ ``keep``). Rejected or id-less articles give none."""
    ok = parsed.where(F.col("ok") & F.col("pmc_id").isNotNull()).select(*keep, "pmc_id", "text")
    cols = (*keep, "pmc_id")
    f = findings_from_mentions(extract_mentions(ok, "text", cols, window, pattern), cols, case_rule, pattern)
    # the text was built after the UDF, so the prefilter cannot move below the exchange
    return f.select(*keep, "pos", F.concat(F.lit(ARTICLE_CURIE_PREFIX), "pmc_id").alias("pmcid"),
                    "synid", "context")


def rejects(parsed: DataFrame, keep=("source_file",)) -> DataFrame:
    """Articles that did not parse (V2), with the parser's reason."""
    return parsed.where(~F.col("ok")).select(*keep, "reason")


def coverage(parsed: DataFrame, file_col: str = "source_file", window: int = CONTEXT_WINDOW,
             case_rule: str = "reference", pattern: AccessionPattern = DEFAULT_PATTERN) -> DataFrame:
    """Per file: articles seen, parsed, with an id, with at least one finding, findings (V4).

    One pass over the parsed articles: each article's findings are counted inside its row, so
    the XML UDF runs once and only partial aggregates are shuffled."""
    n = F.when(F.col("ok") & F.col("pmc_id").isNotNull(),
               count_findings(F.col("text"), window, case_rule, pattern)).otherwise(F.lit(0))
    return _by_file(parsed.select(file_col, "ok", "pmc_id", n.alias("n")), file_col)


def with_findings(parsed: DataFrame, window: int = CONTEXT_WINDOW, case_rule: str = "reference",
                  pattern: AccessionPattern = DEFAULT_PATTERN) -> DataFrame:
    """Parsed articles with their findings as one array (``found``: synid, context) in place of the text, so that
    what is staged for findings and coverage is mined once, and is small."""
    found = F.when(F.col("ok") & F.col("pmc_id").isNotNull(), findings_array(F.col("text"), window, case_rule, pattern))
    return parsed.withColumn("found", found).drop("title", "abstract", "body", "back", "text")


def findings_of(mined: DataFrame, keep=("source_file",)) -> DataFrame:
    """``findings_from_articles`` (without ``pos``) of what ``with_findings`` gave."""
    rows = mined.select(*keep, "pmc_id", F.explode("found").alias("f"))
    return rows.select(*keep, F.concat(F.lit(ARTICLE_CURIE_PREFIX), "pmc_id").alias("pmcid"), "f.synid", "f.context")


def coverage_of(mined: DataFrame, file_col: str = "source_file") -> DataFrame:
    """``coverage`` of what ``with_findings`` gave."""
    n = F.coalesce(F.size("found"), F.lit(0))
    return _by_file(mined.select(file_col, "ok", "pmc_id", F.when(n > 0, n).otherwise(F.lit(0)).alias("n")), file_col)


def _by_file(per_article: DataFrame, file_col: str) -> DataFrame:
    return per_article.groupBy(file_col).agg(
        F.count(F.lit(1)).alias("articles"),
        F.count_if(F.col("ok")).alias("parsed"),
        F.count_if(F.col("ok") & F.col("pmc_id").isNotNull()).alias("with_id"),
        F.count_if(F.col("n") > 0).alias("articles_with_findings"),
        F.sum("n").cast("bigint").alias("findings"))

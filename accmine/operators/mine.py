"""Mention mining (X4-X9) as native Column expressions.

For every text the id regex runs once forward and once over the reversed text.
A lookahead capture gives the ``window`` characters after each match; on the
reversed text the same capture gives the characters before it. Both arrays are
aligned with the match array, so no offsets and no per-row Python are needed.
The work is narrow (no shuffle of its own): it runs in the stage that reads the
text, after the conditional spread of ``prepare_text``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import (ACCESSION_MAX_DIGITS, ACCESSION_MIN_DIGITS, ACCESSION_PREFIX,
                               ARTICLE_CURIE_PREFIX, CONTEXT_WINDOW)
from ..functions.text import collapse_ws, strip_ws
from .joins import spread


# "Not after a digit". Java steps back by UTF-16 unit in a look-behind unless the pattern text
# itself holds a supplementary character; naming one supplementary digit (U+1D7CE, already in
# \d) makes the look-behind step back by code point, as Python's re does.
NOT_AFTER_DIGIT = "(?<![\\d\U0001D7CE])"


@dataclass(frozen=True)
class AccessionPattern:
    """``prefix`` + ``min_digits``..``max_digits`` digits, not touching other digits, any case."""

    prefix: str = ACCESSION_PREFIX
    min_digits: int = ACCESSION_MIN_DIGITS
    max_digits: int = ACCESSION_MAX_DIGITS

    def __post_init__(self):
        if not re.fullmatch(r"[A-Za-z]+", self.prefix):
            raise ValueError("prefix must be letters")

    @property
    def forward(self) -> str:
        return rf"(?iU){NOT_AFTER_DIGIT}{self.prefix}\d{{{self.min_digits},{self.max_digits}}}(?!\d)"

    @property
    def backward(self) -> str:
        """The same matches, found on the reversed text. Whether a digit stands here is asked first: the
        look-behind, the dear part, is then skipped at nearly every place."""
        return rf"(?iU)(?=\d){NOT_AFTER_DIGIT}\d{{{self.min_digits},{self.max_digits}}}{self.prefix[::-1]}(?!\d)"

    @property
    def valid_id(self) -> str:
        return rf"(?U)^{self.prefix.lower()}\d{{{self.min_digits},{self.max_digits}}}$"


DEFAULT_PATTERN = AccessionPattern()


def _with_tail(p: str, window: int) -> str:
    return rf"(?s){p}(?=(.{{0,{window}}}))"


def _id_and_tail(pattern: AccessionPattern, window: int) -> str:
    """Group 1 = the id followed by up to ``window`` characters, captured by a lookahead at the
    start of the match, so one pass yields both. The look-behind comes after it: it is asked only where an id is."""
    core = rf"{pattern.prefix}\d{{{pattern.min_digits},{pattern.max_digits}}}(?!\d)"
    return rf"(?siU)(?=({core}.{{0,{window}}})){NOT_AFTER_DIGIT}{core}"


def mention_arrays(text: Column, window: int = CONTEXT_WINDOW,
                   pattern: AccessionPattern = DEFAULT_PATTERN) -> Column:
    """array<struct<mention, before, after>> for all matches in ``text``, in text order.

    Two regex passes per text: forward (id + following window) and over the reversed text
    (preceding window). Both find the same matches, so the arrays line up."""
    fwd = F.regexp_extract_all(text, F.lit(_id_and_tail(pattern, window)), F.lit(1))
    rbefore = F.regexp_extract_all(F.reverse(text), F.lit(_with_tail(pattern.backward, window)), F.lit(1))
    head = rf"(?iU)^{pattern.prefix}\d+"
    return F.zip_with(
        fwd, F.reverse(rbefore),
        lambda x, rb: F.struct(F.regexp_extract(x, head, 0).alias("mention"), F.reverse(rb).alias("before"),
                               F.substring(x, F.length(F.regexp_extract(x, head, 0)) + 1,
                                           F.lit(1 << 30)).alias("after")))


def maybe_mentions(text: Column, pattern: AccessionPattern = DEFAULT_PATTERN) -> Column:
    """Cheap test that a text can hold a mention: its lower-cased form contains the prefix.
    Every match of the (case-insensitive) pattern that survives the id rules passes it."""
    return F.lower(text).contains(pattern.prefix.lower())


def prepare_text(df: DataFrame, text_col: str = "text", keep=("doc_id",), collapse: bool = True,
                 spread_input: bool = True, pattern: AccessionPattern = DEFAULT_PATTERN) -> DataFrame:
    """``keep`` + ``text`` ready for mining: texts that cannot hold the prefix are dropped first
    (cheap, and valid before collapsing since folding blanks cannot create or remove the prefix),
    an under-partitioned input is spread over the cluster, then whitespace runs collapse."""
    df = df.select(*keep, text_col).where(maybe_mentions(F.col(text_col), pattern))
    if spread_input:
        df = spread(df, [*keep, text_col])  # the text in the hash: a repeated key cannot skew
    return df.select(*keep, (collapse_ws(text_col) if collapse else F.col(text_col)).alias("text"))


def extract_mentions(df: DataFrame, text_col: str = "text", keep=("doc_id",),
                     window: int = CONTEXT_WINDOW, pattern: AccessionPattern = DEFAULT_PATTERN,
                     prefilter: bool = True) -> DataFrame:
    """One row per regex match: ``keep`` columns, ``pos`` (0-based order in text), mention, before, after.

    With ``prefilter`` texts that cannot contain the prefix are dropped before any regex runs."""
    arr = mention_arrays(F.col(text_col), window, pattern)
    if prefilter:
        df = df.where(maybe_mentions(F.col(text_col), pattern))
    return (df.select(*keep, F.posexplode(arr).alias("pos", "m"))
              .select(*keep, "pos", F.col("m.mention").alias("mention"),
                      F.col("m.before").alias("before"), F.col("m.after").alias("after")))


def finding_rule(mention: Column, before: Column, after: Column, case_rule: str = "reference",
                 pattern: AccessionPattern = DEFAULT_PATTERN) -> Column:
    """Whether a raw match is a finding: its lower-cased id is a valid id and, with
    ``case_rule='reference'``, occurs in the stripped window text."""
    synid = F.lower(mention)
    cond = synid.rlike(pattern.valid_id)
    if case_rule == "reference":
        cond = cond & (F.instr(strip_ws(F.concat(before, mention, after)), synid) > 0)
    elif case_rule != "fold":
        raise ValueError("case_rule is 'reference' or 'fold'")
    return cond


def findings_array(text: Column, window: int = CONTEXT_WINDOW, case_rule: str = "reference",
                   pattern: AccessionPattern = DEFAULT_PATTERN) -> Column:
    """array<struct<synid, context>> of the findings in ``text``, in text order (as ``findings_from_mentions`` gives
    them); null for texts that cannot hold a mention."""
    hits = F.filter(mention_arrays(text, window, pattern), lambda m: finding_rule(m["mention"], m["before"], m["after"], case_rule, pattern))
    found = F.transform(hits, lambda m: F.struct(F.lower(m["mention"]).alias("synid"), _context(m["before"], m["mention"], m["after"]).alias("context")))
    return F.when(maybe_mentions(text, pattern), found)


def _context(before, mention, after) -> Column:
    return F.translate(strip_ws(F.concat(before, mention, after)), '"', "'")


def count_findings(text: Column, window: int = CONTEXT_WINDOW, case_rule: str = "reference",
                   pattern: AccessionPattern = DEFAULT_PATTERN) -> Column:
    """Number of findings in ``text``, computed in the row (no explode, no shuffle)."""
    arr = mention_arrays(text, window, pattern)
    hits = F.filter(arr, lambda m: finding_rule(m["mention"], m["before"], m["after"], case_rule, pattern))
    return F.when(maybe_mentions(text, pattern), F.size(hits)).otherwise(F.lit(0))


def findings_from_mentions(m: DataFrame, keep=("doc_id",), case_rule: str = "reference",
                           pattern: AccessionPattern = DEFAULT_PATTERN) -> DataFrame:
    """Apply the finding rules to raw matches: lower-case id, window text stripped, quotes to
    apostrophes. ``case_rule='reference'`` keeps a match only if its lower-cased id occurs in the
    window text (so upper-case ids only survive with a lower-case copy nearby); ``'fold'`` keeps all."""
    keep_row = finding_rule(F.col("mention"), F.col("before"), F.col("after"), case_rule, pattern)
    return (m.where(keep_row)
             .select(*keep, "pos", F.lower("mention").alias("synid"),
                     _context(F.col("before"), F.col("mention"), F.col("after")).alias("context")))


def mine_text(df: DataFrame, text_col: str = "text", keep=("doc_id",), window: int = CONTEXT_WINDOW,
              case_rule: str = "reference", pattern: AccessionPattern = DEFAULT_PATTERN,
              collapse: bool = True, spread_input: bool = True) -> DataFrame:
    """Text -> findings (``keep`` columns, pos, synid, context). Whitespace runs collapse first.

    ``spread_input``: if the input arrives in fewer partitions than the cluster's parallelism,
    hash-spread it on the key columns before the regex work (see ``joins.spread``)."""
    src = prepare_text(df, text_col, keep, collapse, spread_input, pattern)
    return findings_from_mentions(extract_mentions(src, "text", keep, window, pattern, prefilter=False),
                                  keep, case_rule, pattern)


def with_pmcid(df: DataFrame, article_col: str = "pmc_id") -> DataFrame:
    """Article id to its stored CURIE form ``pmc:PMC…``."""
    return df.withColumn("pmcid", F.concat(F.lit(ARTICLE_CURIE_PREFIX), F.col(article_col)))

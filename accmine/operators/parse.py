"""Article XML -> id and section text.

The only Python in the mining path: one Arrow UDF that parses each article with the
standard-library XML parser and returns a struct, a bounded piece of a batch at a time. It is
marked non-deterministic so Catalyst evaluates it exactly once per row, after
the repartition that spreads the (non-splittable) corpus files over tasks.
Id fallback, section joining and whitespace folding happen natively afterwards.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.fixed import ARTICLE_ID_TYPES
from ..functions.text import collapse_ws, normalize_article_id
from .joins import spread

_SECTIONS = ("article-title", "abstract", "body", "back")
_COLUMNS = tuple(f.name for f in schemas.SECTIONS.fields)
PIECE_ROWS, PIECE_CHARS = 256, 1 << 20      # articles of a batch that are Python objects at once
GZIP_EXPANSION = 6.0     # text bytes for one compressed byte, to size the parse tasks

# Ship this module's code with the UDF (pickled by value), so Python workers need no installed
# copy of the package: the same job runs from any directory and on any cluster.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _parse_one(xml):
    """(ok, pmc_id, title, abstract, body, back, reason); whatever the parser raises rejects the article."""
    import xml.etree.ElementTree as ET

    if xml is None:
        return (False, None, None, None, None, None, "no text")
    try:
        root = ET.fromstring(xml)
        pmc = None
        for el in root.iter("article-id"):
            if el.get("pub-id-type") in ARTICLE_ID_TYPES:
                pmc = el.text
                break
        out = [True, pmc]
        for tag in _SECTIONS:
            el = root.find(f".//{tag}")
            # every element boundary acts as a blank; runs of blanks fold later
            out.append(None if el is None else " ".join(el.itertext()).strip())
        return (*out, None)
    except Exception as exc:  # one odd article must not fail the job; its reason is kept
        return (False, None, None, None, None, None, f"{type(exc).__name__}: {exc}"[:200])


def _sections_array(rows: list) -> pa.Array:
    columns = zip(*rows) if rows else [()] * len(_COLUMNS)
    return pa.StructArray.from_arrays([pa.array(list(c), pa.bool_() if n == "ok" else pa.string()) for n, c in zip(_COLUMNS, columns)], list(_COLUMNS))


def _in_pieces(batch: pa.Array) -> Iterator[pa.Array]:
    """The sections of a batch's articles in pieces of bounded rows and text: memory beside the batch itself
    does not follow the rows of a batch."""
    rows, chars = [], 0
    for value in batch:
        xml = value.as_py()
        rows.append(_parse_one(xml))
        chars += len(xml or "")
        if len(rows) >= PIECE_ROWS or chars >= PIECE_CHARS:
            yield _sections_array(rows)
            rows, chars = [], 0
    if rows or not len(batch):
        yield _sections_array(rows)


@F.arrow_udf(schemas.SECTIONS)
def _sections_udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield from _in_pieces(batch)


sections_udf = _sections_udf.asNondeterministic()


def may_hold_id(xml, prefix: str):
    """Whether an article's raw XML can hold an id: exact, never false for an article with a finding.

    An id stands inside one text node (element boundaries read as blanks). Its letters are there as such,
    unless character references, comments, CDATA sections or processing instructions write or split
    them; the five predefined entities are no letters, and any other entity is an error."""
    odd = F.contains(xml, F.lit("&#")) | F.contains(xml, F.lit("<!")) | F.contains(xml, F.lit("<?"))
    return odd | F.contains(F.lower(xml), F.lit(prefix.lower()))


def parse_articles(raw: DataFrame, xml_col: str = "xml", keep=("source_file",),
                   partitions: int | None = None, only_ids: str | None = None) -> DataFrame:
    """Raw articles -> ``keep`` + ok, reason, pmc_id, title, abstract, body, back, text.

    ``partitions``: hash-spread the raw articles over this many partitions before parsing; ``None`` spreads
    them by size when the scan's (unsplittable) files are too few or too large; ``0`` keeps the input
    partitioning. ``pmc_id`` is null for unparseable articles and for articles without any id; they
    yield no findings; ``reason`` says why an article did not parse.

    ``only_ids`` (an id prefix): parse only articles whose raw XML can hold such an id, see
    ``may_hold_id``. The findings are the same; the other articles never reach Python, and are missing
    from reject and coverage audits.
    """
    src = raw.select(*dict.fromkeys([*keep, xml_col]))
    if only_ids:
        src = src.where(may_hold_id(F.col(xml_col), only_ids))
    if partitions:
        src = spread(src, [*keep, xml_col], partitions)
    elif partitions is None:
        src = spread(src, [*keep, xml_col], splittable=False, expansion=GZIP_EXPANSION)
    p = src.select(*keep, F.col(xml_col), sections_udf(F.col(xml_col)).alias("s"))
    fallback = F.nullif(F.regexp_extract(F.col(xml_col), r"(?U)(?:PMC|pmc)(\d+)", 1), F.lit(""))
    raw_id = F.coalesce(F.nullif(F.col("s.pmc_id"), F.lit("")), F.concat(F.lit("PMC"), fallback))
    pmc_id = F.when(F.col("s.ok"), normalize_article_id(raw_id))
    text = collapse_ws(F.concat_ws(" ", "s.title", "s.abstract", "s.body", "s.back"))
    return p.select(*keep, F.col("s.ok").alias("ok"), F.col("s.reason").alias("reason"), pmc_id.alias("pmc_id"),
                    F.col("s.title").alias("title"), F.col("s.abstract").alias("abstract"),
                    F.col("s.body").alias("body"), F.col("s.back").alias("back"),
                    F.when(F.col("s.ok"), text).alias("text"))

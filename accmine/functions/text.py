"""Scalar text helpers as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import ARTICLE_CURIE_PREFIX, ARTICLE_ID_PREFIX, CORPUS_FILE_RANGE, WS_CLASS


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def collapse_ws(col) -> Column:
    """Every run of whitespace becomes one blank; ends are kept (like re.sub(r'\\s+', ' ', t))."""
    return F.regexp_replace(_c(col), F.lit(f"(?U){WS_CLASS}+"), F.lit(" "))


def strip_ws(col) -> Column:
    """Remove leading and trailing whitespace of any kind (like str.strip())."""
    return F.regexp_replace(_c(col), F.lit(f"(?U)\\A{WS_CLASS}+|{WS_CLASS}+\\z"), F.lit(""))


def clean_text(col) -> Column:
    """Collapse and trim (like ' '.join(t.split())). After collapsing, only blanks remain, so trim suffices."""
    return F.trim(collapse_ws(col))


def kwic(text, start, end, size=25) -> Column:
    """Keyword in context: struct(before, after, full) around 0-based [start, end).

    Each side is stripped; full is ``before + ' ' + target + ' ' + after`` stripped.
    Null or empty text gives three empty strings.
    """
    t, s, e = _c(text), _c(start), _c(end)
    size = _c(size) if not isinstance(size, int) else F.lit(size)
    n = F.length(t)
    cstart = F.greatest(F.lit(0), s - size)
    cend = F.least(n, e + size)
    before = strip_ws(F.substring(t, cstart + 1, s - cstart))
    after = strip_ws(F.substring(t, e + 1, F.greatest(F.lit(0), cend - e)))
    target = F.substring(t, s + 1, F.greatest(F.lit(0), e - s))
    full = strip_ws(F.concat_ws(" ", before, target, after))
    empty = t.isNull() | (n == 0)
    return F.struct(
        F.when(empty, F.lit("")).otherwise(before).alias("before"),
        F.when(empty, F.lit("")).otherwise(after).alias("after"),
        F.when(empty, F.lit("")).otherwise(full).alias("full"),
    )


def add_curie(col, prefix: str = ARTICLE_CURIE_PREFIX) -> Column:
    return F.concat(F.lit(prefix), _c(col))


def strip_curie(col, prefix: str = ARTICLE_CURIE_PREFIX) -> Column:
    """Drop a leading ``pmc:``; other values pass unchanged."""
    c = _c(col)
    return F.when(c.startswith(prefix), F.substring(c, len(prefix) + 1, 1 << 30)).otherwise(c)


def normalize_article_id(col) -> Column:
    """Prefix ``PMC`` unless the id already starts with it (blanks are kept as they are)."""
    c = _c(col)
    return F.when(c.startswith(ARTICLE_ID_PREFIX), c).otherwise(F.concat(F.lit(ARTICLE_ID_PREFIX), c))


def file_range(name_col) -> Column:
    """struct(start_pmc, end_pmc, start_id) parsed from a corpus file name; nulls when it has no range."""
    n = _c(name_col)
    pat = f"(?U){CORPUS_FILE_RANGE}"
    start = F.nullif(F.regexp_extract(n, pat, 1), F.lit(""))
    end = F.nullif(F.regexp_extract(n, pat, 2), F.lit(""))
    return F.struct(
        start.try_cast("bigint").alias("start_pmc"),
        end.try_cast("bigint").alias("end_pmc"),
        F.when(start.isNotNull(), F.concat(F.lit(ARTICLE_ID_PREFIX), start)).alias("start_id"),
    )


def iso_date(col) -> Column:
    """First ten characters of an ISO timestamp; empty string when missing."""
    c = _c(col)
    return F.coalesce(F.substring(c, 1, 10), F.lit(""))


def parent_id(col, prefix: str = "syn") -> Column:
    """Integer parent id to accession form; 0 or null give null."""
    c = _c(col)
    return F.when(c.isNotNull() & (c != 0), F.concat(F.lit(prefix), c.cast("string")))


def decode_text(bin_col) -> Column:
    """UTF-8 when the bytes are valid UTF-8, else Latin-1 (which accepts any byte)."""
    b = _c(bin_col)
    return F.when(F.is_valid_utf8(b.cast("string")), b.cast("string")).otherwise(
        F.decode(b, "ISO-8859-1"))


def decoded_with(bin_col) -> Column:
    b = _c(bin_col)
    return F.when(F.is_valid_utf8(b.cast("string")), F.lit("utf-8")).otherwise(F.lit("latin-1"))


def kwic_pieces(before_raw, target, after_raw) -> Column:
    """Keyword in context from the raw side windows of a match (X7 on mined mentions)."""
    b, a = strip_ws(_c(before_raw)), strip_ws(_c(after_raw))
    return F.struct(b.alias("before"), a.alias("after"),
                    strip_ws(F.concat_ws(" ", b, _c(target), a)).alias("full"))


def source_file_from_path(path_col) -> Column:
    """Corpus file name from a path: the last ``PMCa_PMCb[.xml][.gz]`` in it (a flat corpus file,
    a ``source_file=…`` folder, or a batch file ``<output>.<corpus file>.csv``), else the file name."""
    p = _c(path_col)
    hit = F.nullif(F.regexp_extract(p, r"^.*(PMC\d+_PMC\d+(?:\.xml)?(?:\.gz)?)", 1), F.lit(""))
    return F.coalesce(hit, F.element_at(F.split(p, "/"), -1))


def xml_text(c) -> Column:
    """Escape text for XML element content (& < >)."""
    c = _c(c)
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def xml_attr(c) -> Column:
    """Escape text for a double-quoted XML attribute value."""
    c = xml_text(c)
    for a, b in (('"', "&quot;"), ("\n", "&#10;"), ("\r", "&#13;"), ("\t", "&#09;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c

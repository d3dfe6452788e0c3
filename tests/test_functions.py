"""Text helpers against hand-written values and their laws."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from accmine.functions import text as T


def one(spark, col, **values):
    row = ", ".join(f"{k} {'long' if isinstance(v, int) else 'binary' if isinstance(v, bytes) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], row).select(col.alias("v")).first().v


@pytest.mark.parametrize("text, s, e, n, want", [
    ("alpha beta gamma delta", 11, 16, 6, ("beta", "delta", "beta gamma delta")),
    ("alpha beta gamma delta", 0, 5, 3, ("", "be", "alpha be")),
    ("alpha beta gamma delta", 17, 22, 100, ("alpha beta gamma", "", "alpha beta gamma delta")),
    ("  k  ", 2, 3, 9, ("", "", "k")), ("ab", 1, 1, 1, ("a", "b", "a  b")), ("", 0, 0, 5, ("", "", "")), (None, 0, 0, 5, ("", "", "")),
])
def test_keyword_in_context(spark, text, s, e, n, want):
    df = spark.createDataFrame([(text, s, e)], "t string, s int, e int")
    assert tuple(df.select(T.kwic("t", "s", "e", n).alias("k")).first().k) == want


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.text(st.sampled_from(list("ab \n🙂é")), min_size=1, max_size=30), st.integers(0, 30), st.integers(0, 5),
                          st.integers(0, 12)), min_size=1, max_size=6))
def test_keyword_in_context_laws(spark, cases):
    rows = [(t, min(s, len(t)), min(s + k, len(t)), n) for t, s, k, n in cases]
    df = spark.createDataFrame(rows, "t string, s int, e int, n int")
    for (t, s, e, n), r in zip(rows, df.select(T.kwic("t", "s", "e", F.col("n")).alias("k")).collect()):
        before, after, full = r.k
        assert before == before.strip() and after == after.strip() and full == full.strip()
        assert len(before) <= n and len(after) <= n
        assert t[:s].rstrip().endswith(before) and t[e:].lstrip().startswith(after)
        assert full == f"{before} {t[s:e]} {after}".strip()


@pytest.mark.parametrize("raw, folded, stripped, clean", [
    ("x", "x", "x", "x"), (" \t x \n\n y", " x y", "x \n\n y", "x y"), ("\x1c x\x85", " x ", "x", "x"), ("", "", "", ""), (" ", " ", "", "")])
def test_white_space(spark, raw, folded, stripped, clean):
    got = one(spark, F.array(T.collapse_ws("t"), T.strip_ws("t"), T.clean_text("t")), t=raw)
    assert got == [folded, stripped, clean]


@pytest.mark.parametrize("name, want", [
    ("PMC40_PMC49.xml.gz", (40, 49, "PMC40")), ("lead/PMC007_PMC9.tar", (7, 9, "PMC007")), ("PMC5.xml.gz", (None, None, None)),
    ("PMC_PMC3.xml.gz", (None, None, None)), ("pmc1_pmc2.xml.gz", (None, None, None)),
    ("PMC99999999999999999999_PMC1.xml", (None, 1, "PMC99999999999999999999"))])
def test_corpus_file_names(spark, name, want):
    assert tuple(one(spark, T.file_range("n"), n=name)) == want


@pytest.mark.parametrize("path, want", [
    ("hdfs://h/a/PMC1_PMC9.xml.gz", "PMC1_PMC9.xml.gz"), ("/in/source_file=PMC5_PMC6.xml.gz/part-1.csv", "PMC5_PMC6.xml.gz"),
    ("/in/out.PMC7_PMC8.xml.gz.csv", "PMC7_PMC8.xml.gz"), ("/in/PMC1_PMC2/notes.txt", "PMC1_PMC2"), ("/in/notes.txt", "notes.txt")])
def test_corpus_file_of_a_path(spark, path, want):
    assert one(spark, T.source_file_from_path("p"), p=path) == want


def test_ids_and_prefixes(spark):
    assert one(spark, F.array(T.add_curie("a"), T.strip_curie("a"), T.strip_curie("b"), T.normalize_article_id("c"), T.normalize_article_id("a")),
               a="PMC8", b="pmc:pmc:PMC8", c="8") == ["pmc:PMC8", "PMC8", "pmc:PMC8", "PMC8", "PMC8"]
    assert one(spark, F.array(T.parent_id("z"), T.parent_id("p"), T.parent_id("p", "ds")), z=0, p=31) == [None, "syn31", "ds31"]
    assert one(spark, F.array(T.iso_date("d"), T.iso_date("n")), d="2023-11-05T10:00:00Z", n=None) == ["2023-11-05", ""]


@pytest.mark.parametrize("raw, text, how", [("naïve ✓".encode(), "naïve ✓", "utf-8"), ("naïve".encode("latin-1"), "naïve", "latin-1"), (b"", "", "utf-8"),
                                            (b"\x80abc", "\x80abc", "latin-1")])
def test_decoding(spark, raw, text, how):
    assert one(spark, F.array(T.decode_text("b"), T.decoded_with("b")), b=raw) == [text, how]


def test_xml_escapes(spark):
    assert one(spark, F.array(T.xml_text("t"), T.xml_attr("t")), t='<a & "b">\n\t') == ['&lt;a &amp; "b"&gt;\n\t', "&lt;a &amp; &quot;b&quot;&gt;&#10;&#09;"]

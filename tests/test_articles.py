"""Article XML: scan rules, id rules, section text, rejects, the exact gate before the parse."""

import gzip
import xml.etree.ElementTree as ET

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from accmine.operators.articles import findings_from_articles, rejects
from accmine.operators.parse import _parse_one, may_hold_id, parse_articles
from accmine.sources.corpus import read_articles


def article(body="", front="", back="", ident='<article-id pub-id-type="pmc">PMC77</article-id>', attrs='dtd-version="1.3"'):
    return (f"<article {attrs}><front><article-meta>{ident}{front}</article-meta></front>"
            f"<body>{body}</body><back>{back}</back></article>")


# lists, footnotes, boxed text, formulas, mixed content and nested sections
MIXED = article(
    front="<title-group><article-title>On <italic>reuse</italic> of syn5550001</article-title></title-group>"
          "<abstract><sec><title>Aim</title><p>None cited.</p></sec><sec><title>Data</title><p>See syn5550002;</p></sec></abstract>",
    body="<sec><title>A</title><sec><title>B</title><list><list-item><p>first syn5550003</p></list-item>"
         "<list-item><p>then <bold>syn5550004</bold> and on</p></list-item></list></sec></sec>"
         "<boxed-text><p>x<sub>2</sub> (syn5550005)</p></boxed-text><disp-quote><p>nothing</p></disp-quote>",
    back="<fn-group><fn><p>Footnote: syn5550006.</p></fn></fn-group><app-group><app><p>Appendix</p></app></app-group>")


def parse(spark, xmls, **kw):
    df = spark.createDataFrame([(str(i), x) for i, x in enumerate(xmls)], "source_file string, xml string")
    return parse_articles(df, "xml", ("source_file",), partitions=0, **kw)


def found(spark, xmls, **kw):
    rows = findings_from_articles(parse(spark, xmls, **kw), ("source_file",)).collect()
    return sorted((r.source_file, r.pos, r.pmcid, r.synid, r.context) for r in rows)


def test_sections_in_reading_order(spark):
    rows = found(spark, [MIXED])
    assert [r[3] for r in rows] == [f"syn555000{k}" for k in range(1, 7)]
    assert {r[2] for r in rows} == {"pmc:PMC77"}
    p = parse(spark, [MIXED]).first()
    assert p.title == "On  reuse  of syn5550001" and p.text.startswith("On reuse of syn5550001 Aim None cited. Data")


@pytest.mark.parametrize("ident, want", [
    ('<article-id pub-id-type="doi">10.1/x</article-id><article-id pub-id-type="pmc">31</article-id>', "PMC31"),
    ('<article-id pub-id-type="pmcid">PMC32</article-id><article-id pub-id-type="pmc">PMC33</article-id>', "PMC32"),
    ('<article-id pub-id-type="pmc"></article-id><ext-link>see pmc34 there</ext-link>', "PMC34"),
    ('<related-object>PMC35</related-object>', "PMC35"),
    ('<article-id pub-id-type="pmid">36</article-id>', None),
])
def test_where_the_id_comes_from(spark, ident, want):
    r = parse(spark, [article(ident=ident)]).first()
    assert (r.ok, r.pmc_id) == (True, want)


@pytest.mark.parametrize("xml", [article(body="<p>open"), article(body="<p>&nbsp;</p>"), article(body="<p a=1/>"), "<article ", "", None,
                                 article(body="<p>\x01</p>"), article()[:-len("</article>")]])
def test_what_does_not_parse_is_rejected_with_a_reason(spark, xml):
    p = parse(spark, [xml, article()])
    assert [(r.source_file, bool(r.reason)) for r in rejects(p).collect()] == [("0", True)]
    assert found(spark, [xml]) == []


def test_any_exception_of_the_parser_rejects(monkeypatch):
    def boom(_):
        raise RecursionError("too deep")

    monkeypatch.setattr(ET, "fromstring", boom)
    assert _parse_one("<article />")[0] is False and _parse_one("<article />")[-1] == "RecursionError: too deep"


def test_text_nodes_join_with_blanks():
    body = _parse_one(article(body="<p>a<![CDATA[ <k> ]]>b<!-- c -->d &lt;e&gt; &#102;</p><p>g<x>h</x>i</p>"))[4]
    assert " ".join(body.split()) == "a <k> bd <e> f g h i"


def test_title_is_the_first_in_the_document(spark):
    xml = article(back="<ref-list><ref><article-title>Cited syn5551111</article-title></ref></ref-list>")
    assert parse(spark, [xml]).first().title == "Cited syn5551111"
    assert [r[3] for r in found(spark, [xml])] == ["syn5551111"] * 2       # as title, and in the back matter


# ---------------------------------------------------------------- exact gate ---

PIECES = ["syn", "SYN", "sy", "n", "123", "4567", "5554444", " ", "<b>", "</b>", "<!-- s -->", "<![CDATA[n]]>", "<![CDATA[syn]]>", "<?pi?>",
          "&#115;", "&#x79;", "&amp;", "ref", "\n"]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=9).map("".join), min_size=1, max_size=8))
def test_gate_loses_no_finding(spark, bodies):
    xmls = [article(body=f"<p>{b}</p>") for b in bodies]
    assert found(spark, xmls, only_ids="syn") == found(spark, xmls)


def test_gate_is_native_and_below_the_parse(spark):
    plain = article(body="<p>nothing to see</p>").replace("dtd-version", "v")
    split = [article(body="<p>sy<!-- x -->n5557777</p>"), article(body="<p>sy<![CDATA[n5558888]]></p>"), article(body="<p>&#115;yn5559999</p>")]
    p = parse(spark, [plain, *split, article(body="<p>Syn</p>")], only_ids="syn")
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert plan.index("ArrowEvalPython") < plan.index("Filter")            # printed top-down
    assert sorted(r.source_file for r in p.collect()) == ["1", "2", "3", "4"]
    assert [r[3] for r in found(spark, split, only_ids="syn")] == ["syn5557777", "syn5558888", "syn5559999"]
    assert spark.range(1).select(may_hold_id(F.lit("x SYN y"), "syn").alias("m")).first().m


def test_parse_runs_once(spark):
    df = spark.createDataFrame([("f", MIXED)], "source_file string, xml string")
    plan = parse_articles(df, "xml", ("source_file",), partitions=3).where("ok")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.index("ArrowEvalPython") < plan.index("Exchange")


# ---------------------------------------------------------------------- scan ---

def write(path, text, gz=False):
    data = text if isinstance(text, bytes) else text.encode()
    with (gzip.open if gz else open)(path, "wb") as fh:
        fh.write(data)


def scan(spark, folder):
    return sorted((r.source_file, r.xml) for r in read_articles(spark, str(folder)).collect())


def test_scan_finds_whole_articles_only(spark, tmp_path):
    a, b = article(body="<p>1</p>"), article(body="<p>2</p>", attrs='\n xml:lang="en"')
    write(tmp_path / "PMC1_PMC5.xml.gz", f'<?xml version="1.0"?>\n<!DOCTYPE x>\n<set>{a}\n<note/>{b}</set>\n', gz=True)
    write(tmp_path / "PMC6_PMC9.xml", f"﻿<set>\n{b}{a}")
    write(tmp_path / "PMC10_PMC11.xml", "<set><article><p>no attributes, not an article of the archive</p></article></set>")
    write(tmp_path / "PMC12_PMC13.xml", "")
    write(tmp_path / "PMC14_PMC15.xml", a)
    assert scan(spark, tmp_path) == sorted([("PMC1_PMC5.xml.gz", a), ("PMC1_PMC5.xml.gz", b), ("PMC6_PMC9.xml", a),
                                            ("PMC6_PMC9.xml", b), ("PMC14_PMC15.xml", a)])


@pytest.mark.parametrize("cut", [len("</article>"), len("</back></article>"), 30, 3])
def test_a_cut_off_tail_is_no_article(spark, tmp_path, cut):
    write(tmp_path / "PMC1_PMC2.xml.gz", article(body="<p>syn5550001</p>") + "\n" + article(body="<p>syn5550002</p>")[:-cut], gz=True)
    p = parse_articles(read_articles(spark, str(tmp_path)), "xml", ("source_file",), partitions=0)
    assert sorted(r.ok for r in p.collect()) == [False, True]
    assert [r.synid for r in findings_from_articles(p).collect()] == ["syn5550001"]


def test_bytes_that_are_no_text_stay_in_their_article(spark, tmp_path):
    bad = article(body="<p>x @ syn5550001</p>").encode().replace(b"@", b"\xff\xfe")
    write(tmp_path / "PMC1_PMC2.xml.gz", bad + article().encode(), gz=True)
    got = scan(spark, tmp_path)
    assert len(got) == 2 and "�" in got[0][1] + got[1][1]


def test_a_plain_file_read_in_many_splits_gives_each_article_once(spark, tmp_path):
    n = 2000
    write(tmp_path / "PMC1_PMC2000.xml", "<set>\n" + "\n".join(
        article(body=f"<p>{'é' * (k % 89)} n{k}n</p>") for k in range(n)) + "\n</set>")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        arts = read_articles(spark, str(tmp_path))
        assert arts.rdd.getNumPartitions() > 5
        got = arts.select(F.regexp_extract("xml", r"n(\d+)n", 1).cast("int").alias("k")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(r.k for r in got) == list(range(n))


def test_a_batch_is_parsed_in_bounded_pieces():
    import pyarrow as pa
    from accmine.operators import parse
    batch = pa.array(["<a/>", None, "<b>"] * 300 + ["<a>" + "x" * parse.PIECE_CHARS + "</a>"] * 3)
    pieces = list(parse._in_pieces(batch))
    assert [r for p in pieces for r in p.field("ok").to_pylist()] == [True, False, False] * 300 + [True] * 3
    assert max(map(len, pieces)) == parse.PIECE_ROWS and len(pieces) == 4 + 2 and [len(p) for p in parse._in_pieces(batch[:0])] == [0]


def test_articles_mined_once_give_the_same(spark):
    from accmine.operators.articles import coverage, coverage_of, findings_from_articles, findings_of, with_findings
    texts = [(True, "PMC1", 'a "syn1234567" 5syn1234567 SYN7654321 b 12syn1234567'), (True, "PMC2", "none"), (True, None, "syn1234567"),
             (False, None, None), (True, "PMC3", None), (True, "PMC4", "\U0001D7CEsyn1234567 x\U0001F600syn12345678")]
    parsed = spark.createDataFrame([("f", ok, None, i, None, None, None, None, t) for ok, i, t in texts],
                                   "source_file string, ok boolean, reason string, pmc_id string, title string, abstract string, body string, back string, text string")
    for rule in ("reference", "fold"):
        mined = with_findings(parsed, case_rule=rule)
        want = findings_from_articles(parsed, case_rule=rule).select("source_file", "pmcid", "synid", "context")
        assert sorted(findings_of(mined).collect()) == sorted(want.collect()) and "text" not in mined.columns
        assert coverage_of(mined).collect() == coverage(parsed, case_rule=rule).collect()

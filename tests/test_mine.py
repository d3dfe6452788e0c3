"""Mention mining. Expected rows are written by hand, or come from a scanner that walks the text character
by character and uses no regular expression."""

import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from accmine.operators.mine import AccessionPattern, count_findings, extract_mentions, mine_text


def mine(spark, texts, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return sorted(tuple(r) for r in mine_text(df, **kw).select("doc_id", "pos", "synid", "context").collect())


def is_digit(c):
    return unicodedata.category(c) == "Nd"


def fold(text):
    out = []
    for c in text:
        if c.isspace():
            if not out or out[-1] != " ":
                out.append(" ")
        else:
            out.append(c)
    return "".join(out)


def walk(texts, window=25, rule="reference", lo=7, hi=12):
    """Findings by walking: at each s/S try the letters, then count the digits behind them."""
    out = []
    for doc, raw in enumerate(texts):
        t, pos, i = fold(raw), 0, 0
        while i < len(t):
            if t[i:i + 3].lower() == "syn" and t[i:i + 3].isascii() and not (i and is_digit(t[i - 1])):
                j = i + 3
                while j < len(t) and is_digit(t[j]):
                    j += 1
                if lo <= j - i - 3 <= hi:
                    sid = "syn" + t[i + 3:j]
                    around = t[max(0, i - window):j + window].strip()
                    if rule == "fold" or sid in around:
                        out.append((doc, pos, sid, around.replace('"', "'")))
                    pos, i = pos + 1, j
                    continue
            i += 1
    return sorted(out)


def test_a_finding_and_its_surroundings(spark):
    assert mine(spark, ["Reads are kept under  syn44443333\n(controlled access), version 2."]) == [
        (0, 0, "syn44443333", "Reads are kept under syn44443333 (controlled access), ver")]


@pytest.mark.parametrize("text, ids", [
    ("syn000001", []), ("syn0000001", ["syn0000001"]), ("syn000000000001", ["syn000000000001"]), ("syn0000000000001", []),
    ("7syn1230000", []), ("_syn1230000_", ["syn1230000"]), ("resyn1230000b", ["syn1230000"]), ("syn-1230000", []), ("syn 1230000", []),
    ("syn1230000syn1230001", ["syn1230000"]), ("syn1230000,syn1230001", ["syn1230000", "syn1230001"]),
    ("Syn1230000", []), ("SYN1230000 is syn1230000", ["syn1230000", "syn1230000"]), ("syn٠١٢٣٤٥٦", ["syn٠١٢٣٤٥٦"]),
])
def test_what_counts_as_an_id(spark, text, ids):
    got = mine(spark, [text])
    assert [r[2] for r in got] == ids and got == walk([text])


def test_positions_count_matches_that_are_dropped_too(spark):
    assert [(r[1], r[2]) for r in mine(spark, ["SYN7770000" + " ." * 20 + " syn7770001"])] == [(1, "syn7770001")]


@pytest.mark.parametrize("window", [0, 1, 7, 400])
def test_window(spark, window):
    texts = ["a" * 12 + " syn7770000 " + "b" * 12, "syn7770000", '"syn7770000" "q"', "🙂" * 9 + "syn7770000" + "🙂" * 9]
    assert mine(spark, texts, window=window) == walk(texts, window)


def test_sides_never_pass_the_window(spark):
    df = spark.createDataFrame([(0, "left " * 9 + "syn7770000" + " right" * 9)], "doc_id long, text string")
    r = extract_mentions(df, "text", ("doc_id",), window=11).first()
    assert (r.before, r.mention, r.after) == ("t left left "[-11:], "syn7770000", " right righ"[:11])


def test_fold_rule_and_counts(spark):
    texts = ["SYN7770000", "x", "", "syn7770000 SYN7770001 syn7770000"]
    assert mine(spark, texts, case_rule="fold") == walk(texts, rule="fold")
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.n for r in df.select(count_findings(df.t).alias("n")).collect()] == [0, 0, 0, 2]
    with pytest.raises(ValueError):
        mine(spark, texts, case_rule="other")


def test_other_ids(spark):
    df = spark.createDataFrame([(0, "GSE77 gse101 gse1000000 xgse12")], "doc_id long, text string")
    got = mine_text(df, pattern=AccessionPattern("gse", 2, 5)).orderBy("pos").collect()
    assert [r.synid for r in got] == ["gse101", "gse12"]
    with pytest.raises(ValueError):
        AccessionPattern("a.b")


alphabet = st.sampled_from(list("synSYN0147 \n\t.,\"é🙂٣") + ["syn7770000", "SYN7770000", "𝟎"])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(alphabet, max_size=40).map("".join), min_size=1, max_size=6))
def test_equals_the_walk(spark, texts):
    assert mine(spark, texts) == walk(texts)

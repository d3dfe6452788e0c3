"""Fill-in-middle: token boundaries against the token pattern, the transformed texts against SQL, exact round trips."""

import random
import re

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from accmine.llm import fill_middle as fm
from accmine.llm.queries import QUERIES, SQL

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def check_cuts(text, cache, max_chunk=None):
    raw = text.encode()
    chunks = fm.chunks_of([b"before ", raw, b" after"], cache.gear)[1]
    assert b"".join(chunks) == raw
    tokens = TOKEN.findall(text)
    cuts = fm.Cuts(chunks, cache)
    assert cuts.n == len(tokens)
    for k in range(len(tokens) + 1):
        head = "".join(tokens[:k])
        assert cuts.place(k) == (len(head.encode()), len(head))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab é 𝛂 \t\n\r\x0b\x0c\x1c", max_size=400))
def test_cuts_are_token_boundaries_whatever_the_chunks(text):
    cache, bits, most = fm.ChunkCache(), fm.CUT_BITS, fm.MAX_CHUNK
    try:
        for fm.CUT_BITS, fm.MAX_CHUNK in ((1, 7), (2, 64), (10, 1 << 16)):
            check_cuts(text, cache)
    finally:
        fm.CUT_BITS, fm.MAX_CHUNK = bits, most


def test_shared_passages_are_summarized_once():
    rnd = random.Random(4)
    passage = " ".join("".join(rnd.choices("abcdefgh", k=6)) for _ in range(4000)).encode()
    cache = fm.ChunkCache()
    for k in range(20):
        for c in fm.chunks_of([f"document {k} begins ".encode() * (k + 1) + passage + b" and ends"], cache.gear)[0]:
            assert cache.summary(c) == fm.summarize(c)
    assert cache.misses < 0.2 * (cache.hits + cache.misses)


def test_the_cache_is_bounded_and_checks_the_content(monkeypatch):
    cache = fm.ChunkCache(limit=1000)
    for k in range(500):
        cache.summary(b"w%d " % k)
        assert cache.size <= 1000 + 10
    key = hash(b"one two")
    cache.entries[key] = (b"other", (9, True, True, 9))      # a chunk with the same hash
    assert cache.summary(b"one two") == (2, True, True, 7)


def test_chunks_do_not_depend_on_place():
    rnd = random.Random(8)
    passage = bytes(rnd.choices(b"abcdef ghij", k=60_000))
    gear = fm._gear()
    a, b = (set(fm.chunks_of([head + passage], gear)[0]) for head in (b"", b"some other beginning " * 9))
    assert len(a & b) >= 0.9 * len(a) and max(map(len, a)) <= fm.MAX_CHUNK
    assert np.mean([len(x) for x in a]) == pytest.approx(1 << fm.CUT_BITS, rel=0.6)


DOCS = [(0, "plain words here"), (1, None), (2, ""), (3, "has <P> inside"), (4, "has <M>"), (5, "   "), (6, "one"), (None, "no id at all"),
        (7, "ends with space \n"), (8, "𝛂𝛃 é b <S"), (9, "P> starts and ends <"), (9, "P> starts and ends <"), (10, "no_space_" * 30_000),
        (11, "long text " * 60_000), (12, "<S <M <P >P> >")] + [(k, f"word{k} " * (k % 23) + "<M" * (k % 3)) for k in range(20, 220)]


def test_odd_tables_equal_the_sql(spark, tmp_path):
    spark.createDataFrame([(*d, "x") for d in DOCS], "doc_id long, text string, n string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    key = lambda r: tuple(map(str, r))
    got = sorted((tuple(r) for r in QUERIES["op11_fill_in_middle"](spark, str(tmp_path)).collect()), key=key)
    assert got == sorted(con.execute(SQL["op11_fill_in_middle"]).fetchall(), key=key)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_output_restores_and_other_columns_stay(spark):
    docs = spark.createDataFrame([(*d, 1.5) for d in DOCS], "doc_id long, text string, form double")
    out = fm.fill_in_middle(docs, fim_percent=100, spm_percent=50)
    rows = out.select("form", "text", "fim.output", fm.restore(out["fim.output"], out["fim.form"]).alias("back")).collect()
    assert all(r.back == (r.text or "") and r.form == 1.5 for r in rows)
    assert sum(r.output != (r.text or "") for r in rows) > 150
    assert fm.fill_in_middle(docs, out_col="form").columns == ["doc_id", "text", "form", "form_"]
    assert fm.fill_in_middle(docs.where("false")).collect() == []

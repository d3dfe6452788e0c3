"""Token counts (op3) and byte-level BPE (op7) against the public libraries."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from accmine.llm import byte_bpe, token_counts
from accmine.llm.queries import QUERIES

ODD = ["", " ", "a" * 3000, " " * 500, "it's WE'LL I'D", "<|endoftext|>x<|startoftext|>", "\x1c\x1f\x85\xa0  x",
       "ΑΣ ΣΑΣ İI ẞß", "á é ́", "😀🏳️‍🌈 한국어 漢字 \U000323e7a", "1½² 10٣", "\n\n\t a\r\n", "word " * 400]


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.ByteBpe()


@pytest.fixture(scope="module")
def tik(bpe):
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


@pytest.fixture(scope="module")
def word():
    return token_counts.WordBpe()


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(token_counts.VOCABULARY)


def counts(lib, texts):
    return [len(e.ids) for e in lib.encode_batch(texts, add_special_tokens=False)]


def test_every_vocabulary_entry_has_its_own_slot(bpe):
    h = bpe.whole
    assert len(h.keys) == len(bpe.ranks) == len(set(h.keys))
    assert all(h.get(k) == v for k, v in bpe.ranks.items())
    assert h.get(b"no such entry at all") is None and byte_bpe.MinimalPerfectHash({}).get(b"x") is None


def test_odd_texts(bpe, tik, word, lib):
    assert [bpe.encode(t) for t in ODD] == [tik.encode_ordinary(t) for t in ODD]
    assert word.count(ODD) == counts(lib, ODD)
    assert [bpe.decode(bpe.encode(t)) for t in ODD] == [t.encode() for t in ODD]


chars = st.text(st.one_of(st.characters(max_codepoint=0x2FF, exclude_categories=["Cs"]), st.characters(exclude_categories=["Cs"])),
                max_size=60)


@settings(max_examples=60, deadline=None)
@given(st.lists(chars, min_size=1, max_size=5))
def test_any_text(bpe, tik, word, lib, texts):
    assert [bpe.encode(t) for t in texts] == [tik.encode_ordinary(t) for t in texts]
    assert word.count(texts) == counts(lib, texts)


def test_heap_equals_library_without_the_first_tier(bpe, tik):
    rng = random.Random(5)
    for _ in range(300):
        piece = bytes(rng.choices(b"abcdehinorst ", k=rng.randint(1, 25)))
        assert list(byte_bpe.heap_merge(piece, bpe.ranks)) == tik._core_bpe.encode_single_piece(piece) or piece in bpe.ranks


def test_memo_restart_changes_nothing(bpe, tik, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MEMO_SIZE", 3)
    fresh = byte_bpe.ByteBpe()
    texts = ["one two three four five", "two three six", "one one seven"]
    assert [fresh.encode(t) for t in texts] == [tik.encode_ordinary(t) for t in texts]


def test_merges_out_of_order_are_refused(tmp_path):
    import json
    chars = token_counts.byte_symbols().values()
    vocab = {c: i for i, c in enumerate([*chars, *[c + "</w>" for c in chars]])}
    vocab |= {"ab": 512, "abc": 513}
    path = tmp_path / "v.json"
    path.write_text(json.dumps({"model": {"vocab": vocab, "merges": [["ab", "c"], ["a", "b"]], "end_of_word_suffix": "</w>"}}))
    with pytest.raises(ValueError):
        token_counts.MergeTable(str(path))


def test_operators_on_odd_tables(spark, tik, lib):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (2, None, "y"), (None, "", "z"), (3, "long " * 5000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tokens string")
    counted = token_counts.count_tokens(docs).collect()
    assert sorted(str(r.tokens) for r in counted) == sorted(str(t) for _, _, t in rows)        # a column of that name stays
    got = {(r.doc_id, r.text): (r.tokens_.n_bytes, r.tokens_.n_tokens) for r in counted}
    assert got == {(i, t): (len((t or "").encode()), counts(lib, [t or ""])[0]) for i, t, _ in rows}
    back = byte_bpe.decode(byte_bpe.encode(docs)).collect()
    assert len(back) == len(rows)
    for r in back:
        assert r.ids == tik.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.count_tokens(empty).count() == 0 and byte_bpe.round_trip_digests(empty).count() == 0


def test_queries(spark, sf_dir, tik, lib):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in QUERIES["op7_byte_bpe"](spark, sf_dir).collect():
        ids = tik.encode_ordinary(text[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(text[r.doc_id].encode()).hexdigest())
    for r in QUERIES["op3_token_counts"](spark, sf_dir).collect():
        n = counts(lib, [text[r.doc_id]])[0]
        assert (r.n_tokens, r.over_limit) == (n, n > 2048)


def test_ranks_are_read_as_published(bpe):
    with open(byte_bpe.VOCABULARY, "rb") as f:
        token, rank = f.readline().split()
    assert bpe.ranks[base64.b64decode(token)] == int(rank)

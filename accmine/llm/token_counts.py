"""Token counts by rank-synchronous array merging.

The distinct pre-tokens of a batch are held as one ragged array of symbol numbers. In each round every
sequence finds the lowest rank among its neighbouring pairs and merges all places of that pair at once;
sequences without a mergeable pair leave. What remains of a sequence is its number of tokens.

This equals merging one pair at a time because in the vocabulary a symbol comes from one merge only and
every merge that uses it ranks later (checked when the file is loaded), so a merge never opens a better one.

Defined cases: null text is empty: 0 bytes, 0 tokens; special strings inside a text count as one token
each, as the library does by default; texts are never cut; other columns are kept,
and if one is named like ``out_col`` the new one gets an underscore behind its name.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import is_latin1, later_characters, latin1_pattern
from .common import free_name, worker_cache

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
MEMO_SIZE = 500_000       # pre-tokens remembered per worker; the memo starts anew when full
BATCH_SYMBOLS = 4 << 20   # symbols merged at once; a longer single pre-token is merged alone


def byte_symbols() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte: printable bytes stand
    for themselves, the others for the characters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class MergeTable:
    """Pair -> (rank, merged symbol), as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, merges = model["vocab"], model["merges"]
        suffix = model.get("end_of_word_suffix") or ""
        chars = byte_symbols()
        self.inner = np.array([vocab[chars[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[chars[b] + suffix] for b in range(256)], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        a = np.array([vocab[x] for x, _ in pairs], np.int64)
        b = np.array([vocab[y] for _, y in pairs], np.int64)
        made = np.array([vocab[x + y] for x, y in pairs], np.int64)
        self.base = int(max(vocab.values())) + 1
        born = np.full(self.base, -1, np.int64)
        born[made] = np.arange(len(made))
        if len(np.unique(made)) != len(made) or (born[a] >= np.arange(len(a))).any() or (born[b] >= np.arange(len(b))).any():
            raise ValueError("merges out of order: simultaneous merging would not equal one at a time")
        key = a * self.base + b
        order = np.argsort(key)
        self.key, self.rank, self.made = key[order], order.astype(np.int64), made[order]
        # special strings are cut out of the raw text before anything else
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None

    NONE = np.iinfo(np.int64).max

    def count(self, pieces: list[bytes]) -> np.ndarray:
        """Tokens of each non-empty pre-token."""
        lens = np.fromiter(map(len, pieces), np.int64, len(pieces))
        out = np.empty(len(pieces), np.int64)
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        sym = self.inner[raw]
        ends = np.cumsum(lens)
        sym[ends - 1] = self.last[raw[ends - 1]]
        seq = np.repeat(np.arange(len(pieces)), lens)
        while len(sym):
            # rank of the pair that starts at each symbol (none across sequences)
            same = np.empty(len(sym), bool)
            same[-1] = False
            np.equal(seq[1:], seq[:-1], out=same[:-1])
            left = np.flatnonzero(same)
            key = sym[left] * self.base + sym[left + 1]
            at = np.searchsorted(self.key, key)
            at[at == len(self.key)] = 0
            known = self.key[at] == key
            rank = np.full(len(sym), self.NONE)
            rank[left[known]] = self.rank[at[known]]
            made = np.zeros(len(sym), np.int64)
            made[left[known]] = self.made[at[known]]
            first = np.flatnonzero(np.concatenate(([True], seq[1:] != seq[:-1])))
            size = np.diff(np.append(first, len(seq)))
            best = np.minimum.reduceat(rank, first)
            stop = best == self.NONE
            out[seq[first[stop]]] = size[stop]
            pick = (rank == np.repeat(best, size)) & (rank != self.NONE)
            # places of a pair like (a, a) may overlap: take every other one of an unbroken run
            p = np.flatnonzero(pick)
            if len(p):
                run = np.concatenate(([True], p[1:] != p[:-1] + 1))
                start = np.maximum.accumulate(np.where(run, np.arange(len(p)), 0))
                p = p[(np.arange(len(p)) - start) % 2 == 0]
            sym[p] = made[p]
            keep = ~np.repeat(stop, size)
            keep[p + 1] = False
            sym, seq = sym[keep], seq[keep]
        return out


class WordBpe:
    def __init__(self, path: str = VOCABULARY):
        self.path = path
        self.table = MergeTable(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.findall, self.findall_latin1 = regex.compile(pattern).findall, latin1_pattern(pattern).findall
        self.later = later_characters()
        self.byte_of = {c: b for b, c in byte_symbols().items()}
        self.memo: dict[str, int] = {}

    def pre_tokens(self, text: str) -> list[str]:
        """Normalized and split as the vocabulary file says: NFC, lower case letter by letter, pattern."""
        if text.isascii() or is_latin1(text):      # composed already, and lower case stays in Latin-1
            return self.findall_latin1(text.lower())
        if not self.later.search(text):
            # a final sigma is lowered like any other: by letter, not by its place in the word
            return self.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())
        # characters assigned after Unicode 3.2: the library's tables decide
        from tokenizers import Tokenizer

        lib = worker_cache(("word-bpe-lib", self.path), lambda: Tokenizer.from_file(self.path))
        pieces = lib.pre_tokenizer.pre_tokenize_str(lib.normalizer.normalize_str(text))
        return [bytes(map(self.byte_of.__getitem__, p)).decode() for p, _ in pieces]

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text; the pre-tokens not yet known are merged together."""
        parts = [[t] if self.table.special is None else self.table.special.split(t) for t in texts]
        split = [[self.pre_tokens(s) for s in p if s] for p in parts]
        memo = self.memo
        new = set().union(*(t for p in split for t in p)).difference(memo)
        if len(memo) + len(new) > MEMO_SIZE:
            memo.clear()
            new = set().union(*(t for p in split for t in p))
        batch, size = [], 0
        for t in new:
            raw = t.encode()
            if batch and size + len(raw) > BATCH_SYMBOLS:
                self._learn(batch)
                batch, size = [], 0
            batch.append((t, raw))
            size += len(raw)
        self._learn(batch)
        get = memo.__getitem__
        return [len(p) - 1 + sum(sum(map(get, t)) for t in s) for p, s in zip(parts, split)]

    def _learn(self, batch):
        if batch:
            self.memo.update(zip([t for t, _ in batch], self.table.count([r for _, r in batch]).tolist()))


def count_tokens(docs: DataFrame, text_col: str = "text", out_col: str = "tokens", path: str = VOCABULARY,
                 chunk_chars: int = 4 << 20) -> DataFrame:
    """``docs`` plus ``out_col`` with n_bytes (UTF-8) and n_tokens of the whole text."""
    out_col = free_name(docs, out_col)

    @F.arrow_udf("struct<n_bytes: bigint, n_tokens: bigint>")
    def counts(text: pa.Array) -> pa.Array:
        bpe = worker_cache(("word-bpe", path), lambda: WordBpe(path))
        texts = [t.as_py() or "" for t in text]
        out, a, size = [], 0, 0
        for b, t in enumerate(texts):
            size += len(t)
            if size >= chunk_chars:
                out += bpe.count(texts[a:b + 1])
                a, size = b + 1, 0
        out += bpe.count(texts[a:])
        return pa.StructArray.from_arrays([pa.array([len(t.encode()) for t in texts], pa.int64()),
                                           pa.array(out, pa.int64())], ["n_bytes", "n_tokens"])

    return docs.withColumn(out_col, counts.asNondeterministic()(F.col(text_col)))

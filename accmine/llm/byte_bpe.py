"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary resolves a whole pre-token that is itself a token.
Tier two, for misses: the pre-token's bytes form a linked list, and a heap of (rank, position) merges
the lowest rank first. Results of either tier are remembered per worker, in a memo of bounded size.

Pre-tokens come from the vocabulary's published split pattern. Characters assigned after Unicode 3.2
may have another class in the tiktoken library's Unicode tables than in this process's; in texts that
hold such characters, each is classified by asking the library and replaced, for splitting only, by a
stand-in of that class.

Defined cases: null text is empty text: no ids; an empty text has no ids; texts of any length are
encoded whole; ids that are not in the vocabulary raise on decoding; other columns are kept,
and if one is named like ``out_col`` the new one gets an underscore behind its name.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import unicodedata
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, worker_cache

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
MEMO_SIZE = 500_000        # pre-tokens remembered per worker; the memo starts anew when full
_MASK = (1 << 64) - 1


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class MinimalPerfectHash:
    """n keys to n slots without collisions: keys fall into buckets by one part of a 64-bit hash, and
    each bucket, largest first, gets the first displacement that sends all its keys to free slots.
    Each slot keeps its key, so a string that is no key is told apart by one comparison."""

    PER_BUCKET = 3

    def __init__(self, keys: dict[bytes, int]):
        n = self.n = len(keys)
        self.n_buckets = max(1, n // self.PER_BUCKET)
        hashes = np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64)
        bucket = (hashes % np.uint64(self.n_buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        size = np.bincount(bucket, minlength=self.n_buckets)
        start = np.concatenate(([0], np.cumsum(size)))
        taken = np.zeros(n, bool)
        disp = np.zeros(self.n_buckets, np.int64)
        slot = np.zeros(n, np.int64)
        tries = np.arange(64, dtype=np.uint64)[:, None]
        many = [b for b in np.argsort(-size, kind="stable").tolist() if size[b] > 1]
        for b in many:
            own = order[start[b]:start[b + 1]]
            h, d = hashes[own][None, :], np.uint64(0)
            while True:
                pos = self._slot(h, tries + d, n)
                ok = ~taken[pos].any(axis=1)
                p = np.sort(pos, axis=1)
                ok &= (p[:, 1:] != p[:, :-1]).all(axis=1)
                k = int(ok.argmax())
                if ok[k]:
                    disp[b] = int(d) + k
                    slot[own] = pos[k]
                    taken[pos[k]] = True
                    break
                d += np.uint64(64)
        # a bucket of one key names its slot outright: -1 - slot
        alone = order[start[:-1][size == 1]]
        slot[alone] = np.flatnonzero(~taken)
        disp[size == 1] = -1 - slot[alone]
        self.disp = disp.tolist()
        self.keys: list[bytes] = [b""] * n
        self.values: list[int] = [0] * n
        for (k, v), s in zip(keys.items(), slot.tolist()):
            self.keys[s], self.values[s] = k, v

    @staticmethod
    def _slot(h, d, n):
        with np.errstate(over="ignore"):
            x = (h ^ (d * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
        return ((x >> np.uint64(32)) % np.uint64(n)).astype(np.int64)

    def get(self, key: bytes) -> int | None:
        if not self.n:
            return None
        h = xxhash.xxh64_intdigest(key)
        d = self.disp[h % self.n_buckets]
        if d < 0:
            s = -1 - d
        else:
            s = ((((h ^ (d * 0x9E3779B97F4A7C15 & _MASK)) * 0xD6E8FEB86659FD93) & _MASK) >> 32) % self.n
        return self.values[s] if self.keys[s] == key else None


def heap_merge(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Merge a pre-token's bytes, lowest rank first and leftmost among equals, over a linked list."""
    n = len(piece)
    end = list(range(1, n + 1))          # symbol i covers piece[i:end[i]]; end[i] starts the next one
    prev = list(range(-1, n - 1))
    live = [True] * n
    get = ranks.get
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not live[i]:
            continue
        j = end[i]
        if j >= n or end[j] != stop:     # one of the two symbols has changed since
            continue
        live[j] = False
        end[i] = stop
        if stop < n:
            prev[stop] = i
            if (r := get(piece[i:end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        p = prev[i]
        if p >= 0 and (r := get(piece[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return tuple(out)


# a letter, a number, a space and another character, all of old standing, none of them in the pattern
_STAND_IN = {r"\p{L}": "ж", r"\p{N}": "٣", r"\s": " ", None: "€"}


def latin1_pattern(pattern: str) -> re.Pattern:
    """The same pattern for texts of characters up to U+00FF, with the letter, number and space classes
    spelled out, so the standard library's faster matcher can run it."""
    def chars(cls):
        return "".join(re.escape(chr(c)) for c in range(256) if regex.match(cls, chr(c)))

    sets = {r"\p{L}": chars(r"\p{L}"), r"\p{N}": chars(r"\p{N}"), r"\s": chars(r"\s")}
    out, inside, i = "", False, 0
    while i < len(pattern):
        step = next((k for k in (*sets, r"\S") if pattern.startswith(k, i)), pattern[i])
        if step in sets:
            out += sets[step] if inside else f"[{sets[step]}]"
        elif step == r"\S":
            out += f"[^{sets[chr(92) + 's']}]"
        else:
            inside = {"[": True, "]": False}.get(step, inside)
            out += step
        i += len(step)
    return re.compile(out)


def is_latin1(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def later_characters() -> re.Pattern:
    """Characters that Unicode 3.2 did not assign."""
    old = unicodedata.ucd_3_2_0.category
    new = [c for c in range(0x80, 0x110000) if old(chr(c)) == "Cn"]
    cuts = [0, *[k for k in range(1, len(new)) if new[k] != new[k - 1] + 1], len(new)]
    return re.compile("[" + "".join(f"\\U{new[a]:08x}-\\U{new[b - 1]:08x}" for a, b in zip(cuts, cuts[1:])) + "]")


class ByteBpe:
    def __init__(self, path: str = VOCABULARY, pattern: str = PATTERN):
        self.ranks = load_ranks(path)
        self.whole = MinimalPerfectHash(self.ranks)
        self.token = {r: b for b, r in self.ranks.items()}
        self.digits = {r: str(r) for r in self.token}
        self.findall, self.finditer = regex.compile(pattern).findall, regex.compile(pattern).finditer
        self.findall_latin1 = latin1_pattern(pattern).findall
        self.later = later_characters()
        self.memo: dict[str, tuple[int, ...]] = {}
        self.classes: dict[str, str] = {}

    def _class_of(self, ch: str) -> str:
        """The stand-in for a character, by the library's own character classes."""
        if ch not in self.classes:
            import tiktoken

            probes = worker_cache("byte-bpe-probes", lambda: {
                p: tiktoken.Encoding("probe", pat_str=p, mergeable_ranks={bytes([i]): i for i in range(256)},
                                     special_tokens={}) for p in _STAND_IN if p})
            hit = next((p for p, e in probes.items() if e.encode_ordinary(ch)), None)
            self.classes[ch] = _STAND_IN[hit]
        return self.classes[ch]

    def pre_tokens(self, text: str) -> list[str]:
        if text.isascii() or is_latin1(text):
            return self.findall_latin1(text)
        if not self.later.search(text):
            return self.findall(text)
        shown = self.later.sub(lambda m: self._class_of(m[0]), text)
        return [text[m.start():m.end()] for m in self.finditer(shown)]

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode()
        hit = self.whole.get(raw)
        return (hit,) if hit is not None else heap_merge(raw, self.ranks)

    def encode(self, text: str) -> list[int]:
        toks = self.pre_tokens(text)
        memo = self.memo
        new = set(toks).difference(memo)
        if new:
            if len(memo) + len(new) > MEMO_SIZE:
                memo.clear()
                new = set(toks)
            for t in new:
                memo[t] = self.encode_piece(t)
        return list(chain.from_iterable(map(memo.__getitem__, toks)))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


def _tokenizer(path: str, pattern: str) -> ByteBpe:
    return worker_cache(("byte-bpe", path, pattern), lambda: ByteBpe(path, pattern))


def encode(docs: DataFrame, text_col: str = "text", out_col: str = "ids", path: str = VOCABULARY,
           pattern: str = PATTERN) -> DataFrame:
    """``docs`` plus ``out_col``: the token ids of the whole text."""
    out_col = free_name(docs, out_col)

    @F.arrow_udf("array<int>")
    def ids(text: pa.Array) -> pa.Array:
        bpe = _tokenizer(path, pattern)
        return pa.array((bpe.encode(t.as_py() or "") for t in text), pa.list_(pa.int32()))

    return docs.withColumn(out_col, ids.asNondeterministic()(F.col(text_col)))


def decode(docs: DataFrame, ids_col: str = "ids", out_col: str = "decoded", path: str = VOCABULARY) -> DataFrame:
    """``docs`` plus ``out_col``: the bytes that a row's ids stand for (null ids: null)."""
    out_col = free_name(docs, out_col)

    @F.arrow_udf("binary")
    def back(ids: pa.Array) -> pa.Array:
        bpe = _tokenizer(path, PATTERN)
        return pa.array((None if (v := i.as_py()) is None else bpe.decode(v) for i in ids), pa.binary())

    return docs.withColumn(out_col, back.asNondeterministic()(F.col(ids_col)))


def round_trip_digests(docs: DataFrame, text_col: str = "text", out_col: str = "bpe", path: str = VOCABULARY,
                       pattern: str = PATTERN, keep_ids: bool = False) -> DataFrame:
    """``docs`` plus ``out_col`` with n_tokens, the SHA-256 of the decimal ids joined by
    commas and the SHA-256 of the bytes decoded from them, and with ``keep_ids`` the ids themselves. Encoding
    and decoding happen in one pass."""
    out_col = free_name(docs, out_col)
    kind = f"struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string{', ids: array<int>' if keep_ids else ''}>"

    @F.arrow_udf(kind)
    def digests(text: pa.Array) -> pa.Array:
        bpe = _tokenizer(path, pattern)
        n, ids_sha, text_sha, kept = [], [], [], [np.zeros(0, np.int32)]
        for t in text:
            ids = bpe.encode(t.as_py() or "")
            if keep_ids:
                kept.append(np.array(ids, np.int32))
            n.append(len(ids))
            ids_sha.append(hashlib.sha256(",".join(map(bpe.digits.__getitem__, ids)).encode()).hexdigest())
            text_sha.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
        parts = {"n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(ids_sha, pa.string()),
                 "decoded_sha256": pa.array(text_sha, pa.string())}
        if keep_ids:
            parts["ids"] = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *n]), pa.int32()), pa.array(np.concatenate(kept)))
        return pa.StructArray.from_arrays(list(parts.values()), list(parts))

    return docs.withColumn(out_col, digests.asNondeterministic()(F.col(text_col)))

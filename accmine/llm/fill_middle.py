"""Fill-in-middle transformation with content-defined chunk memoization.

A text is cut at token boundaries into prefix, middle and suffix, which are put into another order behind
markers. Tokens are words with the space before them, and space at the end. To find the cuts without looking
at every token of every text, the bytes are cut into chunks where a rolling hash over ``WINDOW`` bytes has its
low bits zero, so equal passages of different documents give equal chunks. Of each chunk only a summary is
needed: words that begin in or reach into it, whether it begins and ends inside a word, and its code points.
Summaries are kept in a cache keyed by a digest and verified against the chunk's content. Adding up the
summaries gives a text's tokens and the chunk that holds a cut; only that chunk is searched word by word.

A scan with one Arrow UDF; a worker's cache is bounded in bytes, its loss costs time only, and the result of
a text does not depend on what is in it.

Defined cases: null text is empty text, and stays plain, like a text that holds a marker; a null id hashes
like an empty one; rows with equal ids are cut at the same places; texts are never shortened; other columns
are kept (if one is named like ``out_col``, the new one gets an underscore behind its name).
"""

from __future__ import annotations

import hashlib
import re
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, free_name, text_pieces, worker_cache

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FIM_PERCENT = 50         # of the texts are transformed,
SPM_PERCENT = 80         # of these so many with the suffix first
SEED = 42

WINDOW = 32              # bytes of the rolling hash
CUT_BITS = 10            # a chunk has about 2^10 bytes
MAX_CHUNK = 1 << 16      # a chunk without a cut ends here
CACHE_BYTES = 24 << 20   # chunk contents kept per worker
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_SPACE = frozenset(b" \t\n\x0b\x0c\r")
_INNER = bytes(range(0x80, 0xC0))        # UTF-8 bytes that begin no code point

OUT = "struct<n: bigint, form: string, prefix_chars: bigint, middle_chars: bigint, output: string>"


def _gear() -> np.ndarray:
    """256 mixed numbers, one for each byte value."""
    return np.array([int.from_bytes(hashlib.sha256(bytes([b])).digest()[:4], "little") for b in range(256)], np.uint32)


def cut_points(data: np.ndarray, gear: np.ndarray) -> np.ndarray:
    """Positions after which a chunk ends: where the hash of the last ``WINDOW`` bytes ends in zeros. The sums
    over windows of 1, 2, 4, … bytes are built by doubling."""
    h, width = gear[data], 1
    while width < WINDOW:
        older = np.zeros_like(h)
        older[width:] = h[:-width] << np.uint32(width)
        h = h + older
        width *= 2
    return np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1


def chunks_of(texts: list[bytes], gear: np.ndarray) -> list[list[bytes]]:
    """The chunks of each text. Texts are hashed together; a window that reaches into the text before only
    moves cuts near a text's beginning, so the result does not depend on it: any cutting is right."""
    joined = b"".join(texts)
    cuts = cut_points(np.frombuffer(joined, np.uint8), gear) if joined else np.zeros(0, np.int64)
    out, at = [], 0
    for t in texts:
        end = at + len(t)
        inner = cuts[np.searchsorted(cuts, at, "right"):np.searchsorted(cuts, end)].tolist()
        edges = [at]
        for c in [*inner, end]:
            edges += range(edges[-1] + MAX_CHUNK, c, MAX_CHUNK)
            edges.append(c)
        out.append([joined[a:b] for a, b in zip(edges, edges[1:]) if b > a])
        at = end
    return out


def summarize(chunk: bytes) -> tuple[int, bool, bool, int]:
    """(runs of non-space, begins inside one, ends inside one, code points)."""
    return len(chunk.split()), chunk[0] not in _SPACE, chunk[-1] not in _SPACE, len(chunk.translate(None, _INNER))


class ChunkCache:
    """Summaries of chunks seen before. The key is a short hash; the content decides."""

    def __init__(self, limit: int = CACHE_BYTES):
        self.limit, self.size, self.entries = limit, 0, {}
        self.gear = _gear()
        self.hits = self.misses = 0

    def summary(self, chunk: bytes):
        key = hash(chunk)
        known = self.entries.get(key)
        if known is not None and known[0] == chunk:
            self.hits += 1
            return known[1]
        self.misses += 1
        made = summarize(chunk)
        if self.size > self.limit:
            self.entries.clear()
            self.size = 0
        self.entries[key] = (chunk, made)
        self.size += len(chunk)
        return made


class Cuts:
    """A text's tokens and token boundaries, from its chunks' summaries."""

    def __init__(self, chunks: list[bytes], cache: ChunkCache):
        self.chunks = chunks
        parts = [cache.summary(c) for c in chunks]
        nexts = [p[1] for p in parts[1:]] + [False]
        # a run that goes on in the next chunk ends there
        self.ends = list(accumulate(p[0] - (p[2] and goes_on) for p, goes_on in zip(parts, nexts)))
        self.bytes = [0, *accumulate(map(len, chunks))]
        self.chars = [0, *accumulate(p[3] for p in parts)]
        self.words = self.ends[-1] if parts else 0
        self.n = self.words + bool(parts and not parts[-1][2])

    def place(self, k: int) -> tuple[int, int]:
        """(byte, code point) at which the first ``k`` tokens end."""
        if k <= 0:
            return 0, 0
        if k > self.words:
            return self.bytes[-1], self.chars[-1]
        c = int(np.searchsorted(self.ends, k))
        left = k - (self.ends[c - 1] if c else 0)
        for m in _WORD.finditer(self.chunks[c]):
            left -= 1
            if not left:
                break
        head = self.chunks[c][:m.end()]
        return self.bytes[c] + len(head), self.chars[c] + len(head.translate(None, _INNER))


def hashes(doc_id, seed: int) -> list[int]:
    """Four numbers below 2^32 from seed and id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k:k + 8], 16) for k in (0, 8, 16, 24)]


def transform(text: bytes, chunks: list[bytes], doc_id, cache: ChunkCache, fim_percent: int, spm_percent: int, seed: int):
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    cuts = Cuts(chunks, cache)
    h1, h2, h3, h4 = hashes(doc_id, seed)
    marked = any(m.encode() in text for m in (PREFIX, SUFFIX, MIDDLE))
    if not text or marked or h3 % 100 >= fim_percent:
        return cuts.n, "plain", None, None, text
    a, b = sorted((h1 % (cuts.n + 1), h2 % (cuts.n + 1)))
    (a, a_chars), (b, b_chars) = cuts.place(a), cuts.place(b)
    head, body, tail = PREFIX.encode() + text[:a], MIDDLE.encode() + text[a:b], SUFFIX.encode() + text[b:]
    spm = h4 % 100 < spm_percent
    return cuts.n, "spm" if spm else "psm", a_chars, b_chars - a_chars, (tail + head if spm else head + tail) + body


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out_col: str = "fim",
                   fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT, seed: int = SEED) -> DataFrame:
    """``docs`` plus ``out_col``: tokens, form (plain, psm: prefix, suffix, middle; spm: suffix first), lengths of
    prefix and middle in code points (null if plain), and the transformed text."""
    out_col = free_name(docs, out_col)

    @F.arrow_udf(OUT)
    def fim(doc_id: pa.Array, text: pa.Array) -> pa.Array:
        cache = worker_cache(("fim-chunks",), ChunkCache)
        rows, ids = [], iter(doc_id.to_pylist())
        for piece in text_pieces(text, CHUNK_BYTES):
            for t, chunks in zip(piece, chunks_of(piece, cache.gear)):
                rows.append(transform(t, chunks, next(ids), cache, fim_percent, spm_percent, seed))
        n, form, prefix, middle, output = zip(*rows) if rows else ([],) * 5
        arrays = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                  pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())]
        return pa.StructArray.from_arrays(arrays, ["n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.withColumn(out_col, fim.asNondeterministic()(F.col(id_col).cast("string"), F.col(text_col)))


def restore(output: Column, form: Column) -> Column:
    """The exact text again, from output and form. The first marker of each kind is the one that was put in: the
    text holds none, and no part of it can complete one."""
    def between(first: str, second: str):      # first A second B <M> C
        rest = F.substring(output, F.lit(len(first) + 1), F.length(output))
        cut = F.instr(rest, second)
        b = F.substring(rest, cut + len(second), F.length(rest))
        at = F.instr(b, MIDDLE)
        return (F.substring(rest, F.lit(1), cut - 1), F.substring(b, F.lit(1), at - 1),
                F.substring(b, at + len(MIDDLE), F.length(b)))

    p, s, m = between(PREFIX, SUFFIX)
    s2, p2, m2 = between(SUFFIX, PREFIX)
    return F.when(form == "psm", F.concat(p, m, s)).when(form == "spm", F.concat(p2, m2, s2)).otherwise(output)

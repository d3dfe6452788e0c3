"""Benchmark decontamination by an FM-index over each training shard.

A shard is a piece of a task's documents. Its words become integers (benchmark vocabulary; every
other word is one code that no phrase holds), a suffix array gives the Burrows-Wheeler transform,
and a wavelet matrix over it answers rank queries. All benchmark windows are searched backwards at
once, occurrences are located by walking to sampled suffix positions, and hits of a document are
merged into removal spans.

Words outside the benchmark vocabulary can stand in no occurrence, so the index holds the shard's
runs of vocabulary words of at least the shortest window's length: no possible occurrence is left out.
Against a benchmark of at most ``BENCH_BLOCK_BYTES`` the documents are scanned once and never shuffled.

Defined cases: null or word-less text has no words and no hits; null or word-less items, and items
with a null id, take no part; a repeated document row gives a repeated result row; an item id that
occurs in several rows counts once; other columns are kept, and if one is named
like ``out_col`` the new one gets an underscore behind its name.
"""

from __future__ import annotations

import re
from functools import reduce
from itertools import repeat
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER_AZ, free_name, ragged_ranges, staged, text_pieces

WINDOW = 10
SAMPLE_RATE = 8                  # every 8th text position keeps its suffix position
BENCH_BLOCK_BYTES = 32 << 20     # benchmark text broadcast at once; a larger benchmark takes several passes

# bytes of word characters keep themselves (A-Z lowered), all others become a blank
_WORD_BYTES = bytes(b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32
                    for b in (LOWER_AZ[i] for i in range(256)))
_LOWER = {c: c + 32 for c in range(65, 91)}
_WORD_RE = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def bench_words(text: bytes) -> list[bytes]:
    """Words of a text as the contract defines them."""
    return text.translate(_WORD_BYTES).split()


def windows_of(items: list[tuple[str, bytes]], window: int = WINDOW) -> SimpleNamespace:
    """The benchmark's windows: ``pat[w, -len:]`` holds a window's word codes, ``owner`` (CSR by
    ``owner_start``) the items it comes from. Plain data, so it can be broadcast."""
    vocab: dict[bytes, int] = {}
    wins: dict[tuple, int] = {}
    owners: list[set] = []
    item_ids = sorted({i for i, _ in items})
    number = {i: n for n, i in enumerate(item_ids)}
    for item, text in items:
        w = [vocab.setdefault(x, len(vocab) + 2) for x in bench_words(text)]  # 0: end, 1: gap
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            j = wins.setdefault(tuple(w[k:k + n]), len(wins))
            if j == len(owners):
                owners.append(set())
            owners[j].add(number[item])
    lens = np.array([len(w) for w in wins], np.int64)
    pat = np.zeros((len(wins), window), np.int64)
    for j, w in enumerate(wins):
        pat[j, window - len(w):] = w
    return SimpleNamespace(
        vocab=vocab, item_ids=item_ids, lens=lens, pat=pat, min_len=int(lens.min()) if len(wins) else 0,
        owner_start=np.cumsum([0] + [len(o) for o in owners]).astype(np.int64),
        owner=np.array([i for o in owners for i in sorted(o)], np.int64))


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling; the last symbol must be the unique smallest."""
    n = len(s)
    rank = np.unique(s, return_inverse=True)[1].astype(np.int64)
    k = 1
    while True:
        second = np.zeros(n, np.int64)
        second[:n - k] = rank[k:] + 1
        key = rank * (n + 1) + second
        sa = np.argsort(key, kind="stable")
        ks = key[sa]
        new = np.empty(n, np.int64)
        new[sa] = np.concatenate(([0], np.cumsum(ks[1:] != ks[:-1])))
        rank = new
        if rank[sa[-1]] == n - 1:
            return sa
        k *= 2


class WaveletMatrix:
    """Rank and access over an integer sequence: one bit plane per level, high bit first."""

    def __init__(self, s: np.ndarray, max_value: int):
        self.levels = max(1, int(max_value).bit_length())
        self.rank1, self.zeros, self.bits = [], [], []
        cur = s
        for lv in range(self.levels - 1, -1, -1):
            bit = ((cur >> lv) & 1).astype(np.int64)
            self.bits.append(bit)
            self.rank1.append(np.concatenate(([0], np.cumsum(bit))))
            self.zeros.append(int(len(bit) - bit.sum()))
            cur = np.concatenate((cur[bit == 0], cur[bit == 1]))

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of symbol ``c`` before position ``i``, for arrays of both."""
        lo, hi = np.zeros_like(i), i.copy()
        for k in range(self.levels):
            one = (c >> (self.levels - 1 - k)) & 1
            r_lo, r_hi = self.rank1[k][lo], self.rank1[k][hi]
            lo = np.where(one, self.zeros[k] + r_lo, lo - r_lo)
            hi = np.where(one, self.zeros[k] + r_hi, hi - r_hi)
        return hi - lo

    def access(self, i: np.ndarray) -> np.ndarray:
        c, p = np.zeros_like(i), i.copy()
        for k in range(self.levels):
            one, r = self.bits[k][p], self.rank1[k][p]
            c = (c << 1) | one
            p = np.where(one, self.zeros[k] + r, p - r)
        return c


class FMIndex:
    def __init__(self, s: np.ndarray, n_symbols: int, rate: int = SAMPLE_RATE):
        sa = suffix_array(s)
        self.n = len(s)
        self.wm = WaveletMatrix(s[sa - 1], n_symbols - 1)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(s, minlength=n_symbols))))
        mark = sa % rate == 0
        self.mark_rank = np.concatenate(([0], np.cumsum(mark)))
        self.mark, self.samples = mark, sa[mark]

    def search(self, pat: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of all patterns (right-aligned rows) by backward search."""
        lo, hi = np.zeros(len(pat), np.int64), np.full(len(pat), self.n, np.int64)
        live = np.arange(len(pat))
        for step in range(pat.shape[1]):
            live = live[(lens[live] > step) & (hi[live] > lo[live])]
            if not len(live):
                break
            c = pat[live, pat.shape[1] - 1 - step]
            lo[live] = self.first[c] + self.wm.rank(c, lo[live])
            hi[live] = self.first[c] + self.wm.rank(c, hi[live])
        return lo, np.maximum(hi, lo)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: step back until a sampled position."""
        out = np.empty(len(rows), np.int64)
        todo, row, steps = np.arange(len(rows)), rows.copy(), 0
        while len(todo):
            hit = self.mark[row]
            out[todo[hit]] = self.samples[self.mark_rank[row[hit]]] + steps
            todo, row = todo[~hit], row[~hit]
            c = self.wm.access(row)
            row = self.first[c] + self.wm.rank(c, row)
            steps += 1
        return out


def scan_shard(docs: list[bytes], w: SimpleNamespace):
    """Per document: number of words; merged hit spans (first word, end word); item numbers."""
    n = len(docs)
    counts, parts = np.zeros(n, np.int64), []
    get = w.vocab.get
    for d, text in enumerate(docs):
        words = bench_words(text)
        counts[d] = len(words)
        parts.append(np.fromiter(map(get, words, repeat(1)), np.int64, len(words)))
        parts.append(np.ones(1, np.int64))          # no phrase crosses documents
    spans, items = [[] for _ in range(n)], [[] for _ in range(n)]
    if not docs or not len(w.lens):
        return counts, spans, items
    code = np.concatenate(parts)
    edge = np.flatnonzero(np.diff(np.concatenate(([0], (code > 1).astype(np.int8), [0]))))
    start, end = edge[0::2], edge[1::2]
    keep = end - start >= w.min_len
    start, length = start[keep], end[keep] - start[keep] + 1   # a run and the gap behind it
    if not len(start):
        return counts, spans, items
    at = ragged_ranges(start, length)
    s = np.concatenate((code[at], [0]))
    s[np.cumsum(length) - 1] = 1
    fm = FMIndex(s, len(w.vocab) + 2)
    lo, hi = fm.search(w.pat, w.lens)
    found = np.flatnonzero(hi > lo)
    if not len(found):
        return counts, spans, items
    occ = hi[found] - lo[found]
    win = np.repeat(found, occ)
    pos = at[fm.locate(ragged_ranges(lo[found], occ))]          # word number within the shard
    mark = np.zeros(len(code) + 1, np.int64)
    np.add.at(mark, pos, 1)
    np.add.at(mark, pos + w.lens[win], -1)
    edge = np.flatnonzero(np.diff(np.concatenate(([0], (np.cumsum(mark) > 0).astype(np.int8)))))
    doc_start = np.concatenate(([0], np.cumsum(counts + 1)))
    for a, b in zip(edge[0::2], edge[1::2]):
        d = int(np.searchsorted(doc_start, a, "right")) - 1
        spans[d].append((int(a - doc_start[d]), int(b - doc_start[d])))
    doc = np.searchsorted(doc_start, pos, "right") - 1
    n_own = w.owner_start[win + 1] - w.owner_start[win]
    pair = np.repeat(doc, n_own) * len(w.item_ids) + w.owner[ragged_ranges(w.owner_start[win], n_own)]
    for p in np.unique(pair):
        items[p // len(w.item_ids)].append(w.item_ids[p % len(w.item_ids)])
    return counts, spans, items


_HITS = ("struct<n_words: bigint, spans: array<struct<start: bigint, end: bigint>>, items: array<string>>")
_SPAN_PA = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _bench_parts(bench: DataFrame, id_col: str, text_col: str, block_bytes: int) -> list[DataFrame]:
    """The benchmark in parts of about ``block_bytes`` of text each, dealt by hash of item and text."""
    b = (bench.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
              .select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t")))
    size = b.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    n = max(1, -(-size // block_bytes))
    return [b if n == 1 else b.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k) for k in range(n)]


def _windows(part: DataFrame, window: int):
    """A part's windows, broadcast."""
    found = windows_of([(r.i, r.t.encode()) for r in part.toLocalIterator()], window)
    return part.sparkSession.sparkContext.broadcast(found)


def _merge(spans):
    out = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def find_contamination(docs: DataFrame, bench: DataFrame, text_col: str = "text", bench_id: str = "item_id",
                       bench_text: str = "text", window: int = WINDOW, out_col: str = "hits",
                       block_bytes: int = BENCH_BLOCK_BYTES) -> DataFrame:
    """``docs`` plus ``out_col``: number of words, merged removal spans (word numbers, end
    exclusive) and the sorted ids of the items of which a window occurs.

    A benchmark of one block is one scan. A larger one takes a pass for each block: the documents are numbered
    and staged once, a pass stages the rows that hit, and its block is released before the next is made, so
    driver and workers hold one block at a time."""
    out_col = free_name(docs, out_col)
    parts = _bench_parts(bench, bench_id, bench_text, block_bytes)
    if len(parts) == 1:
        return docs.withColumn(out_col, _hits(_windows(parts[0], window))(F.col(text_col)))
    row, h = free_name(docs, "_row"), free_name(docs, "_h")
    rows = staged(docs.withColumn(row, F.monotonically_increasing_id()), "leak-documents")
    found = []
    for k, part in enumerate(parts):
        block = _windows(part, window)
        hits = rows.select(row, _hits(block)(F.col(text_col)).alias(h))
        found.append(staged(hits if k == 0 else hits.where(F.size(F.col(h)["spans"]) > 0), "leak-hits"))   # the first has all counts
        block.destroy()
    every = reduce(DataFrame.unionByName, found).groupBy(row).agg(F.collect_list(h).alias(h))   # one a block at most
    return rows.join(every, row).withColumn(out_col, _merged(h)).select(*docs.columns, out_col)


def _struct(n, spans, items) -> pa.StructArray:
    spans = [[{"start": a, "end": b} for a, b in s] for s in spans]
    return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(spans, _SPAN_PA), pa.array(items, pa.list_(pa.string()))],
                                      ["n_words", "spans", "items"])


def _hits(block):
    """Hits of a text against one broadcast block."""
    @F.arrow_udf(_HITS)
    def hits(text: pa.Array) -> pa.Array:
        n, spans, items = [], [], []
        for piece in text_pieces(text):
            c, s, i = scan_shard(piece, block.value)
            n.extend(c.tolist())
            spans.extend(s)
            items.extend(i)
        return _struct(n, spans, items)

    return hits.asNondeterministic()


def _merged(col: str):
    """The hits of one text against several blocks as one."""
    @F.arrow_udf(_HITS)
    def merged(hits: pa.Array) -> pa.Array:
        n, spans, items = [], [], []
        for h in hits.to_pylist():
            n.append(max(x["n_words"] for x in h))
            spans.append(_merge([(s["start"], s["end"]) for x in h for s in x["spans"]]))
            items.append(sorted({i for x in h for i in x["items"]}))
        return _struct(n, spans, items)

    return merged(F.col(col))


def remove_contamination(docs: DataFrame, bench: DataFrame, text_col: str = "text", length_col: str | None = "n_chars",
                         bench_id: str = "item_id", bench_text: str = "text", window: int = WINDOW,
                         block_bytes: int = BENCH_BLOCK_BYTES) -> DataFrame:
    """``docs`` with every occurring benchmark window cut out of the text (from the first letter of a
    span's first word to the last of its last; a blank takes its place) and, if there is such a column,
    the text length set anew. Cutting may bring words together that form a window again, so a changed
    text is searched again until it has none (against a benchmark of several blocks, in further rounds of
    passes). Texts without a hit, nulls too, stay as they are."""
    parts = _bench_parts(bench, bench_id, bench_text, block_bytes)
    if len(parts) > 1:
        return _with_length(_remove_in_passes(docs, bench, text_col, bench_id, bench_text, window, block_bytes), docs, text_col, length_col)
    block = _windows(parts[0], window)

    @F.arrow_udf("string")
    def cleaned(text: pa.Array) -> pa.Array:
        out = text.to_pylist()
        base = 0
        for piece in text_pieces(text):
            todo = list(range(len(piece)))
            while todo:
                _, spans, _ = scan_shard([(out[base + i] or "").encode() for i in todo], block.value)
                todo, spans = [i for i, s in zip(todo, spans) if s], [s for s in spans if s]
                for i, s in zip(todo, spans):
                    out[base + i] = cut(out[base + i], s)
            base += len(piece)
        return pa.array(out, pa.string())

    return _with_length(docs.withColumn(text_col, cleaned.asNondeterministic()(F.col(text_col))), docs, text_col, length_col)


def _remove_in_passes(docs: DataFrame, bench: DataFrame, text_col: str, bench_id: str, bench_text: str, window: int,
                      block_bytes: int) -> DataFrame:
    """Cut, and search what was cut again, until nothing is found."""
    @F.arrow_udf("string")
    def without(text: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array([t if not s else cut(t, [(x["start"], x["end"]) for x in s]) for t, s in zip(text.to_pylist(), spans.to_pylist())],
                        pa.string())

    name, done, todo = free_name(docs, "_leaks"), [], docs
    while True:
        found = staged(find_contamination(todo, bench, text_col, bench_id, bench_text, window, name, block_bytes), "leak-round")
        hit = F.size(F.col(name)["spans"]) > 0
        done.append(found.where(~hit).drop(name))
        if found.where(hit).isEmpty():
            return reduce(DataFrame.unionByName, done)
        todo = staged(found.where(hit).withColumn(text_col, without.asNondeterministic()(F.col(text_col), F.col(name)["spans"])).drop(name),
                      "leak-cut")


def _with_length(out: DataFrame, docs: DataFrame, text_col: str, length_col: str | None) -> DataFrame:
    if length_col and length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        out = out.withColumn(length_col, F.char_length(text_col).cast(kind))
    return out


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the spans."""
    at = [m.span() for m in _WORD_RE.finditer(text.translate(_LOWER))]
    out, last = [], 0
    for a, b in spans:
        out += [text[last:at[a][0]], " "]
        last = at[b - 1][1]
    return "".join(out) + text[last:]

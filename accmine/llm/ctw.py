"""Context-tree weighting over binary-decomposed byte contexts, trained and applied as Spark jobs.

A byte is eight binary decisions, each with its own context tree: a node is (the last d bytes, the bits of
this byte so far), d = 0 .. depth. A node's Krichevsky-Trofimov estimate depends on its two counts only, so
a corpus is learned from counts, in any order. Weighting mixes each node's estimate half and half with the
product over its one-byte-longer contexts; the shares that this gives after training weigh the estimates of
all depths when a text is scored. A text's log10 probability is the sum over its bytes and its end (byte
0xFF, which UTF-8 lacks, and which also stands before the text); ``score / -log10(2) / bytes`` is the code
length per byte.

Jobs: (1) documents are staged in blocks of bounded size, and each block lists its distinct byte strings of
depth + 1 and its distinct words, with training counts, packed by bucket: a few hundred rows a block,
however long its texts. (2) The lists of a bucket are summed up a tree of groups, at most some 64 lists a
task. From the first sums on, a bucket is split into cells, as many as its entries need: strings by their
third context byte, so that a cell holds whole subtrees below three bytes of context, and words by hash.
(3) The nodes under two bytes of context are summed over the cells as rows; the levels above, at most
65,280 nodes, on the driver. (4) Each cell walks its trees down and gives every string its log10 probability.
(5) These go down the same tree: every group gets the entries it asked for and no others. (6) Each block
scores its documents. Nothing that grows with the corpus is broadcast or collected, and no task holds more
than its group's lists or its cell's strings.

Defined cases: null text is empty text (one token: its end); rows with a null id are scored and not learned
from; without training rows all bits have probability 1/2 and all words count zero; repeated rows are
learned and scored each for itself; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER_AZ, staged

DEPTH = 5                     # bytes of context; at most 6, so that a string fits a long
BUCKETS = 256                 # of contexts, and of words, in a block's lists
CELL_ENTRIES = 4 << 20        # entries of a cell, as summed so far
BLOCK_BYTES = 32 << 20        # text of a block
CHUNK_BYTES = 4 << 20         # text turned to arrays at once
GROUP_LISTS = 64              # lists of a bucket, or of a cell, that meet in one task
EDGE = 0xFF
GRAM, WORD = 0, 1
PACKED = "kind int, bucket int, block bigint, data binary"
SUMMED = "known bigint, total bigint, entries bigint, data binary"


# ---------------------------------------------------------------- packed lists ---
# A list is a bucket's keys in order (strings as integers, or words) with a value each. Keys go as
# differences or joined text, numbers as byte planes, both compressed: an entry takes a few bytes.

def _codec() -> pa.Codec:
    return pa.Codec("zstd", compression_level=1)


def _planes(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def pack(keys, values: np.ndarray) -> bytes:
    """``keys``: ascending int64 array, or list of words; ``values``: int64 or float32."""
    words = isinstance(keys, list)
    raw = [b"\n".join(keys) if words else _planes(np.diff(keys, prepend=np.int64(0))), _planes(values)]
    out = [bytes(_codec().compress(r)) if r else b"" for r in raw]
    head = np.array([words, values.dtype == np.float32, len(values), len(raw[0]), len(out[0])], np.int64)
    return b"".join([head.tobytes(), *out])


def unpack(data: bytes):
    words, floats, n, size, cut = np.frombuffer(data, np.int64, 5).tolist()
    kind = np.dtype(np.float32 if floats else np.int64)

    def plain(part, size):
        return bytes(_codec().decompress(part, size)) if size else b""

    def numbers(raw, kind):
        return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(kind.itemsize, n).T).view(kind).ravel()

    raw = plain(data[40:40 + cut], size)
    keys = (raw.split(b"\n") if n else []) if words else np.cumsum(numbers(raw, np.dtype(np.int64)))
    return keys, numbers(plain(data[40 + cut:], n * kind.itemsize), kind)


def sum_strings(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with their summed numbers."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys, kind="stable")              # made of sorted runs: a merge
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(n, first)


def rows_out(rows: list[tuple]) -> pa.RecordBatch:
    kind, bucket, block, data = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(bucket, pa.int32()),
                                       pa.array(block, pa.int64()), pa.array(data, pa.binary())],
                                      ["kind", "bucket", "block", "data"])


# ----------------------------------------------------------- strings and words ---

def grams(docs: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The (context, byte) string of every coded position as an integer, document after document; the
    number of positions of each document (its bytes and its end)."""
    gap = bytes([EDGE]) * depth
    a = np.frombuffer(gap + gap.join(docs) + gap, np.uint8)
    size = np.fromiter(map(len, docs), np.int64, len(docs))
    n = len(a) - depth                                   # windows of depth + 1 bytes
    key = np.zeros(n, np.int64)
    for d in range(depth + 1):
        key <<= 8
        key |= a[d:d + n]
    coded = np.zeros(n + 1, np.int8)                     # windows that end inside a gap are not coded
    start = np.concatenate(([0], np.cumsum(size + depth)[:-1]))
    np.add.at(coded, start, 1)
    np.add.at(coded, start + size + 1, -1)
    return key[np.cumsum(coded[:n], dtype=np.int8) > 0], size + 1


class HashTable:
    """Place of each of some distinct strings, by open addressing in arrays."""

    FREE = np.int64(-1)

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.key = np.full(1 << self.bits, self.FREE)
        self.place = np.zeros(1 << self.bits, np.int32)
        todo, h = np.arange(len(keys), dtype=np.int32), self._slot(keys)
        while len(todo):
            free = self.key[h] == self.FREE
            put, at = todo[free], h[free]
            self.key[at] = keys[put]                     # of several for one slot the last stays
            won = self.key[at] == keys[put]
            self.place[at[won]] = put[won]
            todo = np.concatenate((todo[~free], put[~won]))
            h = np.concatenate((h[~free], at[~won])) + 1 & (1 << self.bits) - 1

    def _slot(self, keys):
        mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places of keys that are all there."""
        h = self._slot(keys)
        out = self.place[h]
        miss = np.flatnonzero(self.key[h] != keys)
        h = h[miss]
        while len(miss):
            h = h + 1 & (1 << self.bits) - 1
            out[miss] = self.place[h]
            bad = self.key[h] != keys[miss]
            miss, h = miss[bad], h[bad]
        return out


def context_bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of a string by its last two context bytes."""
    return (((keys >> 8) & 0xFFFF) * 40503 >> 4) % buckets


def node_bucket(node: Column, buckets: int) -> Column:
    """The same of a node under two context bytes, as a column."""
    return (F.shiftright(F.shiftright(node, 8) * 40503, 4) % buckets).cast("int")


def cells_of(kind: int, keys, cells: int) -> np.ndarray:
    """Cell of each entry inside its bucket: strings by their third context byte, words by hash."""
    if kind == GRAM:
        return ((keys >> 24) & 0xFF) % cells
    return np.fromiter(((xxhash.xxh3_64_intdigest(w) >> 32) % cells for w in keys), np.int64, len(keys))


def _pieces(texts: list[bytes], flags):
    out, own, size = [], [], 0
    for t, f in zip(texts, flags):
        if out and size + len(t) > CHUNK_BYTES:
            yield out, own
            out, own, size = [], [], 0
        out.append(t)
        own.append(f)
        size += len(t)
    if out:
        yield out, own


def block_lists(texts: list[bytes], train: list[bool], depth: int):
    """(strings, their training counts, words with training counts) of one batch of documents."""
    keys, n, words = [], [], Counter()
    for docs, learn in _pieces(texts, train):
        k, size = grams(docs, depth)
        k <<= 1
        k |= np.repeat(np.array(learn, np.int64), size)
        k, c = np.unique(k, return_counts=True)
        keys.append(k >> 1)
        n.append(c * (k & 1))
        for d, yes in zip(docs, learn):
            if yes:
                words.update(d.split())
            else:
                words.update(dict.fromkeys(d.split(), 0))
    return *sum_strings(np.concatenate(keys), np.concatenate(n)), words


def _list_rows(block: int, keys: np.ndarray, n: np.ndarray, words: Counter, buckets: int):
    b = context_bucket(keys, buckets)
    order = np.argsort(b.astype(np.uint16 if buckets <= 1 << 16 else np.int64), kind="stable")
    edges = np.searchsorted(b[order], np.arange(buckets + 1))
    for k in np.flatnonzero(np.diff(edges)).tolist():
        at = order[edges[k]:edges[k + 1]]
        yield GRAM, k, block, pack(keys[at], n[at])
    own = [[] for _ in range(buckets)]
    for w in words:
        own[xxhash.xxh3_64_intdigest(w) % buckets].append(w)
    for k, ws in enumerate(own):
        if ws:
            ws.sort()
            yield WORD, k, block, pack(ws, np.fromiter(map(words.__getitem__, ws), np.int64, len(ws)))


def _lists(depth: int, buckets: int):
    """Staged documents (block, train, text), blocks together -> packed lists of each block."""
    def run(batches):
        block, keys, n, words = None, np.zeros(0, np.int64), np.zeros(0, np.int64), Counter()
        for b in batches:
            if not b.num_rows:
                continue
            ids = b.column("block").to_numpy()
            texts = [(t or "").encode().translate(LOWER_AZ) for t in b.column("text").to_pylist()]
            train = b.column("train").to_pylist()
            cut = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
            for s, e in zip(cut, cut[1:]):
                if block is not None and ids[s] != block:
                    yield rows_out(list(_list_rows(block, keys, n, words, buckets)))
                    keys, n, words = keys[:0], n[:0], Counter()
                block = int(ids[s])
                k, c, w = block_lists(texts[s:e], train[s:e], depth)
                keys, n = sum_strings(np.concatenate((keys, k)), np.concatenate((n, c)))
                words.update(w)
        if block is not None:
            yield rows_out(list(_list_rows(block, keys, n, words, buckets)))

    return run


def _take(keys, at: np.ndarray):
    return [keys[i] for i in at.tolist()] if isinstance(keys, list) else keys[at]


def _summed(key, table):
    """The lists of one group of a bucket or cell, as one list under the group's key."""
    lists = [unpack(d) for d in table["data"].to_pylist()]
    if key[0].as_py() == GRAM:
        keys, n = sum_strings(np.concatenate([k for k, _ in lists]), np.concatenate([v for _, v in lists]))
    else:
        total = Counter()
        for words, v in lists:
            total.update(dict(zip(words, v.tolist())))
        keys = sorted(total)
        n = np.fromiter(map(total.__getitem__, keys), np.int64, len(keys))
    ids = {c: pa.array([k.as_py()], pa.int32()) for c, k in zip(("kind", "bucket", *(["cell"] * (len(key) > 3)), "node"), key)}
    return pa.table(ids | {"known": pa.array([int((n > 0).sum())], pa.int64()), "total": pa.array([int(n.sum())], pa.int64()),
                           "entries": pa.array([len(n)], pa.int64()), "data": pa.array([pack(keys, n)], pa.binary())})


def _cells(cells: dict[int, int]):
    """Lists of a bucket -> the lists of its cells."""
    def run(batches):
        for b in batches:
            kinds, data = b.column("kind").to_pylist(), b.column("data").to_pylist()
            for k, (kind, d) in enumerate(zip(kinds, data)):
                keys, n = unpack(d)
                own = cells_of(kind, keys, cells[kind])
                for c in np.unique(own).tolist():
                    at = np.flatnonzero(own == c)
                    v = n[at]
                    yield pa.RecordBatch.from_arrays(
                        [b.column("kind").slice(k, 1), b.column("bucket").slice(k, 1), pa.array([c], pa.int32()),
                         b.column("node").slice(k, 1), pa.array([int((v > 0).sum())], pa.int64()), pa.array([int(v.sum())], pa.int64()),
                         pa.array([len(v)], pa.int64()), pa.array([pack(_take(keys, at), v)], pa.binary())],
                        ["kind", "bucket", "cell", "node", "known", "total", "entries", "data"])

    return run


# ------------------------------------------------------------------- the trees ---

_SMALL = 256
_LG_HALF = np.array([math.lgamma(n + 0.5) for n in range(_SMALL)])
_LG_ONE = np.array([math.lgamma(n + 1.0) for n in range(_SMALL)])


def _lgamma(n: np.ndarray, shift: float, table: np.ndarray) -> np.ndarray:
    x = np.maximum(n, _SMALL) + shift
    big = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x ** 3)
    return np.where(n < _SMALL, table[np.minimum(n, _SMALL - 1)], big)


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of any sequence with these counts."""
    return _lgamma(n0, 0.5, _LG_HALF) + _lgamma(n1, 0.5, _LG_HALF) - _lgamma(n0 + n1, 1.0, _LG_ONE) - math.log(math.pi)


def decisions(byte: np.ndarray):
    """For each of the eight bits: (bits so far with a leading one, the bit)."""
    for j in range(8):
        yield (1 << j) | (byte >> (8 - j)), (byte >> (7 - j)) & 1


def grow(keys: np.ndarray, n: np.ndarray, depth: int, top: int) -> dict[int, dict]:
    """Nodes of depths ``depth`` .. ``top`` of the strings with n > 0: key (context bytes << 8 | bits so
    far), counts, log KT, log weighted probability, and the place of each node's shorter context."""
    keys, n = keys[n > 0], n[n > 0]
    ctx, byte = keys >> 8 << 8, keys & 0xFF
    both = list(decisions(byte))
    node = np.concatenate([ctx | p for p, _ in both]) if len(keys) else np.zeros(0, np.int64)
    bit = np.concatenate([b for _, b in both]) if len(keys) else np.zeros(0, np.int64)
    key, place = np.unique(node, return_inverse=True)
    w = np.tile(n, 8) if len(keys) else np.zeros(0, np.int64)
    n1 = np.bincount(place, w * bit, len(key)).astype(np.int64)
    n0 = np.bincount(place, w * (1 - bit), len(key)).astype(np.int64)
    levels = {}
    kt = log_kt(n0, n1)
    pw = kt
    for d in range(depth, top - 1, -1):
        levels[d] = {"key": key, "n0": n0, "n1": n1, "kt": kt, "pw": pw}
        if d > top:
            up = key & ((1 << (8 * d)) - 1)              # drop the farthest byte
            key, place = np.unique(up, return_inverse=True)
            levels[d]["up"] = place
            n0 = np.bincount(place, n0, len(key)).astype(np.int64)
            n1 = np.bincount(place, n1, len(key)).astype(np.int64)
            longer = np.bincount(place, pw, len(key))
            kt = log_kt(n0, n1)
            pw = math.log(0.5) + np.logaddexp(kt, longer)
    return levels


def mix(level: dict, known: np.ndarray, rest: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """Probability of a one already settled by this depth, and the share left to deeper contexts, from
    the same of the shorter contexts."""
    share = np.ones(len(level["kt"])) if last else np.exp(math.log(0.5) + level["kt"] - level["pw"])
    one = (level["n1"] + 0.5) / (level["n0"] + level["n1"] + 1.0)
    return known + rest * share * one, rest * (1 - share)


NODES = "node bigint, n0 bigint, n1 bigint, longer double"


def _node_rows(key, n0, n1, longer) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(n0.astype(np.int64)), pa.array(n1.astype(np.int64)),
                                       pa.array(longer.astype(np.float64))], ["node", "n0", "n1", "longer"])


def _two_sums(depth: int):
    """Cell -> counts and summed log probabilities of the nodes under two context bytes (0: no longer ones)."""
    def run(batches):
        for b in batches:
            for data in b.column("data").to_pylist():
                top = min(depth, 3)
                low = grow(*unpack(data), depth, top)[top]
                if depth == 2:
                    yield _node_rows(low["key"], low["n0"], low["n1"], np.zeros(len(low["key"])))
                    continue
                key, place = np.unique(low["key"] & 0xFFFFFF, return_inverse=True)   # last two bytes, bits so far
                yield _node_rows(key, *(np.bincount(place, low[c], len(key)) for c in ("n0", "n1", "pw")))

    return run


def _two_level(nodes: pa.RecordBatch, depth: int) -> tuple[np.ndarray, dict]:
    """Nodes under two context bytes: their keys, and what ``mix`` takes."""
    key, n0, n1, longer = (nodes.column(c).to_numpy(zero_copy_only=False) for c in ("node", "n0", "n1", "longer"))
    kt = log_kt(n0, n1)
    return key, {"n0": n0, "n1": n1, "kt": kt, "pw": kt if depth == 2 else math.log(0.5) + np.logaddexp(kt, longer)}


def _one_sums(depth: int):
    """Nodes under two context bytes -> partial sums of those under one."""
    def run(batches):
        for b in batches:
            key, two = _two_level(b, depth)
            one, place = np.unique(key & 0xFFFF, return_inverse=True)
            yield _node_rows(one, *(np.bincount(place, two[c], len(one)) for c in ("n0", "n1", "pw")))

    return run


def _two_shares(depth: int, upper):
    """Nodes under two context bytes -> what these settle and leave to longer contexts."""
    def run(batches):
        known, rest, _ = upper.value
        for b in batches:
            key, two = _two_level(b, depth)
            k, r = mix(two, known[key & 0xFFFF], rest[key & 0xFFFF], depth == 2)
            yield pa.RecordBatch.from_arrays([b.column("bucket"), b.column("node"), pa.array(k), pa.array(r)],
                                             ["bucket", "node", "settled", "left"])

    return run


def upper_levels(sums: list[tuple[int, int, int, float]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From the nodes under one context byte (key, n0, n1, log probability of the longer contexts): for
    every (byte, bits so far), known and rest after depth 1, and the probability of a one if the scoring
    stops there. Nodes without counts take the values of depth 0, or 1/2."""
    known, rest, p = np.zeros(65536), np.ones(65536), np.full(65536, 0.5)
    if not sums:
        return known, rest, p
    node, n0, n1, longer = (np.array(c) for c in zip(*sums))
    kt = log_kt(n0, n1)
    one = {"n0": n0, "n1": n1, "kt": kt, "pw": math.log(0.5) + np.logaddexp(kt, longer)}
    bits = node & 0xFF
    z0, z1 = (np.bincount(bits, x, 256).astype(np.int64) for x in (n0, n1))
    kt0 = log_kt(z0, z1)
    zero = {"n0": z0, "n1": z1, "kt": kt0,
            "pw": math.log(0.5) + np.logaddexp(kt0, np.bincount(bits, one["pw"], 256))}
    k0, r0 = mix(zero, np.zeros(256), np.ones(256), False)
    k0, r0 = np.where(z0 + z1 > 0, k0, 0.0), np.where(z0 + z1 > 0, r0, 1.0)
    p[:] = np.tile(k0 + r0 / 2, 256)
    known[node], rest[node] = mix(one, k0[bits], r0[bits], False)
    p[node] = known[node] + rest[node] / 2
    return known, rest, p


def log_probabilities(keys: np.ndarray, n: np.ndarray, depth: int, one: np.ndarray, two: tuple) -> np.ndarray:
    """log10 probability of each string's byte after its context. Each bit is predicted by the deepest
    node of its context that training reached. ``one``: probabilities if this is under one context byte at
    most; ``two``: nodes under two context bytes in order, and their settled and left shares."""
    node2, settled, left = two
    levels = {2: {"key": node2, "p": settled + left / 2}}
    if depth > 2:
        levels |= grow(keys, n, depth, 3)
    for d in range(3, depth + 1):
        if d == 3:
            up = np.searchsorted(node2, levels[3]["key"] & 0xFFFFFF)
            k, r = settled, left
        else:
            up = levels[d]["up"]
        k, r = mix(levels[d], k[up], r[up], d == depth)
        levels[d]["p"] = k + r / 2
    out = np.zeros(len(keys))
    for so_far, bit in decisions(keys & 0xFF):
        node = keys >> 8 << 8 | so_far
        p = one[node & 0xFFFF]
        for d in range(2, depth + 1):
            have = levels[d]["key"]
            if not len(have):
                continue
            own = (node & ((1 << (8 * (d + 1))) - 1))
            at = np.minimum(np.searchsorted(have, own), len(have) - 1)
            p = np.where(have[at] == own, levels[d]["p"][at], p)
        out += np.log10(np.where(bit == 1, p, 1 - p))
    return out


def _values(depth: int, upper):
    """A cell's summed list and its nodes under two context bytes -> value of each entry: strings their
    log10 probability, words their count."""
    def run(key, cell, two):
        out = cell["data"]
        if cell.num_rows and key[0].as_py() == GRAM:
            node, settled, left = (two[c].to_numpy() for c in ("node", "settled", "left"))
            order = np.argsort(node)
            keys, n = unpack(cell["data"][0].as_py())
            lp = log_probabilities(keys, n, depth, upper.value[2], (node[order], settled[order], left[order]))
            out = pa.array([pack(keys, lp.astype(np.float32))], pa.binary())
        ids = (pa.array([k.as_py()] * cell.num_rows, pa.int32()) for k in key)
        return pa.table(dict(zip(("kind", "bucket", "cell"), ids)) | {"node": cell["node"].cast(pa.int32()), "data": out.cast(pa.binary())})

    return run


def _answers(own: tuple[str, ...], node_type: pa.DataType):
    """The lists of a group's members with the values looked up in the group's list (all its cells)."""
    def run(key, asked, values):
        out = []
        if asked.num_rows:
            have, value = zip(*map(unpack, values["data"].to_pylist()))
            if key[0].as_py() == WORD:
                value_of = {w: c for ws, v in zip(have, value) for w, c in zip(ws, v.tolist())}
            else:
                have, value = np.concatenate(have), np.concatenate(value)
                if values.num_rows > 1:
                    order = np.argsort(have, kind="stable")
                    have, value = have[order], value[order]
            for d in asked["data"].to_pylist():
                keys, _ = unpack(d)
                if key[0].as_py() == GRAM:
                    v = value[np.searchsorted(have, keys)]
                else:
                    v = np.fromiter(map(value_of.__getitem__, keys), np.int64, len(keys))
                out.append(pack(keys, v))
        ids = {c: asked[c].cast(node_type if c == own[-1] else pa.int32()) for c in own}
        return pa.table(ids | {"data": pa.array(out, pa.binary())})

    return run


def _score(depth: int, n_total: int, n_distinct: int, ends: int):
    z = n_total + n_distinct + 1

    def value(c):
        return math.log10((c + 1) / z)

    unseen = value(0)                                    # of no seen word

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        keys, lp, logs = [np.zeros(0, np.int64)], [np.zeros(0, np.float32)], {}
        for kind, d in zip(answers["kind"].to_pylist(), answers["data"].to_pylist()):
            k, v = unpack(d)
            if kind == GRAM:
                keys.append(k)
                lp.append(v)
            else:
                counts, which = np.unique(v, return_inverse=True)
                of_count = list(map(value, counts.tolist()))
                logs.update(zip(k, map(of_count.__getitem__, which.tolist())))
        keys, first = np.unique(np.concatenate(keys), return_index=True)
        lp = np.concatenate(lp)[first].astype(np.float64)
        place = HashTable(keys).find
        n_tokens, n_known, base, score = [], [], [], [np.zeros(0)]
        texts = ((t.as_py() or "").encode().translate(LOWER_AZ) for t in docs["text"])
        for piece, _ in _pieces(texts, repeat(None)):
            strings, size = grams(piece, depth)
            score.append(np.add.reduceat(lp[place(strings)], np.concatenate(([0], np.cumsum(size)[:-1]))))
            for d in piece:
                values = list(map(logs.__getitem__, d.split()))
                n_tokens.append(len(values) + 1)
                n_known.append(len(values) - values.count(unseen) + (ends > 0))
                base.append(math.fsum(values) + value(ends))
        return pa.table({"id": docs["id"], "train": docs["train"], "n_tokens": pa.array(n_tokens, pa.int64()),
                         "n_known": pa.array(n_known, pa.int64()), "base_score": pa.array(base, pa.float64()),
                         "score": pa.array(np.concatenate(score), pa.float64())})

    return run


def score_documents(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH,
                    buckets: int = BUCKETS, block_bytes: int = BLOCK_BYTES, group_lists: int = GROUP_LISTS,
                    cell_entries: int = CELL_ENTRIES) -> DataFrame:
    """``id_col``, train, n_tokens, n_known, train_tokens, base_score and score of every document, learned
    from the documents where ``train`` holds. The last four parameters place the work; results do not depend on them."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    plain = docs.select(F.col(id_col).alias("id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text_col).alias("text"))
    largest = (plain.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(F.octet_length("text")).alias("b"))
                    .agg(F.coalesce(F.max("b"), F.lit(0))).first()[0])
    cuts = max(1, -(-largest // block_bytes))
    block = F.spark_partition_id().cast("bigint") * cuts + F.pmod(F.xxhash64("id", "text"), F.lit(cuts))
    texts = staged(plain.withColumn("block", block).sortWithinPartitions("block"), "ctw-texts", compression="zstd")
    lists = staged(texts.select("block", "train", "text").mapInArrow(_lists(depth, buckets), PACKED), "ctw-lists")
    size = lists.agg(F.count_distinct("block")).first()[0]
    nodes = max(1, -(-size // group_lists))
    asked = lists.withColumn("parent", F.pmod(F.xxhash64("block"), F.lit(nodes)).cast("int"))
    once = staged(asked.groupBy("kind", "bucket", "parent").applyInArrow(_summed, f"kind int, bucket int, node int, {SUMMED}"), "ctw-sums")
    cells = {GRAM: 1, WORD: 1}
    for r in once.groupBy("kind", "bucket").agg(F.sum("entries").alias("n")).groupBy("kind").agg(F.max("n").alias("n")).collect():
        cells[r.kind] = max(1, -(-r.n // cell_entries))
    cells[GRAM] = min(cells[GRAM], 256) if depth > 2 else 1
    celled = "kind int, bucket int, cell int, node int, "
    tree = [staged(once.mapInArrow(_cells(cells), celled + SUMMED), "ctw-cells")]     # sums of ever larger groups
    up = []
    while nodes > 1:
        nodes = -(-nodes // group_lists)
        up.append(nodes)
        members = tree[-1].withColumn("parent", F.pmod("node", F.lit(nodes)))
        tree.append(staged(members.groupBy("kind", "bucket", "cell", "parent").applyInArrow(_summed, celled + SUMMED), "ctw-sums"))
    root = tree[-1]
    ends = texts.agg(F.count_if("train")).first()[0]
    known = root.where(F.col("kind") == WORD).agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("known"), F.lit(0))).first()
    n_total, n_distinct = known[0] + ends, known[1] + (ends > 0)
    sums = [F.sum(c).alias(c) for c in ("n0", "n1", "longer")]
    two = staged(root.where(F.col("kind") == GRAM).select("data").mapInArrow(_two_sums(depth), NODES).groupBy("node").agg(*sums)
                     .withColumn("bucket", node_bucket(F.col("node"), buckets)), "ctw-two")
    one = two.select("node", "n0", "n1", "longer").mapInArrow(_one_sums(depth), NODES).groupBy("node").agg(*sums)
    upper = spark.sparkContext.broadcast(upper_levels([tuple(r) for r in one.toLocalIterator()]))
    shares = (two.mapInArrow(_two_shares(depth, upper), "bucket int, node bigint, settled double, left double")
                 .withColumn("kind", F.lit(GRAM)).withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells[GRAM] - 1)))))
    keys = ["kind", "bucket", "cell"]
    values = root.select(*keys, "node", "data").groupBy(*keys).cogroup(shares.groupBy(*keys)).applyInArrow(_values(depth, upper), celled + "data binary")
    for below, nodes in zip(reversed(tree[:-1]), reversed(up)):
        members = below.select(*keys, "node", "data", F.pmod("node", F.lit(nodes)).alias("parent"))
        values = (members.groupBy(*keys, "parent").cogroup(values.groupBy(*keys, "node"))
                         .applyInArrow(_answers((*keys, "node"), pa.int32()), celled + "data binary"))
    by = ["kind", "bucket"]
    answers = (asked.groupBy(*by, "parent").cogroup(values.groupBy(*by, "node"))
                    .applyInArrow(_answers((*by, "block"), pa.int64()), PACKED))
    out = f"id {kind}, train boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    run = _score(depth, n_total, n_distinct, ends)
    scored = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, out)
    return scored.select(F.col("id").alias(id_col), "train", "n_tokens", "n_known", F.lit(n_total).cast("bigint").alias("train_tokens"),
                         "base_score", "score")

"""SimHash near-duplicates: fingerprints of whole texts, linked by bit-sliced comparison.

Fingerprints within ``radius`` bits agree in at least two of ``radius + 2`` bit blocks, so equal pairs of
blocks bring every link's two ends into a common bucket. Distinct fingerprints only are bucketed (copies
share one). A bucket of any size is cut into tiles, and each pair of tiles is one bounded group, so no
task holds a whole bucket. Inside a group the fingerprints stand as 64 vertical bit planes of machine
words, 64 candidates a word; a query's differing bits are added to carry-save counters of all
candidates at once, and words in which every candidate is past the radius are abandoned. A group returns
the links that span its components, not all pairs. Connected components then run over distinct fingerprints.

Defined cases: null or word-less texts have fingerprint zero and link like any other; a text of fewer
words than a shingle is one shingle; rows with a null id have a fingerprint and a component, but never
name it (a component of such rows only has a null id); repeated rows give repeated rows; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER_AZ, ragged_ranges, staged, text_pieces
from .components import connected_components

SHINGLE_WORDS = 4
RADIUS = 4
HASH_SEED = 42
TILE = 1024              # expected fingerprints in a tile; a group is one or two tiles
SEGMENT = 1 << 16        # shingles whose bits are spread out at once
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


# ------------------------------------------------------------------ fingerprints ---

def fingerprints(docs: list[bytes], k: int = SHINGLE_WORDS, seed: int = HASH_SEED) -> np.ndarray:
    """uint64 SimHash of each text."""
    ones, total = np.zeros((len(docs), 64), np.int64), np.zeros(len(docs), np.int64)
    hashes, owner, held = [], [], 0
    h = xxhash.xxh64_intdigest

    def add():
        bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = np.array([o for o, _ in owner])
        start = np.cumsum([0] + [n for _, n in owner[:-1]])
        np.add.at(ones, own, np.add.reduceat(bits, start, axis=0, dtype=np.int64))
        hashes.clear()
        owner.clear()

    for d, text in enumerate(docs):
        words = text.translate(LOWER_AZ).split()
        if not words:
            continue
        norm = b" ".join(words)
        end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        start = np.concatenate(([0], end[:-1] + 1))
        n = total[d] = max(1, len(words) - k + 1)
        stop = end[min(k, len(words)) - 1:]
        for s in range(0, n, SEGMENT):
            a, b = start[s:min(s + SEGMENT, n)].tolist(), stop[s:min(s + SEGMENT, n)].tolist()
            hashes += [h(norm[x:y], seed) for x, y in zip(a, b)]
            owner.append((d, len(a)))
            if len(hashes) >= SEGMENT:
                add()
    if hashes:
        add()
    bit = ones * 2 > total[:, None]
    return np.packbits(bit, axis=1, bitorder="little").view(np.uint64).ravel()


def add_fingerprint(docs: DataFrame, text_col: str = "text", out_col: str = "fp", k: int = SHINGLE_WORDS,
                    seed: int = HASH_SEED) -> DataFrame:
    """``docs`` plus ``out_col``: the fingerprint as a signed 64-bit integer."""
    @F.arrow_udf("bigint")
    def fp(text: pa.Array) -> pa.Array:
        parts = [fingerprints(p, k, seed).view(np.int64) for p in text_pieces(text)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64())

    return docs.withColumn(out_col, fp.asNondeterministic()(F.col(text_col)))


# ------------------------------------------------------------- bit-sliced linking ---

def bit_planes(fp: np.ndarray) -> np.ndarray:
    """(64, words): bit j of word w in plane b is bit b of fingerprint 64 w + j."""
    n = -(-len(fp) // 64) * 64
    padded = np.zeros(n, np.uint64)
    padded[:len(fp)] = fp
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def near_pairs(fp: np.ndarray, lo: np.ndarray, hi: np.ndarray, radius: int = RADIUS, step: int = 1 << 12):
    """Yield index arrays (i, j), lo[i] <= j < hi[i], of fingerprints at most ``radius`` bits apart."""
    planes = bit_planes(fp)
    words = np.where(hi > lo, (hi - 1) // 64 - lo // 64 + 1, 0)
    all_q = np.repeat(np.arange(len(fp)), words)
    all_w = ragged_ranges(lo // 64, words)
    limit = radius + 1
    levels = limit.bit_length()
    for s in range(0, len(all_q), step):
        q, w = all_q[s:s + step], all_w[s:s + step]
        a = np.clip(lo[q] - 64 * w, 0, 64).astype(np.uint64)
        b = np.clip(hi[q] - 64 * w, 0, 64).astype(np.uint64)
        over = ~(_below(b) & ~_below(a))                   # lanes out of range count as past the radius
        count = [np.zeros(len(q), np.uint64) for _ in range(levels)]
        value = fp[q]
        for bit in range(64):
            diff = planes[bit][w] ^ (np.uint64(0) - ((value >> np.uint64(bit)) & np.uint64(1)))
            full = _ALL
            for k in range(levels):                        # carry-save add of one bit per lane
                carry = count[k] & diff
                count[k] ^= diff
                full = full & (count[k] if limit >> k & 1 else ~count[k])
                diff = carry
            over |= full                                   # exactly radius + 1 reached
            if bit % 8 == 7:
                alive = over != _ALL
                if not alive.all():                        # abandon words with no lane left
                    q, w, over, value = q[alive], w[alive], over[alive], value[alive]
                    count = [c[alive] for c in count]
                    if not len(q):
                        break
        if len(q):
            lane = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            r, j = np.nonzero(lane)
            yield q[r], w[r] * 64 + j


def _below(n: np.ndarray) -> np.ndarray:
    """Words with the lowest n bits set, 0 <= n <= 64."""
    return np.where(n >= 64, _ALL, (np.uint64(1) << np.minimum(n, np.uint64(63))) - np.uint64(1))


def join_labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Bring i and j under one (smallest) label, in place; labels are roots."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def spanning_links(fp: np.ndarray, group: np.ndarray, side: np.ndarray, radius: int = RADIUS):
    """Links that span the components found inside each group. Rows come ordered by group and side;
    a group of one side compares all its rows, a group of two sides one side with the other."""
    n = len(fp)
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    size = np.diff(np.append(first, n))
    g_end = np.repeat(first + size, size)
    two = np.repeat(np.maximum.reduceat(side, first) != np.minimum.reduceat(side, first), size)
    n_low = np.add.reduceat((side == np.repeat(np.minimum.reduceat(side, first), size)).astype(np.int64), first)
    split = np.repeat(first + n_low, size)
    i = np.arange(n)
    lo = np.where(two, split, i + 1)
    hi = np.where(two & (i >= split), lo, g_end)
    label = np.arange(n)
    for a, b in near_pairs(fp, lo, hi, radius):
        join_labels(label, a, b)
    far = np.flatnonzero(label != i)
    return fp[label[far]], fp[far]


def _links_udf(radius: int, batch_rows: int = 1 << 15):
    """Rows (g, t, fp) ordered by group and side -> links; holds whole groups, of bounded size."""
    def run(batches):
        held, rows = [], 0

        def flush(last: bool):
            t = pa.Table.from_batches(held)
            cols = [t[c].to_numpy() for c in ("p", "m", "ta", "tb", "t", "fp")]
            change = np.zeros(len(t), bool)
            change[0] = True
            for c in cols[:4]:
                change[1:] |= c[1:] != c[:-1]
            group = np.cumsum(change)
            n = len(t) if last else int(np.flatnonzero(group == group[-1])[0])
            held[:] = [] if last else t.slice(n).to_batches()
            if not n:
                return None
            a, b = spanning_links(cols[5][:n].view(np.uint64), group[:n], cols[4][:n], radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows >= batch_rows:
                if (out := flush(False)) is not None:
                    yield out
                rows = sum(b.num_rows for b in held)
        if held and (out := flush(True)) is not None:
            yield out

    return run


def block_masks(blocks: int) -> list[int]:
    """Masks of every pair of ``blocks`` bit blocks that together cover 64 bits."""
    cut = [64 * k // blocks for k in range(blocks + 1)]
    masks = [((1 << cut[k + 1]) - 1) ^ ((1 << cut[k]) - 1) for k in range(blocks)]
    return [a | b for a, b in combinations(masks, 2)]


def link_fingerprints(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (a, b) that span the components of distinct fingerprints (column ``fp``)."""
    signed = [m - (1 << 64) if m >> 63 else m for m in block_masks(radius + 2)]
    keys = F.array(*[F.struct(F.lit(k).alias("p"), F.col("fp").bitwiseAND(F.lit(m)).alias("m"))
                     for k, m in enumerate(signed)])
    member = distinct.select("fp", F.explode(keys).alias("k")).select("fp", "k.p", "k.m")
    # a lone fingerprint has no partner; the sizes are staged so that the join's two sides are plain
    # shuffles and a very large bucket is split by the skew handling
    sizes = staged(member.groupBy("p", "m").count().where("count > 1"), "simhash-buckets")
    sized = member.join(sizes, ["p", "m"])
    tiles = F.ceil(F.col("count") / F.lit(tile)).cast("int")
    t = sized.select("p", "m", "fp", tiles.alias("n")).withColumn("t", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
    # a tile meets every tile of its bucket, itself included: each fingerprint appears once per tile
    pairs = t.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    group = ["p", "m", "ta", "tb"]
    rows = (pairs.select("p", "m", F.least("t", "o").alias("ta"), F.greatest("t", "o").alias("tb"), "t", "fp")
                 .repartition(*group).sortWithinPartitions(*group, "t"))
    return rows.mapInArrow(_links_udf(radius), "a bigint, b bigint")


# ------------------------------------------------------------------- components ---

def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS,
                    radius: int = RADIUS, seed: int = HASH_SEED, tile: int = TILE) -> DataFrame:
    """One row per input row: ``id_col``, fp and component_id, the smallest id reachable over links."""
    fps = staged(add_fingerprint(docs.select(F.col(id_col), F.col(text_col)), text_col, "fp", k, seed)
                 .select(id_col, "fp"), "simhash-fp")
    return fps.join(components_of(fps, id_col, radius, tile), "fp").select(id_col, "fp", "component_id")


def components_of(fps: DataFrame, id_col: str, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(fp, component_id) of every distinct fingerprint of a staged table (``id_col``, fp); the id may be
    of any ordered type."""
    distinct = staged(fps.groupBy("fp").agg(F.min(id_col).alias("id")), "simhash-distinct")
    roots = connected_components(link_fingerprints(distinct, radius, tile))
    rooted = staged(distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                    .select("fp", "id", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    named = staged(rooted.groupBy("root").agg(F.min("id").alias("component_id")), "simhash-components")
    return staged(rooted.join(named, "root").select("fp", "component_id"), "simhash-named")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS,
             radius: int = RADIUS, seed: int = HASH_SEED, tile: int = TILE) -> DataFrame:
    """The rows of ``docs`` with one row of each group left: that of the smallest id (null ids last; among
    rows of one id, the first in table order). All columns are kept."""
    cols = docs.columns
    number = "_row"
    while number in cols:
        number += "_"
    fp_col = "fp"
    while fp_col in cols:
        fp_col += "_"
    full = staged(add_fingerprint(docs, text_col, fp_col, k, seed).withColumn(number, F.monotonically_increasing_id()),
                  "simhash-docs")
    order = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(number).alias("row"))
    fps = staged(full.select(order.alias("at"), F.col(fp_col).alias("fp")), "simhash-fp")
    named = components_of(fps, "at", radius, tile)
    lost = fps.join(named, "fp").where(F.col("at") != F.col("component_id")).select(F.col("at.row").alias(number))
    return full.join(staged(lost, "simhash-lost"), number, "left_anti").select(*cols)

"""Exact top-k inner-product search over norm-sorted vectors.

Vectors are turned to integers, and rotated by the right singular vectors of the whole table (from its
Gram matrix, a sum over all rows), which moves most of the length into the first components. Candidates lie in
blocks of bounded size by descending length. All queries first meet the block of the longest vectors, which
gives each a k-th best score; since |q| |x| bounds a score, a query then needs the blocks up to the last one
long enough to reach it, and none behind. Queries of like need share a block, and a candidate block is sent
to the query blocks that need it only, so what is shuffled follows the pairs of blocks that can matter.

In a task a block of queries meets a block of candidates, again by descending length: a whole slice is
skipped once |q| |x| cannot reach the query's k-th best score so far, and inside a slice partial sums over the
leading rotated components, plus the Cauchy-Schwarz bound |q_rest| |x_rest| on what is missing, leave few
candidates. Survivors get their exact integer score. Each query's best of every block meet in one small
aggregate.

Defined cases: vectors that are null or hold a null or non-finite component take no part, nor do vectors with
a null id or with a component whose integer does not fit a long; a pair whose score does not fit a long has
none and is not ranked; vectors of different lengths meet as if the shorter were padded with zeros; equal ids
are one item: they are never each other's candidates, each repeated row counts as a candidate of its own, and
each repeated query row gets a ranking of its own; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

K = 20
SCALE = 64
QUERY_BLOCK = 4096           # queries in a block
QUERY_ROWS = 512             # of which so many are compared at once
CANDIDATE_BLOCK = 16384      # candidates in a block: with 64 components, 8 MB
SLICE = 1024                 # candidates compared at once
STEPS = (8, 16, 32)          # leading components after which candidates are dropped


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """(id, v array<bigint>) of the vectors that take part."""
    x = F.col("_v")
    scaled = F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double")))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    fits = F.forall(x, lambda c: F.abs(F.lit(scale) * c.cast("double")) < float(2 ** 63))
    return (df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("_v"))
              .where(F.col("id").isNotNull() & x.isNotNull() & finite & fits)
              .select("id", scaled.alias("v")))


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    """int64 rows of ``dim`` components, zero-padded."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    n = len(lists)
    size = np.asarray(lists.value_lengths(), dtype=np.int64) if n else np.zeros(0, np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (size == dim).all():
        return flat.reshape(n, dim)
    out = np.zeros((n, dim), np.int64)
    row = np.repeat(np.arange(n), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def rotation(vectors: DataFrame, dim: int) -> np.ndarray:
    """Right singular vectors of the whole table, largest singular value first. Each task sends one
    ``dim`` x ``dim`` sum; Spark adds them up by row, so the driver gets ``dim`` rows."""
    def gram(batches):
        total = np.zeros((dim, dim))
        for b in batches:
            x = _matrix(b.column(0), dim).astype(np.float64)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(dim), dim)), pa.array(np.tile(np.arange(dim), dim)), pa.array(total.ravel())],
            ["i", "j", "s"])

    sums = vectors.select("v").mapInArrow(gram, "i bigint, j bigint, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    g = np.zeros((dim, dim))
    for r in sums.toLocalIterator():
        g[r.i, r.j] = r.s
    values, axes = np.linalg.eigh((g + g.T) / 2)
    return np.ascontiguousarray(axes[:, np.argsort(-values)])


LONG = 2.0 ** 63


def exact_scores(q: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Integer inner products of rows, and which of them fit a long. Sums wrap around, so a score that fits is
    right whatever its parts are; where it may not fit Python's integers decide."""
    score = np.einsum("ij,ij->i", q, x)
    size = np.abs(q.astype(np.float64) * x.astype(np.float64)).sum(1)
    fit = size < LONG / 2
    for k in np.flatnonzero(~fit):
        total = sum(int(a) * int(b) for a, b in zip(q[k], x[k]))
        fit[k] = -(1 << 63) <= total < 1 << 63
    return score, fit


def block_top_k(q_id, q, x_id, x, axes, k, slice_rows=SLICE, steps=STEPS, least=None):
    """Best k candidates of each query within one block: arrays (query row, candidate id, score). Candidates
    below a query's ``least`` score may be left out."""
    dim = axes.shape[0]
    steps = [s for s in steps if s < dim]
    x_len = np.sqrt((x.astype(np.float64) ** 2).sum(1))
    order = np.argsort(-x_len, kind="stable")
    x_id, x, x_len = x_id[order], x[order], x_len[order]
    q_len = np.sqrt((q.astype(np.float64) ** 2).sum(1))
    q_rot, x_rot = q.astype(np.float64) @ axes, x.astype(np.float64) @ axes
    q_rest = [np.sqrt((q_rot[:, s:] ** 2).sum(1)) for s in steps]
    x_rest = [np.sqrt((x_rot[:, s:] ** 2).sum(1)) for s in steps]
    n_q = len(q)
    best_s = np.zeros((n_q, 0), np.int64)
    best_i = np.zeros((n_q, 0), np.int64)
    have = np.zeros(n_q, np.int64)
    least = np.full(n_q, -np.inf) if least is None else least
    floor = least.copy()                                               # k-th best score so far
    low = np.iinfo(np.int64).min
    for s in range(0, len(x), slice_rows):
        e = min(s + slice_rows, len(x))
        slack = 1e-9 * q_len * x_len[s] + 1e-6                         # rounding of the rotated sums
        live = np.flatnonzero(q_len * x_len[s] + slack >= floor)
        if not len(live):
            break                                                      # every later vector is shorter still
        own, err = floor[live], slack[live]
        keep = q_id[live][:, None] != x_id[None, s:e]
        part, done = np.zeros((len(live), e - s)), 0
        for n, step in enumerate([*steps, dim]):
            part += q_rot[live, done:step] @ x_rot[s:e, done:step].T
            if step < dim:
                if np.isneginf(own).all():
                    done = step                                        # nothing to prune with yet
                    continue
                bound = part + q_rest[n][live][:, None] * x_rest[n][None, s:e]
                keep &= bound >= (own - err)[:, None]
            else:                                                      # whole sums: only their rounding is open
                sums = np.where(keep & (part + err[:, None] < LONG), part, -np.inf)   # surely scores
                if sums.shape[1] > k:
                    own = np.maximum(own, np.partition(sums, -k, axis=1)[:, -k] - err)
                keep &= part >= (own - err)[:, None]
            done = step
            if np.count_nonzero(keep) < 0.02 * keep.size:
                break                                                  # so few that they are summed one by one
        r, c = np.nonzero(keep)
        if not len(r):
            continue
        score, fit = np.empty(len(r), np.int64), np.empty(len(r), bool)
        for a in range(0, len(r), 1 << 17):
            b = a + (1 << 17)
            score[a:b], fit[a:b] = exact_scores(q[live[r[a:b]]], x[s + c[a:b]])
        r, c, score = r[fit], c[fit], score[fit]
        if not len(r):
            continue
        # merge: old best and survivors of each query, best first, ties to the smaller id
        old_r, old_c = np.nonzero(np.arange(best_s.shape[1])[None, :] < have[:, None])
        all_q = np.concatenate((old_r, live[r]))
        all_s = np.concatenate((best_s[old_r, old_c], score))
        all_i = np.concatenate((best_i[old_r, old_c], x_id[s + c]))
        o = np.lexsort((all_i, -all_s, all_q))
        all_q, all_s, all_i = all_q[o], all_s[o], all_i[o]
        place = np.arange(len(o)) - np.searchsorted(all_q, all_q)
        top = place < k
        all_q, all_s, all_i, place = all_q[top], all_s[top], all_i[top], place[top]
        best_s, best_i = np.full((n_q, k), low), np.zeros((n_q, k), np.int64)
        best_s[all_q, place], best_i[all_q, place] = all_s, all_i
        have = np.bincount(all_q, minlength=n_q)
        floor = np.maximum(least, np.where(have == k, best_s[:, k - 1].astype(np.float64), -np.inf))
    r, c = np.nonzero(np.arange(best_s.shape[1])[None, :] < have[:, None])
    return r, best_i[r, c], best_s[r, c]


def _meeting(axes, dim: int, k: int):
    """A block of queries and a block of candidates -> each query's best of the block."""
    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"row": [], "query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            x_id, x = right["id"].to_numpy(), _matrix(right["v"], dim)
            for a in range(0, left.num_rows, QUERY_ROWS):
                own = left.slice(a, QUERY_ROWS)
                q_id, row = own["id"].to_numpy(), own["row"].to_numpy()
                least = own["least"].to_numpy(zero_copy_only=False).astype(np.float64)
                r, i, s = block_top_k(q_id, _matrix(own["v"], dim), x_id, x, axes.value, k, least=np.where(np.isnan(least), -np.inf, least))
                for name, v in zip(out, (row[r], q_id[r], i, s)):
                    out[name].append(v)
        return pa.table({name: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64()) for name, v in out.items()})

    return meet


def _reach(longest: np.ndarray):
    """Each query's last block that can hold a candidate for it: lengths descend from block to block."""
    def run(batches):
        for b in batches:
            need = b.column("least").to_numpy(zero_copy_only=False).astype(np.float64)
            size = b.column("len").to_numpy().astype(np.float64)
            with np.errstate(divide="ignore", invalid="ignore"):
                bound = np.where(np.isnan(need) | (need <= 0), 0.0, need / size * (1 - 1e-8))
            last = np.searchsorted(-longest, -bound, "right") - 1
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(last.astype(np.int64))], ["row", "reach"])

    return run


MET = "row bigint, query_id bigint, vec_id bigint, score bigint"


def top_k(vectors: DataFrame, id_col: str, vec_col: str, queries, k: int = K, scale: int = SCALE,
          query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best candidates among all other rows, by integer
    inner product, ties to the smaller id. ``queries`` is a condition on the column ``id``."""
    spark = vectors.sparkSession
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double")))
    ints = staged(integer_vectors(vectors, id_col, vec_col, scale).withColumn("row", F.monotonically_increasing_id())
                  .withColumn("len", size), "topk-vectors")
    info = ints.agg(F.count(F.lit(1)).alias("n"), F.count_if(queries).alias("nq"), F.max(F.size("v")).alias("dim")).first()
    if not info.nq or info.n < 2:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    dim = max(1, info.dim)
    meet = _meeting(spark.sparkContext.broadcast(rotation(ints, dim)), dim, k)

    # blocks of candidates by descending length; the driver gets one length for each
    n_c = -(-info.n // candidate_block)
    blocks = staged(ints.repartitionByRange(n_c, F.desc("len"), "row").select("id", "v", "len", F.spark_partition_id().alias("cb")), "topk-blocks")
    found = blocks.groupBy("cb").agg(F.max("len").alias("len")).orderBy("cb").collect()
    longest = np.array([r.len for r in found])
    number = spark.createDataFrame([(r.cb, n) for n, r in enumerate(found)], "cb int, n int")
    c = blocks.join(number, "cb").select("id", "v", F.col("n").alias("cb"))

    # a stated query set against all rows, block by block: first all queries against the longest vectors
    n_q = -(-info.nq // query_block)
    every = F.sequence(F.lit(0), F.lit(n_q - 1))
    q = ints.where(queries).select("row", "id", "v", "len", F.pmod(F.xxhash64("row"), F.lit(n_q)).cast("int").alias("qb"), F.lit(0).alias("cb"))
    first = q.withColumn("least", F.lit(None).cast("bigint")).groupBy("qb", "cb").cogroup(
        c.where("cb = 0").withColumn("qb", F.explode(every)).groupBy("qb", "cb")).applyInArrow(meet, MET)
    met = staged(first, "topk-first")
    if len(found) > 1:
        least = met.groupBy("row").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("least"))
        needed = q.select("row", "id", "v", "len").join(least, "row", "left")
        reach = needed.select("row", "least", "len").mapInArrow(_reach(longest), "row bigint, reach bigint").where("reach > 0")
        # queries of like need together: a block's need is little more than its queries'
        asking = staged(needed.join(staged(reach, "topk-reach"), "row").repartitionByRange(n_q, F.desc("reach"), "row")
                        .withColumn("qb", F.spark_partition_id()), "topk-asking")
        needs = asking.groupBy("qb").agg(F.max("reach").alias("reach")).orderBy("qb").collect()      # reach descends
        order = spark.createDataFrame([(r.qb, n) for n, r in enumerate(needs)], "qb int, n int")
        asking = asking.join(order, "qb").drop("qb").withColumnRenamed("n", "qb")
        asked_by = np.searchsorted(-np.array([r.reach for r in needs]), -np.arange(len(found)), "right").tolist()
        to = spark.createDataFrame([(cb, n) for cb, n in enumerate(asked_by) if cb and n], "cb int, blocks int")
        left = asking.withColumn("cb", F.explode(F.sequence(F.lit(1), F.col("reach").cast("int"))))
        right = c.join(to, "cb").select("id", "v", "cb", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("qb"))
        rest = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInArrow(meet, MET)
        met = met.unionByName(staged(rest, "topk-rest"))
    # at most k rows a query and block: the final pick is over k x blocks rows
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("vec_id").alias("i")))), 1, k)
    return (met.groupBy("row", "query_id").agg(best.alias("b")).select("query_id", F.posexplode("b").alias("rank", "b"))
               .select("query_id", (F.col("rank") + 1).alias("rank"), F.col("b.i").alias("vec_id"), (-F.col("b.s")).alias("score")))

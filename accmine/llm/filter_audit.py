"""Audit of how filters interact: what each filter removes, wastes and loses in every order of application.

Each document is reduced to the set of filters that it fails, a mask of a few bits; documents of one part and
mask are counted together (all, good, toxic). The audit itself works on masks: the matrix of masks (0 where a
filter fails, infinite elsewhere) and the matrix of the filters' positions in every order (the inverse of the
permutation) are combined by min-plus product, so that entry (mask, order) is the step that removes such
documents. Counts are scattered to (order, removal step) with the groups' weights; what a filter would remove
after an earlier one did is redundant.

At scale: the texts are scanned once for the mask; copies are found by their SHA-256, whose least id is a
partial aggregate joined back on hash and id, so neither a hot text nor a hot part meets in one task. The
audit's tasks get one row of 2^filters counts for each part.

Defined cases: null text is empty text; null part is the empty string; a null id is neither copy nor original;
rows that repeat one id are originals together; of repeated labels one that holds is enough; parts without
documents do not occur, so an empty table gives an empty audit; other columns play no role.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged
from .mixing import SPACE

MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITALS_PERCENT = 2
SYMBOLS = "[#$%&*|]"

COUNTS = ("n", "good", "toxic")
OUT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
       "good_lost long, toxic_lost long, shapley long")


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions of one text by itself, under their letters."""
    words = F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {"A": n < MIN_WORDS, "B": distinct * 100 < n * MIN_DISTINCT_PERCENT,
            "C": capitals.cast("bigint") * 100 > F.length(text).cast("bigint") * MAX_CAPITALS_PERCENT, "D": text.rlike(SYMBOLS)}


def fail_masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               part_col: str = "source", filters=text_filters, copies: str = "E") -> tuple[DataFrame, str]:
    """(part, mask, n, good, toxic) counts, and the filters' letters in the order of the mask's bits. ``copies``
    names the filter that fails a document whose text a smaller id has, too; it takes the last bit."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    conditions = filters(F.col("_text"))
    bits = [F.when(c, 1 << k).otherwise(0) for k, c in enumerate(conditions.values())]
    facts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"), text.alias("_text"))
    facts = staged(facts.select("id", "part", sum(bits, F.lit(0)).alias("mask"), F.unhex(F.sha2("_text", 256)).alias("hash")), "audit-facts")
    original = staged(facts.where(F.col("id").isNotNull()).groupBy("hash").agg(F.min("id").alias("id"))
                           .withColumn("original", F.lit(True)), "audit-originals")
    known = staged(labels.select(F.col(id_col).alias("id"), "quality", "toxic").where(F.col("id").isNotNull()).groupBy("id").agg(
        F.max((F.coalesce("quality", F.lit(0)) == 1).cast("int")).alias("good"),
        F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("int")).alias("toxic")), "audit-labels")
    judged = facts.join(original, ["hash", "id"], "left").join(known, "id", "left")
    copy = F.col("id").isNotNull() & F.col("original").isNull()
    mask = F.col("mask") + F.when(copy, 1 << len(bits)).otherwise(0)
    counts = judged.groupBy("part", mask.alias("mask")).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    return counts, "".join(conditions) + copies


def removal_ranks(n_filters: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(orders, positions, ranks): all orders of the filters, each filter's place (from 0) in every order, and
    for every mask and order the place of the filter that removes it, ``n_filters`` if none does."""
    orders = np.array(list(permutations(range(n_filters))))
    positions = np.argsort(orders, axis=1)                                    # inverse permutations
    fails = (np.arange(1 << n_filters)[:, None] >> np.arange(n_filters)) & 1
    masks = np.where(fails == 1, 0, n_filters)                                # stands for infinity
    ranks = np.full((len(masks), len(orders)), n_filters)
    for f in range(n_filters):                                                # min-plus product
        ranks = np.minimum(ranks, masks[:, f, None] + positions[None, :, f])
    return orders, positions, ranks


def audit_part(counts: np.ndarray, ranked) -> dict[str, np.ndarray]:
    """Figures of one part from its (masks, 3) counts; each result has the shape (orders, steps)."""
    orders, positions, ranks = ranked
    n_orders, n = orders.shape
    removed = np.zeros((3, n_orders, n + 1), np.int64)
    redundant = np.zeros((n_orders, n), np.int64)
    every = np.arange(n_orders)
    for mask in np.flatnonzero(counts.any(axis=1)):
        for k in range(3):
            np.add.at(removed[k], (every, ranks[mask]), counts[mask, k])      # weighted scatter
        for f in np.flatnonzero((mask >> np.arange(n)) & 1):
            late = positions[:, f] > ranks[mask]
            np.add.at(redundant, (every[late], positions[late, f]), counts[mask, 0])
    out = removed[:, :, :n]
    by_filter = np.zeros(n, np.int64)
    np.add.at(by_filter, orders, out[0])
    return {"kept": counts[:, 0].sum() - np.cumsum(out[0], axis=1), "removed": out[0], "redundant": redundant,
            "unique_fails": counts[1 << orders, 0], "good_lost": out[1], "toxic_lost": out[2], "shapley": by_filter[orders]}


def audit_filters(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """One row for each part, order of the filters and step: documents kept after the step, removed by it,
    redundant (fail its filter, removed before), failing only its filter, good and toxic documents that it
    removes, and what its filter removes over all orders."""
    counts, letters = fail_masks(docs, labels, **columns)
    rows = counts.groupBy("part").agg(F.collect_list(F.struct("mask", *COUNTS)).alias("masks"))   # at most 2^filters

    def audit(batches):
        ranked = removal_ranks(len(letters))
        orders = ranked[0]
        names = ["".join(letters[f] for f in o) for o in orders.tolist()]
        shown = pa.array([x for x in names for _ in letters])
        steps = pa.array(list(range(1, len(letters) + 1)) * len(names), pa.int32())
        for batch in batches:
            for part, masks in zip(batch.column("part").to_pylist(), batch.column("masks").to_pylist()):
                table = np.zeros((1 << len(letters), 3), np.int64)
                for m in masks:
                    table[m["mask"]] += [m[c] for c in COUNTS]
                got = audit_part(table, ranked)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(steps)), shown, steps, *[pa.array(v.reshape(-1), pa.int64()) for v in got.values()]],
                    ["part", "filter_order", "step", *got])

    return rows.mapInArrow(audit, OUT)

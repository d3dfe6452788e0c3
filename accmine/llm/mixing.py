"""Mixing sources to target weights by Sainte-Laguë apportionment, with DataFrame functions only.

Every source's documents are dealt into shards of about ``SHARD_DOCS`` documents by a hash of id and text.
In a shard the documents follow each other in hash order, and the shard's words are cut into blocks of
``BLOCK_WORDS`` words. Targets come from the weights (``targets``); the blocks of the whole mix go to the
sources, and each source's blocks to its shards, by the highest quotients weight / (2 s - 1) of the s-th block
(``sainte_lague``). A shard of n blocks with a quota of q takes every block q div n times, and the q mod n
blocks with the least seeded hashes once more. A document takes the words that its blocks share with it.

At scale: texts are read once, for their number of words. Shards and ranges bound every window, so a hot
source is cut like any other; sources, shards and quotas are written tables, and only totals (one row)
reach the driver. No step depends on task order, so reruns give the same mix.

Defined cases: null text has no words; null source is a source of its own, after all others; documents
without words take none; repeated rows are documents of their own; null ids are allowed; an empty table gives
an empty result. Of the input only the id is returned, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import with_ordinal
from .common import staged

SPACE = r"\x20\x09-\x0D"
WEIGHTS = (3, 1, 2)      # of the sources in code-point order, repeating
SHARE_PERCENT = 150      # words of the mix, in percent of all words
MOST = 2                 # no source's target, and no document, above so many times its words
BLOCK_WORDS = 32
SHARD_DOCS = 1024
TASK_BLOCKS = 200_000    # blocks ranked by one task
SEED = 42


def word_count(text: Column) -> Column:
    """Words (maximal runs of other than space characters) of a text, null: 0. Each word with the space before
    it becomes one character, so no array of words is built."""
    short = F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE}]*[^{SPACE}]+", "w")
    return F.length(F.regexp_replace(short, f"[{SPACE}]+", "")).cast("bigint")


def source_key(source: Column) -> Column:
    """A key that is never null and sorts by code point, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def seeded_hash(*parts) -> Column:
    """md5 (32 hex digits) of the parts behind the seed, joined by colons."""
    return F.md5(F.concat_ws(":", *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts]).cast("binary"))


def targets(sources: DataFrame, weights=WEIGHTS, share_percent: int = SHARE_PERCENT, most: int = MOST) -> DataFrame:
    """(key, source_size, …) plus ``target`` words of each source: the mix's words by weight, where no target
    passes ``most`` times its source's words and the excess goes to the others by weight.

    Sources are ordered by the level at which they fill up, most * size / weight; a source is full if the level
    reached with all before it full is at least its own."""
    placed = with_ordinal(sources, ["key"])
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("ordinal") % len(weights) + 1).cast("int")).cast("bigint")
    placed = placed.withColumn("weight", w).withColumn("most", F.col("source_size") * most)
    placed = with_ordinal(placed.withColumn("level", F.col("most") / F.col("weight")), ["level", "ordinal"], "place",
                          {"most_before": "most", "weight_before": "weight"})
    words, weight = placed.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    mix = words * share_percent / 100
    left, rest = F.lit(mix) - F.col("most_before"), F.lit(weight) - F.col("weight_before")
    placed = placed.withColumn("full", left * F.col("weight") >= F.col("most") * rest)
    full_words, open_weight = placed.agg(F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))), F.lit(0)),
                                         F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))), F.lit(0))).first()
    shared = F.lit(mix - full_words) * F.col("weight") / F.lit(float(open_weight or 1))
    return placed.withColumn("target", F.when(F.col("full"), F.col("most").cast("double")).otherwise(shared)).drop(
        "ordinal", "weight", "most", "level", "place", "most_before", "weight_before", "full")


def sainte_lague(parties: DataFrame, group: list[str], party: list[str], weight: str, cap: str, seats: str,
                 out_col: str = "quota") -> DataFrame:
    """``parties`` plus each one's seats: in every group the ``seats`` seats (the same on all its rows) go to the
    highest quotients weight / (2 s - 1), equal ones in the order of ``party``, and no party has more than ``cap``.

    With n parties of weight W together and S seats, the divisors W / (S - n/2) and W / (S + n/2) give at most and
    at least S seats. So every party surely has the seats of the first, and only those between the two, at
    most about 4 n, are ranked."""
    p = staged(parties.withColumn("_group", F.concat_ws("\u0001", *group) if group else F.lit("")), "parties")
    has = F.col(weight) > 0
    g = staged(p.where(has).groupBy("_group").agg(F.count(F.lit(1)).alias("_n"), F.sum(weight).alias("_w"), F.max(seats).alias("_s")),
               "party-groups")
    half, w = F.col("_n") / 2, F.col(weight)
    sure = F.when(F.col("_s") > half, F.greatest(F.lit(0), F.floor(w * (F.col("_s") - half) / F.col("_w") + 0.5) - 1)).otherwise(0)
    p = (p.join(g, "_group", "left")
          .withColumn("_sure", F.when(has, F.least(F.col(cap), sure)).otherwise(0).cast("bigint"))
          .withColumn("_top", F.when(has, F.least(F.col(cap), F.floor(w * (F.col("_s") + half) / F.col("_w") + 0.5) + 1))
                               .otherwise(0).cast("bigint")))
    p = staged(p, "party-seats")
    names = ["_group", *party]
    asked = (p.where(F.col("_top") > F.col("_sure"))
              .select(*names, F.col(weight).alias("_weight"), F.explode(F.sequence(F.col("_sure") + 1, "_top")).alias("_seat"))
              .withColumn("_quotient", F.col("_weight") / (F.col("_seat") * 2 - 1)))
    ranked = with_ordinal(asked, ["_group", F.desc("_quotient"), *party], "_place")
    need = p.groupBy("_group").agg((F.max("_s") - F.sum("_sure")).alias("_need"))
    first = ranked.groupBy("_group").agg(F.min("_place").alias("_first"))
    bounds = staged(first.join(need, "_group"), "seat-bounds")
    won = ranked.join(bounds, "_group").where(F.col("_place") - F.col("_first") < F.col("_need"))
    extra = won.groupBy(*names).agg(F.count(F.lit(1)).alias("_extra"))
    quota = F.col("_sure") + F.coalesce("_extra", F.lit(0))
    return staged(p.join(extra, names, "left").select(*parties.columns, quota.cast("bigint").alias(out_col)), "quotas")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights=WEIGHTS, share_percent: int = SHARE_PERCENT, most: int = MOST, block_words: int = BLOCK_WORDS,
                shard_docs: int = SHARD_DOCS, seed: int = SEED) -> DataFrame:
    """(id, size, source_size, target, taken) for every row of ``docs``: its words, its source's words and
    target, and how many of its words the mix takes, repeats counted."""
    digest = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    facts = staged(docs.select(F.col(id_col).alias("_id"), source_key(F.col(source_col)).alias("key"),
                               word_count(F.col(text_col)).alias("size"),
                               seeded_hash(seed, F.coalesce(F.col(id_col).cast("string"), F.lit("")), digest).alias("hash")), "mix-facts")
    sources = targets(facts.groupBy("key").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs")),
                      weights, share_percent, most)
    sources = staged(sources.withColumn("shards", F.ceil(F.col("docs") / shard_docs).cast("bigint")), "mix-sources")
    number = F.conv(F.substring("hash", 1, 15), 16, 10).cast("bigint")
    dealt = facts.join(sources.select("key", "shards", "source_size", "target"), "key").withColumn("shard", number % F.col("shards"))
    cells = staged(dealt.groupBy("key", "shard").agg(F.sum("size").alias("words"))
                        .withColumn("blocks", F.ceil(F.col("words") / block_words).cast("bigint")), "mix-shards")

    # a source's weight is its target in thousandths of a block of its mean length (its shards' last blocks are short)
    of_source = cells.groupBy("key").agg(F.sum("blocks").alias("blocks"))
    mean = F.col("target") * F.col("blocks") / F.col("source_size") * 1000
    asked = staged(sources.join(of_source, "key").select(
        "key", "blocks", F.when(F.col("source_size") > 0, F.round(mean)).otherwise(0).cast("bigint").alias("weight")), "mix-weights")
    weight, blocks = asked.agg(F.coalesce(F.sum("weight"), F.lit(0)), F.coalesce(F.sum("blocks"), F.lit(0))).first()
    seats = round(weight / 1000)
    quotas = sainte_lague(asked.withColumn("seats", F.lit(seats).cast("bigint")).withColumn("cap", F.col("blocks") * most),
                          [], ["key"], "weight", "cap", "seats", "seats_won")
    shard_parties = cells.join(quotas.select("key", F.col("seats_won").alias("seats")), "key").withColumn("cap", F.col("blocks") * most)
    shares = sainte_lague(shard_parties, ["key"], ["shard"], "blocks", "cap", "seats", "quota")

    # the hash up to which a shard's blocks are taken once more
    spare = F.when(F.col("blocks") > 0, F.col("quota") % F.col("blocks")).otherwise(0)
    ranks = F.sort_array(F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1),
                                     lambda b: seeded_hash(seed, F.col("key"), F.col("shard").cast("string"), b.cast("string"))))
    last = F.when(spare > 0, F.element_at(ranks, spare.cast("int"))).otherwise("")
    ranked = shares.repartition(max(1, -(-blocks // TASK_BLOCKS)), "key", "shard")      # few rows, but as much work as they have blocks
    takes = staged(ranked.select("key", "shard", F.when(F.col("blocks") > 0, F.floor(F.col("quota") / F.col("blocks"))).otherwise(0)
                                 .cast("bigint").alias("rounds"), last.alias("last_hash")), "mix-takes")

    order = Window.partitionBy("key", "shard").orderBy("hash", "_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("at", F.coalesce(F.sum("size").over(order), F.lit(0).cast("bigint"))).join(takes, ["key", "shard"])
    end = F.col("at") + F.col("size")

    def of_block(total, b):
        again = seeded_hash(seed, F.col("key"), F.col("shard").cast("string"), b.cast("string")) <= F.col("last_hash")
        inside = F.least(end, (b + 1) * block_words) - F.greatest(F.col("at"), b * block_words)
        return total + inside * (F.col("rounds") + again.cast("bigint"))

    numbers = F.sequence(F.floor(F.col("at") / block_words), F.floor((end - 1) / block_words))
    taken = F.when(F.col("size") > 0, F.aggregate(numbers, F.lit(0).cast("bigint"), of_block)).otherwise(0)
    return placed.select(F.col("_id").alias(id_col), "size", "source_size", "target", taken.cast("bigint").alias("taken"))

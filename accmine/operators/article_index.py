"""The index of stored articles (J1): which parts of the results can hold a batch's articles.

Stored rows lie in blocks of article numbers (``block_of``), one folder a block in every appended part. For
every part and block the manifest has the number of articles and the least and greatest id, and the part's
index folder has a Bloom filter over the block's ids: a table of 63-bit words, each a row (block, word, bits). All
bits of an id lie in one word, so an id is one row wherever it meets the filter, when that is made and when it is
asked, and nothing is gathered by id.
A batch is compared with the ranges first; of the blocks that overlap only the filter's words for the batch's
own ids count. What is left, blocks with an id that passed, is read and joined exactly, so a false positive
costs a read and nothing else. The work follows the batch and the blocks that it touches. A missing id (null)
is an id like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..session import scratch_path
from ..sinks.tables import stage
from ..sinks.versions import VersionedTable

BLOCK_IDS = 1_000_000     # article numbers in a block
OTHER_BLOCKS = 64         # blocks for ids without a number, by hash
BITS_PER_ID = 16
PROBES = 5                # about 0.5 % of unknown ids pass
WORD = 63                 # bits kept in a long, without its sign

WORDS = StructType([StructField("part", StringType()), StructField("block", LongType()),
                    StructField("word", LongType()), StructField("bits", LongType())])
KEYS = StructType([StructField("pmcid", StringType())])


def article_number(pmcid: Column) -> Column:
    """The number of an article id; null for ids without one."""
    return F.nullif(F.regexp_extract(pmcid, r"^(?:pmc:)?PMC(\d{1,17})$", 1), F.lit("")).try_cast("bigint")


def block_of(pmcid: Column) -> Column:
    """The block of an article id: by its number, ids without one (and null) by hash below zero."""
    other = F.lit(-1) - F.pmod(F.xxhash64(pmcid), F.lit(OTHER_BLOCKS))
    return F.coalesce(F.floor(article_number(pmcid) / BLOCK_IDS), other).cast("bigint")


def _range() -> list[Column]:
    key = F.coalesce(F.col("pmcid"), F.lit(""))
    return [F.min(key).alias("least"), F.max(key).alias("most")]


FILTER = "word"           # noted with a part: parts of another filter are told by their ranges alone


def _masked(ids: DataFrame) -> DataFrame:
    """(…, word, mask): the word of each id and its bits there; ``ids`` has pmcid and n, the block's number of
    articles. The bits are taken from one hash, each from its own digits."""
    words = F.floor((F.col("n") * BITS_PER_ID + WORD - 1) / WORD)
    at = F.pmod(F.xxhash64("pmcid", F.lit(1)), F.lit(WORD ** PROBES))
    bits = [F.expr(f"shiftleft(1L, cast((_at div {WORD ** k}L) % {WORD} as int))") for k in range(PROBES)]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    return (ids.withColumn("word", F.pmod(F.xxhash64("pmcid", F.lit(0)), F.greatest(F.lit(1), words))).withColumn("_at", at)
               .withColumn("mask", mask).drop("_at"))


def write_index(table: VersionedTable, data: str, index: str) -> list[dict]:
    """Write the filter of the part at ``data`` to ``index`` and return the manifest's entries: for each block
    its number of articles and least and greatest id. Entries are as many as blocks, not articles."""
    spark = table.spark
    ids = stage(table.read_paths([data], StructType([*KEYS.fields, WORDS["block"]])).distinct(), scratch_path(spark, "part-articles"))
    blocks = ids.groupBy("block").agg(F.count(F.lit(1)).alias("n"), *_range()).collect()
    sizes = spark.createDataFrame([(b.block, b.n) for b in blocks], "block bigint, n bigint")
    words = _masked(ids.join(sizes, "block")).groupBy("block", "word").agg(F.bit_or("mask").alias("bits"))
    words.hint("rebalance", "block").sortWithinPartitions("block", "word").write.partitionBy("block").parquet(index)
    return [b.asDict() for b in blocks]


def _folder(path: str) -> str:
    return path.rsplit("part=", 1)[1]


def matching_blocks(table: VersionedTable, ids: DataFrame, parts: list[dict]) -> list[str]:
    """Block folders that may hold one of ``ids`` (columns pmcid, block; a written table), by range and by
    filter. The driver sees blocks, never ids."""
    span = {r.block: (r.least, r.most) for r in ids.groupBy("block").agg(*_range()).collect()}
    near = [(p, b) for p in parts for b in p["blocks"]
            if b["block"] in span and b["least"] <= span[b["block"]][1] and b["most"] >= span[b["block"]][0]]
    found = {f"{p['path']}/block={b['block']}" for p, b in near if p.get("filter") != FILTER}
    near = [(p, b) for p, b in near if p.get("filter") == FILTER]
    if near:
        sizes = table.spark.createDataFrame([(_folder(p["index"]), b["block"], b["n"]) for p, b in near], "part string, block bigint, n bigint")
        words = table.read_paths([f"{p['index']}/block={b['block']}" for p, b in near], WORDS)
        asked = _masked(ids.join(sizes, "block")).select("part", "block", "word", "mask")
        hits = asked.join(words, ["part", "block", "word"]).where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
        data = {_folder(p["index"]): p["path"] for p, _ in near}
        found |= {f"{data[r.part]}/block={r.block}" for r in hits.select("part", "block").distinct().collect()}
    return sorted(found)


def stored_articles(table: VersionedTable, ids: DataFrame, parts: list[dict]) -> DataFrame:
    """Those of ``ids`` (pmcid; distinct) that are stored, from the matching blocks alone."""
    ids = stage(ids.select("pmcid", block_of(F.col("pmcid")).alias("block")), scratch_path(table.spark, "batch-articles"))
    plain = [p["path"] for p in parts if "blocks" not in p]                  # parts without an index are read whole
    paths = matching_blocks(table, ids, [p for p in parts if "blocks" in p])
    wanted = ids.select(F.col("pmcid").alias("_id"))
    return table.read_paths(paths + plain, KEYS).join(wanted, F.col("pmcid").eqNullSafe(F.col("_id")), "left_semi").distinct()

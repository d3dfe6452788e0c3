"""Citations and counts kept up to date.

The store holds the distinct findings (article, id, digest of the context) with their numbers of rows, in
blocks of article numbers, sorted by id: in every block an id's articles are one sorted run, so a much cited
id is a list in several blocks. All findings of an article lie in one block; so counts of articles, pairs and
rows of a block are exact and add up. A batch rewrites only the blocks that its articles fall into, and
appends the change of each id's counts; these small tables are summed when they are read and merged when
they are many. One commit moves all of it, with the batch's name: a batch is applied once.

A batch and the blocks it touches are shuffled once: dealt into buckets of a block by article, so that a task sees
all findings of its articles, merges them, and marks in each row what it adds to the counts. The counts are then
sums over the rows written. Findings without an article's name are dealt by their own keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StringType, StructField, StructType

from ..functions.fixed import ARTICLE_CURIE_PREFIX
from ..functions.text import strip_curie
from ..operators.article_index import block_of
from ..operators.summarize import citation_pairs
from ..session import scratch_path
from .tables import stage
from .versions import VersionedTable

MAX_CHANGES = 16          # tables of changes before they are merged
BUCKET_ROWS = 250_000     # findings of a block that one task merges

_S, _L = StringType(), LongType()
ROWS = StructType([StructField("synid", _S), StructField("pmcid", _S), StructField("digest", BinaryType()), StructField("rows", _L)])
BLOCKED = StructType([*ROWS.fields, StructField("block", _L)])
IDS = StructType([StructField("synid", _S), StructField("articles", _L), StructField("rows", _L)])
MARKED = StructType([*BLOCKED.fields, StructField("new_pair", BooleanType()), StructField("first_of_article", BooleanType())])
FILES = StructType([StructField("source_file", _S)])


def _named():
    """Whether a finding has an article that citations count (see ``citation_pairs``)."""
    return F.coalesce((F.col("pmcid") != "") & (F.col("pmcid") != ARTICLE_CURIE_PREFIX), F.lit(False))


class CitationStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.table = spark, VersionedTable(spark, root)

    def _parts(self, base: dict, kind: str) -> list[str]:
        return [p["path"] for p in base["parts"] if p["kind"] == kind]

    def add(self, findings: DataFrame, batch: str) -> bool:
        """Add a batch's findings (pmcid, synid, context, source_file). False if the batch was added before."""
        base = self.table.manifest()
        batches = base["properties"].get("batches", [])
        if batch in batches:
            return False
        digest = F.unhex(F.md5(F.col("context").cast("binary")))
        # with the file, so that the files too come from what is staged
        own = findings.select("synid", "pmcid", digest.alias("digest"), "source_file").groupBy("synid", "pmcid", "digest", "source_file").agg(
            F.count(F.lit(1)).alias("rows"))
        own = stage(own.withColumn("block", block_of(strip_curie("pmcid"))), scratch_path(self.spark, "batch-findings"))
        touched = {r.block: r.n for r in own.groupBy("block").agg(F.count(F.lit(1)).alias("n")).collect()}
        before = [p for p in base["parts"] if p["kind"] == "block" and p["block"] in touched]
        for p in before:
            touched[p["block"]] += p["distinct"]
        path = self.table.folder()
        (self._merged(self.table.read_paths([p["path"] for p in before], BLOCKED), own, touched)
             .sortWithinPartitions("block", "synid", "pmcid", "digest").write.partitionBy("block").parquet(path))
        stored = self.table.read_paths([path], MARKED)
        blocks = stored.groupBy("block").agg(F.count_if("first_of_article").alias("articles"), F.sum("rows").alias("rows"),
                                             F.count(F.lit(1)).alias("distinct")).collect()
        unnamed = stored.where(~_named()).select("block", "pmcid").distinct().groupBy("block").agg(F.count(F.lit(1)).alias("n"))
        unnamed = {r.block: r.n for r in unnamed.collect()}
        none = F.lit(0).cast("bigint")
        change = stored.where("new_pair").groupBy("synid").agg(F.count(F.lit(1)).alias("articles")).withColumn("rows", none).unionByName(
            own.groupBy("synid").agg(F.sum("rows").alias("rows")).withColumn("articles", none)).groupBy("synid").agg(
            F.sum("articles").alias("articles"), F.sum("rows").alias("rows"))
        parts = [p for p in base["parts"] if p["kind"] != "block" or p["block"] not in touched]
        parts += [{"kind": "block", "path": f"{path}/block={b.block}", "block": b.block, "articles": b.articles + unnamed.get(b.block, 0), "rows": b.rows,
                   "distinct": b.distinct} for b in blocks]
        parts = self._with_change(parts, "ids", change, IDS, lambda df: df.groupBy("synid").agg(
            F.sum("articles").alias("articles"), F.sum("rows").alias("rows")))
        parts = self._with_change(parts, "files", own.select("source_file").distinct(), FILES, lambda df: df.distinct())
        self.table.commit(base, parts, {"batches": [*batches, batch]})
        return True

    def _merged(self, old: DataFrame, own: DataFrame, sizes: dict[int, int]) -> DataFrame:
        """The findings of the touched blocks with the batch's (columns of ``MARKED``), by buckets. A row is marked
        ``new_pair`` where it is the first of a citation (named article and id, prefix stripped) that ``old`` has
        not, and ``first_of_article`` where it is the first of a named article's id as it is stored."""
        keys = ["block", "bucket", "article", "synid", "pmcid", "digest"]
        buckets = self.spark.createDataFrame([(b, -(-n // BUCKET_ROWS)) for b, n in sizes.items()], "block bigint, buckets bigint")
        rows = old.withColumn("old", F.lit(True)).unionByName(own.drop("source_file").withColumn("old", F.lit(False)))
        by = F.when(_named(), F.xxhash64("article")).otherwise(F.xxhash64("synid", "digest"))
        rows = rows.join(F.broadcast(buckets), "block").withColumn("article", strip_curie("pmcid")).withColumn("bucket", F.pmod(by, "buckets"))
        rows = rows.repartition("block", "bucket").groupBy(*keys).agg(F.sum("rows").alias("rows"), F.max("old").alias("old"))
        # an article's rows by id, those that are not new first; all that follows looks back in this order
        order = Window.partitionBy("block", "bucket", "article").orderBy("synid", F.desc("old"))
        first = (F.row_number().over(order) == 1) | ~F.lag("synid").over(order).eqNullSafe(F.col("synid"))
        prefixed = F.coalesce(F.startswith("pmcid", F.lit(ARTICLE_CURIE_PREFIX)), F.lit(False))    # an article has two ids: with it, and without
        until = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        alike = F.when(prefixed, F.count_if(prefixed).over(until)).otherwise(F.count_if(~prefixed).over(until))
        cited = _named() & F.coalesce(F.col("synid") != "", F.lit(False))
        return rows.select(*BLOCKED.fieldNames(), (first & ~F.col("old") & cited).alias("new_pair"), (_named() & (alike == 1)).alias("first_of_article"))

    def _with_change(self, parts: list[dict], kind: str, change: DataFrame, schema: StructType, merge) -> list[dict]:
        have = [p for p in parts if p["kind"] == kind]
        if len(have) >= MAX_CHANGES:
            change = merge(self.table.read_paths([p["path"] for p in have], schema).unionByName(change.select(*schema.fieldNames())))
            parts = [p for p in parts if p["kind"] != kind]
        return [*parts, {"kind": kind, "path": self.table.write(change)}]

    # ------------------------------------------------------------------ reads ---

    def ids(self) -> DataFrame:
        """(synid, articles, rows) of every id stored."""
        changes = self.table.read_paths(self._parts(self.table.manifest(), "ids"), IDS)
        return changes.groupBy("synid").agg(F.sum("articles").alias("articles"), F.sum("rows").alias("rows"))

    def citations(self) -> DataFrame:
        """synid, pmcid, n_articles, as ``summarize.citations_by_id`` over all rows (A1). Pairs lie in one block
        each, so they are distinct without meeting; the counts are staged so that a hot id's join is split."""
        rows = self.table.read_paths(self._parts(self.table.manifest(), "block"), ROWS)
        counts = stage(self.ids().where(F.col("articles") > 0).select("synid", F.col("articles").alias("n_articles")),
                       scratch_path(self.spark, "id-counts"))
        return citation_pairs(rows).join(counts, "synid")

    def doc_counts(self) -> DataFrame:
        """pmcid, mentions, unique_ids."""
        rows = self.table.read_paths(self._parts(self.table.manifest(), "block"), ROWS)
        return rows.groupBy("pmcid").agg(F.sum("rows").alias("mentions"), F.count_distinct("synid").alias("unique_ids"))

    def totals(self) -> DataFrame:
        """One row: documents, rows, distinct (rows but for their batch), unique_ids, files. The first three are
        sums over the manifest's blocks; findings are not read."""
        base = self.table.manifest()
        blocks = [p for p in base["parts"] if p["kind"] == "block"]
        total = {k: sum(p[k] for p in blocks) for k in ("articles", "rows", "distinct")}
        missing = self.table.read_paths([p["path"] for p in blocks if p["block"] < 0], ROWS).where(F.col("pmcid").isNull())
        documents = total["articles"] - (0 if missing.isEmpty() else 1)                # null is a group, but no document
        known = [F.lit(v).cast("bigint").alias(n) for n, v in
                 (("documents", documents), ("rows", total["rows"]), ("distinct", total["distinct"]))]
        none = F.lit(None).cast("bigint")
        ids = self.ids().where((F.col("rows") > 0) & F.col("synid").isNotNull()).agg(F.count(F.lit(1)).alias("unique_ids"), none.alias("files"))
        files = self.table.read_paths(self._parts(base, "files"), FILES).agg(none.alias("unique_ids"), F.count_distinct("source_file").alias("files"))
        both = ids.unionByName(files).agg(F.max("unique_ids").alias("unique_ids"), F.max("files").alias("files"))
        return both.select(*known, "unique_ids", "files")

    def summary(self) -> DataFrame:
        """documents, mentions, unique_ids (A5)."""
        return self.totals().select("documents", F.col("rows").alias("mentions"), "unique_ids")

    def combine_stats(self) -> DataFrame:
        """rows_before, rows_after, unique_synids, files (A4)."""
        return self.totals().select(F.col("rows").alias("rows_before"), F.col("distinct").alias("rows_after"),
                                     F.col("unique_ids").alias("unique_synids"), "files")

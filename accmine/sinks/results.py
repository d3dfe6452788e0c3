"""The results table (K3): appended parts, an index of their articles, and the position of the weekly run, all
moved by one commit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import schemas
from ..operators.article_index import FILTER, block_of, stored_articles, write_index
from .versions import Conflict, VersionedTable

MAX_PARTS = 32           # a table of more parts is compacted
APPENDED = StructType([*schemas.RESULTS.fields, StructField("source_file", StringType())])


class ResultsTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.table = spark, VersionedTable(spark, root)

    def read(self, version: int | None = None) -> DataFrame:
        return self.table.read(schemas.RESULTS, version)

    def position(self) -> str | None:
        """The saved resume point (``PMC…``), moved by the same commit as the rows."""
        return self.table.manifest()["properties"].get("position")

    def lookup(self, base: dict):
        """Distinct article ids -> those stored in the version ``base``: reads only matching blocks."""
        return lambda ids: stored_articles(self.table, ids, base["parts"])

    def base(self) -> dict:
        """The current version. A folder of Parquet files that was never committed, as earlier releases wrote it,
        becomes the first part, without an index: it is read whole until it is compacted."""
        base = self.table.manifest()
        if base["version"] < 0 and any(n.endswith(".parquet") for n, _ in self.table.files.names(self.table.root)):
            self.table.commit(base, [{"path": f"{self.table.root}/*.parquet"}])
            base = self.table.manifest()
        return base

    def _write_part(self, rows: DataFrame) -> dict | None:
        have = [F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in APPENDED.fieldNames()]
        blocked = rows.select(*have).withColumn("block", block_of(F.col("pmcid")))
        path, index = self.table.write(blocked.hint("rebalance", "block"), ["block"]), self.table.folder()
        if self.rows([path]).isEmpty():
            return None
        return {"path": path, "index": index, "filter": FILTER, "blocks": write_index(self.table, path, index)}

    def rows(self, paths: list[str]) -> DataFrame:
        """The rows of appended parts."""
        return self.table.read_paths(paths, APPENDED)

    def append(self, make_rows, position: str | None = None, tries: int = 5) -> list[str]:
        """Append ``make_rows(lookup)``, the rows that are new by the lookup it gets, and move the position (never
        back) with them; returns the appended parts. If another writer was faster the rows are made again."""
        for left in range(tries, 0, -1):
            base = self.base()
            part = self._write_part(make_rows(self.lookup(base)))
            old = base["properties"].get("position")
            ahead = position is not None and (old is None or int(position[3:]) > int(old[3:]))
            if part is None and not ahead:
                return []
            try:
                self.table.commit(base, base["parts"] + ([part] if part else []), {"position": position} if ahead else None)
            except Conflict:
                if left == 1:
                    raise
                continue
            if len(base["parts"]) >= MAX_PARTS:
                self.compact()
            return [part["path"]] if part else []

    def compact(self) -> None:
        """Make one part of the smaller half of the parts, with one index: rows and position stay."""
        base = self.table.manifest()
        size = lambda p: sum(b["n"] for b in p.get("blocks", []))
        parts = sorted(base["parts"], key=size, reverse=True)
        keep, small = parts[:len(parts) // 2], parts[len(parts) // 2:]
        if len(small) > 1:
            merged = self._write_part(self.table.read_paths([p["path"] for p in small], APPENDED))
            try:
                self.table.commit(base, keep + ([merged] if merged else []))
            except Conflict:       # somebody appended meanwhile: a later append compacts
                pass

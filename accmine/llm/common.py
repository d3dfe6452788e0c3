"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import types
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sinks.tables import stage

# A-Z to a-z on UTF-8 bytes; every other byte stays
LOWER_AZ = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

# Arrow batches are cut into pieces of about this many text bytes before numpy work, so a task's
# memory follows this figure (or its longest single text) and not the batch's row count.
CHUNK_BYTES = 8 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input table; only Spark's reader touches the path."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read back: lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    if compression is None:
        return stage(df, path)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.parquet(path)


CACHE_ITEMS = 2     # a pipeline's stages run in the same workers: what an earlier stage kept goes


def worker_cache(key, build):
    """``build()`` once per Python worker process. Functions pickled by value get fresh globals in
    each task, so what is worth keeping between tasks lives in a module object of its own. Only the
    last ``CACHE_ITEMS`` things used are kept."""
    name = "_accmine_llm_worker_cache"
    mod = sys.modules.get(name)
    if mod is None:
        mod = sys.modules[name] = types.ModuleType(name)
        mod.items = {}
    known = key in mod.items
    value = mod.items.pop(key) if known else build()
    mod.items[key] = value
    while len(mod.items) > CACHE_ITEMS:
        del mod.items[next(iter(mod.items))]
    if not known:
        pa.default_memory_pool().release_unused()     # and what Arrow held for an earlier stage
    return value


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first with underscores behind it that no column has: an operator adds columns and
    replaces none."""
    while name in df.columns:
        name += "_"
    return name


def text_pieces(arr: pa.Array, chunk_bytes: int = CHUNK_BYTES):
    """Yield lists of UTF-8 byte strings (null: empty), cut so that each list holds at most
    ``chunk_bytes`` unless a single text is longer. Order is kept; no text is cut."""
    out, size = [], 0
    for v in arr.cast(pa.binary() if not pa.types.is_large_string(arr.type) else pa.large_binary()):
        b = v.as_py() or b""
        if out and size + len(b) > chunk_bytes:
            yield out
            out, size = [], 0
        out.append(b)
        size += len(b)
    if out:
        yield out


def crc_mod(col, m: int):
    """crc32 of the id as text, modulo ``m`` (null id: null)."""
    return F.pmod(F.crc32(F.col(col).cast("string")), F.lit(m))


def py_crc_mod(value, m: int) -> int:
    return zlib.crc32(str(value).encode()) % m


def ragged_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of ``arange(s, s + n)`` for each pair."""
    lengths = lengths.astype(np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    out = np.arange(total, dtype=np.int64)
    return out + np.repeat(starts.astype(np.int64) - (ends - lengths), lengths)

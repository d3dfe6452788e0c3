"""Whole-document check of a search feed that is written as shards (V3, K6).

Every piece of a shard that a task reads is folded into a small state: the elements it closes that others
opened, what stands at each of those levels, the elements it leaves open, its counts and its first and last
entry. The states are put together in document order, so a fault that shows only across pieces, a damaged
boundary, is found without one task reading the whole document. A state is bounded whatever the damage: no more
children, levels and counts are kept than decide what is reported. ``write_manifest`` notes every shard's
bytes, lines and place in the assembled document, which tells a missing or changed shard.
"""

from __future__ import annotations

import re
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .tables import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # workers need no installed package

# the search feed's elements: what may stand in each, in this order; a star may repeat
CONTENT = {
    "": ["database"],
    "database": ["name", "description", "release", "release_date", "entry_count", "entries"],
    "entries": ["entry*"],
    "entry": ["name", "description", "dates?", "cross_references", "additional_fields"],
    "dates": ["date"],
    "cross_references": ["ref*"],
    "additional_fields": ["field*"],
}
_TAG = re.compile(r"<(/?)([A-Za-z_]+)((?:\s+[A-Za-z_]+=\"[^\"<]*\")*)\s*(/?)>")
# a line that is one reference and nothing else (most of a feed): whole batches are told apart at once
_REF_LINE = r'^[ \t]*<ref(?:[ \t]+[A-Za-z_]+="[^"<]*")*[ \t]*/>[ \t]*$'
_ID = re.compile(r'<entry id="([^"]*)">')
# so many children (squeezed) decide what ``fits`` says of any element: all that it takes, and the first that it does not
CHILDREN = 1 + max(sum(2 if want.endswith("*") else 1 for want in content) for content in CONTENT.values())
# a whole document is four elements deep. A piece keeps the first levels that it closes of others, and the innermost that it
# leaves open: beyond them it is counted that there are more, which only a faulty document has
LEVELS = 16
DETAILS = 10
PIECE = ("shard string, at long, closes array<string>, more long, runs array<array<string>>, buried long, opens array<string>, "
         "open_runs array<array<string>>, entries long, declared array<string>, first string, last string, lines long, bytes long, "
         "fault string")
SHARDS = StructType([StructField("shard", StringType()), StructField("bytes", LongType()), StructField("lines", LongType()),
                     StructField("offset", LongType())])


def _squeezed(run: list[str], tag: str) -> None:
    """Note a child; a row of equal ones counts as two, which is all that the order of children asks for."""
    if len(run) < CHILDREN and run[-2:] != [tag, tag]:
        run.append(tag)


def _innermost(opens: list, runs: list, keep: int = LEVELS) -> int:
    """Drop all but the innermost open elements; their number."""
    n = max(0, len(opens) - keep)
    del opens[:n], runs[:n]
    return n


class Piece:
    def __init__(self):
        self.closes, self.runs, self.opens, self.open_runs = [], [[]], [], []
        self.entries = self.lines = self.bytes = self.more = self.buried = 0
        self.declared, self.first, self.last, self.fault = [], None, None, None

    def here(self) -> list[str]:
        """The children so far of the element that is open."""
        return self.open_runs[-1] if self.opens else [] if self.buried else self.runs[-1]

    def line(self, text: str) -> None:
        self.lines += 1
        self.bytes += len(text.encode()) + 1
        rest = _TAG.sub("", text)
        if "<" in rest or ">" in rest and not text.startswith("<?xml"):
            if not text.startswith("<?xml"):
                self.fault = self.fault or f"line {self.lines}: {text.strip()[:80]}"
        for m in _TAG.finditer(text):
            close, tag, _, empty = m.groups()
            if close:
                if self.opens:
                    run = self.open_runs.pop()
                    parent = self.opens.pop()
                    self.fault = self.fault or (None if parent == tag else f"line {self.lines}: <{parent}> closed by </{tag}>")
                    self.fault = self.fault or fits(parent, run)
                elif self.buried:
                    self.buried -= 1
                    self.fault = self.fault or f"line {self.lines}: </{tag}> closes an element more than {LEVELS} levels out"
                elif len(self.closes) < LEVELS:
                    self.closes.append(tag)
                    self.runs.append([])
                else:
                    self.more += 1
                continue
            _squeezed(self.here(), tag)
            if not empty:
                self.opens.append(tag)
                self.open_runs.append([])
                if len(self.opens) > 4 * LEVELS:
                    self.buried += _innermost(self.opens, self.open_runs)
            if tag == "entry":
                self.entries += 1
        if m := _ID.search(text):
            self.fault = self.fault or (f"line {self.lines}: entry {m[1]} after {self.last}" if self.last and m[1] <= self.last else None)
            self.first, self.last = self.first or m[1], m[1]
        if m := re.search(r"<entry_count>(.*)</entry_count>", text):
            self.declared = [*self.declared, m[1]][:DETAILS]

    def refs(self, lines: int, size: int) -> None:
        """Lines of one reference each, in a row."""
        self.lines += lines
        self.bytes += size
        for _ in range(min(lines, 2)):
            _squeezed(self.here(), "ref")

    def row(self, shard: str, at: int) -> dict:
        self.buried += _innermost(self.opens, self.open_runs)
        return {"shard": shard, "at": at, **{k: getattr(self, k) for k in ("closes", "more", "runs", "buried", "opens", "open_runs", "entries",
                                                                             "declared", "first", "last", "lines", "bytes", "fault")}}


def fits(parent: str, run: list[str]) -> str | None:
    """What is wrong with an element's children (squeezed), if anything."""
    if parent not in CONTENT:
        return f"<{parent}> holds elements" if run else None
    left = list(run)
    for want in CONTENT[parent]:
        tag, many, maybe = want.rstrip("*?"), want.endswith("*"), want[-1] in "*?"
        if left[:1] != [tag]:
            if not maybe:
                return f"<{parent}> lacks <{tag}>"
            continue
        while left[:1] == [tag]:
            left.pop(0)
            if not many:
                break
    return f"<{parent}> holds <{left[0]}> out of place" if left else None


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("shard"),
                                        F.col("_metadata.file_block_start").alias("at"), "value")


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """One row for each piece of a shard that a task reads: its folded state."""

    def fold(batches):
        import numpy as np
        import pyarrow.compute as pc

        key, piece = None, None

        def out():
            return pa.RecordBatch.from_pylist([piece.row(*key)], schema=arrow)

        for b in batches:
            text, at = b.column("value"), b.column("at").to_numpy()
            shards = b.column("shard").dictionary_encode()
            codes = shards.indices.to_numpy()
            plain = pc.match_substring_regex(text, _REF_LINE).to_numpy(zero_copy_only=False)
            upto = np.concatenate([[0], np.cumsum(pc.binary_length(text).to_numpy() + 1, dtype="int64")])
            odd = np.flatnonzero(~plain)
            other = dict(zip(odd.tolist(), text.take(pa.array(odd)).to_pylist()))
            starts = [0, *(np.flatnonzero((at[1:] != at[:-1]) | (codes[1:] != codes[:-1])) + 1).tolist()] if len(at) else []
            for start, end in zip(starts, [*starts[1:], len(at)]):
                here = (shards.dictionary[int(codes[start])].as_py(), int(at[start]))
                if here != key:
                    if key is not None:
                        yield out()
                    key, piece = here, Piece()
                done = start
                for k in odd[np.searchsorted(odd, start):np.searchsorted(odd, end)].tolist():
                    piece.refs(k - done, int(upto[k] - upto[done]))
                    piece.line(other[k])
                    done = k + 1
                piece.refs(end - done, int(upto[end] - upto[done]))
        if key is not None:
            yield out()

    strings, lists = pa.list_(pa.string()), pa.list_(pa.list_(pa.string()))
    arrow = pa.schema([("shard", pa.string()), ("at", pa.int64()), ("closes", strings), ("more", pa.int64()), ("runs", lists),
                       ("buried", pa.int64()), ("opens", strings), ("open_runs", lists), ("entries", pa.int64()),
                       ("declared", strings), ("first", pa.string()), ("last", pa.string()), ("lines", pa.int64()),
                       ("bytes", pa.int64()), ("fault", pa.string())])
    return _lines(spark, path).mapInArrow(fold, PIECE)


def document_faults(rows: list) -> list[str]:
    """Put the pieces' states together in document order; what does not fit."""
    top, stack, runs, buried, faults, last = [], [], [], 0, [], None      # top: the document's own children
    for p in rows:
        place = f"{p.shard} from byte {p.at}"
        if p.fault:
            faults.append(f"{place}: {p.fault}")
        for k, run in enumerate(p.runs):
            here = runs[-1] if stack else [] if buried else top
            for tag in run:
                _squeezed(here, tag)
            if k < len(p.closes):
                if not stack and buried:
                    faults.append(f"{place}: </{p.closes[k]}> closes an element more than {LEVELS} levels out")
                    return faults
                if not stack or stack[-1] != p.closes[k]:
                    faults.append(f"{place}: </{p.closes[k]}> closes <{stack[-1] if stack else ''}>")
                    return faults
                if wrong := fits(stack.pop(), runs.pop()):
                    faults.append(f"{place}: {wrong}")
        if p.more:
            faults.append(f"{place}: closes more than {LEVELS} elements of others")
            return faults
        if p.buried:
            buried += _innermost(stack, runs, 0) + p.buried
        stack += p.opens
        runs += [list(r) for r in p.open_runs]
        buried += _innermost(stack, runs)
        if p.first is not None:
            if last is not None and p.first <= last:
                faults.append(f"{place}: entry {p.first} after {last}")
            last = p.last
    if stack or buried:
        faults.append(f"end: <{stack[-1]}> is open" if stack else f"end: {buried} elements are open")
    elif wrong := fits("", top):
        faults.append(f"end: {wrong}")
    return faults


def _shards(rows: list) -> list[tuple]:
    """(shard, bytes, lines, offset) in document order, from rows that have parts of them."""
    out, offset = [], 0
    for name in sorted({p.shard for p in rows}):
        own = [p for p in rows if p.shard == name]
        size = sum(p.bytes for p in own)
        out.append((name, size, sum(p.lines for p in own), offset))
        offset += size
    return out


def write_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Note the shards of a written feed below ``path/_manifest`` (readers of the feed pass over it): their bytes and
    lines, and the offset at which each begins when they are put together by plain copies."""
    rows = _lines(spark, path).groupBy("shard").agg(F.sum(F.octet_length("value").cast("bigint") + 1).alias("bytes"),
                                                    F.count(F.lit(1)).alias("lines")).collect()      # one row a shard
    return stage(spark.createDataFrame(_shards(rows), SHARDS).coalesce(1), f"{path.rstrip('/')}/_manifest")


def check_feed(spark: SparkSession, path: str) -> DataFrame:
    """(check, ok, detail) of a written feed with a manifest: ``shards`` (none missing, added or changed),
    ``document`` (every element whole, in its place and order, entries by id), ``entry_count`` (as declared)."""
    rows = sorted(pieces(spark, path).collect(), key=lambda p: (p.shard, p.at))
    noted = {r.shard: (r.bytes, r.lines) for r in spark.read.schema(SHARDS).parquet(f"{path.rstrip('/')}/_manifest").collect()}
    there = {s: (b, n) for s, b, n, _ in _shards(rows)}
    odd = [f"{s}: {'missing' if s not in there else 'not noted' if s not in noted else 'changed'}"
           for s in sorted(noted.keys() | there.keys()) if noted.get(s) != there.get(s)]
    faults = document_faults(rows)
    declared, entries = [d for p in rows for d in p.declared], sum(p.entries for p in rows)
    counted = "" if declared == [str(entries)] else f"declared {', '.join(declared[:DETAILS]) or 'nothing'}, found {entries}"
    out = [("shards", not odd, "; ".join(odd[:DETAILS])), ("document", not faults, "; ".join(faults[:DETAILS])),
           ("entry_count", not counted, counted)]
    return spark.createDataFrame(out, "check string, ok boolean, detail string")

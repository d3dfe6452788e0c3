"""Document quality by nearest-neighbour voting in a latent semantic space.

A text's terms are the shapes of its blank-separated words (letters folded to x or, ASCII capitals, X;
digits to 9, repeats to one, other characters kept), pairs of neighbouring shapes, and marks for a word that repeats the one
before it or comes again in the text. Square-rooted term shares, weighted by inverse document frequency and brought to length one,
are projected on the leading singular vectors of a bounded labelled sample. The sample's latent vectors are
broadcast (``SAMPLE`` rows of ``DIMENSIONS`` numbers); every document meets all of them in blocked matrix
products, and the labels of its ``NEIGHBOURS`` nearest (all that tie with the last) vote, weighted by cosine.

Documents are scanned once and never shuffled. Labels of held-out rows, and lang, source and id, are never
inputs. Learning and scoring are invariant to the order of rows.

Defined cases: null and word-less texts have no direction and get the sample's share of label 1 (so do all
texts if the sample is empty: share 1); null labels and labels of ids outside the documents teach nothing, of
repeated labels the greatest counts; repeated document rows are scored each for itself; other columns are kept,
and if one is named like ``out_col`` the new one gets an underscore behind its name.
"""

from __future__ import annotations

import re
import zlib
from operator import eq
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, worker_cache
from .toxicity import labelled_sample

SAMPLE = 8192            # labelled rows whose vectors vote
DIMENSIONS = 32
TERMS = 1024             # hashed shape terms; as many again for pairs
NEIGHBOURS = 15
THRESHOLD = 0.3
BLOCK = 512              # documents in one matrix product
TIE = 1e-5               # similarities this close to the last neighbour's vote too
MEMO_SIZE = 200_000      # words remembered per worker
MARKS = 2                # repeats the word before; came before in the text

_RUN = re.compile(rb"(.)\1+", re.S)
_SHAPE = bytes(88 if 65 <= b <= 90 else 120 if 97 <= b <= 122 or b >= 128 else 57 if 48 <= b <= 57 else b for b in range(256))


def shape_of(word: str) -> int:
    """Term number of a word's shape (of its UTF-8 bytes; those of other scripts count as small letters)."""
    return zlib.crc32(_RUN.sub(rb"\1", word.encode().translate(_SHAPE))) % TERMS


WIDTH = 2 * TERMS + MARKS


def term_shares(texts: list[str], memo: dict[str, int]) -> np.ndarray:
    """Square root of each term's share among its kind, float32."""
    out = np.zeros((len(texts), WIDTH), np.float32)
    for r, text in enumerate(texts):
        words = text.split()
        if not words:
            continue
        own = set(words)
        new = own.difference(memo)
        if new:
            if len(memo) + len(new) > MEMO_SIZE:
                memo.clear()
                new = own
            memo.update(zip(new, map(shape_of, new)))
        shape = np.fromiter(map(memo.__getitem__, words), np.int64, len(words))
        out[r, :TERMS] = np.bincount(shape, minlength=TERMS) / len(words)
        if len(words) > 1:
            pair = (shape[:-1] * 31 + shape[1:]) % TERMS
            out[r, TERMS:2 * TERMS] = np.bincount(pair, minlength=TERMS) / len(pair)
            out[r, 2 * TERMS] = sum(map(eq, words, words[1:])) / (len(words) - 1)
        out[r, 2 * TERMS + 1] = max(0.0, 1 - len(own) / len(words) - 0.5) * 2     # beyond what prose repeats
    return np.sqrt(out, out=out)


def unit(x: np.ndarray) -> np.ndarray:
    size = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.maximum(size, 1e-12)


def fit(x: np.ndarray, y: np.ndarray, dimensions: int = DIMENSIONS) -> SimpleNamespace:
    """Latent space of the sample's term rows, and the sample's vectors in it."""
    n = len(x)
    if not n:
        return SimpleNamespace(axes=None, share=1.0)
    found = (x > 0).sum(axis=0)
    idf = (np.log((n + 1) / (found + 1)) + 1).astype(np.float32)
    used = found >= min(3, n)                                # terms of one or two texts span no shared direction
    w = unit((x * idf)[:, used])
    values, vectors = np.linalg.eigh((w.T @ w).astype(np.float64))   # right singular vectors of the sample
    axes = np.zeros((x.shape[1], min(dimensions, int(used.sum()))), np.float32)
    axes[used] = vectors[:, np.argsort(-values)[:axes.shape[1]]] * idf[used][:, None]
    return SimpleNamespace(axes=axes, vectors=unit(x @ axes).T.copy(), label=y.astype(np.float32), share=float(y.mean()))


def vote(x: np.ndarray, model: SimpleNamespace, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Weighted share of label 1 among each row's nearest sample vectors."""
    if model.axes is None:
        return np.full(len(x), model.share)
    k = min(neighbours, model.vectors.shape[1])
    out = np.empty(len(x))
    for s in range(0, len(x), BLOCK):
        z = x[s:s + BLOCK] @ model.axes
        some = (z * z).sum(axis=1) > 0
        cos = unit(z) @ model.vectors
        last = np.partition(cos, cos.shape[1] - k, axis=1)[:, -k][:, None]
        weight = np.where(cos >= last - TIE, np.maximum(cos, 0), 0).astype(np.float32)
        total = weight.sum(axis=1)
        out[s:s + BLOCK] = np.where(some & (total > 0), weight @ model.label / np.maximum(total, 1e-12), model.share)
    return np.clip(out, 0.0, 1.0)


def train_model(docs: DataFrame, labels: DataFrame, train: Column, label_col: str = "quality", id_col: str = "doc_id",
                text_col: str = "text", sample: int = SAMPLE) -> SimpleNamespace:
    """The voting sample, from labelled rows for which ``train`` (over the labels' columns) holds."""
    rows = labelled_sample(docs, labels, label_col, train, id_col, text_col, sample)

    def run(batches):
        memo = {}
        for b in batches:
            texts = b.column("text").to_pylist()
            for s in range(0, len(texts), BLOCK):
                x = term_shares([t or "" for t in texts[s:s + BLOCK]], memo)
                cells = [np.flatnonzero(r) for r in x]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c.astype(np.int32) for c in cells], pa.list_(pa.int32())),
                     pa.array([r[c] for r, c in zip(x, cells)], pa.list_(pa.float32())),
                     b.column("label").slice(s, BLOCK)], ["at", "share", "label"])

    # the sample's non-zero terms, some dozens a row: bounded by the sample's size
    got = rows.mapInArrow(run, "at array<int>, share array<float>, label int").collect()
    got.sort(key=lambda r: (r.at, r.share, r.label))         # not in the order that tasks finish
    x = np.zeros((len(got), WIDTH), np.float32)
    for k, r in enumerate(got):
        x[k, r.at] = r.share
    return fit(x, np.array([r.label for r in got], np.float32))


def score_documents(docs: DataFrame, model: SimpleNamespace, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` plus ``out_col``: the neighbours' vote for label 1."""
    out_col = free_name(docs, out_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        memo = worker_cache("quality-shapes", dict)
        out = []
        for s in range(0, len(text), BLOCK):
            texts = [t or "" for t in text.slice(s, BLOCK).to_pylist()]
            out.append(vote(term_shares(texts, memo), shared.value))
        return pa.array(np.concatenate(out) if out else [], pa.float64())

    return docs.withColumn(out_col, score.asNondeterministic()(F.col(text_col)))

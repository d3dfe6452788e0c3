"""Toxicity by weak supervision: many lexicon and pattern voters, a generative label model, a linear classifier.

1. A bounded sample of labelled ids is drawn (``SAMPLE`` ids, by hash of the id), with one text for each.
2. Lexicon entries (words and word beginnings that mostly occur in toxic texts) are mined from the sample.
   Entries of one stem form a lexicon, each lexicon is a voter; pattern voters look at how many entries a
   text has, how densely, and whether it has none. A voter says toxic, clean, or nothing.
3. A generative label model is fitted to the votes by expectation maximisation: each voter's vote
   probabilities under either label (with a weak prior from the seen, noisy labels), and the correlation of
   voters given the label, by which votes that repeat each other are discounted. It gives every sample text
   a posterior label.
4. Logistic regression on the texts' voter counts learns the posterior labels; it scores all texts.

Model and lexicons are bounded by parameters and broadcast; the documents are scanned once for scoring and
never shuffled. Labels of held-out rows, and lang, source and id, are never inputs.

Defined cases: null text is empty text; a text without any entry gets the classifier's base score; labels
that are null or of ids outside the documents teach nothing, of repeated labels the greatest counts; repeated
document rows are scored each for itself, and of those of a drawn id one is learned from; without a usable label of both kinds every score is the share of
toxic labels (0 without labels); other columns are
kept (if one is named like ``out_col``, the new one gets an underscore behind its name). The lexicon keeps at most ``max_entries`` entries:
a rarer toxic word beyond them does not count as a hit.
"""

from __future__ import annotations

import uuid
from collections import Counter
from itertools import repeat
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, staged, worker_cache

SAMPLE = 20_000          # labelled rows to learn from
PREFIXES = (3, 4, 5, 6)  # lengths of word beginnings tried as entries
STEM = 3                 # entries that share so many first letters form one lexicon
MIN_TOXIC = 6            # toxic sample texts that an entry must occur in, at least,
MIN_TOXIC_SHARE = 0.008  # and at least this share of the toxic sample texts
MIN_PRECISION = 0.6      # share of toxic texts among an entry's sample texts
MAX_ENTRIES = 4096       # entries kept, those in most toxic sample texts; a parameter of ``train_model``
MAX_LEXICONS = 96
MEMO_SIZE = 200_000      # words remembered per worker
THRESHOLD = 0.7

# ASCII other than letters ends a word
_SPLIT = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().translate(_SPLIT).split()


def terms_of(word: bytes) -> list[str]:
    """A word's possible entries: itself, and its beginnings (marked by a star)."""
    w = word.decode()
    return [w, *[w[:k] + "*" for k in PREFIXES if len(w) > k]]


# ------------------------------------------------------------------- lexicons ---

def _count_terms(batches):
    """Sample texts -> in how many toxic and clean texts each term occurs."""
    count = {1: Counter(), 0: Counter()}
    for b in batches:
        for text, y in zip(b.column("text").to_pylist(), b.column("label").to_pylist()):
            count[y].update({t for w in set(words_of(text or "")) for t in terms_of(w)})
    terms = list(count[1])         # terms of clean texts only can never be entries here, but may be elsewhere
    rest = [t for t in count[0] if t not in count[1]]
    for k in range(0, len(terms) + len(rest), 50_000):
        part = (terms + rest)[k:k + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([count[1][t] for t in part], pa.int64()),
                                          pa.array([count[0][t] for t in part], pa.int64())], ["term", "toxic", "clean"])


def group_lexicons(entries: list[tuple[str, int, int]], max_lexicons: int = MAX_LEXICONS) -> dict[str, int]:
    """Entry -> lexicon number. Lexicons are stems, the most frequent first; the last takes all others."""
    weight = Counter()
    for term, toxic, _ in entries:
        weight[term.rstrip("*")[:STEM]] += toxic
    rank = {stem: min(k, max_lexicons - 1) for k, (stem, _) in enumerate(sorted(weight.items(), key=lambda x: (-x[1], x[0])))}
    return {term: rank[term.rstrip("*")[:STEM]] for term, _, _ in entries}


def lexicon_of(word: bytes, lexicon: dict[str, int]) -> int:
    """The lexicon that the word hits, or -1: the word itself decides before its beginnings."""
    for t in terms_of(word):
        if (n := lexicon.get(t)) is not None:
            return n
    return -1


def features(texts: list[str], lexicon: dict[str, int], n_lexicons: int, memo: dict[bytes, int]) -> np.ndarray:
    """Per text: hits of each lexicon, then all hits, distinct hit words, words."""
    out = np.zeros((len(texts), n_lexicons + 3))
    for r, text in enumerate(texts):
        words = words_of(text)
        new = set(words).difference(memo)
        if new:
            if len(memo) + len(new) > MEMO_SIZE:
                memo.clear()
                new = set(words)
            memo.update(zip(new, map(lexicon_of, new, repeat(lexicon))))
        hit = np.fromiter(map(memo.__getitem__, words), np.int64, len(words))
        at = np.flatnonzero(hit >= 0)
        out[r, :n_lexicons] = np.bincount(hit[at], minlength=n_lexicons)
        out[r, n_lexicons:] = len(at), len({words[k] for k in at.tolist()}), len(words)
    return out


def votes(x: np.ndarray) -> np.ndarray:
    """(texts, voters) of 1 toxic, -1 clean, 0 nothing: one voter a lexicon, then the patterns."""
    hits, distinct, words = x[:, -3], x[:, -2], x[:, -1]
    dense = hits / np.maximum(words, 1)
    stray = dense < 0.006                                              # what chance words make of it
    patterns = [
        np.where(hits == 0, -1, 0),                                    # no entry at all
        np.where(stray, -1, np.where(distinct >= 2, 1, 0)),            # several different entries
        np.where(stray, -1, np.where(hits >= 3, 1, 0)),                # many entries
        np.where(dense >= 0.01, 1, np.where(stray, -1, 0)),            # dense, or only stray entries
        np.where(dense >= 0.015, 1, 0),
    ]
    return np.column_stack([x[:, :-3] > 0, *patterns]).astype(np.int8)


# ----------------------------------------------------------------- label model ---

def label_model(v: np.ndarray, seen: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Posterior probability of toxic for each row of votes.

    Expectation maximisation over the (vote | label) probabilities of each voter and the label's prior; the
    seen, noisy labels give the starting point and a Dirichlet prior of one count each, so that the hidden
    label stays the one they name. A voter's evidence is its log likelihood ratio; voters whose evidence goes
    together beyond the label are discounted by the sum of their positive correlations given the label."""
    y = np.asarray(seen, float)
    p = np.clip(y, 0.05, 0.95)
    for _ in range(rounds):
        pos, neg = p.sum() + y.sum(), (1 - p).sum() + (1 - y).sum()
        prior = np.clip((pos + 1) / (pos + neg + 2), 1e-4, 1 - 1e-4)
        ratio = np.zeros(v.shape)
        for value in (-1, 0, 1):
            is_v = v == value
            a = ((p + y) @ is_v + 0.5) / (pos + 1.5)
            b = ((2 - p - y) @ is_v + 0.5) / (neg + 1.5)
            ratio += is_v * np.log(a / b)
        w = p.sum(), (1 - p).sum()
        centred = ratio - np.outer(p, p @ ratio / max(w[0], 1e-9)) - np.outer(1 - p, (1 - p) @ ratio / max(w[1], 1e-9))
        sd = np.sqrt((centred ** 2).mean(0)) + 1e-9
        corr = (centred / sd).T @ (centred / sd) / len(v)
        discount = 1 / np.maximum(1, np.clip(corr, 0, None).sum(0))
        logit = np.log(prior / (1 - prior)) + ratio @ discount
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return p


def design(x: np.ndarray) -> np.ndarray:
    """Features of the linear classifier."""
    hits, distinct, words = x[:, -3], x[:, -2], x[:, -1]
    dense = hits / np.maximum(words, 1)
    return np.column_stack([np.log1p(x[:, :-3]), np.log1p(hits), np.log1p(distinct), np.minimum(dense, 0.1) * 50,
                            np.minimum(dense, 0.015) * 100, dense < 0.006, hits == 0, hits == 1])


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights (bias last) for soft labels, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    reg = np.full(len(w), l2)
    reg[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + reg * w
        hess = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(reg)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    return w


# ------------------------------------------------------------------ Spark jobs ---

def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, train: Column, id_col: str, text_col: str,
                    size: int) -> DataFrame:
    """Staged (text, label) of at most ``size`` labelled ids, by hash of the id, one row each: of several rows of
    an id the text with the least hash, picked by a partial aggregate. The drawn ids are broadcast, so the
    documents are only scanned."""
    drawn = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & train)
                   .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("label"))
                   .orderBy(F.xxhash64("_id"), "_id").limit(size))
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).alias("_id"), F.struct(F.xxhash64(text).alias("hash"), text.alias("text")).alias("t"))
    one = texts.join(F.broadcast(drawn), "_id").groupBy("_id").agg(F.min("t").alias("t"), F.max("label").alias("label"))
    return staged(one.select("t.text", "label"), "labelled-sample")


def train_model(docs: DataFrame, labels: DataFrame, train: Column, label_col: str = "toxic", id_col: str = "doc_id",
                text_col: str = "text", sample: int = SAMPLE, max_entries: int = MAX_ENTRIES) -> SimpleNamespace:
    """Lexicons and classifier weights, learned from labelled rows for which ``train`` (over the labels'
    columns) holds: at most ``sample`` of them, and ``max_entries`` lexicon entries."""
    rows = labelled_sample(docs, labels, label_col, train, id_col, text_col, sample)
    n, n_toxic = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    least = max(MIN_TOXIC, MIN_TOXIC_SHARE * n_toxic)
    entries = (rows.mapInArrow(_count_terms, "term string, toxic bigint, clean bigint").groupBy("term")
                   .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
                   .where((F.col("toxic") >= least) & (F.col("toxic") >= MIN_PRECISION * (F.col("toxic") + F.col("clean") + 2)))
                   .orderBy(F.desc("toxic"), "clean", "term").limit(max_entries).collect())
    share = n_toxic / n if n else 0.0
    if not entries or n_toxic in (0, n):
        return SimpleNamespace(lexicon={}, n=0, weights=None, share=share)
    lexicon = group_lexicons([tuple(e) for e in entries])
    k = max(lexicon.values()) + 1

    def run(batches):
        memo = {}
        for b in batches:
            x = features([t or "" for t in b.column("text").to_pylist()], lexicon, k, memo)
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), b.column("label")], ["x", "label"])

    # one row of a few dozen numbers for each sample text: bounded by the sample's size
    got = sorted(rows.mapInArrow(run, "x array<double>, label int").collect(), key=lambda r: (r.x, r.label))
    x, seen = np.array([r.x for r in got]), np.array([r.label for r in got])
    posterior = label_model(votes(x), seen)
    return SimpleNamespace(lexicon=lexicon, n=k, weights=logistic(design(x), posterior), share=share)


def score_texts(texts: list[str], model, memo: dict[bytes, int]) -> np.ndarray:
    if model.weights is None:
        return np.full(len(texts), model.share)
    x = design(features(texts, model.lexicon, model.n, memo))
    return 1 / (1 + np.exp(-np.clip(x @ model.weights[:-1] + model.weights[-1], -30, 30)))


def score_documents(docs: DataFrame, model: SimpleNamespace, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` plus ``out_col``: probability that the whole text is toxic."""
    out_col = free_name(docs, out_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    token = uuid.uuid4().hex         # what a worker remembers of words holds for this model only

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        memo = worker_cache(("toxicity", token), dict)
        return pa.array(score_texts([t or "" for t in text.to_pylist()], shared.value, memo), pa.float64())

    return docs.withColumn(out_col, score.asNondeterministic()(F.col(text_col)))

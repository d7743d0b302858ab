"""Toxicity by a classifier chain.

Categories are predicted one after the other: kinds of toxic texts, then `toxic`, the label itself. A
category's linear model sees how often the text has each of a few hundred telling words or beginnings
of words (inflected languages have many forms of one stem), and the probabilities of all earlier
categories. In training, those probabilities are out-of-fold predictions, so that a later model
learns how far it can trust the earlier ones on texts they have not seen.

Labels may have several columns: then the chain predicts them in the order given. Where there is only
one, toxic or not, its kinds come from the data: the labelled toxic texts are clustered (spherical
k-means over their telling words, weighted by rarity), and each cluster is a category.

Training takes the MAX_LABELLED labelled documents with the least hash of their id; they are scored
on the driver. The model (under 20 kB) then scores all documents where they lie: no shuffle.

Cases: a null or empty text has no words and gets the models' base rates; labels without a document,
or with nulls, are left out; a document with several labels counts as often; without labelled rows
all probabilities are null; without rows of both classes a model is its base rate; ties in the
choice of rows or words go by hash; repeated rows are scored alike; an empty table gives an empty
result; very long texts count in whole; other columns are not carried; labels are compared with 0, a
label that is null leaves its row out; one id with several texts is several examples.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import read_table
from tidemark.llm.shingles import LETTERS, mix, slices, word_hashes

#: So many labelled documents at most are learnt from (a parameter of `train`).
MAX_LABELLED = 8_000
#: Kinds of toxic texts, where there is one label only.
KINDS = 2
N_WORDS = 400
#: Bytes of the beginnings of words that count, besides whole words.
PREFIXES = (0, 6, 7, 8)
FOLDS = 5
BUCKET_BITS = 18

@dataclass
class Chain:
    names: tuple[str, ...]  # of the categories
    buckets: np.ndarray  # of the words that count
    weights: list[np.ndarray]  # by category: the words', the earlier categories', the base

    def predict(self, counts: np.ndarray) -> np.ndarray:
        """Rows x categories, from rows x words."""
        x = np.log1p(counts)
        p = np.zeros((len(x), 0))
        for w in self.weights:
            p = np.column_stack([p, _sigmoid(np.column_stack([x, p, np.ones(len(x))]) @ w)])
        return p


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 12) -> np.ndarray:
    """Weights of a ridge logistic regression; the last column of x is the base, which isn't shrunk."""
    w = np.zeros(x.shape[1])
    share = np.clip(y.mean() if len(y) else 0.0, 1e-3, 1 - 1e-3)
    w[-1] = np.log(share / (1 - share))
    if not 0 < y.sum() < len(y):
        return w
    shrink = np.full(x.shape[1], ridge)
    shrink[-1] = 1e-6
    for _ in range(rounds):
        p = _sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(shrink), x.T @ (y - p) - shrink * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def bucket_of(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all words and beginnings of words, and the row of each."""
    buckets, of = [], []
    for prefix in PREFIXES:
        words, rows = word_hashes(data, offsets, LETTERS, prefix)
        with np.errstate(over="ignore"):
            buckets.append(bucket_of(mix(words + np.uint64(prefix))))
        of.append(np.repeat(np.arange(len(offsets) - 1), np.diff(rows)))
    return np.concatenate(buckets), np.concatenate(of)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, labels, buckets, counts) of (doc_id, labels, text): the buckets of a text's distinct words."""
    for batch in batches:
        for first, data, offsets in slices(batch.column(2)):
            buckets, of = features(data, offsets)
            order = np.argsort(of, kind="stable")
            rows = np.searchsorted(of[order], np.arange(len(offsets)))
            own = [np.unique(buckets[order[a:b]], return_counts=True) for a, b in zip(rows, rows[1:], strict=False)]
            yield pa.record_batch(
                [batch.column(0).slice(first, len(own)), batch.column(1).slice(first, len(own)), pa.array([x.astype(np.int32).tobytes() for x, _ in own], pa.binary()), pa.array([n.astype(np.int32).tobytes() for _, n in own], pa.binary())],
                names=["doc_id", "labels", "buckets", "counts"],
            )


def kinds_of(x: np.ndarray, kinds: int = KINDS, rounds: int = 30) -> np.ndarray:
    """The cluster of each row, largest first: spherical k-means, started from rows far from each other."""
    if not len(x):
        return np.zeros(0, np.int64)
    own = x * np.log((len(x) + 1) / ((x > 0).sum(axis=0) + 0.5))
    own = own / np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-9)
    centre = own.mean(axis=0)
    starts = [int(np.argmax(own @ centre))]
    while len(starts) < min(kinds, len(own)):
        starts.append(int(np.argmin((own @ own[starts].T).max(axis=1))))
    centres, of = own[starts], np.zeros(len(own), np.int64)
    for _ in range(rounds if len(starts) > 1 else 0):
        of = np.argmax(own @ centres.T, axis=1)
        sums = np.array([own[of == k].sum(axis=0) for k in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    sizes = np.bincount(of, minlength=kinds)
    return np.argsort(np.argsort(-sizes, kind="stable"))[of]


def chained(x: np.ndarray, goals: list[np.ndarray]) -> list[np.ndarray]:
    """The weights of each category's model: over x, the out-of-fold probabilities of the earlier ones, and the base. Row k is in fold k % FOLDS."""
    n = len(x)
    fold = np.arange(n) % FOLDS
    earlier, weights = np.zeros((n, 0)), []
    for y in goals:
        full = np.column_stack([x, earlier, np.ones(n)])
        weights.append(logistic(full, y))
        out_of_fold = np.zeros(n)
        for f in range(FOLDS):
            if (fold == f).any():
                out_of_fold[fold == f] = _sigmoid(full[fold == f] @ logistic(full[fold != f], y[fold != f]))
        earlier = np.column_stack([earlier, out_of_fold])
    return weights


def fit(examples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, names: tuple[str, ...] = ("toxic",), n_words: int = N_WORDS) -> Chain:
    """The chain of examples (buckets, counts), in the order that deals them over the folds. labels: rows x names; the last is the label itself."""
    toxic = labels[:, -1]
    present, with_toxic = np.zeros(1 << BUCKET_BITS), np.zeros(1 << BUCKET_BITS)
    for (own, _), t in zip(examples, toxic, strict=True):
        present[own] += 1
        with_toxic[own] += t
    n, share = len(toxic), toxic.mean()
    # Chi-square of a word's presence against the label.
    expected = present * share
    spread = np.maximum(present * share * (1 - share) * (1 - present / n), 1e-9)
    telling = np.where(present >= 3, (with_toxic - expected) ** 2 / spread, 0)
    chosen = np.argsort(-telling, kind="stable")[:n_words]
    place = np.full(1 << BUCKET_BITS, -1)
    place[chosen] = np.arange(len(chosen))
    x = np.zeros((n, len(chosen)))
    for r, (own, count) in enumerate(examples):
        at = place[own]
        x[r, at[at >= 0]] = np.log1p(count[at >= 0])
    goals = list(labels.T.astype(float))
    if len(names) == 1:
        names = (*(f"kind_{k + 1}" for k in range(KINDS)), *names)
        of = np.full(n, -1)
        of[toxic > 0] = kinds_of(x[toxic > 0])
        goals = [*((of == k).astype(float) for k in range(KINDS)), *goals]
    return Chain(names, chosen, chained(x, goals))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str | tuple[str, ...] = "toxic", max_labelled: int = MAX_LABELLED) -> Chain | None:
    """The chain learnt from at most max_labelled labelled documents; None without any. label: one column, or several in the chain's order."""
    names = (label,) if isinstance(label, str) else tuple(label)
    rows = labels.select(F.col(key).alias("doc_id"), *[(F.col(c).cast("double") != 0).cast("string").alias(f"l{k}") for k, c in enumerate(names)]).dropna()
    rows = rows.select("doc_id", F.concat_ws(",", *[f"l{k}" for k in range(len(names))]).alias("labels"))
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("labels")]
    rows = rows.orderBy(*order).limit(max_labelled)
    own = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(rows), "doc_id").select("doc_id", "labels", "text")
    counted = own.mapInArrow(_count, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, labels string, buckets binary, counts binary")
    found = counted.orderBy(*order, "buckets", "counts").limit(max_labelled).collect()
    if not found:
        return None
    examples = [(np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["counts"], np.int32)) for r in found]
    return fit(examples, np.array([[x == "true" for x in r["labels"].split(",")] for r in found], float), names)


def _score(chain: Chain | None, names: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(1 << BUCKET_BITS, -1)
        if chain is not None:
            place[chain.buckets] = np.arange(len(chain.buckets))
        for batch in batches:
            for first, data, offsets in slices(batch.column(1)):
                n = len(offsets) - 1
                ids = batch.column(0).slice(first, n)
                if chain is None:
                    yield pa.record_batch([ids, *[pa.nulls(n, pa.float64())] * len(names)], names=["id", *names])
                    continue
                buckets, doc = features(data, offsets)
                at = place[buckets]
                width = len(chain.buckets)
                counts = np.bincount(doc[at >= 0] * width + at[at >= 0], minlength=n * width).reshape(n, width)
                p = chain.predict(counts)
                yield pa.record_batch([ids, *[pa.array(p[:, k]) for k in range(len(names))]], names=["id", *names])

    return run


def score(docs: DataFrame, chain: Chain | None, key: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """(key, p_ + each category, toxic): one row for each row of docs. toxic: whether the last category reaches the threshold."""
    names = chain.names if chain else (*(f"kind_{k + 1}" for k in range(KINDS)), "toxic")
    rows = docs.select(key, F.col(text).cast("string"))
    columns = [f"c{k}" for k in range(len(names))]
    out = rows.mapInArrow(_score(chain, tuple(columns)), f"id {rows.schema[0].dataType.simpleString()}, " + ", ".join(f"{c} double" for c in columns))
    return out.select(F.col("id").alias(key), *[F.col(c).alias(f"p_{n}") for c, n in zip(columns, names, strict=True)], (F.col(columns[-1]) >= threshold).alias("toxic"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return score(docs, train(docs, read_table(spark, sf_dir, "labels")))

"""Quality classifier from learned subword embeddings.

A document is the average of the vectors of its features: every word, its character n-grams with
word boundaries, and every pair of neighbouring words, each hashed into a table of vectors. A
softmax layer turns the average into class probabilities. Table and layer are trained together by
stochastic gradient descent in numpy on a bounded sample of labelled documents. Since average and
layer are linear, scoring needs one number per feature, which a worker keeps by word.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.llm.tokens import CACHED_WORDS, mix, slices, text_bytes

BUCKETS = 1 << 17
DIMENSIONS = 12
SHORTEST, LONGEST = 3, 5
EPOCHS = 4
# Small samples are gone through more often, up to so many steps.
LEAST_STEPS = 6_000
RATE = 1.0
# Labelled documents used for training at most; the classifier doesn't need more, whatever the corpus.
MAX_ROWS = 3_000


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def word_features(words: list[bytes], hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word and its character n-grams, one word after the other, and their number by word."""
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    text = np.frombuffer(b"<" + b"><".join(words) + b">", np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    end = np.repeat(np.cumsum(sizes), sizes)
    owner, buckets = [np.arange(len(words))], [hashes]
    for n in range(SHORTEST, LONGEST + 1):
        start = np.flatnonzero(np.arange(len(text)) + n <= end)
        # Up to five bytes and their number are the n-gram itself; mixing spreads them over the buckets.
        gram = np.full(len(start), n << 56, np.uint64)
        for k in range(n):
            gram |= text[start + k] << np.uint64(8 * k)
        owner.append(np.repeat(np.arange(len(words)), sizes)[start])
        buckets.append(mix(gram))
    order = np.argsort(np.concatenate(owner), kind="stable")
    return (
        (np.concatenate(buckets)[order] % np.uint64(BUCKETS)).astype(np.int64),
        np.bincount(np.concatenate(owner), minlength=len(words)),
    )


def pair_features(hashes: np.ndarray) -> np.ndarray:
    """Buckets of neighbouring word pairs; a word followed by itself is one feature, whichever word it is."""
    if len(hashes) < 2:
        return np.empty(0, np.int64)
    both = mix(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])
    both[hashes[:-1] == hashes[1:]] = 7
    return (both % np.uint64(BUCKETS)).astype(np.int64)


def _split(text: bytes | None) -> list[bytes]:
    return text.split() if text else []


def features(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and how often each occurs."""
    words = _split(text)
    if not words:
        return np.empty(0, np.int64), np.empty(0)
    distinct: dict[bytes, int] = {}
    at = np.array([distinct.setdefault(w, len(distinct)) for w in words])
    hashes = word_hashes(list(distinct))
    buckets, sizes = word_features(list(distinct), hashes)
    times = np.repeat(np.bincount(at), sizes)
    pairs = pair_features(hashes[at])
    values, place = np.unique(np.concatenate([buckets, pairs]), return_inverse=True)
    return values, np.bincount(place, weights=np.concatenate([times, np.ones(len(pairs))]))


def fit(texts: list[bytes | None], labels: list[int], epochs: int = EPOCHS, rate: float = RATE) -> tuple[np.ndarray, float]:
    """(one weight per bucket, bias) of the log odds of label 1."""
    rows = [features(t) for t in texts]
    random = np.random.default_rng(5)
    table = random.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer, bias = np.zeros((DIMENSIONS, 2)), np.zeros(2)
    share = np.bincount(labels, minlength=2)[:2] / max(1, len(labels))
    if len(labels) and share.min() > 0:
        bias = np.log(share)
    epochs = max(epochs, -(-LEAST_STEPS // max(1, len(rows))))
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for k in random.permutation(len(rows)):
            speed = rate * (1 - done / steps)
            done += 1
            ids, counts = rows[k]
            if not len(ids):
                continue
            weight = counts / counts.sum()
            vector = weight @ table[ids]
            odds = vector @ layer + bias
            p = np.exp(odds - odds.max())
            p /= p.sum()
            p[labels[k]] -= 1
            back = layer @ p
            layer -= speed * np.outer(vector, p)
            bias -= speed * 0.1 * p
            table[ids] -= (speed * len(ids) ** 0.5 * weight[:, None] * back).astype(np.float32)
    return table @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0])


def _fitted(epochs: int, rate: float):
    def run(group: pa.Table) -> pa.Table:
        order = np.argsort(group.column("doc_id").to_numpy(), kind="stable")
        texts, labels = text_bytes(group.column("text").combine_chunks()), group.column("label").to_pylist()
        weights, bias = fit([texts[k] for k in order], [labels[k] for k in order], epochs, rate)
        return pa.table(
            {"weights": pa.array([weights.astype(np.float32).tobytes()], pa.binary()), "bias": pa.array([bias])}
        )

    return run


class Classifier:
    """Log odds of label 1: one weight per bucket and a bias."""

    def __init__(self, weights: np.ndarray, bias: float) -> None:
        self.weights, self.bias = weights, bias


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, epochs: int = EPOCHS, rate: float = RATE) -> Classifier:
    """Learn from documents (doc_id, text) that ``labels`` (doc_id, label 0/1) names.

    ``max_rows`` documents at most, chosen by a hash of the id, so the sample doesn't depend on
    order or partitions. Null ids and labels are ignored; of repeated labels or documents the
    smallest counts. Without labels, or with one class only, every score is that of the bias.
    """
    known = (
        labels.where("doc_id is not null and label in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min(F.col("label").cast("int")).alias("label"))
    )
    named = docs.select("doc_id").join(known, "doc_id").distinct()
    # At most max_rows ids and labels: a bounded list.
    chosen = named.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    sample = docs.select("doc_id", "text").join(chosen, "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.first("label").alias("label")
    )
    learned = sample.withColumn("everything", F.lit(1)).groupBy("everything").applyInArrow(_fitted(epochs, rate), "weights binary, bias double").collect()
    if not learned:
        return Classifier(np.zeros(BUCKETS, np.float32), 0.0)
    return Classifier(np.frombuffer(bytes(learned[0]["weights"]), np.float32), learned[0]["bias"])


class _Scorer:
    """Texts → probabilities of label 1; remembers hash, feature sum and feature number by word."""

    def __init__(self, weights: np.ndarray, bias: float) -> None:
        self.weights, self.bias = weights.astype(np.float64), bias
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[bytes, int] = {}
        self.hashes, self.sums, self.sizes = np.empty(0, np.uint64), np.empty(0), np.empty(0, np.int64)

    def _learn(self, new: list[bytes]) -> None:
        if len(self.slot) + len(new) > CACHED_WORDS:
            self._forget()
        hashes = word_hashes(new)
        buckets, sizes = word_features(new, hashes)
        sums = np.bincount(np.repeat(np.arange(len(new)), sizes), weights=self.weights[buckets], minlength=len(new))
        self.slot.update(zip(new, range(len(self.slot), len(self.slot) + len(new))))
        self.hashes, self.sums = np.concatenate([self.hashes, hashes]), np.concatenate([self.sums, sums])
        self.sizes = np.concatenate([self.sizes, sizes])

    def scores(self, texts: list[bytes | None]) -> list[float]:
        split = [_split(t) for t in texts]
        distinct = set().union(*split)
        if new := [w for w in distinct if w not in self.slot]:
            known = len(self.slot)
            self._learn(new)
            if len(self.slot) < known + len(new):
                # Everything was forgotten on the way.
                self._learn([w for w in distinct if w not in self.slot])
        return [self._score(words) for words in split]

    def _score(self, words: list[bytes]) -> float:
        odds = self.bias
        if words:
            at = np.fromiter(map(self.slot.__getitem__, words), np.int64, len(words))
            pairs = pair_features(self.hashes[at])
            odds += float(self.sums[at].sum() + self.weights[pairs].sum()) / int(self.sizes[at].sum() + len(pairs))
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))


def score_documents(docs: DataFrame, model: Classifier, keep: list[Column]) -> DataFrame:
    """``keep`` columns of ``docs`` (text) with ``score``: the probability of label 1.

    A null, empty or blank text has no features: its score is that of the bias. Repeated rows come
    back as often as given; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    rows = docs.select(*keep, F.col("text").cast("string").alias("__text"))
    names = [f.name for f in rows.schema.fields if f.name != "__text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(*shared.value)
        for batch in slices(batches, 500):
            scores = scorer.scores(text_bytes(batch.column("__text")))
            yield pa.record_batch({n: batch.column(n) for n in names} | {"score": pa.array(scores, pa.float64())})

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "__text")
    return rows.mapInArrow(run, f"{fields}, score double")


def accepted(docs: DataFrame, model: Classifier, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` (text) that score at least ``least``, filtered where they are read."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(*shared.value)
        for batch in slices(batches, 500):
            good = [s >= least for s in scorer.scores(text_bytes(batch.column("text")))]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

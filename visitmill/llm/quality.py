"""Quality of a text by supervised subword embeddings.

A document is the mean of learned vectors, one per hashed word and character n-gram; a softmax over it
gives the classes. Vectors and softmax are trained here in numpy by stochastic gradient descent on a
bounded sample of labelled documents. As the score is linear in the mean, a text is scored with one
number per bucket: its logit is the mean of these numbers over all its words and n-grams.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmill.llm.common import extended, held_out, query, sample_window, slices, table, uniform

# The sample that is learned from: documents per class, and code points of each. A longer text counts with a window of that
# length, so that no text takes the room of others.
DOCUMENTS, SAMPLE_CHARS = 1500, 16 * 1024
BUCKETS, DIMENSIONS, NGRAMS, EPOCHS, BATCH, RATE, SEED = 1 << 17, 8, (3, 4), 6, 32, 0.5, 11
THRESHOLD = 0.7
SLICE_BYTES = 2 * 1024 * 1024

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)  # 2^64 divided by the golden ratio, odd
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def features(
    data: np.ndarray, buckets: int, starts: np.ndarray | None = None
) -> list[tuple[np.ndarray, np.ndarray]]:
    """(place, bucket) of all n-grams, words and word repeats of a byte array; a word's place is its end.

    ``starts`` says where texts begin, if there are several.

    An n-gram may touch blanks but holds none inside, so that it sees where words begin and end.
    """
    shift = np.uint64(64 - (buckets - 1).bit_length())
    wide = data.astype(np.uint64) + np.uint64(1)
    blank = BLANK[data]
    out = []
    for n in NGRAMS:
        count = len(data) - n + 1
        if count <= 0:
            continue
        h = np.full(count, n, np.uint64)
        for i in range(n):
            h *= np.uint64(259)
            h += wide[i : i + count]
        h *= MULTIPLIER
        h >>= shift
        inside = np.zeros(count, bool)
        for i in range(1, n - 1):
            inside |= blank[i : i + count]
        keep = np.flatnonzero(~inside)
        out.append((keep, h[keep].astype(np.int32)))
    first = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]])) if len(data) else np.zeros(0, int)
    if len(first):
        # A word's hash is a sum over its letters and their places.
        last = np.flatnonzero(~blank & np.concatenate([blank[1:], [True]]))
        lengths = last - first + 1
        began = np.zeros(len(data), np.int64)
        began[first] = first
        inner = (np.arange(len(data)) - np.maximum.accumulate(began)).astype(np.uint64)
        term = wide * (inner * np.uint64(2) + np.uint64(1)) * MULTIPLIER
        term ^= term >> np.uint64(29)
        term *= np.uint64(0xBF58476D1CE4E5B9)
        term[blank] = 0
        h = np.add.reduceat(term, first) + lengths.astype(np.uint64)
        h *= MULTIPLIER
        out.append((last, (h >> shift).astype(np.int32)))
        # The word bigram that says the same word again has a bucket of its own for any word.
        again = np.where(h[1:] == h[:-1], 0, 1).astype(np.int32)
        text = np.searchsorted(starts, last, "right") if starts is not None else np.zeros(len(last), int)
        together = text[1:] == text[:-1]
        out.append((last[1:][together], again[together]))
    return out


def bag(text: bytes, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their shares."""
    found = features(np.frombuffer(b" " + text + b" ", np.uint8), buckets)
    every = np.concatenate([b for _, b in found]) if found else np.zeros(0, np.int32)
    if not len(every):
        return every, np.zeros(0, np.float32)
    ids, counts = np.unique(every, return_counts=True)
    return ids, (counts / len(every)).astype(np.float32)


@dataclass
class Classifier:
    """Vectors of the buckets, softmax weights and bias for classes 0 and 1."""

    vectors: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def slopes(self) -> np.ndarray:
        """What each bucket adds to the logit of class 1 against class 0."""
        return (self.vectors @ (self.weights[:, 1] - self.weights[:, 0])).astype(np.float32)

    def offset(self) -> float:
        return float(self.bias[1] - self.bias[0])


def train(
    labelled: list[tuple[int, bytes]], *, buckets: int = BUCKETS, dimensions: int = DIMENSIONS, epochs: int = EPOCHS, seed: int = SEED
) -> Classifier:
    """Learn from (class, text) pairs; both classes weigh the same in the vectors, the bias has their share."""
    rng = np.random.default_rng(seed)
    model = Classifier(
        rng.uniform(-1, 1, (buckets, dimensions)).astype(np.float32) / dimensions,
        rng.normal(0, 0.5, (dimensions, 2)).astype(np.float32),
        np.zeros(2, np.float32),
    )
    y = np.array([label for label, _ in labelled])
    share = np.bincount(y, minlength=2) + 0.5
    bags = [bag(text, buckets) for _, text in labelled]
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            rate = RATE * (1 - (epoch + at / len(order)) / epochs)
            rows = [i for i in order[at : at + BATCH] if len(bags[i][0])]
            if not rows:
                continue
            ids = np.concatenate([bags[i][0] for i in rows])
            shares = np.concatenate([bags[i][1] for i in rows])
            sizes = np.array([len(bags[i][0]) for i in rows])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            mean = np.add.reduceat(model.vectors[ids] * shares[:, None], starts, axis=0)
            logits = mean @ model.weights + model.bias
            logits -= logits.max(axis=1, keepdims=True)
            p = np.exp(logits)
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            down = p @ model.weights.T
            model.weights -= rate / len(rows) * (mean.T @ p) * 4
            model.bias -= rate / len(rows) * p.sum(axis=0)
            for i, step in zip(rows, down):
                # A share is small; the step is scaled up so that a text as a whole moves by the rate.
                own, part = bags[i]
                model.vectors[own] -= (rate * np.sqrt(len(own)) * part)[:, None] * step
    return calibrated(model, bags, y, share)


def calibrated(model: Classifier, bags: list, y: np.ndarray, share: np.ndarray) -> Classifier:
    """Scale and shift the logit so that the scores are probabilities on the sample (Newton steps)."""
    slopes, offset = model.slopes(), model.offset()
    logit = np.array([float(slopes[i] @ s) + offset for i, s in bags])
    a, b = 1.0, 0.0
    # Soft targets keep the scale finite where the classes part cleanly.
    target = np.where(y == 1, (share[1] + 0.5) / (share[1] + 1.5), 1 / (share[0] + 1.5))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * logit + b, -30, 30)))
        w = p * (1 - p) + 1e-6
        g = np.array([((p - target) * logit).sum() + 1e-3 * (a - 1), (p - target).sum()])
        h = np.array([[(w * logit * logit).sum() + 1e-3, (w * logit).sum()], [(w * logit).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - float(np.clip(step[0], -2, 2)), b - float(np.clip(step[1], -2, 2))
    a = max(a, 1e-3)
    weights = model.weights * a
    bias = np.array([0.0, model.offset() * a + b], np.float32)
    return Classifier(model.vectors, weights.astype(np.float32), bias)


def score_texts(slopes: np.ndarray, offset: float, texts: list[bytes]) -> list[float]:
    """Probability of class 1 for each text, from sums over one joined buffer."""
    data = np.frombuffer(b" " + b" \n ".join(texts) + b" ", np.uint8)
    lengths = np.array([len(t) for t in texts])
    # Bounds of the texts' stretches, with one blank on each side.
    ends = np.cumsum(lengths + 3)
    starts = ends - lengths - 3
    total, count = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    buckets = len(slopes)
    for place, bucket in features(data, buckets, starts):
        cumulated = np.concatenate([[0.0], np.cumsum(slopes[bucket], dtype=np.float64)])
        low, high = np.searchsorted(place, starts), np.searchsorted(place, starts + lengths + 2)
        # An n-gram that reaches beyond the blank after a text holds blanks inside; the features leave it out.
        total += cumulated[high] - cumulated[low]
        count += high - low
    logit = total / np.maximum(count, 1) + offset
    return (1 / (1 + np.exp(-np.clip(logit, -500, 500)))).tolist()


def _scoring(slopes: np.ndarray, offset: float, threshold: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                scores = score_texts(slopes, offset, [(t or "").encode() for t in part.column("text").to_pylist()])
                kept = part.drop_columns(["text"])
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())],
                    names=[*kept.schema.names, "score", "predicted"],
                )

    return run


def sample_labelled(docs: DataFrame, labels: DataFrame, learn, *, per_class: int = DOCUMENTS) -> list[tuple[int, bytes]]:
    """A bounded sample of labelled documents, as many of class 0 as of class 1; of very long ones a window.

    ``labels`` has ``doc_id, quality``; other values than 0 and 1 are left out, and an id with several
    labels counts with the lowest. Rates follow from the classes' counts.
    """
    marked = labels.where(learn & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    marked = marked.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    counts = {r.quality: r.n for r in marked.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return []
    chance = F.when(F.col("quality") == 0, per_class / counts[0]).otherwise(per_class / counts[1])
    chosen = marked.where(uniform(SEED, "doc_id") < chance)
    # About two times per_class ids: a bounded table, so it may go to every task.
    bounded = chosen.limit(4 * per_class)
    texts = docs.select("doc_id", "text").where(F.length("text") > 0).join(F.broadcast(bounded), "doc_id")
    rows = texts.withColumn("place", uniform(SEED + 1, "doc_id", "text"))
    share = 4 * per_class / max(1, rows.count())
    cut = sample_window("text", SAMPLE_CHARS, SEED).alias("text")
    found = rows.where(F.col("place") < share).select("quality", cut, "doc_id").collect()
    return [(r.quality, r.text.encode()) for r in sorted(found, key=lambda r: (r.doc_id, r.text))]


def fit(docs: DataFrame, labels: DataFrame, learn, *, per_class: int = DOCUMENTS) -> Classifier | None:
    """Train on labelled rows where ``learn`` (on the labels' columns) holds; None without both classes."""
    labelled = sample_labelled(docs, labels, learn, per_class=per_class)
    return train(labelled) if len({y for y, _ in labelled}) == 2 else None


def score_quality(docs: DataFrame, model: Classifier | None, *, text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without its text, with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    One pass over whole texts, no shuffle. A null text is empty; an empty text gets the score of the
    bias alone. Equal texts get equal scores, in every row that holds them; an empty table gives no rows. Without a model every score is 0.5. Columns called ``score`` or ``predicted`` are
    replaced, all others stay.
    """
    others = [c for c in docs.columns if c not in (text_column, "score", "predicted")]
    if model is None:
        plain = docs.select(*[F.col(f"`{c}`") for c in others], F.lit(0.5).alias("score"))
        return plain.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)], F.col(f"`{text_column}`").alias("text"))
    schema = extended(inner.drop("text").schema, "score double, predicted int")
    scored = inner.mapInArrow(_scoring(model.slopes(), model.offset(), threshold), schema)
    return scored.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(others)], "score", "predicted")


@query()
def op10_quality(spark, folder):
    """Every document with the score of its whole text; learned from labelled rows that are not held out."""
    docs, out = table(spark, folder, "documents"), held_out("doc_id", 4, 2)
    model = fit(docs, table(spark, folder, "labels"), ~out)
    return score_quality(docs.select("doc_id", out.alias("held_out"), "text"), model)

"""Quality score: logistic regression on hashed word n-grams, trained online."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Labelled documents that are learnt from at most; those of the smallest hashes.
SAMPLE = 12_000
EPOCHS = 2
#: Weights, 4 bytes each; the last is the constant.
DIMENSIONS = 1 << 20
NGRAMS = 2
#: Learning rate and its damping, then the penalties of absolute and squared weights.
ALPHA, BETA, L1, L2 = 10.0, 1.0, 0.005, 0.0
CUT = 0.3

_TOKEN = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^\sA-Za-z0-9\x80-\xff]+")


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a text: hashed words, numbers and runs of marks, and their
    n-grams; damped counts scaled to length 1, and the constant."""
    tokens = _TOKEN.findall((text or "").encode("utf-8", "replace"))
    one = np.fromiter(map(zlib.crc32, tokens), np.uint64, len(tokens))
    parts = [one]
    for n in range(2, NGRAMS + 1):
        grams = np.zeros(max(0, len(one) - n + 1), np.uint64)
        for k in range(n):
            grams = grams * np.uint64(0x9E3779B1) + one[k: k + len(grams)]
        # A word after itself: the same n-gram, whatever the word.
        grams[one[: len(grams)] == one[n - 1: n - 1 + len(grams)]] = 0
        parts.append(grams ^ np.uint64(n))
    hashed = np.concatenate(parts)
    with np.errstate(over="ignore"):
        mixed = (hashed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(40)
    slots, counts = np.unique(mixed.astype(np.int64) % (DIMENSIONS - 1), return_counts=True)
    values = np.log1p(counts)
    norm = np.sqrt((values * values).sum())
    values = values / norm if norm else values
    return np.append(slots, DIMENSIONS - 1), np.append(values, 1.0)


def _chance(margin: float) -> float:
    return 1 / (1 + np.exp(-np.clip(margin, -35, 35)))


class Ftrl:
    """Follow the regularised leader, proximal form: per slot the sum of gradients ``z``
    and of their squares ``n``; weights exist only where they are asked for."""

    def __init__(self):
        self.z = np.zeros(DIMENSIONS)
        self.n = np.zeros(DIMENSIONS)

    def weights(self, slots=slice(None)) -> np.ndarray:
        z, n = self.z[slots], self.n[slots]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, slots: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(slots)
        gradient = (_chance(w @ values) - label) * values
        square = gradient * gradient
        sigma = (np.sqrt(self.n[slots] + square) - np.sqrt(self.n[slots])) / ALPHA
        self.z[slots] += gradient - sigma * w
        self.n[slots] += square


def _train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    model = Ftrl()
    for frame in batches:
        for text, label in zip(frame["text"], frame["label"]):
            model.learn(*features(text), label)
    yield pd.DataFrame({"weights": [model.weights().astype("<f4").tobytes()]})


def held_out(doc_id: str = "doc_id") -> str:
    return f"coalesce(crc32(cast({doc_id} as string)) % 5 = 0, false)"


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """The weights, learnt from a sample of labelled documents that are not held out.

    The sample is bounded, so its ids are broadcast and only its texts are shuffled, to
    the one task that learns in the order of a hash; it reads them as a stream, once per
    epoch. Repeated labels of an id count as 1 only if all agree; null ids and labels are
    left out. Without labels all weights are 0, and every score 0.5.
    """
    wanted = (
        labels.where(f"doc_id IS NOT NULL AND quality IS NOT NULL AND NOT {held_out()}")
        .groupBy("doc_id").agg(F.min("quality").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    rows = documents.select("doc_id", "text").join(F.broadcast(wanted), "doc_id").select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(EPOCHS))).alias("epoch")
    )
    ordered = rows.repartition(1).sortWithinPartitions("epoch", F.xxhash64("epoch", "doc_id"), F.xxhash64("text"))
    result = ordered.select("text", "label").mapInPandas(_train, "weights binary").first()
    return np.frombuffer(result["weights"], "<f4") if result else np.zeros(DIMENSIONS, "<f4")


def with_score(documents: DataFrame, weights: np.ndarray) -> DataFrame:
    """``documents`` with ``score``, the chance of label 1; whole texts, null as empty.

    Each score is a sparse dot product; the weights (``DIMENSIONS`` numbers, whatever the
    corpus) are broadcast, nothing is shuffled. A column named ``score`` is replaced.
    """
    shared = documents.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        w = shared.value

        def of(text: str | None) -> float:
            slots, values = features(text)
            return float(_chance(w[slots] @ values))
        return texts.map(of) if len(texts) else pd.Series([], dtype="float64")

    return documents.withColumn("score", score(F.coalesce("text", F.lit(""))))


def quality_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The result of the query; repeated rows and null ids are scored like any other."""
    scored = with_score(documents.select("doc_id", "text"), train(documents, labels))
    return scored.select(
        "doc_id", F.expr(held_out()).alias("held_out"), "score", F.expr(f"int(score >= {CUT})").alias("predicted"),
    )

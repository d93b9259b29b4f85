"""Language of a text: sparse multinomial logistic regression on TF-IDF of character n-grams."""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loginwatch.llm.common import stored

#: Labelled documents that are learnt from at most, spread evenly over the languages as
#: far as these have so many; and languages that are learnt at most, the most frequent ones.
SAMPLE, LANGUAGES = 6_000, 256
EPOCHS = 2
#: One in so many of the sample sets the temperature instead of the weights.
CALIBRATION = 5
#: Lengths of the n-grams, and bits of their slots.
NGRAMS, BITS = 4, 18
#: Learning rate and its damping, then the elastic net: absolute and squared weights.
ALPHA, BETA, L1, L2 = 4.0, 1.0, 0.004, 0.01
#: Logarithms of the lowest and the highest temperature.
COLDEST, HOTTEST = -3.0, 3.0
#: Code points that are hashed at a time.
CHUNK = 1 << 20
UNKNOWN = "und"

SLOTS = 1 << BITS
_NO_LETTER = re.compile(r"[\W\d_]+")


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the character n-grams of a whole text, ascending, and their counts.

    Letters are lower-cased; all between words counts as one space, and so do both ends.
    Very long texts are hashed piece by piece, with the same result.
    """
    words = _NO_LETTER.sub(" ", (text or "").lower()).strip()
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes = np.frombuffer(f" {words} ".encode("utf-32-le", "replace"), "<u4")
    if len(codes) <= CHUNK:
        return np.unique(_hashed(codes, 0), return_counts=True)
    counts = np.zeros(SLOTS, np.int64)
    for at in range(0, len(codes), CHUNK):
        before = min(at, NGRAMS - 1)
        counts += np.bincount(_hashed(codes[at - before: at + CHUNK], before), minlength=SLOTS)
    slots = np.flatnonzero(counts)
    return slots, counts[slots]


def _hashed(codes: np.ndarray, before: int) -> np.ndarray:
    """Slots of all n-grams that end at place ``before`` or later."""
    part = codes.astype(np.uint64)
    hashed, found = np.zeros(len(part), np.uint64), []
    for n in range(1, NGRAMS + 1):
        # The n-gram that ends at each place from n - 1 on.
        hashed = (hashed[:-1] if n > 1 else hashed) * np.uint64(0x100000001B3) + part[n - 1:]
        mixed = (hashed + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)
        found.append(mixed[max(0, before - n + 1):].astype(np.int32))
    return np.concatenate(found)


def weighed(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots and TF-IDF values of a text, scaled to length 1; damped counts."""
    slots, counts = grams(text)
    values = np.log1p(counts) * idf[slots]
    norm = np.sqrt(values @ values)
    return slots, values / norm if norm else values


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


# --------------------------------------------------------------------------------- model

def _softmax(margins: np.ndarray) -> np.ndarray:
    grown = np.exp(margins - margins.max(axis=-1, keepdims=True))
    return grown / grown.sum(axis=-1, keepdims=True)


class Ftrl:
    """Follow the regularised leader, one column for each class: sums of gradients ``z`` and
    of their squares ``n``. The last slot is the constant."""

    def __init__(self, classes: int):
        self.z = np.zeros((SLOTS + 1, classes))
        self.n = np.zeros((SLOTS + 1, classes))

    def weights(self, slots=slice(None)) -> np.ndarray:
        z, n = self.z[slots], self.n[slots]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, slots: np.ndarray, values: np.ndarray, label: int) -> None:
        slots, values = np.append(slots, SLOTS), np.append(values, 1.0)
        w = self.weights(slots)
        wrong = _softmax(values @ w)
        wrong[label] -= 1
        gradient = np.outer(values, wrong)
        n = self.n[slots]
        grown = n + gradient * gradient
        self.z[slots] += gradient - (np.sqrt(grown) - np.sqrt(n)) / ALPHA * w
        self.n[slots] = grown


def temperature(margins: np.ndarray, labels: np.ndarray) -> float:
    """What margins are divided by, so that the labels are likeliest: golden section over
    its logarithm, in which the loss has one valley. 1 without labels."""
    if not len(labels):
        return 1.0

    def loss(at: float) -> float:
        scaled = margins / np.exp(at)
        top = scaled.max(axis=1)
        return float((top + np.log(np.exp(scaled - top[:, None]).sum(axis=1)) - scaled[np.arange(len(labels)), labels]).mean())

    low, high, part = COLDEST, HOTTEST, (5**0.5 - 1) / 2
    for _ in range(60):
        one, two = high - part * (high - low), low + part * (high - low)
        low, high = (low, two) if loss(one) <= loss(two) else (one, high)
    return float(np.exp((low + high) / 2))


class Model(NamedTuple):
    """``rows`` has the place of a slot's weights in ``weights``; the last one is all zero."""
    languages: list[str]
    idf: np.ndarray
    rows: np.ndarray
    weights: np.ndarray
    constant: np.ndarray
    heat: float

    def margins(self, text: str | None) -> np.ndarray:
        slots, values = weighed(text, self.idf)
        return values @ self.weights[self.rows[slots]] + self.constant

    def predict(self, text: str | None) -> tuple[str, float]:
        """The likeliest language, of equally likely ones the first by name, and its chance."""
        if not has_letter(text):
            return UNKNOWN, 0.0
        chance = _softmax(self.margins(text) / self.heat)
        best = int(chance.argmax())
        return self.languages[best], min(1.0, float(chance[best]))


# --------------------------------------------------------------------------------- Spark

def held_out(doc_id: str = "doc_id") -> str:
    return f"coalesce(crc32(cast({doc_id} as string)) % 3 = 1, false)"


def _learnable(documents: DataFrame) -> DataFrame:
    return documents.where(f"doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL AND NOT {held_out()}").select("text", "lang")


def inverse_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """How many rows there are, and ln((1 + rows) / (1 + rows with the n-gram)) + 1 by slot,
    from all rows: each partition gives one array of counts, merged in two rounds."""
    def dumped(n: int, counts: np.ndarray) -> pa.RecordBatch:
        data = zlib.compress(np.append(counts, n).astype("<i8").tobytes(), 1)
        return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, counts = 0, np.zeros(SLOTS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                counts[grams(text.as_py())[0]] += 1
                n += 1
        if n:
            yield dumped(n, counts)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS + 1, np.int64)
        for batch in batches:
            for data in batch.column(0):
                total += np.frombuffer(zlib.decompress(data.as_py()), "<i8")
        yield dumped(total[-1], total[:-1])

    parts = texts.select("text").mapInArrow(count, "counts binary").repartition(16).mapInArrow(merge, "counts binary")
    data = parts.repartition(1).mapInArrow(merge, "counts binary").first()["counts"]
    total = np.frombuffer(zlib.decompress(data), "<i8")
    return int(total[-1]), (np.log((1 + total[-1]) / (1 + total[:-1])) + 1).astype(np.float32)


def _sampled(texts: DataFrame, sample: int) -> tuple[list[str], DataFrame]:
    """The languages, and ``text``, ``lang``, ``h`` of the sample: distinct texts of a language
    with the smallest hashes, in proportion to how many it has."""
    hashed = texts.withColumn("h", F.xxhash64("text", "lang"))
    keys = stored(hashed.select("lang", "h").distinct(), "language_keys")
    sizes = keys.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    sizes = stored(sizes, "language_sizes")
    # At most LANGUAGES rows, then at most ``sample``.
    share = (F.col("h").bitwiseAND((1 << 52) - 1) / float(1 << 52)) * F.col("n")
    wanted = keys.join(F.broadcast(sizes), "lang").select("h", share.alias("at")).orderBy("at", "h").limit(sample).select("h")
    found = hashed.join(F.broadcast(stored(wanted, "language_sample").distinct()), "h").select("text", "lang", "h").distinct()
    return sorted(r["lang"] for r in sizes.select("lang").collect()), found


def train(documents: DataFrame, sample: int = SAMPLE) -> Model | None:
    """The model; None if nothing can be learnt from.

    Learns from rows that are not held out and have an id, a text and a language. N-gram
    statistics cover all of them; weights and temperature come from a sample of ``sample``
    distinct texts, which one task learns from in the order of a hash, as a stream.
    """
    texts = _learnable(documents)
    n, idf = inverse_frequencies(texts)
    if not n:
        return None
    languages, found = _sampled(texts, sample)
    place = {lang: i for i, lang in enumerate(languages)}
    shared = documents.sparkSession.sparkContext.broadcast(idf)

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        idf, model, margins, labels = shared.value, Ftrl(len(languages)), [], []
        weights = None
        for frame in batches:
            for text, lang, epoch in zip(frame["text"], frame["lang"], frame["epoch"]):
                slots, values = weighed(text, idf)
                if epoch <= EPOCHS:
                    model.learn(slots, values, place[lang])
                    continue
                weights = model.weights() if weights is None else weights
                margins.append(values @ weights[slots] + weights[SLOTS])
                labels.append(place[lang])
        weights = model.weights() if weights is None else weights
        heat = temperature(np.array(margins).reshape(len(labels), len(languages)), np.array(labels, np.int64))
        used = np.flatnonzero(weights[:SLOTS].any(axis=1))
        yield pd.DataFrame({"model": [pickle.dumps((used, weights[used].astype(np.float32), weights[SLOTS], heat))]})

    # The calibration rows come last, once.
    epochs = f"if(pmod(shiftright(h, 52), {CALIBRATION}) = 0, array({EPOCHS + 1}), sequence(1, {EPOCHS}))"
    ordered = (
        found.select("text", "lang", "h", F.explode(F.expr(epochs)).alias("epoch")).repartition(1)
        .sortWithinPartitions("epoch", F.xxhash64("epoch", "h"), "h")
    )
    row = ordered.select("text", "lang", "epoch").mapInPandas(learn, "model binary").first()
    used, weights, constant, heat = pickle.loads(row["model"])
    rows = np.full(SLOTS, len(used), np.int32)
    rows[used] = np.arange(len(used), dtype=np.int32)
    return Model(languages, idf, rows, np.vstack([weights, np.zeros((1, len(languages)), np.float32)]), constant, heat)


def with_language(documents: DataFrame, model: Model | None) -> DataFrame:
    """``documents`` with ``lang_pred`` and ``score``; columns of these names are replaced.

    A sparse product for each whole text; nothing is shuffled. Texts that are null or have
    no letter, and all texts if there is no model, are ``und`` with score 0. What is
    broadcast is bounded by the slots and ``LANGUAGES``.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        model = shared.value
        told = [model.predict(t) if model else (UNKNOWN, 0.0) for t in texts]
        return pd.DataFrame(told, columns=["lang_pred", "score"]).astype({"lang_pred": object, "score": float})

    other = [c for c in documents.columns if c not in ("lang_pred", "score")]
    told = documents.select(F.struct(*other).alias("row"), predict("text").alias("told"))
    return told.select("row.*", "told.lang_pred", "told.score")


def language_predictions(documents: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The result of the query; repeated rows and null ids are told like any other. Rows
    without an id are neither learnt from nor held out."""
    told = with_language(documents.select("doc_id", "text"), train(documents, sample))
    return told.select("doc_id", F.expr(held_out()).alias("held_out"), "lang_pred", "score")

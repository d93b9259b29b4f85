"""The quality classifier against a plain dictionary version, and on labels it has not seen."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loginwatch.llm import classifier as c

from .cases import PROSE, documents, odd_documents, table

LABELS = "doc_id long, quality int, toxic int"


class SlowFtrl:
    """The learner weight by weight, in dictionaries."""

    def __init__(self):
        self.z, self.n = {}, {}

    def weight(self, slot):
        z, n = self.z.get(slot, 0.0), self.n.get(slot, 0.0)
        if abs(z) <= c.L1:
            return 0.0
        return -(z - math.copysign(c.L1, z)) / ((c.BETA + math.sqrt(n)) / c.ALPHA + c.L2)

    def chance(self, features):
        return 1 / (1 + math.exp(-max(-35, min(35, sum(v * self.weight(s) for s, v in features.items())))))

    def learn(self, features, label):
        wrong = self.chance(features) - label
        for s, v in features.items():
            g, n, w = wrong * v, self.n.get(s, 0.0), self.weight(s)
            self.z[s] = self.z.get(s, 0.0) + g - (math.sqrt(n + g * g) - math.sqrt(n)) / c.ALPHA * w
            self.n[s] = n + g * g


def sparse(text):
    slots, values = c.features(text)
    assert len(set(slots.tolist())) == len(slots)
    return dict(zip(slots.tolist(), values.tolist()))


def prose(rng, good):
    words = ["the", "quick", "fox", "jumps", "over", "lazy", "dogs"] if good else ["$$$", "buy", "now", "***", "click"]
    return " ".join(rng.choice(words) for _ in range(rng.randrange(3, 30)))


def test_learner_equals_plain_version():
    rng = random.Random(4)
    fast, slow = c.Ftrl(), SlowFtrl()
    for i in range(120):
        text, label = prose(rng, i % 2), i % 2
        fast.learn(*c.features(text), label)
        slow.learn(sparse(text), label)
    weights = fast.weights()
    assert max(abs(weights[s] - slow.weight(s)) for s in slow.z) < 1e-9
    for i in range(20):
        features = sparse(prose(rng, i % 2))
        assert abs(c._chance(sum(v * weights[s] for s, v in features.items())) - slow.chance(features)) < 1e-6


def test_features():
    one, two = sparse("b a b"), sparse("a b a")
    assert one != two and abs(sum(v * v for s, v in one.items() if s != c.DIMENSIONS - 1) - 1) < 1e-12
    for text in (None, "", " \n "):
        assert sparse(text) == {c.DIMENSIONS - 1: 1.0}
    assert len(sparse(PROSE * 4000)) == len(sparse(PROSE * 2))  # very long: counts grow, slots do not


def agreed(labels):
    """Labels that are learnt from: of ids that are not held out, 1 only if all agree."""
    seen = {}
    for doc_id, quality, _ in labels:
        if doc_id is not None and quality is not None and zlib.crc32(str(doc_id).encode()) % 5:
            seen[doc_id] = min(seen.get(doc_id, 1), quality)
    return seen


def test_scores_equal_a_plain_model_on_the_same_order(spark):
    rng = random.Random(9)
    texts = [prose(rng, i % 3) for i in range(90)]
    docs = documents(spark, texts)
    marks = [(i, int(i % 3 > 0), 0) for i in range(90)]
    labels = spark.createDataFrame(marks, LABELS)
    wanted = agreed(marks)
    keys = spark.createDataFrame([(i, texts[i], e) for i in wanted for e in range(1, c.EPOCHS + 1)], "doc_id long, text string, epoch int")
    order = keys.orderBy("epoch", F.xxhash64("epoch", "doc_id"), F.xxhash64("text")).collect()
    slow = SlowFtrl()
    for r in order:
        slow.learn(sparse(r.text), wanted[r.doc_id])
    for r in c.quality_scores(docs, labels).collect():
        assert r.score == pytest.approx(slow.chance(sparse(texts[r.doc_id])), abs=1e-5)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3)


def test_held_out_labels_are_ranked_well(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = c.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").select("score", "quality").collect()
    good, bad = ([r.score for r in got if r.quality == q] for q in (1, 0))
    assert len(good) > 20 and len(bad) > 5
    assert np.mean([g > b for g in good for b in bad]) > 0.95


def test_held_out_labels_are_not_learnt(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    turned = labels.withColumn("quality", F.expr(f"if({c.held_out()}, 1 - quality, quality)"))
    assert (c.train(docs, labels) == c.train(docs, turned)).all()


def test_repeated_and_contradicting_labels(spark):
    docs = documents(spark, [PROSE + str(i) for i in range(12)])
    ids = [i for i in range(12) if zlib.crc32(str(i).encode()) % 5]
    once = spark.createDataFrame([(i, i % 2, 0) for i in ids], LABELS)
    noisy = once.unionByName(once).unionByName(spark.createDataFrame([(i, 1, 1) for i in ids if i % 2 == 0] + [(None, 1, 0), (ids[0], None, 0)], LABELS))
    assert (c.train(docs, once) == c.train(docs, noisy)).all()


def test_the_sample_is_bounded_and_its_order_fixed(spark):
    docs = documents(spark, [prose(random.Random(i), i % 2) for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], LABELS)
    some = c.train(docs, labels, 10)
    assert (some == c.train(docs.repartition(5), labels.repartition(3), 10)).all()
    assert not (some == c.train(docs, labels)).all()


def test_odd_rows(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(5, 1, 0), (6, 0, 0), (8, 1, 0), (0, 0, 0), (99, 1, 0)], LABELS)
    got = c.quality_scores(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert {r.held_out for r in got if r.doc_id is None} == {False}
    for none in (labels.where("false"), labels.withColumn("quality", F.lit(None).cast("int"))):
        assert {(r.score, r.predicted) for r in c.quality_scores(docs, none).collect()} == {(0.5, 1)}
    assert c.quality_scores(docs.where("false"), labels).count() == 0
    clashing = docs.selectExpr("*", "'x' AS score", "1 AS weights")
    assert c.with_score(clashing, np.zeros(c.DIMENSIONS, "<f4")).columns == [*docs.columns, "score", "weights"]

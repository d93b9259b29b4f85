"""Language prediction against a plain dictionary version, and its accuracy on unseen rows."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from loginwatch.llm import language_id as li

from .cases import PROSE, documents, odd_documents, table

BIG = 1 << 64


def slow_slot(gram):
    h = 0
    for c in gram:
        h = (h * 0x100000001B3 + ord(c)) % BIG
    return ((h + len(gram)) * 0x9E3779B97F4A7C15 % BIG) >> (64 - li.BITS)


def slow_grams(text):
    words = " ".join(re.findall(r"[^\W\d_]+", (text or "").lower()))
    full = f" {words} " if words else ""
    return Counter(slow_slot(full[i: i + n]) for n in range(1, li.NGRAMS + 1) for i in range(len(full) - n + 1))


def slow_weighed(text, idf):
    values = {s: math.log(1 + c) * idf.get(s, idf[None]) for s, c in slow_grams(text).items()}
    norm = math.sqrt(sum(v * v for v in values.values()))
    return {s: v / norm for s, v in values.items()}


class SlowFtrl:
    """The same learner, weight by weight, in dictionaries."""

    def __init__(self, classes):
        self.classes, self.z, self.n = classes, {}, {}

    def weight(self, key):
        z, n = self.z.get(key, 0.0), self.n.get(key, 0.0)
        if abs(z) <= li.L1:
            return 0.0
        return -(z - math.copysign(li.L1, z)) / ((li.BETA + math.sqrt(n)) / li.ALPHA + li.L2)

    def margins(self, values):
        return [sum(v * self.weight((s, c)) for s, v in values.items()) for c in range(self.classes)]

    def learn(self, values, label):
        values = values | {li.SLOTS: 1.0}
        m = self.margins(values)
        e = [math.exp(x - max(m)) for x in m]
        for c in range(self.classes):
            wrong = e[c] / sum(e) - (c == label)
            for s, v in values.items():
                w, g, n = self.weight((s, c)), wrong * v, self.n.get((s, c), 0.0)
                self.z[s, c] = self.z.get((s, c), 0.0) + g - (math.sqrt(n + g * g) - math.sqrt(n)) / li.ALPHA * w
                self.n[s, c] = n + g * g


TEXTS = ["", None, "a", "Ä 9_ß", "the cat, the CAT", "x" * 50, "日本語 テキスト", "\n\t12 34", "áe 😀 b"]


@pytest.mark.parametrize("text", TEXTS)
def test_grams(text):
    slots, counts = li.grams(text)
    assert dict(zip(slots.tolist(), counts.tolist())) == slow_grams(text)


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = PROSE * 30
    whole = li.grams(text)
    for chunk in (1, 2, 3, 7, 100):
        monkeypatch.setattr(li, "CHUNK", chunk)
        assert all((a == b).all() for a, b in zip(li.grams(text), whole))


@pytest.mark.parametrize("penalty", [li.L1, 0.1])
def test_learner_equals_plain_version(monkeypatch, penalty):
    monkeypatch.setattr(li, "L1", penalty)
    texts = [("the cat sat on the mat", 0), ("der hund und die katze", 1), ("le chat et le chien", 2), ("the dog", 0), ("die maus", 1)] * 3
    idf = np.ones(li.SLOTS, np.float32)
    fast, slow = li.Ftrl(3), SlowFtrl(3)
    for text, label in texts:
        fast.learn(*li.weighed(text, idf), label)
        slow.learn(slow_weighed(text, {None: 1.0}), label)
    w = fast.weights()
    assert all(abs(w[s, c] - slow.weight((s, c))) < 1e-9 for s, c in slow.z)
    # The absolute penalty leaves weights at exactly 0.
    assert penalty < 0.1 or 0 < np.count_nonzero(w) < len(slow.z)


def test_temperature_is_the_likeliest():
    rng = np.random.default_rng(3)
    margins = rng.normal(size=(4000, 3)) * 2
    chance = np.exp(margins) / np.exp(margins).sum(axis=1, keepdims=True)
    labels = (rng.random(4000)[:, None] > chance.cumsum(axis=1)).sum(axis=1)
    assert abs(li.temperature(margins, labels) - 1) < 0.1
    assert abs(li.temperature(margins * 5, labels) - 5) < 0.5
    assert li.temperature(np.zeros((0, 3)), np.zeros(0, int)) == 1.0
    assert li.temperature(np.eye(3) * 9, np.arange(3)) == pytest.approx(math.exp(li.COLDEST), rel=1e-3)


def test_statistics_cover_all_rows_that_are_learnt_from(spark):
    docs = table(spark, "documents")
    n, idf = li.inverse_frequencies(li._learnable(docs))
    learnt = [r["text"] for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1]
    held = Counter(s for t in learnt for s in slow_grams(t))
    assert n == len(learnt)
    want = np.log((1 + n) / (1 + np.array([held.get(s, 0) for s in range(li.SLOTS)]))) + 1
    assert np.allclose(idf, want, rtol=1e-6)


def test_accuracy_on_unseen_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    got = li.language_predictions(docs).collect()
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    unseen = [r for r in got if r["held_out"]]
    right = [r["lang_pred"] == lang[r["doc_id"]] for r in unseen]
    assert np.mean(right) > 0.98
    # Calibrated: on average the score is the share of right answers.
    assert abs(np.mean([r["score"] for r in unseen]) - np.mean(right)) < 0.03
    assert all(0 <= r["score"] <= 1 for r in got)


def test_labels_of_held_out_rows_are_not_learnt(spark):
    docs = table(spark, "documents").select("doc_id", "text", "lang", "source")
    wrong = docs.selectExpr("doc_id", "text", f"if({li.held_out()}, 'zz', lang) AS lang", "'q' AS source")
    assert sorted(map(tuple, li.language_predictions(docs).collect())) == sorted(map(tuple, li.language_predictions(wrong).collect()))


def test_sample_is_bounded_and_even(spark):
    docs = documents(spark, [f"{PROSE} {i}" for i in range(300)], "en").unionByName(
        documents(spark, [f"und der hund {chr(97 + i)}" for i in range(20)], "de", 1000)
    ).unionByName(documents(spark, ["le chat"] * 200, "fr", 2000))
    languages, found = li._sampled(li._learnable(docs), 40)
    rows = found.collect()
    assert languages == ["de", "en", "fr"] and len(rows) == 40
    counts = Counter(r["lang"] for r in rows)
    assert counts["de"] >= 8 and counts["fr"] == 1 and counts["en"] > 10


def test_odd_rows(spark):
    docs = odd_documents(spark)
    got = li.language_predictions(docs).collect()
    assert len(got) == docs.count()
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[0]["lang_pred"] == by_id[1]["lang_pred"] == by_id[2]["lang_pred"] == "und" and by_id[0]["score"] == 0
    assert by_id[3]["lang_pred"] in {"en", "de", "fr"} and by_id[None]["held_out"] is False
    assert li.language_predictions(docs.where("false")).count() == 0
    unlabelled = li.language_predictions(docs.selectExpr("doc_id", "text", "cast(null as string) AS lang")).collect()
    assert {(r["lang_pred"], r["score"]) for r in unlabelled} == {("und", 0.0)}
    one = li.language_predictions(docs.where("lang = 'en'")).collect()
    assert {r["lang_pred"] for r in one} == {"en", "und"}
    clashing = docs.selectExpr("*", "'x' AS score", "1 AS lang_pred", "2 AS told")
    told = li.with_language(clashing, li.train(docs))
    assert told.columns == [*docs.columns, "told", "lang_pred", "score"] and told.count() == docs.count()
    digits = documents(spark, ["12 34", "٣", "ª", "ñ"])
    assert [r["lang_pred"] for r in li.with_language(digits, li.train(docs)).orderBy("doc_id").collect()][:2] == ["und", "und"]

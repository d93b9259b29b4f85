import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loginwatch.llm import quality_rules as q

from .cases import PROSE, documents, odd_documents, table

SPACE = " \t\n\x0b\x0c\r"


def slow_measures(text):
    text = text or ""
    words = [w for w in re.split(f"[{SPACE}]+", text) if w]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(covered), len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


@pytest.mark.parametrize("make", [
    odd_documents, lambda s: table(s, "documents"), lambda s: documents(s, []),
    lambda s: documents(s, ["a b a b a b", "a b c a b c x a b c", "a a a a", "a b c d b c d", "l\nl\n \nl\n\nm\nm", "# # <> a|b"]),
])
def test_counts_equal_brute_force(spark, make):
    docs = make(spark)
    out = q.quality_report(docs, table(spark, "labels"))
    got = [tuple(r)[:7] for r in out.collect()]
    want = [(r.doc_id, *slow_measures(r.text)) for r in docs.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert not [r for r in out.collect() if r.base_failed and r.kept]


@pytest.mark.parametrize("n, k", [(10, 0), (10, 3), (1000, 12), (5000, 30), (200_000, 1800), (7, 7), (0, 0), (9, 0), (2000, 9), (1_000_000_000, 9_990_000)])
def test_binomial_tail(spark, n, k):
    got = spark.range(1).select(F.expr(q.binomial_tail(f"{n}L", f"{k}L", 0.01))).first()[0]
    if k >= 0.01 * n:
        assert got == 1
        return
    logs = [math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(.01) + (n - j) * math.log(.99)
            for j in range(max(0, k - 200_000), k + 1)]
    top = max(logs)
    assert got == pytest.approx(math.exp(top) * sum(math.exp(x - top) for x in logs), rel=1e-5)


def labelled(spark, n, noise):
    """Good prose and bad prose full of symbols; of the good, a share ``noise`` looks bad."""
    rng = random.Random(n)
    texts, labels = [], []
    for i in range(n):
        good = i % 3 > 0
        words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(60)]
        odd = not good or rng.random() < noise
        texts.append((i, " ".join(w + "###" if odd else w for w in words), "en", "s", 1))
        labels.append((i, int(good), 0))
    return documents(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_certified_rule_rejects_bad_documents(spark):
    docs, labels = labelled(spark, 1500, 0.0)
    out = q.quality_report(docs, labels).join(labels, "doc_id").groupBy("quality").agg(F.avg(F.expr("int(kept)"))).collect()
    assert dict(map(tuple, out)) == {0: 0.0, 1: 1.0}
    kept = q.good_documents(docs.withColumn("levels", F.lit(1)), labels)
    assert kept.count() == 1000 and kept.columns == [*docs.columns, "levels"]


def test_rule_that_would_reject_too_many_good_ones_is_not_chosen(spark):
    docs, labels = labelled(spark, 1500, 0.05)
    assert q.quality_report(docs, labels).where("NOT kept").count() == 0


def test_too_few_labels_reject_nothing(spark):
    docs, labels = labelled(spark, 90, 0.0)
    assert q.quality_report(docs, labels).where("NOT kept").count() == 0
    assert q.quality_report(docs, labels.where("false")).where("NOT kept").count() == 0


def test_only_built_in_functions_and_no_text_shuffle(spark):
    docs, labels = labelled(spark, 90, 0.0)
    plan = q.quality_report(docs, labels)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def narrow(spark, parts):
    """Labelled rows of the certification: (stratum, step, quality, how many)."""
    rows, marks, at = [], [], 0
    for stratum, step, quality, n in parts:
        rows += [(at + i, stratum, False, step) for i in range(n)]
        marks += [(at + i, quality) for i in range(n)]
        at += n
    return spark.createDataFrame(rows, "doc_id long, stratum string, base_failed boolean, step int"), spark.createDataFrame(marks, "doc_id long, quality int")


def test_the_promise_is_for_all_rules_together(spark):
    """Two rules that each reject 0.6 % of the good documents, other ones, would be certified
    one by one; together they reject 1.2 % and are not."""
    rows, marks = narrow(spark, [("a", 1, 1, 24), ("a", 1, 1, 24), ("a", None, 1, 3952), ("a", 1, 0, 200)])
    assert q.certified_steps(rows, marks).count() == 0
    half, marks = narrow(spark, [("a", 1, 1, 24), ("a", None, 1, 3976), ("a", 1, 0, 200)])
    assert [tuple(r) for r in q.certified_steps(half, marks).collect()] == [("a", 1)]


def test_steps_are_tested_in_order_and_end_at_the_first_that_fails(spark):
    parts = [("a", 2, 0, 9), ("a", 3, 0, 90), ("a", 3, 1, 30), ("a", 5, 0, 900), ("a", None, 1, 970), ("b", 1, 0, 50), ("b", None, 1, 100), ("", 1, 0, 5), ("", None, 1, 900)]
    rows, marks = narrow(spark, parts)
    # "b" has too few good ones; the empty stratum is one of its own.
    assert {tuple(r) for r in q.certified_steps(rows, marks).collect()} == {("a", 2), ("", 1)}


def test_null_languages_are_a_stratum_of_their_own(spark):
    docs, labels = labelled(spark, 1500, 0.0)
    unknown = docs.withColumn("lang", F.lit(None).cast("string"))
    kept = q.quality_report(unknown, labels).where("kept").count()
    assert kept == 1000
    repeated = labels.unionByName(labels).unionByName(labels.selectExpr("doc_id", "cast(null as int) AS quality", "toxic"))
    assert q.quality_report(unknown, repeated).where("kept").count() == kept


def test_rejecting_step_is_the_first_cutoff_that_rejects(spark):
    docs = documents(spark, ["plain words here " + " ".join(f"w{i}" for i in range(80)), "a# b# c# " * 40, PROSE])
    for r in q.measured(docs).collect():
        steps = []
        for rule in q.RULES:
            value = rule.sign * eval(rule.measure, {"greatest": max}, r.asDict())
            steps += [k + 1 for k, c in enumerate(rule.cutoffs) if value > c]
        assert r["step"] == (min(steps) if steps else None)

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from loginwatch.llm import decontamination as dc

from .cases import documents, odd_documents, table

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow_words(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def slow_report(docs, items):
    windows = {}
    for item, text in items:
        w = slow_words(text)
        m = min(13, len(w))
        for i in range(len(w) - m + 1) if m else ():
            windows.setdefault(tuple(w[i:i + m]), set()).add(item)
    lengths = {len(x) for x in windows}
    for doc_id, text in docs:
        w, hit, found = slow_words(text), set(), set()
        for m in lengths:
            for i in range(len(w) - m + 1):
                if (own := windows.get(tuple(w[i:i + m]))) is not None:
                    hit |= set(range(i, i + m))
                    found |= own - {None}
        names = ",".join(sorted(map(str, found)))
        yield doc_id, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


ITEMS = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"),
    (2, "zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau"),
    (10, "short item"), (3, "x"), (4, ""), (5, None), (None, "quick brown fox"), (6, "... !"),
    (7, "la la la la la la la la la la la la la la la"), (10, "short item"), (11, "Short, ITEM"),
]
TEXTS = [
    "alpha, BETA gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon",
    "a short item, short item! x x", "la " * 40, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu",
    "zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau " * 3, "école x naïve", None, "", "the quick brown fox",
    "word " * 500 + "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu",
]


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("limit", [1, 100, 1 << 20])
def test_report_equals_brute_force(spark, limit, monkeypatch):
    monkeypatch.setattr(dc, "contamination", lambda d, b, f=dc.contamination: f(d, b, limit))
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    for docs in (documents(spark, TEXTS), odd_documents(spark), documents(spark, [])):
        want = slow_report([(r.doc_id, r.text) for r in docs.collect()], ITEMS)
        assert rows(dc.contamination_report(docs, bench)) == sorted(want, key=repr)


def test_given_tables(spark):
    docs, bench = table(spark, "documents"), table(spark, "benchmark")
    want = list(slow_report([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in bench.collect()]))
    assert rows(dc.contamination_report(docs, bench)) == sorted(want, key=repr)
    dirty = {w[0] for w in want if w[-1]}
    kept = dc.without_contaminated(docs, bench)
    assert dirty and kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {w[0] for w in want} - dirty


def test_empty_benchmark_and_clashing_columns(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    docs = odd_documents(spark).withColumn("spans", F.lit(1)).withColumn("items", F.lit("mine"))
    out = dc.contamination(docs, bench)
    assert out.where("contaminated OR n_hit > 0").count() == 0 and out.count() == docs.count()
    kept = dc.without_contaminated(docs, bench)
    assert kept.columns == docs.columns and {r["items"] for r in kept.collect()} == {"mine"}


def test_shift_tables_skip():
    p = dc.Patterns([(1, slow_words(ITEMS[0][1]))])
    m, size, shift, buckets = p.tables[0]
    assert (m, size) == (13, 2) and max(shift.values()) == 11 and len(buckets) == 4

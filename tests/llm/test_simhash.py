import random

import pytest
import xxhash
from pyspark.sql import functions as F

from loginwatch.llm import components, simhash

from .cases import PROSE, bag, documents, odd_documents, table


def slow_fingerprint(text):
    words = [w for w in bytes((text or "").encode()).lower().split()]
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    out = 0
    for bit in range(64):
        ones = sum(xxhash.xxh64_intdigest(s, 42) >> bit & 1 for s in shingles)
        out |= (2 * ones > len(shingles)) << bit
    return out if shingles else 0


def classes(values):
    """Least id reachable, by comparing all pairs; values: (id, fingerprint)."""
    root = {fp: fp for _, fp in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    distinct = sorted(root)
    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for i, fp in values:
        if i is not None:
            least[find(fp)] = min(least.get(find(fp), i), i)
    return [(i, fp, least.get(find(fp))) for i, fp in values]


@pytest.mark.parametrize("text", [
    None, "", " ", "One", "one two", "One two three", "ÀB c\x0bd e f", PROSE * 30, "a a a a a a", "\x1fa b\x85c d",
])
def test_fingerprint_by_the_definition(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


@pytest.mark.parametrize("make", [odd_documents, lambda s: table(s, "documents"), lambda s: documents(s, [])])
def test_classes_equal_all_pairs(spark, make):
    docs = make(spark)
    rows = [(r.doc_id, slow_fingerprint(r.text)) for r in docs.select("doc_id", "text").collect()]
    want = sorted(((i, f"{fp:016x}", c) for i, fp, c in classes(rows)), key=repr)
    assert bag(simhash.near_copy_classes(docs), "doc_id", "fingerprint", "component_id") == want


def prints(spark, values):
    signed = [(i, fp - (1 << 64) if fp >> 63 else fp) for i, fp in enumerate(values)]
    return spark.createDataFrame(signed, "doc_id long, fp long").repartition(3)


@pytest.mark.parametrize("crowd", [1, 8, 256])
def test_links_of_dense_and_sparse_clouds(spark, monkeypatch, crowd):
    """Clouds around some centres, chains of two-bit steps, and pairs at distances 1 to 4."""
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(crowd)
    values = {0, (1 << 64) - 1}
    for _ in range(4):
        centre = rng.getrandbits(64)
        values |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(60)}
    x = rng.getrandbits(64)
    for _ in range(25):
        x ^= sum(1 << b for b in rng.sample(range(64), 2))
        values.add(x)
    for d in (1, 2, 3, 4):
        for _ in range(20):
            x = rng.getrandbits(64)
            values |= {x, x ^ sum(1 << b for b in rng.sample(range(64), d))}
    values = sorted(values, key=lambda v: hash((v, crowd)))
    frame = prints(spark, values)
    got = sorted((r.doc_id, r.component_id) for r in simhash.with_classes(simhash.stored(frame, "t")).collect())
    assert got == sorted((i, c) for i, _, c in classes(list(enumerate(values))))


def test_every_word_lies_near_its_home_anchor():
    _, cosets = simhash._cosets()
    assert len(cosets) == 2048 and all(len(c[0]) == 1 for c in cosets)


def test_components_of_a_long_path(spark):
    edges = spark.range(300).select(F.expr("id").alias("a"), F.expr("id + 1").alias("b"))
    out = components.components(simhash.stored(edges.repartition(4), "t"))
    assert {(r.node, r.root) for r in out.collect()} == {(i, 0) for i in range(301)}


def test_one_document_of_each_class_stays(spark):
    docs = odd_documents(spark).withColumn("fp", F.lit("x")).withColumn("n", F.lit(1)).withColumn("_key", F.lit("k"))
    kept = simhash.first_of_each(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, slow_fingerprint(r.text)) for r in docs.select("doc_id", "text").collect()]
    n_classes = len({(c, fp if c is None else 0) for _, fp, c in classes(rows)})
    got = kept.collect()
    assert len(got) == n_classes
    assert sum(r.doc_id == 5 for r in got) == 1 and not any(r.doc_id == 6 for r in got)


def test_plan_has_no_pairwise_join(spark):
    plan = simhash.links(prints(spark, [1, 2, 3]))._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan

"""URL filters under other rules, missing classes and odd rows; the threshold by brute force."""

import random

from pyspark.sql import functions as F

from loginwatch.llm import url_filters as u

PAGES = "page_id long, url string, html string"


def pages(spark, urls):
    return spark.createDataFrame([(i, x, None) for i, x in enumerate(urls)], PAGES)


def by_id(frame):
    return {r["page_id"]: r for r in frame.collect()}


def test_the_longest_rule_wins_and_covers_subdomains(spark):
    rules = (u.Rule("block", "a.org", "/"), u.Rule("allow", "a.org", "/x/"), u.Rule("block", "b.a.org", "/x/"))
    urls = ["http://a.org/", "http://a.org/x/1", "http://B.A.org/x/1", "http://c.b.a.org/x/", "http://c.a.org/x/2", "http://xa.org/x/", "a.org/x/", None, "http://a.org"]
    got = by_id(u.judged(pages(spark, urls), rules))
    assert [got[i]["rule"] for i in range(9)] == ["a.org/", "a.org/x/", "b.a.org/x/", "b.a.org/x/", "a.org/x/", None, None, None, None]
    assert [got[i]["verdict"] for i in range(5)] == ["block", "allow", "block", "block", "allow"]
    assert [got[i]["host"] for i in (2, 6, 7, 8)] == ["b.a.org", "", "", "a.org"] and [got[i]["path"] for i in (1, 8)] == ["/x/1", ""]


def make(rng, good):
    return "".join(rng.choice("aeiourlnst" if good else "xqzkjwv") for _ in range(rng.randrange(5, 20)))


def test_unseen_urls_are_judged_by_what_was_learnt(spark):
    rng = random.Random(1)
    rules = (u.Rule("allow", "good.org", "/"), u.Rule("block", "bad.org", "/"))
    urls = [f"http://{'good' if i % 2 else 'bad'}.org/{make(rng, i % 2)}" for i in range(600)]
    urls += [f"http://new.net/{make(rng, i % 2)}" for i in range(100)]
    got = by_id(u.judged(pages(spark, urls), rules))
    right = [got[600 + i]["verdict"] == ("allow" if i % 2 else "block") for i in range(100)]
    assert all(got[600 + i]["rule"] is None for i in range(100)) and sum(right) > 90


def test_missing_classes(spark):
    """Without one of the classes the cut is 0; without any rule every score is 0 and all pass."""
    urls = [f"http://a.org/{i}" for i in range(40)] + ["http://b.net/q", None, ""]
    for rules in ((u.Rule("allow", "a.org", "/"),), (u.Rule("block", "a.org", "/"),)):
        got = by_id(u.judged(pages(spark, urls), rules))
        assert {got[i]["verdict"] for i in range(40)} == {rules[0].verdict}
        assert all(got[i]["verdict"] == ("allow" if got[i]["score"] >= 0 else "block") for i in range(40, 43))
    assert {r["verdict"] for r in u.judged(pages(spark, urls), ()).collect()} == {"allow"}
    assert u.judged(pages(spark, urls).where("false")).count() == 0


def test_threshold_is_the_best_of_the_grid(spark):
    rng = random.Random(2)
    rows = [(rng.gauss(1 if i % 3 else -0.5, 1), bool(i % 3)) for i in range(400)]
    cut = u.threshold(spark.createDataFrame(rows, "score double, accepted boolean")).first()["cut"]
    good, bad = ([s for s, a in rows if a is side] for side in (True, False))

    def balance(at):
        return sum(s >= at for s in good) / len(good) + sum(s < at for s in bad) / len(bad)

    grid = [k * 2 * u.RANGE / u.BINS - u.RANGE for k in range(u.BINS + 1)]
    assert abs(balance(cut) - max(map(balance, grid))) < 1e-9
    empty = spark.createDataFrame([], "score double, accepted boolean")
    assert u.threshold(empty).first()["cut"] == 0.0


def test_clashing_columns_are_replaced_and_rows_kept(spark):
    frame = pages(spark, ["http://a.com/x"] * 3 + [None]).withColumns({c: F.lit("mine") for c in ("host", "path", "rule", "score", "verdict", "other")})
    got = u.judged(frame).collect()
    assert len(got) == 4 and all(r["other"] == "mine" for r in got) and {r["rule"] for r in got} == {"com/", None}

"""The bit table lets all its keys pass, few others, and leaves no trace in results."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loginwatch.operators import incidents, triage
from loginwatch.operators.membership import MAX_SHARE, Membership, passing_share
from loginwatch.operators.skew import HotKeys

from conftest import day


def log(spark, accounts, rows=1):
    return spark.range(accounts * rows).selectExpr(f"id AS event_id", f"concat('u', id % {accounts}) AS username")


@pytest.mark.parametrize("members, most", [(0, None), (1, None), (5_000, None), (5_000, 1024)])
def test_share_of_others_is_as_stated(spark, members, most):
    flagged = spark.range(members).selectExpr("concat('u', id) AS username")
    found = Membership.of(flagged, "username", *([most] if most else []))
    rows = log(spark, 200_000)
    passed = found.thin(rows).selectExpr("count(1) AS n", f"count_if(event_id < {members}) AS own").first()
    assert passed["own"] == members
    others = passed["n"] - members
    # The stated share is a mean over hashes; a single table strays from it.
    expected = found.share * (200_000 - members)
    assert abs(others - expected) <= 5 + 0.6 * expected, (others, expected)
    assert found.only(rows).count() == members


def test_stated_share_grows_with_the_load():
    shares = [passing_share(n, 64) for n in (0, 1, 64, 256, 1024, 10**7)]
    assert shares[0] == 0 and shares == sorted(shares) and shares[-1] == 1.0


def test_too_many_members_are_joined_without_a_table(spark):
    found = Membership.of(log(spark, 20_000), "username", 64)
    assert found.bits is None and found.share > MAX_SHARE
    assert found.only(log(spark, 40_000)).count() == 20_000


def test_nulls_repeats_and_nothing(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "a"), (4, "a"), (5, "é")], "event_id long, username string")
    flagged = rows.where("event_id != 5").unionByName(rows.where("event_id = 3"))
    found = Membership.of(flagged, "username")
    assert sorted(r.event_id for r in found.only(rows).collect()) == [2, 3, 4]
    assert Membership.of(rows.where("false"), "username").only(rows).count() == 0
    assert found.only(rows.where("false")).count() == 0


def test_only_what_passes_is_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        flagged = spark.range(2_000).selectExpr("concat('u', id) AS username")
        found = Membership.of(flagged, "username")
        plan = found.only(log(spark, 100_000), HotKeys(None, 10**9))._jdf.queryExecution().executedPlan()
        text = plan.toString()
        # The log's lookup in the bit table stands below the exchange of the exact join.
        assert text.index("SortMergeJoin") < text.index("Exchange hashpartitioning(username") < text.index("BroadcastHashJoin")
        passed = found.thin(log(spark, 100_000)).count()
        assert 2_000 <= passed <= 2_000 + 5 + 98_000 * found.share * 1.5 and found.share < 0.01
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_operators_take_either_form(spark, tables, cfg):
    events = tables.events([
        (1, "a", day(0), "US", 1, "1.1.1.1"), (2, "b", day(0), "US", 0, "1.1.1.1"), (3, None, day(0), "US", 0, "1.1.1.1"),
        (4, "a", day(-9), "US", 1, "1.1.1.1"), (5, "a", day(1), "US", 1, "1.1.1.2"),
    ])
    users = spark.createDataFrame([("a",), ("zz",)], "username string")
    members = Membership.of(users, "username")
    for operator in (triage.user_timeline, incidents.incident_attempts):
        plain, thinned = (operator(events, u, cfg).select("event_id").orderBy("event_id").collect() for u in (users, members))
        assert plain == thinned and [r.event_id for r in plain] == [1, 5]
    assert members.thin(events.withColumns({"bits": F.lit(0), "word": F.lit(0)})).count() == 3

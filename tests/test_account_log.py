"""The log by account: the same findings, without a shuffle of the settled accounts."""

from __future__ import annotations

import pytest
from conftest import day
from pyspark.sql import functions as F

from loginwatch.operators import brute_force, impossible_travel
from loginwatch.plans import queries
from loginwatch.plans.hunt import demo_hunt
from loginwatch.sources.account_log import read_account_log, write_account_log

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def hunt(spark):
    return demo_hunt(spark, SF)


@pytest.fixture(scope="module")
def log(spark, hunt, tmp_path_factory):
    write_account_log(hunt.attempts, "by_account", str(tmp_path_factory.mktemp("log")), 4, queries.BUSY_ROWS)
    return read_account_log(spark, "by_account")


def bag(frame):
    return sorted(map(repr, frame.collect()))


RULES = {
    "travel": lambda h: impossible_travel.travel_transitions,
    "brute": lambda h: lambda events: brute_force.detect_brute_force(events, None, h.cfg),
    "failed": lambda h: lambda events: brute_force.detect_bruteforce_failed(events, None, h.cfg),
}


@pytest.mark.parametrize("name", RULES)
def test_rules_find_the_same(hunt, log, name):
    rule = RULES[name](hunt)
    assert bag(log.per_account(rule)) == bag(rule(hunt.events)) != []


def test_every_attempt_is_in_one_part(hunt, log):
    assert log.settled.count() > 0 and log.busy.count() > 0
    assert bag(log.per_account(lambda events: events)) == bag(hunt.events)
    assert not {r.username for r in log.settled.collect()} & {r.username for r in log.busy.collect()}


@pytest.mark.parametrize("name", RULES)
def test_settled_accounts_are_not_shuffled(spark, hunt, log, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rule = RULES[name](hunt)
        settled = rule(log.settled)._jdf.queryExecution().executedPlan().toString()
        windows = settled[settled.index("Window"):] if "Window" in settled else settled
        below = [line for line in windows.splitlines() if "Exchange" in line and "BroadcastExchange" not in line]
        # A window or aggregate keyed by the account reads its bucket; only hits are joined to successes.
        assert not below, below
        assert "Exchange hashpartitioning(username" in rule(hunt.events)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_unknown_accounts_and_rewriting(spark, tables, tmp_path):
    rows = [(i, u, day(0), "US", 1, "1.1.1.1") for i, u in enumerate(["a", "a", "b", None, None, "c"])]
    attempts = tables.attempts(rows).withColumn("note", F.lit("x"))
    for limit, busy in ((1, [0, 1, 3, 4]), (2, [3, 4])):
        write_account_log(attempts, "small", str(tmp_path / "small"), 2, limit)
        log = read_account_log(spark, "small")
        assert sorted(r.event_id for r in log.busy.collect()) == busy
        assert sorted(r.event_id for r in log.per_account(lambda events: events).collect()) == list(range(6))
    write_account_log(attempts.where("false"), "small", str(tmp_path / "small"), 2)
    assert read_account_log(spark, "small").per_account(impossible_travel.travel_transitions).count() == 0

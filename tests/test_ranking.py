"""Places in a total order, counted range by range."""

from __future__ import annotations

import contextlib
import io

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loginwatch.operators import triage
from loginwatch.operators.ranking import placed
from loginwatch.plans.hunt import demo_hunt
from loginwatch.plans.session import stored

SMALL = "/root/testdata/sf0.001"
ROWS = "a int, b string, place_before int"


def plan_of(frame) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain("formatted")
    return out.getvalue()


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.none() | st.integers(0, 3), st.none() | st.sampled_from("xyz"), st.just(0)), max_size=40))
def test_places_equal_a_plain_sort(spark, rows):
    got = placed(spark.createDataFrame(rows, ROWS), ["a", F.desc("b")]).collect()
    assert sorted(r["place"] for r in got) == list(range(1, len(rows) + 1))

    def key(a, b):
        """Nulls first going up, last going down."""
        return -1 if a is None else a, 1 if b is None else -ord(b)

    assert [key(r["a"], r["b"]) for r in sorted(got, key=lambda r: r["place"])] == sorted(key(a, b) for a, b, _ in rows)


def test_ties_and_repeated_rows_get_places_of_their_own(spark):
    rows = [(1, "x", i) for i in range(50)] + [(1, "x", 7)] * 30
    got = placed(spark.createDataFrame(rows, ROWS), ["a", "b"])
    assert sorted(r["place"] for r in got.collect()) == list(range(1, 81)) and got.columns == ["place", "a", "b", "place_before"]
    again = {r["place_before"]: r["place"] for r in placed(spark.createDataFrame(rows[::-1], ROWS), ["a", "b"]).collect()}
    assert again == {r["place_before"]: r["place"] for r in got.orderBy("place").collect()}


def test_every_finding_has_its_place(spark):
    queue = stored(demo_hunt(spark, SMALL).queue(), "queue")
    found = triage.queue_places(queue)
    assert found.count() == queue.count() == found.agg(F.max("place")).first()[0]
    head = {tuple(r) for r in triage.queue_head(queue, 25).collect()}
    assert head == {tuple(r) for r in found.where("place <= 25").select(*triage.queue_head(queue, 1).columns).collect()}


@pytest.mark.parametrize("frame", ["queue", "account"])
def test_no_task_sees_all_rows(spark, frame):
    hunt = demo_hunt(spark, SMALL)
    found = triage.account_timeline(hunt.events, "U000003", hunt.cfg) if frame == "account" else triage.queue_places(stored(hunt.queue(), "queue"))
    plan = plan_of(found)
    assert "SinglePartition" not in plan and "Window" not in plan

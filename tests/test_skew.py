"""One account, and through it one source, with a third of the log: same results, even tasks."""

from __future__ import annotations


import compare
import pytest
from pyspark.sql import functions as F

from loginwatch.operators import skew, timeline, triage
from loginwatch.operators.skew import HotKeys, dealt_join, split_join
from loginwatch.plans.hunt import demo_hunt
from loginwatch.plans.queries import registered


GIVEN = "/root/testdata/sf0.01"
HOT = 7


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """The given log with every third event moved to one account."""
    home = tmp_path_factory.mktemp("skewed")
    events = spark.read.parquet(f"{GIVEN}/events.parquet")
    moved = events.withColumn("user_id", F.expr(f"if(event_id % 3 = 0, {HOT}L, user_id)"))
    moved.coalesce(1).write.parquet(str(home / "log"))
    next((home / "log").glob("part-*")).rename(home / "events.parquet")
    for name in compare.TABLES:
        if name != "events":
            (home / f"{name}.parquet").symlink_to(f"{GIVEN}/{name}.parquet")
    return str(home)


@pytest.mark.parametrize("name", [
    "travel_transitions", "detect_unfamiliar_country", "detect_impossible_travel", "detect_after_hours", "detect_brute_force",
    "detect_password_spray", "detect_bruteforce_failed", "hunt_failures_since_success", "correlate_event_count",
    "correlate_value_count", "stream_event_count", "campaign_metrics", "incident_pages", "incident_signals", "triage_queue",
    "hunt_after_hours", "hunt_unfamiliar_country", "hunt_unfamiliar_country_all", "assemble_incidents", "user_timeline",
    "spray_accounts", "hunt_password_spray_names", "campaign_errors",
])
def test_results_with_a_hot_account(spark, skewed, monkeypatch, name):
    monkeypatch.setattr("loginwatch.operators.skew.HOT_ROWS", 500)
    for module in ("timeline", "impossible_travel", "incidents", "hunts"):
        monkeypatch.setattr(f"loginwatch.operators.{module}.HOT_ROWS", 500)
    for function in ("timeline.with_previous", "timeline.with_chunk", "timeline.hot_accounts"):
        module, f = function.split(".")
        target = getattr(__import__(f"loginwatch.operators.{module}", fromlist=[f]), f)
        monkeypatch.setattr(target, "__defaults__", tuple(500 if d == 4_000_000 else d for d in target.__defaults__ or ()))
    assert compare.compare(spark, compare.connect(skewed), skewed, name) is None


def test_no_task_gathers_the_hot_account(spark, skewed):
    """Rows that reach a rule's ordered pass are points, which a busy account has few of."""
    events = spark.read.parquet(f"{skewed}/events.parquet")
    assert events.where(F.col("user_id") == HOT).count() * 3 >= events.count()
    seconds = events.where(F.col("user_id") == HOT).select("ts").distinct().count()
    doubled = events
    for _ in range(4):
        doubled = doubled.unionByName(doubled)
    from loginwatch.operators.normalize import login_events
    from loginwatch.operators.timeline import account_points
    from loginwatch.sources import demo

    points = account_points(login_events(demo.attempts_from(doubled)))
    of_hot = points.where("username = 'U000007'").count()
    assert doubled.count() == 16 * events.count() and of_hot <= seconds


SPLIT = [
    "detect_unfamiliar_country", "detect_after_hours", "hunt_after_hours", "hunt_unfamiliar_country_all", "assemble_incidents",
    "detect_password_spray", "spray_accounts", "campaign_metrics",
]


def largest_read(spark, run) -> int:
    """Most rows that one task read from a shuffle while ``run`` ran."""
    context = spark.sparkContext
    group = f"largest-{id(run)}"
    context.setJobGroup(group, group)
    try:
        run()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker, store, most = context.statusTracker(), context._jsc.sc().statusStore(), 0
    stages = {s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds}
    for stage in stages:
        tasks = store.taskList(stage, 0, 100_000)
        for i in range(tasks.size()):
            metrics = tasks.apply(i).taskMetrics()
            if metrics.isDefined():
                most = max(most, metrics.get().shuffleReadMetrics().recordsRead())
    return most


@pytest.fixture()
def bare(spark):
    """No help from the engine: no automatic broadcast, no adaptive plans; many partitions."""
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "24"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("name", SPLIT)
def test_largest_task_is_a_small_share_without_help(spark, skewed, bare, monkeypatch, name):
    """The hot account has a third of the log; no task reads a twelfth of the window."""
    window = demo_hunt(spark, skewed).window_events.count()
    monkeypatch.setattr(skew, "HOT_ROWS", 500)
    assert largest_read(spark, registered()[name](spark, skewed).collect) < window / 12


def test_timelines_leave_the_hot_account_where_it_is(spark, skewed, bare, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 500)
    hunt = demo_hunt(spark, skewed)
    users = spark.createDataFrame([("U000007",), ("U000003",)], "username string")
    timeline = triage.user_timeline(hunt.events, users, hunt.cfg)
    assert largest_read(spark, timeline.collect) < hunt.window_events.count() / 12
    assert timeline.count() == hunt.window_events.where("username IN ('U000007', 'U000003')").count()


def test_plain_join_would_gather_the_hot_account(spark, skewed, bare):
    """What the test before guards against, seen with the same measure."""
    hunt = demo_hunt(spark, skewed)
    window = hunt.window_events
    side = window.select("username").distinct().withColumn("x", F.lit(1))
    assert largest_read(spark, window.join(side, "username").select("event_id", "x").collect) > window.count() / 4


ROWS, SIDE = "k string, v long", "k string, w string"


def test_split_join_equals_the_plain_one(spark):
    rows = spark.createDataFrame([("a", i) for i in range(30)] + [("b", i) for i in range(5)] + [("c", 1), ("d", 2), (None, 3), (None, 4)], ROWS)
    side = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", None), ("e", "z"), (None, "n")], SIDE)
    no_hot_in_side = side.where("k <> 'a'")
    for small in (side, no_hot_in_side, side.where("false")):
        for how in ("inner", "left", "left_semi"):
            want = sorted(map(tuple, rows.join(small, ["k"], how).collect()), key=repr)
            for limit in (0, 4, 10, 1000):
                hot = HotKeys.of(rows, ["k"], limit)
                got = split_join(rows, small, ["k"], how, hot)
                assert got.columns == rows.join(small, ["k"], how).columns
                assert sorted(map(tuple, got.collect()), key=repr) == want
    assert split_join(rows.where("false"), side, ["k"], "left").count() == 0
    with pytest.raises(ValueError):
        split_join(rows, side, ["k"], "outer")


def test_hot_keys_are_counted(spark):
    rows = spark.createDataFrame([("a", i % 2) for i in range(30)] + [("b", 0)] * 5 + [(None, 0)] * 50, ROWS)
    hot = HotKeys.of(rows, ["k"], 10)
    assert [r["k"] for r in hot.listed.collect()] == ["a"] and HotKeys.of(rows, ["k"], 30).listed is None
    assert HotKeys.of(rows, ["k"], 14).within(rows, ["k", "v"]).listed.count() == 2
    assert HotKeys.of(rows, ["k"], 15).within(rows, ["k", "v"]).listed is None


def test_dealt_join_equals_the_plain_one(spark):
    rows = spark.createDataFrame([("a", i) for i in range(40)] + [(None, i) for i in range(9)] + [("b", None)], ROWS)
    side = spark.createDataFrame([("a", "x"), (None, "n"), ("z", "y")], SIDE).withColumnRenamed("k", "sk")
    for how in ("inner", "left_semi"):
        want = sorted(map(tuple, rows.join(side, F.expr("k <=> sk"), how).collect()), key=repr)
        assert sorted(map(tuple, dealt_join(rows, side, "k <=> sk", "v", how, 5).collect()), key=repr) == want
    with pytest.raises(ValueError):
        dealt_join(rows, side, "k = sk", "v", "left")


@pytest.mark.parametrize("block", [1, 7, 10, 1000])
def test_running_totals_do_not_depend_on_blocks(spark, block):
    """Rows at, just before and just after the edges of blocks, negative instants and a NULL key too."""
    rows = [(k, t, d, d > 0) for k in ("a", "b", None) for t, d in [(-8, 2), (-7, 1), (0, 3), (6, 4), (7, -1), (9, 5), (10, 1), (10, -2), (11, 6), (70, -3), (71, 1)]]
    moves = spark.createDataFrame(rows, "k string, t long, delta long, arrives boolean")
    plain = moves.groupBy("k", "t").agg(F.sum("delta").alias("d"), F.max("arrives").alias("arrives")).selectExpr(
        "k", "t AS at", "sum(d) OVER (PARTITION BY k ORDER BY t) AS trailing", "arrives").where("arrives").drop("arrives")
    got = timeline.running_total(moves, "k", block)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_no_task_sorts_more_than_a_block_of_a_key(spark, bare):
    moves = spark.range(20_000).selectExpr("'hot' AS k", "id AS t", "1L AS delta", "true AS arrives")
    found = timeline.running_total(moves, "k", 500)
    # Forty blocks on 24 partitions: some tasks get a few of them.
    assert largest_read(spark, found.collect) <= 20_000 / 4 and found.agg(F.max("trailing")).first()[0] == 20_000

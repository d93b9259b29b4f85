"""Password guessing against one account: landed, and not landed."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loginwatch.config import HuntConfig
from loginwatch.functions import clock, messages
from loginwatch.operators.normalize import named, since_day, successes
from loginwatch.operators.timeline import account_points


def failure_runs(events: DataFrame, cfg: HuntConfig) -> DataFrame:
    """Per account and success instant: failures that lead up to it uninterrupted.

    A failure belongs to the next later success instant and, when one shares its own
    second, to that one as well. Working on one row per account and second keeps the
    ordered pass linear and bounded, with no interval join.
    """
    span = timedelta(minutes=cfg.bf_window_minutes)
    start = clock.micros_of(cfg.detection_start)
    earliest = clock.utc(cfg.detection_start) - span
    reach = since_day(events, clock.dates_from(earliest)).where(F.col("ts") >= clock.instant(earliest))
    points = account_points(reach.select("username", "ts", "success"))
    # Newest first, so the last success instant seen so far is the next one in time.
    next_win = """last(if(wins > 0, at, NULL), true) OVER (PARTITION BY username ORDER BY at DESC
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
    targets = (
        points.selectExpr("username", "at", "failures", "wins", f"{next_win} AS next_win")
        .where("failures > 0")
        .selectExpr("username", "at", "failures", "explode(array(if(wins > 0, at, NULL), next_win)) AS target")
        .where(f"target - at <= {span // timedelta(microseconds=1)}L AND target >= {start}L")
    )
    return (
        targets.groupBy("username", "target")
        .agg(F.expr("sum(failures) AS failure_count"), F.expr("min(at) AS first_at"))
        .where(f"failure_count >= {cfg.bf_min_failures}")
        .selectExpr(
            "username", "timestamp_micros(target) AS ts", "failure_count",
            "timestamp_micros(first_at) AS first_failure_ts",
        )
    )


def detect_brute_force(events: DataFrame, employees: DataFrame | None, cfg: HuntConfig) -> DataFrame:
    recent = since_day(successes(events), cfg.detection_start)
    hits = recent.join(failure_runs(events, cfg), ["username", "ts"])
    return named(hits, employees).selectExpr(
        "event_id", "username", "user_name", "department",
        "date_format(first_failure_ts, 'yyyy-MM-dd HH:mm:ss') AS first_failure",
        f"{clock.stamp()} AS success_time", "failure_count", "source_ip AS success_ip", "'HIGH' AS severity",
        f"{messages.BRUTE_FORCE.format(minutes=cfg.bf_window_minutes)} AS reason",
    )


def detect_bruteforce_failed(events: DataFrame, employees: DataFrame | None, cfg: HuntConfig) -> DataFrame:
    """Failures of one account from one source in one day, none of which landed.

    Success and failure share the grouping key, so the exclusion is part of the same
    map-side combined aggregate. A success never excludes an unknown source.
    """
    groups = (
        since_day(events, cfg.detection_start)
        .groupBy("username", "source_ip", "login_date")
        .agg(
            F.expr("count_if(success = 0) AS failure_count"),
            F.expr("count_if(success = 1) AS wins"),
            F.expr("min(if(success = 0, ts, NULL)) AS first_ts"),
            F.expr("max(if(success = 0, ts, NULL)) AS last_ts"),
        )
        .where(f"failure_count >= {cfg.bf_failed_min_failures} AND (wins = 0 OR source_ip IS NULL)")
    )
    return named(groups, employees).selectExpr(
        "username", "user_name", "department", "login_date", "source_ip", "failure_count",
        "date_format(first_ts, 'HH:mm:ss') AS first_attempt",
        "date_format(last_ts, 'HH:mm:ss') AS last_attempt",
        "concat(username, '|', source_ip, '|', login_date) AS campaign_key", "'MEDIUM' AS severity",
        f"{messages.BRUTEFORCE_FAILED} AS reason",
    )

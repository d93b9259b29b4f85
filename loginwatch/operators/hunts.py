"""Hunting-query variants: relative to ``asof`` instead of a configuration table.

They watch for the same threats as the detections, with the simpler semantics of the
hunts. Events are those strictly later than ``asof - lookback``; baseline-style hunts
split that range at ``asof - split``.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loginwatch.functions import clock
from loginwatch.functions.accounts import country_severity, starts_as_service
from loginwatch.operators.impossible_travel import CHANGED_COUNTRY, one_per_pair, with_pair
from loginwatch.operators.normalize import after, failures, successes
from loginwatch.operators.password_spray import source_day_accounts, with_name_pages
from loginwatch.operators.sizing import broadcast_if_small
from loginwatch.operators.skew import split_join
from loginwatch.operators.timeline import HOT_ROWS, with_previous


def _detect_phase(asof: datetime, split: timedelta) -> str:
    return f"ts >= timestamp_micros({clock.micros_of(clock.utc(asof) - split)})"


def _recent(events: DataFrame, asof: datetime, lookback: timedelta) -> DataFrame:
    return after(events, clock.utc(asof) - lookback)


def hunt_after_hours(
    events: DataFrame,
    asof: datetime,
    lookback: timedelta = timedelta(days=7),
    split: timedelta = timedelta(days=2),
    slack: int = 2,
) -> DataFrame:
    """Detect-phase successes outside the account's baseline hours, give or take ``slack``.

    The hour range is one map-side combined aggregate joined back, busy accounts without
    a shuffle. Accounts without a baseline never fire.
    """
    recent = successes(_recent(events, asof, lookback)).where(f"NOT {starts_as_service()}")
    detect = _detect_phase(asof, split)
    usual = recent.where(f"NOT {detect}").groupBy("username").agg(
        F.expr("min(login_hour) AS min_hour"), F.expr("max(login_hour) AS max_hour")
    )
    return split_join(recent.where(detect), usual, ["username"]).where(
        f"login_hour < min_hour - {slack} OR login_hour > max_hour + {slack}"
    ).select("event_id", "username", "ts", "login_hour", "min_hour", "max_hour", "source_ip")


def hunt_unfamiliar_country(
    events: DataFrame,
    asof: datetime,
    lookback: timedelta = timedelta(days=7),
    split: timedelta = timedelta(days=2),
    mode: str = "latest",
) -> DataFrame:
    """Detect-phase logins from a country not in the baseline; no baseline means all fire.

    ``latest`` looks at each account's newest detect-phase login, ``all`` at every one.
    """
    recent = successes(_recent(events, asof, lookback))
    detect = _detect_phase(asof, split)
    pairs = recent.where(f"NOT {detect}").select("username", "country").distinct()
    known = pairs.groupBy("username").agg(F.expr("array_sort(collect_list(country)) AS known"))
    if mode == "latest":
        newest = F.expr("max(struct(ts, event_id, country, source_ip)) AS m")
        logins = recent.where(detect).groupBy("username").agg(newest).select("username", "m.*")
    elif mode == "all":
        logins = recent.where(detect).select("username", "ts", "event_id", "country", "source_ip")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    # The newest login is one row per account already.
    rows = logins.join(known, "username", "left") if mode == "latest" else split_join(logins, known, ["username"], "left")
    return rows.where("NOT coalesce(array_contains(known, country), false)").selectExpr(
        "event_id", "username", "country AS detect_country",
        "coalesce(array_join(known, ','), '') AS baseline", "source_ip", f"{country_severity()} AS severity",
    )


def hunt_impossible_travel(
    events: DataFrame,
    country_distance: DataFrame,
    asof: datetime,
    lookback: timedelta = timedelta(days=7),
    max_kmh: float = 900.0,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Consecutive successes in two countries, gated on the rounded speed.

    Distances are looked up under the normalised pair; no time between the two counts
    as infinitely fast and leaves ``required_kmh`` NULL. Exceptions do not apply.
    """
    fields = ["event_id", "ts", "country"]
    recent = successes(_recent(events, asof, lookback)).select("username", *fields)
    legs = with_pair(with_previous(recent, fields, CHANGED_COUNTRY, hot_rows), "prev.country").join(
        one_per_pair(country_distance, "distance_km"), ["country_a", "country_b"]
    )
    kmh = clock.round_ratio("distance_km * 3600L", "seconds")
    return legs.selectExpr("*", "unix_seconds(ts) - unix_seconds(prev.ts) AS seconds").selectExpr(
        "event_id", "username", "prev.country AS prev_country", "country", "seconds",
        "seconds / 3600D AS hours", f"CASE WHEN seconds > 0 THEN {kmh} END AS required_kmh",
    ).where(f"seconds = 0 OR required_kmh > {max_kmh!r}D").drop("seconds")


def hunt_failures_since_success(
    events: DataFrame,
    asof: datetime,
    lookback: timedelta = timedelta(days=7),
    min_failures: int = 5,
) -> DataFrame:
    """Successes that end a run of failures, however long the run lasted.

    Failures of an instant precede its successes; the success with the lowest id closes
    the run. Works on one row per account and second, so the running count is bounded.
    """
    points = _recent(events, asof, lookback).groupBy("username", "ts").agg(
        F.expr("count_if(success != 1) AS failures"),
        F.expr("min(if(success = 1, struct(event_id, source_ip), NULL)) AS closer"),
    )
    run = """coalesce(count_if(closer IS NOT NULL) OVER (PARTITION BY username ORDER BY ts
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L)"""
    runs = points.selectExpr("*", f"{run} AS run_no").groupBy("username", "run_no").agg(
        F.expr("sum(failures) AS failures_since_success"),
        F.expr("min(if(failures > 0, ts, NULL)) AS first_failure"),
        F.expr("max(if(closer IS NOT NULL, struct(ts, closer), NULL)) AS end"),
    )
    minutes = clock.tenths("unix_seconds(end.ts) - unix_seconds(first_failure)", "60L")
    return runs.where(f"end IS NOT NULL AND failures_since_success >= {min_failures}").selectExpr(
        "end.closer.event_id AS event_id", "username", "end.ts AS ts", "end.closer.source_ip AS source_ip",
        "failures_since_success", "first_failure", f"{minutes} AS time_window_minutes",
    )


def hunt_failed_bruteforce(
    events: DataFrame,
    asof: datetime,
    lookback: timedelta = timedelta(days=7),
    min_failures: int = 10,
) -> DataFrame:
    """Account, source and day with many failures and no success; one aggregate."""
    groups = _recent(events, asof, lookback).groupBy("username", "source_ip", F.expr("login_date AS day")).agg(
        F.expr("count_if(success != 1) AS failures"), F.expr("count_if(success = 1) AS successes")
    )
    return groups.where(f"failures >= {min_failures} AND successes = 0")


def hunt_password_spray(
    events: DataFrame,
    asof: datetime,
    lookback: timedelta = timedelta(days=7),
    min_accounts: int = 5,
    page: int | None = None,
) -> DataFrame:
    """Sources failing against many accounts in a day; breadth is counted exactly.

    Accounts are folded per source and day first, so that a busy source is spread over
    its accounts. With ``page``, their names come too, on pages of about that many.
    """
    accounts = source_day_accounts(failures(_recent(events, asof, lookback)))
    groups = accounts.groupBy("source_ip", "login_date").agg(
        F.expr("count_if(username IS NOT NULL) AS accounts_targeted"), F.expr("sum(failures) AS total_failures"),
        F.expr("count(1) AS accounts"),
    ).where(f"accounts_targeted >= {min_accounts}")
    if page is not None:
        groups = with_name_pages(groups, accounts, page)
    return groups.drop("accounts").withColumnRenamed("login_date", "day")


def hunt_password_spray_estimate(
    events: DataFrame,
    asof: datetime,
    lookback: timedelta = timedelta(days=7),
    min_accounts: int = 5,
    error: float = 0.05,
) -> DataFrame:
    """The exact hunt with ``estimate``, the breadth as a sketch sees it.

    The sketch needs one small shuffle and serves dashboards; it never decides who is
    reported. ``close`` tells whether it is within ``error`` of the exact count (or off by
    one account at most).
    """
    key = ["source_ip", F.expr("login_date AS day")]
    sketch = failures(_recent(events, asof, lookback)).groupBy(*key).agg(
        F.expr(f"approx_count_distinct(username, {error / 3!r}D) AS estimate")
    ).withColumnsRenamed({"source_ip": "key_ip", "day": "key_day"})
    exact = hunt_password_spray(events, asof, lookback, min_accounts)
    return exact.join(sketch, F.expr("source_ip <=> key_ip AND day = key_day")).selectExpr(
        "source_ip", "day", "accounts_targeted", "total_failures",
        f"abs(estimate - accounts_targeted) <= greatest(1, {error!r}D * accounts_targeted) AS close",
    )


def hunt_inactive_account(
    events: DataFrame,
    identity_feed: DataFrame,
    asof: datetime,
    lookback: timedelta = timedelta(days=30),
) -> DataFrame:
    """Recent attempts on accounts the identity feed does not list as active."""
    inactive = identity_feed.where("account_status != 'Active'").selectExpr(
        "principal AS username", "account_status"
    )
    return _recent(events, asof, lookback).join(broadcast_if_small(inactive), "username").selectExpr(
        "event_id", "username", "account_status", "ts", "success", "source_ip", "country",
        "if(success = 1, 'CRITICAL', 'HIGH') AS severity",
    )

"""Consecutive successes too far apart for the time between them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loginwatch.config import HuntConfig
from loginwatch.functions import clock, messages
from loginwatch.operators.normalize import named, since_day, successes
from loginwatch.operators.sizing import broadcast_if_small
from loginwatch.operators.timeline import HOT_ROWS, with_previous

_CARRIED = ["event_id", "ts", "login_date", "login_time", "country", "source_ip"]

CHANGED_COUNTRY = "prev.country != country"


def _last_before(events: DataFrame, since: date, history: DataFrame | None) -> DataFrame:
    """Each account's last success before ``since``, folded map-side or from the history."""
    columns = "ts, event_id, login_date, login_time, country, source_ip"
    if history is None:
        rows = successes(events).where(f"login_date < date'{since}'")
    else:
        rows = history.where("last_success IS NOT NULL").select("username", "country", "last_success.*")
    newest = rows.groupBy("username").agg(F.expr(f"max(struct({columns})) AS m"))
    return newest.select("username", "m.*").select("username", *_CARRIED)


def travel_transitions(events: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every success with the account's previous success beside it."""
    rows = with_previous(successes(events).select("username", *_CARRIED), _CARRIED, hot_rows=hot_rows)
    return rows.selectExpr(
        "event_id", "username", "login_date", "login_time", "country", "source_ip", "ts",
        "prev.event_id AS prev_event_id", "prev.country AS prev_country", "prev.ts AS prev_ts",
        "prev.source_ip AS prev_ip", "prev.login_date AS prev_login_date",
        "prev.login_time AS prev_login_time",
    )


def with_pair(legs: DataFrame, prev_country: str) -> DataFrame:
    """Normalised country pair. Both sides are known to be non-NULL here."""
    return legs.selectExpr(
        "*", f"least(country, {prev_country}) AS country_a", f"greatest(country, {prev_country}) AS country_b"
    )


def one_per_pair(table: DataFrame, value: str) -> DataFrame:
    """The least ``value`` of every country pair, broadcast if the table is small."""
    pairs = table.groupBy("country_a", "country_b").agg(F.expr(f"min({value}) AS {value}"))
    return broadcast_if_small(pairs)


def detect_impossible_travel(
    events: DataFrame,
    employees: DataFrame | None,
    country_distance: DataFrame,
    travel_exceptions: DataFrame,
    cfg: HuntConfig,
    hot_rows: int = HOT_ROWS,
    history: DataFrame | None = None,
) -> DataFrame:
    """Legs whose required speed exceeds the gate; excepted pairs drop to MEDIUM.

    Pair tables are made one row per pair, so that a repeated one doubles no finding, and
    broadcast if small: there are about 31,000 pairs of countries. Arithmetic is in whole seconds and kilometres. Of the
    time before the window only one row per account takes part.
    """
    pair = ["country_a", "country_b"]
    recent = since_day(successes(events), cfg.detection_start).select("username", *_CARRIED)
    rows = recent.unionByName(_last_before(events, cfg.detection_start, history))
    legs = with_previous(rows, _CARRIED, CHANGED_COUNTRY, hot_rows, counted=recent)
    legs = with_pair(since_day(legs, cfg.detection_start), "prev.country").join(
        one_per_pair(country_distance, "distance_km"), pair
    ).join(one_per_pair(travel_exceptions, "rationale"), pair, "left")
    # Same-instant pairs count as one minute apart, so they fire instead of dividing by zero.
    legs = legs.selectExpr(
        "*", "unix_seconds(ts) - unix_seconds(prev.ts) AS gap",
        "greatest(unix_seconds(ts) - unix_seconds(prev.ts), 60L) AS guarded",
        "distance_km * 3600L AS km_seconds",
    ).where(f"cast(km_seconds AS double) > {cfg.max_travel_speed_kmh!r}D * guarded")
    legs = legs.selectExpr(
        "*", f"{clock.tenths('gap', '3600L')} AS hours_apart",
        f"cast({clock.round_ratio('km_seconds', 'guarded')} AS int) AS required_kmh",
    )
    return named(legs, employees).selectExpr(
        "event_id", "prev.event_id AS prev_event_id", "username", "user_name", "department",
        f"{clock.stamp('prev.login_date', 'prev.login_time')} AS timestamp_1",
        "prev.country AS country_1", "prev.source_ip AS ip_1",
        f"{clock.stamp()} AS timestamp_2", "country AS country_2", "source_ip AS ip_2",
        "hours_apart", "distance_km", "required_kmh",
        "if(rationale IS NULL, 'HIGH', 'MEDIUM') AS severity",
        f"{messages.IMPOSSIBLE_TRAVEL.format(gate=cfg.speed_text())} AS reason",
    )

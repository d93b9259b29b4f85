"""Rule correlations over a batch of events: exact rolling windows."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loginwatch.operators.timeline import merge_instants, running_total, trailing_total

HOUR = timedelta(hours=1)


def _micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def correlate_event_count(
    events: DataFrame, group: str = "username", timespan: timedelta = HOUR, gte: int = 5, weight: str = "1L"
) -> DataFrame:
    """Instants at which ``group`` has at least ``gte`` events within the trailing span.

    ``events`` is the rule's base selection, such as the failures; a row stands for
    ``weight`` events.
    """
    totals = trailing_total(events, group, weight, _micros(timespan))
    return totals.where(f"trailing >= {gte}").selectExpr(
        group, "timestamp_micros(at) AS ts", "trailing AS event_count"
    )


def correlate_value_count(
    events: DataFrame,
    group: str = "source_ip",
    field: str = "username",
    timespan: timedelta = HOUR,
    gte: int = 5,
) -> DataFrame:
    """Instants at which ``group`` shows at least ``gte`` distinct ``field`` values in the span.

    A value counts from an event until one span after its last event in reach. Those
    stays are found per (group, value), netted to one row per group and instant, and
    summed in order: the distinct count is exact and no set of values is ever built.
    """
    span = _micros(timespan)
    seen = events.where(f"{field} IS NOT NULL").groupBy(group, field, "ts").agg(F.expr("count(1) AS n"))
    order = f"OVER (PARTITION BY {group}, {field} ORDER BY at)"
    stays = seen.selectExpr(group, field, "unix_micros(ts) AS at").selectExpr(
        group, "at",
        f"if(at - lag(at) {order} <= {span}L, 0L, 1L) AS enters",
        f"coalesce(lead(at) {order} - at > {span}L, true) AS leaves",
    )
    moves = stays.selectExpr(
        group,
        f"""inline(array_compact(array(
            struct(at AS t, enters AS delta, true AS arrives),
            if(leaves, struct(at + {span + 1}L AS t, -1L AS delta, false AS arrives), NULL))))""",
    )
    return running_total(moves, group).where(f"trailing >= {gte}").selectExpr(
        group, "timestamp_micros(at) AS ts", "trailing AS value_count"
    )


def merge_alerts(alerts: DataFrame, group: str, measure: str, gap: timedelta = HOUR) -> DataFrame:
    """Fold alert instants at most ``gap`` apart into one burst per group."""
    instants = alerts.selectExpr("*", "unix_micros(ts) AS at")
    return merge_instants(instants, group, _micros(gap), measure).selectExpr(
        group, "timestamp_micros(first_at) AS first_alert", "timestamp_micros(last_at) AS last_alert",
        "instants", f"peak AS {measure}",
    )


def merge_windows(alerts: DataFrame, group: str, measure: str) -> DataFrame:
    """Fold overlapping or touching alert windows of the streaming form into one burst."""
    order = f"OVER (PARTITION BY {group} ORDER BY window_start"
    reach = f"max(window_end) {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    numbered = alerts.selectExpr("*", f"if(window_start <= {reach}, 0, 1) AS opens").selectExpr(
        "*", f"sum(opens) {order} ROWS UNBOUNDED PRECEDING) AS burst"
    )
    return numbered.groupBy(group, "burst").agg(
        F.expr("min(window_start) AS first_window_start"), F.expr("max(window_end) AS last_window_end"),
        F.expr("count(1) AS windows"), F.expr(f"max({measure}) AS {measure}"),
    ).drop("burst")

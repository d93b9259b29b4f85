"""Successful logins from a country outside the account's baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame

from loginwatch.config import HuntConfig
from loginwatch.functions import clock, messages
from loginwatch.functions.accounts import country_severity
from loginwatch.operators.baselines import country_profile
from loginwatch.operators.normalize import named, since_day, successes
from loginwatch.operators.skew import HotKeys, split_join


def suspect_pairs(events: DataFrame, cfg: HuntConfig, history: DataFrame | None = None) -> DataFrame:
    """The account-country pairs that can fire.

    With a baseline: countries not in it, at any time. Without one: only the account's
    first success, so the pair carries the instant that must be met.
    """
    return country_profile(events, cfg, history).where(
        "NOT known AND (size(known_countries) > 0 OR first_ts = account_first_ts)"
    ).selectExpr(
        "username", "country",
        "if(size(known_countries) = 0, account_first_ts, NULL) AS only_at",
        "if(size(known_countries) > 0, array_join(known_countries, ','), NULL) AS baseline_countries",
    )


def detect_unfamiliar_country(
    events: DataFrame, employees: DataFrame | None, cfg: HuntConfig, history: DataFrame | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """One equi-join of window successes with the few suspect pairs; busy pairs are not
    shuffled. ``hot``: the busy accounts of the window, if they are known."""
    recent, pair = since_day(successes(events), cfg.detection_start), ["username", "country"]
    busy = HotKeys.of(recent, pair) if hot is None else hot.within(recent, pair)
    hits = split_join(recent, suspect_pairs(events, cfg, history), pair, hot=busy).where(
        "only_at IS NULL OR ts = only_at"
    )
    return named(hits, employees).selectExpr(
        "event_id", "username", "user_name", "department", f"{clock.stamp()} AS timestamp",
        "country AS anomaly_country", "baseline_countries", "source_ip",
        "if(only_at IS NULL, 'baseline', 'no_baseline') AS baseline_state",
        f"{country_severity()} AS severity",
        f"{messages.UNFAMILIAR_COUNTRY} AS reason",
    )

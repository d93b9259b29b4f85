"""Successful logins outside the account's usual hours."""

from __future__ import annotations

from pyspark.sql import DataFrame

from loginwatch.config import HuntConfig
from loginwatch.functions import clock, messages
from loginwatch.functions.accounts import IT_DEPARTMENTS, is_service, text_list
from loginwatch.operators.baselines import account_windows
from loginwatch.operators.normalize import since_day, successes
from loginwatch.operators.skew import HotKeys, split_join


def detect_after_hours(
    events: DataFrame, employees: DataFrame, cfg: HuntConfig, history: DataFrame | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Both bounds are inclusive; accounts missing from the directory drop out. Busy accounts
    (``hot``, if they are known) are not shuffled."""
    recent = since_day(successes(events), cfg.detection_start).where(f"NOT {is_service()}")
    hits = split_join(recent, account_windows(events, employees, cfg, history), ["username"], hot=hot).where(
        "login_hour < window_start OR login_hour > window_end"
    )
    return hits.selectExpr(
        "event_id", "username", "user_name", "department", f"{clock.stamp()} AS timestamp",
        "login_hour", "country", "source_ip", "baseline_source", "window_start", "window_end",
        f"if(department IN ({text_list(IT_DEPARTMENTS)}), 'LOW', 'MEDIUM') AS severity",
        f"{messages.AFTER_HOURS} AS reason",
    )

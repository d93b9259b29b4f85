"""Known-normal: countries, hours and patch posture."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loginwatch.config import HuntConfig
from loginwatch.functions import clock
from loginwatch.functions.accounts import FULL_NAME, is_service
from loginwatch.functions.text import joined
from loginwatch.operators.normalize import directory, since_day, successes
from loginwatch.operators.sizing import broadcast_if_small

# The window of accounts without any baseline.
DEFAULT_WINDOW = (6, 20)


def baseline_successes(events: DataFrame, cfg: HuntConfig) -> DataFrame:
    return successes(events).where(f"login_date < date'{cfg.baseline_end}'")


def user_country_baseline(events: DataFrame, cfg: HuntConfig) -> DataFrame:
    """Countries each account succeeded from before the baseline ends."""
    return baseline_successes(events, cfg).select("username", "country").distinct()


def user_country_baseline_display(events: DataFrame, cfg: HuntConfig) -> DataFrame:
    """The baseline as sorted text. The list is bounded by the number of countries."""
    return user_country_baseline(events, cfg).groupBy("username").agg(
        F.expr(f"{joined('collect_list(country)')} AS known_countries"),
        F.expr("count(1) AS country_count"),
    )


def country_profile(events: DataFrame, cfg: HuntConfig, history: DataFrame | None = None) -> DataFrame:
    """Per account and country: first success, and what the account knew at baseline.

    One hash aggregate with map-side combine reads the log; the window runs over its
    pairs, of which an account has at most one per country. With a stored ``history``
    only the detection window is read.
    """
    first = F.expr("min(ts) AS first_ts")
    if history is None:
        pairs = successes(events).groupBy("username", "country").agg(first)
    else:
        fresh = since_day(successes(events), cfg.detection_start).groupBy("username", "country").agg(first)
        pairs = fresh.unionByName(history.select("username", "country", "first_ts")).groupBy(
            "username", "country"
        ).agg(F.expr("min(first_ts) AS first_ts"))
    known = f"first_ts < timestamp_micros({clock.micros_of(cfg.baseline_end)})"
    account = "OVER (PARTITION BY username)"
    return pairs.selectExpr(
        "username", "country", "first_ts", f"{known} AS known",
        f"array_sort(collect_list(if({known}, country, NULL)) {account}) AS known_countries",
        f"min(first_ts) {account} AS account_first_ts",
    )


def hourly_distribution(events: DataFrame) -> DataFrame:
    """Successes by hour and their share of all successes in percent."""
    by_hour = successes(events).groupBy("login_hour").agg(F.expr("count(1) AS login_count"))
    # At most 24 rows reach the total.
    share = clock.tenths("100 * login_count", "sum(login_count) OVER ()")
    return by_hour.selectExpr("login_hour", "login_count", f"{share} AS pct")


def user_hour_baseline(events: DataFrame, cfg: HuntConfig, history: DataFrame | None = None) -> DataFrame:
    if history is not None:
        return history.where("baseline_logins > 0").groupBy("username").agg(
            F.expr("sum(baseline_logins) AS baseline_logins"), F.expr("min(min_hour) AS min_hour"),
            F.expr("max(max_hour) AS max_hour"),
        )
    return baseline_successes(events, cfg).groupBy("username").agg(
        F.expr("count(1) AS baseline_logins"), F.expr("min(login_hour) AS min_hour"),
        F.expr("max(login_hour) AS max_hour"),
    )


def dept_hour_baseline(
    events: DataFrame, employees: DataFrame, cfg: HuntConfig, history: DataFrame | None = None
) -> DataFrame:
    """Department hours, rolled up from the per-account rows; service accounts excluded."""
    people = user_hour_baseline(events, cfg, history).where(f"NOT {is_service()}")
    return people.join(directory(employees), "username").groupBy("department").agg(
        F.expr("sum(baseline_logins) AS baseline_logins"), F.expr("min(min_hour) AS min_hour"),
        F.expr("max(max_hour) AS max_hour"),
    )


def account_windows(
    events: DataFrame, employees: DataFrame, cfg: HuntConfig, history: DataFrame | None = None
) -> DataFrame:
    """Hour window of every directory account, with its display columns."""
    user = user_hour_baseline(events, cfg, history).selectExpr(
        "username", "baseline_logins AS u_n", "min_hour AS u_min", "max_hour AS u_max"
    )
    dept = dept_hour_baseline(events, employees, cfg, history).selectExpr(
        "department", "baseline_logins AS d_n", "min_hour AS d_min", "max_hour AS d_max"
    )
    enough, slack = cfg.hour_baseline_min_samples, cfg.hour_tolerance

    def tier(user_value: str, dept_value: str, default: str) -> str:
        return f"CASE WHEN u_n >= {enough} THEN {user_value} WHEN d_n >= {enough} THEN {dept_value} ELSE {default} END"

    # A handful of departments would make a handful of hot keys.
    tiers = directory(employees).join(user, "username", "left").join(broadcast_if_small(dept), "department", "left")
    return tiers.selectExpr(
        "username", "user_name", "department",
        tier("'user'", "'department'", "'global-default'") + " AS baseline_source",
        tier(f"u_min - {slack}", f"d_min - {slack}", str(DEFAULT_WINDOW[0])) + " AS window_start",
        tier(f"u_max + {slack}", f"d_max + {slack}", str(DEFAULT_WINDOW[1])) + " AS window_end",
    )


def hour_windows(events: DataFrame, employees: DataFrame, cfg: HuntConfig) -> DataFrame:
    return account_windows(events, employees, cfg).select(
        "username", "baseline_source", "window_start", "window_end"
    )


def patch_status(machines: DataFrame, employees: DataFrame, cfg: HuntConfig) -> DataFrame:
    """Days since each device was patched, and the risk band."""
    owners = employees.selectExpr("employee_id", f"{FULL_NAME} AS owner_name", "department")
    days = f"datediff(date'{cfg.asof_date}', os_patch_date)"
    return machines.join(owners, "employee_id", "left").selectExpr(
        "device_id", "employee_id", "owner_name", "department", "operating_system", "os_patch_date",
        f"{days} AS days_since_patch",
        f"CASE WHEN {days} > 180 THEN 'CRITICAL' WHEN {days} > 90 THEN 'WARNING' ELSE 'OK' END AS patch_risk",
    )

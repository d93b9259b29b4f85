"""Login attempts with a typed instant, and the directory columns findings show."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loginwatch.functions import clock
from loginwatch.functions.accounts import FULL_NAME


def login_events(log_in_attempts: DataFrame) -> DataFrame:
    """Add ``ts`` and ``login_hour`` to every attempt. A projection: no shuffle."""
    return log_in_attempts.selectExpr(
        "event_id", "username", "login_date", "login_time", "country", "success", "source_ip",
        f"{clock.login_instant()} AS ts", f"{clock.hour_of()} AS login_hour",
    )


def successes(events: DataFrame) -> DataFrame:
    return events.where("success = 1")


def failures(events: DataFrame) -> DataFrame:
    """The base selection of the failure correlations."""
    return events.where("success = 0")


def since_day(events: DataFrame, day: date) -> DataFrame:
    """Events of ``day`` and later; the bound is a literal and prunes partitions."""
    return events.where(f"login_date >= date'{day}'")


def after(events: DataFrame, moment: datetime | date) -> DataFrame:
    """Events strictly later than ``moment``, with the matching partition bound."""
    return since_day(events, clock.dates_from(moment)).where(F.col("ts") > clock.instant(moment))


def directory(employees: DataFrame) -> DataFrame:
    """Account, display name and department, keyed like events by ``username``."""
    return employees.selectExpr("employee_id AS username", f"{FULL_NAME} AS user_name", "department")


def named(rows: DataFrame, employees: DataFrame | None) -> DataFrame:
    """Attach ``user_name`` and ``department``; unknown accounts keep NULLs.

    Without ``employees`` both are NULL and nothing is joined: for scores and counts.
    """
    if employees is None:
        return rows.selectExpr("*", "cast(NULL AS string) AS user_name", "cast(NULL AS string) AS department")
    return rows.join(directory(employees), "username", "left")

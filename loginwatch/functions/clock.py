"""Login instants, their text forms and exact time arithmetic (UTC).

Functions that take column names or expressions as text return SQL text for ``expr``
and ``selectExpr``; a whole projection then reaches the planner in one call.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


#: ``HH:MM`` or ``HH:MM:SS``, with or without a fraction, within one day.
_TIME_OF_DAY = "^([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9]([.][0-9]+)?)?$"


def is_time_of_day(login_time: str = "login_time") -> str:
    return f"coalesce({login_time} RLIKE '{_TIME_OF_DAY}', false)"


def hour_of(login_time: str = "login_time") -> str:
    """Hour of a time of day; NULL for NULL and for text that is none, such as ``25:00:00``."""
    return f"if({is_time_of_day(login_time)}, cast(substring({login_time}, 1, 2) AS int), NULL)"


def login_instant(login_date: str = "login_date", login_time: str = "login_time") -> str:
    """Date plus time-of-day text as a timestamp, by arithmetic; missing seconds are 0.

    NULL where the text is no time of day: an impossible time never rolls into another
    day. :func:`loginwatch.operators.integrity.dataset_invariants` counts those rows.
    """
    return (
        f"if({is_time_of_day(login_time)},"
        f" timestamp_seconds(cast(unix_date({login_date}) AS bigint) * 86400"
        f" + cast(substring({login_time}, 1, 2) AS int) * 3600 + cast(substring({login_time}, 4, 2) AS int) * 60"
        f" + coalesce(try_cast(substring({login_time}, 7, 2) AS int), 0)), NULL)"
    )


def stamp(login_date: str = "login_date", login_time: str = "login_time") -> str:
    """``YYYY-MM-DD HH:MM:SS`` as shown in findings."""
    return f"concat({login_date}, ' ', {login_time})"


def round_ratio(numerator: str, denominator: str) -> str:
    """Half-up quotient of non-negative integers, exact."""
    return f"((2 * ({numerator}) + ({denominator})) div (2 * ({denominator})))"


def tenths(numerator: str, denominator: str) -> str:
    """Half-up quotient to one decimal, exact in integers until the last step."""
    return f"(cast({round_ratio(f'10 * ({numerator})', denominator)} AS double) / 10D)"


def utc(moment: datetime | date) -> datetime:
    """A plain date or naive datetime is taken as UTC."""
    if not isinstance(moment, datetime):
        moment = datetime(moment.year, moment.month, moment.day)
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


def micros_of(moment: datetime | date) -> int:
    return (utc(moment) - EPOCH) // timedelta(microseconds=1)


def instant(moment: datetime | date) -> Column:
    """A timestamp literal that does not depend on the driver's local zone."""
    return F.expr(f"timestamp_micros({micros_of(moment)})")


def dates_from(moment: datetime | date) -> date:
    """First calendar day that can hold ``moment``: the partition bound for a scan."""
    return utc(moment).date()

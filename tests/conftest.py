"""One Spark session for the suite, and builders for small hand-written tables."""

from __future__ import annotations

import sys
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from loginwatch import schemas  # noqa: E402
from loginwatch.config import HuntConfig  # noqa: E402
from loginwatch.operators.normalize import login_events  # noqa: E402
from loginwatch.plans.session import local_session  # noqa: E402
from loginwatch.sources.reference import DEFAULT_CONFIG  # noqa: E402
from loginwatch.sources.tables import local_table  # noqa: E402

START = date(2024, 5, 10)


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "loginwatch-tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


def config(**changes) -> HuntConfig:
    values = {
        **DEFAULT_CONFIG, "baseline_end": "2024-05-10", "detection_start": "2024-05-10",
        "asof_date": "2024-05-20", **{k: str(v) for k, v in changes.items()},
    }
    return HuntConfig.from_mapping(values)


@pytest.fixture(scope="session")
def cfg() -> HuntConfig:
    return config()


class Tables:
    """Builds DataFrames from compact rows."""

    def __init__(self, spark):
        self.spark = spark

    def attempts(self, rows):
        """Rows ``(event_id, username, 'YYYY-MM-DD HH:MM:SS', country, success, source_ip)``."""
        full = [
            (i, u, date.fromisoformat(at[:10]), at[11:], c, s, ip) for i, u, at, c, s, ip in rows
        ]
        return local_table(self.spark, full, schemas.LOG_IN_ATTEMPTS)

    def events(self, rows):
        return login_events(self.attempts(rows))

    def employees(self, rows):
        """Rows ``(employee_id, department, status)``."""
        full = [(e, f"First{e}", f"Last{e}", d, "HQ", s, date(2020, 1, 1)) for e, d, s in rows]
        return local_table(self.spark, full, schemas.EMPLOYEES)

    def table(self, rows, schema):
        return local_table(self.spark, rows, schema)


@pytest.fixture(scope="session")
def tables(spark) -> Tables:
    return Tables(spark)


def day(offset: int, clock: str = "10:00:00") -> str:
    """A stamp ``offset`` days from the start of the detection window."""
    return f"{START + timedelta(days=offset)} {clock}"


def at(base: str, seconds: int) -> str:
    moment = datetime.fromisoformat(base) + timedelta(seconds=seconds)
    return moment.strftime("%Y-%m-%d %H:%M:%S")


def ids(frame, column: str = "event_id") -> list:
    return sorted(r[column] for r in frame.select(column).collect())


def by(frame, key: str) -> dict:
    return {r[key]: r.asDict(recursive=True) for r in frame.collect()}

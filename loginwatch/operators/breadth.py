"""How many accounts a source tries over any span of days, from kept daily sketches.

A distinct count cannot be added up over days; a sketch can. Each source and day has one
sketch of a bounded size, kept as binary, and any span is answered by uniting its days'
sketches without the log. Estimates order and draw; who is reported is always decided by
exact counts.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loginwatch.operators.history import on_days
from loginwatch.operators.normalize import failures

#: 2^LOG_K slots: a standard error of about 0.8 %, at most some 16 KB for a broad source;
#: narrow sources keep a short list, which is exact.
LOG_K = 14
SKETCHES = "source_ip STRING, failures BIGINT, accounts BINARY, login_date DATE"


def daily_breadth(events: DataFrame, log_k: int = LOG_K) -> DataFrame:
    """One row per source and day with failures: their number, and a sketch of the accounts.

    Combines map-side. An unknown source is a source of its own; attempts without an account
    count as failures but are in no sketch.
    """
    return failures(events).groupBy("source_ip", "login_date").agg(
        F.count(F.lit(1)).alias("failures"), F.hll_sketch_agg("username", log_k).alias("accounts")
    ).select("source_ip", "failures", "accounts", "login_date")


def breadth_over(sketches: DataFrame, first: date, last: date) -> DataFrame:
    """Per source over the days ``first`` to ``last``, both included: ``days`` with failures,
    ``failures`` and ``accounts``, the estimated number of accounts."""
    span = sketches.where(f"login_date BETWEEN date'{first}' AND date'{last}'")
    return span.groupBy("source_ip").agg(
        F.count(F.lit(1)).alias("days"), F.sum("failures").alias("failures"),
        F.hll_sketch_estimate(F.hll_union_agg("accounts")).alias("accounts"),
    )


def keep_breadth(events: DataFrame, path: str, days: Iterable[date], log_k: int = LOG_K) -> None:
    """Sketch some ``days`` anew, one folder per day, reading only their events.

    A day's folder is replaced as a whole, so a run is repeated without harm and late events
    enter by sketching their day again. Days left without a failure get an empty folder.
    """
    days = sorted(set(days))
    if not days:
        return
    spark = events.sparkSession
    # A row without failures stands for each day, so that a day that has become empty is replaced too.
    marks = spark.createDataFrame([(d,) for d in days], "login_date DATE").selectExpr(
        "cast(NULL AS string) AS source_ip", "0L AS failures", "cast(NULL AS binary) AS accounts", "login_date"
    )
    rows = daily_breadth(on_days(events, days), log_k).unionByName(marks)
    rows.repartition("login_date", "source_ip").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("login_date").parquet(path)


def kept_breadth(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SKETCHES).parquet(path).where("failures > 0")


def breadth_check(events: DataFrame, sketches: DataFrame, first: date, last: date, error: float = 0.05) -> DataFrame:
    """Exact breadth per source over a span, and whether the estimate from ``sketches`` is
    within ``error`` of it. Accounts are folded per source first, which spreads a broad one."""
    span = failures(events).where(f"login_date BETWEEN date'{first}' AND date'{last}'")
    exact = span.groupBy("source_ip", "username").agg(F.count(F.lit(1)).alias("n")).groupBy("source_ip").agg(
        F.expr("count(username) AS accounts"), F.sum("n").alias("failures")
    )
    found = breadth_over(sketches, first, last).selectExpr(
        "source_ip AS key_ip", "days", "failures AS summed", "accounts AS estimate"
    )
    return exact.join(found, F.expr("source_ip <=> key_ip"), "left").selectExpr(
        "source_ip", "days", "failures", "accounts", "summed <=> failures AS same_failures",
        f"coalesce(abs(estimate - accounts) <= {error!r}D * accounts, false) AS within",
    )

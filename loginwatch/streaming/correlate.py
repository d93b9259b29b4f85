"""Rule correlations over streams: exact rolling spans, and coarser hopping windows.

The aggregates take a DataFrame of base-selection events with a ``ts`` column. On a
stream, call them below ``with_lateness``: state is dropped once the watermark passes a
window, and events later than that are ignored.

*Rolling* spans are what the rules ask for. The stream folds events to one row per key
and second, which leaves it when the watermark has passed; each batch of such points
continues where the last one ended, and is swept together with the points of one span
before it. *Hopping* windows are cheaper and coarser: a burst nearly as long as the
window can straddle all of them, so they may miss what the rolling form reports.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loginwatch.operators.correlate import correlate_event_count, correlate_value_count
from loginwatch.operators.enrich import account_status
from loginwatch.operators.inactive_account import select_terminated
from loginwatch.plans.session import shared_dir

HOUR = timedelta(hours=1)
SLIDE = timedelta(minutes=20)
LATENESS = timedelta(minutes=30)


def _text(span: timedelta) -> str:
    return f"{span // timedelta(seconds=1)} seconds"


def with_lateness(events: DataFrame, lateness: timedelta = LATENESS) -> DataFrame:
    return events.withWatermark("ts", _text(lateness))


def points(events: DataFrame, *key: str) -> DataFrame:
    """Events per key and second: ``ts`` and ``n``. State is one count per key and second
    that the watermark has not passed."""
    counted = events.groupBy(F.window("ts", "1 second"), *key).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(*key, F.col("window.start").alias("ts"), "n")


def run_rolling(
    spark: SparkSession,
    stream: DataFrame,
    name: str,
    alerts: Callable[[DataFrame], DataFrame],
    timespan: timedelta = HOUR,
    home: str | None = None,
) -> DataFrame:
    """Run a stream of :func:`points` over what its source holds now; all alerts so far.

    A batch holds exactly the points between two watermarks, so it lies wholly after the
    batches before it. ``alerts`` sees it behind the points of one ``timespan`` before its
    end and alerts at its own instants are kept. What the next batch needs, the points
    of the last ``timespan``, is written per batch number, as are alerts, and
    overwritten if a batch is repeated: with the same ``home`` a stopped run goes on where
    it ended, and no batch reads more than the folder before it.
    """
    home = home or shared_dir(spark, name)
    schema = stream.schema
    span = F.expr(f"INTERVAL {timespan // timedelta(seconds=1)} SECOND")

    def each(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{home}/points/{number}")
        own = session.read.schema(schema).parquet(f"{home}/points/{number}")
        tail = session.read.schema(schema).parquet(f"{home}/tail/{number - 1}") if number else own.where("false")
        first, last = own.agg(F.min("ts"), F.max("ts")).first()
        known = tail.unionByName(own)
        if first is not None:
            alerts(known).where(F.col("ts") >= F.lit(first)).write.mode("overwrite").parquet(f"{home}/alerts/batch={number}")
            known = known.where(F.col("ts") >= F.lit(last) - span)
        known.write.mode("overwrite").parquet(f"{home}/tail/{number}")

    query = (
        stream.writeStream.foreachBatch(each).outputMode("append")
        .option("checkpointLocation", f"{home}/progress").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    result = alerts(spark.createDataFrame([], schema))
    result.where("false").write.mode("overwrite").parquet(f"{home}/alerts/batch=-1")
    return spark.read.schema(result.schema).option("basePath", f"{home}/alerts").parquet(f"{home}/alerts").select(
        *result.columns
    )


def rolling_event_count(
    spark: SparkSession, events: DataFrame, group: str = "username", timespan: timedelta = HOUR, gte: int = 5,
    home: str | None = None,
) -> DataFrame:
    """The rolling event count of a stream: equal to the batch form at every instant that
    the watermark has passed."""
    def alerts(rows: DataFrame) -> DataFrame:
        return correlate_event_count(rows, group, timespan, gte, "n")
    return run_rolling(spark, points(events, group), "rolling_event_count", alerts, timespan, home)


def rolling_value_count(
    spark: SparkSession, events: DataFrame, group: str = "source_ip", field: str = "username",
    timespan: timedelta = HOUR, gte: int = 5, home: str | None = None,
) -> DataFrame:
    """The rolling count of distinct values of a stream, likewise exact."""
    def alerts(rows: DataFrame) -> DataFrame:
        return correlate_value_count(rows, group, field, timespan, gte)
    return run_rolling(spark, points(events, group, field), "rolling_value_count", alerts, timespan, home)


def hopping_event_count(
    events: DataFrame,
    group: str = "username",
    timespan: timedelta = HOUR,
    slide: timedelta = SLIDE,
    gte: int = 5,
) -> DataFrame:
    """Windows in which ``group`` has at least ``gte`` events. State is one count per key."""
    counts = events.groupBy(F.window("ts", _text(timespan), _text(slide)), group).agg(
        F.count(F.lit(1)).alias("event_count")
    )
    return counts.where(F.col("event_count") >= gte).select(
        group, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "event_count",
    )


def hopping_value_count(
    events: DataFrame,
    group: str = "source_ip",
    field: str = "username",
    timespan: timedelta = HOUR,
    slide: timedelta = SLIDE,
    gte: int = 5,
) -> DataFrame:
    """Windows in which ``group`` shows at least ``gte`` distinct ``field`` values, exact.

    Two chained aggregates: one state row per (window, group, value), spread over all
    tasks by its key, then one count per (window, group). No state holds a set.
    """
    values = events.where(F.col(field).isNotNull()).groupBy(
        F.window("ts", _text(timespan), _text(slide)), group, field
    ).agg(F.count(F.lit(1)).alias("n"))
    counts = values.groupBy("window", group).agg(F.count(F.lit(1)).alias("value_count"))
    return counts.where(F.col("value_count") >= gte).select(
        group, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "value_count",
    )


def terminated_activity(events: DataFrame, employees: DataFrame) -> DataFrame:
    """Attempts on terminated accounts: a stream-static join, no state."""
    return select_terminated(account_status(events, employees)).select(
        "event_id", "username", "account_status", "ts", "success", "source_ip", "country"
    )


def run_available(spark: SparkSession, stream: DataFrame, name: str, home: str | None = None) -> DataFrame:
    """Run a stream over what its source holds now and return what it wrote.

    Output and progress live in ``home``, by default a new folder below the cluster's
    shared one. A lost executor repeats nothing; nor does a later run with the same ``home``.
    """
    home = home or shared_dir(spark, name)
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", f"{home}/out").option("checkpointLocation", f"{home}/progress")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{home}/out")

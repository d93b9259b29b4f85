"""Rolling counts of a stream that are told before the watermark closes them.

The exact form waits for the allowed lateness. Here an alert is *raised* in the batch that
first shows it, *revised* when late events add to it, and *confirmed* when the watermark
has passed its instant; counts only grow, so nothing raised is ever withdrawn. Confirmed
alerts are those of the exact form.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loginwatch.operators.correlate import correlate_event_count
from loginwatch.plans.session import shared_dir
from loginwatch.streaming.correlate import HOUR, LATENESS


def _interval(span: timedelta):
    return F.expr(f"INTERVAL {span // timedelta(seconds=1)} SECOND")


def early_event_count(
    spark: SparkSession,
    events: DataFrame,
    group: str = "username",
    timespan: timedelta = HOUR,
    gte: int = 5,
    lateness: timedelta = LATENESS,
    home: str | None = None,
) -> DataFrame:
    """Run over what the source of ``events`` holds now; all notices so far.

    One row per notice: ``group``, ``ts``, ``event_count``, ``first_batch`` in which the alert was
    first seen, ``status`` (raised, revised or confirmed) and the ``batch`` of the notice. An
    event is too late, and ignored, if the watermark of the batches before has passed its
    second. State is what an open alert needs, events per key and second of one
    ``lateness`` and one ``timespan``, and the open alerts; both are written per batch number and
    overwritten if a batch is repeated, so with the same ``home`` a stopped run goes on.
    """
    home = home or shared_dir(spark, "early_event_count")
    kind = events.schema[group].dataType.simpleString()
    point, alert = f"{group} {kind}, ts timestamp, n bigint", f"{group} {kind}, ts timestamp, event_count bigint, first_batch bigint"
    second = F.expr("INTERVAL 1 SECOND")

    def each(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession

        def state(name: str, schema: str, of: int) -> DataFrame:
            return session.read.schema(schema).parquet(f"{home}/{name}/{of}") if of >= 0 else session.createDataFrame([], schema)

        def closed(newest) -> F.Column:
            """Whether the watermark that follows from the newest event has passed ``ts``."""
            return F.lit(False) if newest is None else F.col("ts") + second <= F.lit(newest) - _interval(lateness)

        kept = state("points", point, number - 1)
        before = kept.agg(F.max("ts")).first()[0]
        fresh = batch.groupBy(group, F.date_trunc("second", "ts").alias("ts")).agg(F.count(F.lit(1)).alias("n"))
        both = kept.unionByName(fresh.where("ts IS NOT NULL").where(~closed(before)))
        both.groupBy(group, "ts").agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(f"{home}/known/{number}")
        known = state("known", point, number)
        newest = known.agg(F.max("ts")).first()[0]

        told = state("open", alert, number - 1).select(
            F.col(group).alias("_key"), F.col("ts").alias("_ts"), F.col("event_count").alias("_count"), F.col("first_batch").alias("_first")
        )
        current = correlate_event_count(known, group, timespan, gte, "n").where(~closed(before))
        now = current.join(told, F.col(group).eqNullSafe(F.col("_key")) & (F.col("ts") == F.col("_ts")), "left").select(
            group, "ts", F.col("event_count").cast("bigint"), F.coalesce("_first", F.lit(number).cast("bigint")).alias("first_batch"),
            F.when(closed(newest), "confirmed").when(F.col("_count").isNull(), "raised")
            .when(F.col("_count") != F.col("event_count"), "revised").otherwise("open").alias("status"),
        )
        now.write.mode("overwrite").parquet(f"{home}/now/{number}")
        now = state("now", f"{alert}, status string", number)
        now.where("status != 'open'").write.mode("overwrite").parquet(f"{home}/notices/batch={number}")
        now.where("status != 'confirmed'").drop("status").write.mode("overwrite").parquet(f"{home}/open/{number}")
        if newest is not None:
            # An alert still open needs one span before it; the newest second is always among these.
            known = known.where(F.col("ts") + second > F.lit(newest) - _interval(lateness) - _interval(timespan))
        known.write.mode("overwrite").parquet(f"{home}/points/{number}")

    query = (
        events.select(group, "ts").writeStream.foreachBatch(each).outputMode("append")
        .option("checkpointLocation", f"{home}/progress").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    spark.createDataFrame([], f"{alert}, status string").write.mode("overwrite").parquet(f"{home}/notices/batch=-1")
    return spark.read.schema(f"{alert}, status string, batch bigint").parquet(f"{home}/notices")


def confirmed(notices: DataFrame) -> DataFrame:
    """The alerts that are final."""
    return notices.where("status = 'confirmed'").drop("status").withColumnRenamed("batch", "confirmed_batch")

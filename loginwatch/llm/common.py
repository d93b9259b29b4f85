"""Helpers the text operators share: tables, row numbers, joins with hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loginwatch.plans.session import stored

__all__ = ["let", "numbered", "split_join", "stored", "table", "WORD_BREAK"]

WORD_BREAK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body`` of ``value``, with ``value`` computed once per row.

    The optimizer may copy a projected expression into a lambda, where it would run once
    per element; a lambda variable is bound once.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def numbered(frame: DataFrame, keys: list[str], purpose: str) -> DataFrame:
    """``frame`` with ``row``: its place from 0 in the order of ``keys``, nulls first.

    A range shuffle sorts the rows, which are written once; each file's first number is
    the sum of the counts before it, one row per partition. Rows that agree in all keys
    are interchangeable, and are spread over ranges by their place in the input. Pass
    narrow frames.
    """
    parts = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        frame.withColumn("_at", F.monotonically_increasing_id())
        .repartitionByRange(parts, *keys, "_at").sortWithinPartitions(*keys, "_at")
        .drop("_at").withColumn("_id", F.monotonically_increasing_id())
    )
    placed = stored(ordered, purpose).withColumn("_part", F.shiftright("_id", 33))
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    # One row for each partition of the range shuffle: bounded by its count.
    return placed.join(F.broadcast(starts), "_part").withColumn(
        "row", F.col("_start") + F.col("_id").bitwiseAND((1 << 33) - 1)
    ).drop("_part", "_id", "_start")


def split_join(facts: DataFrame, dims: DataFrame, key: str, total: int, bound: int = 10_000) -> DataFrame:
    """Left join on ``key``; ``dims`` has one row per key and its count of facts in ``n``.

    Keys with more than ``total / bound`` facts are at most ``bound`` and are broadcast, so
    no task ever gathers a hot key; the other keys are shuffled. ``facts`` is read twice
    when both kinds occur, so pass a stored or cheap one.
    """
    hot = dims.where(F.col("n") * bound > total)
    cold = dims.where(F.col("n") * bound <= total)
    rest = facts.join(F.broadcast(hot.select(key)), key, "left_anti")
    return facts.join(F.broadcast(hot), key).unionByName(rest.join(cold, key, "left"))

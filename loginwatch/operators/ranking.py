"""A place for every row of a total order, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loginwatch.plans.session import stored

#: The number of a row within its partition takes so many bits of a row id.
ROW_BITS = 33


def placed(rows: DataFrame, order: Sequence[str | Column], purpose: str = "placed") -> DataFrame:
    """``rows`` with ``place``, from 1, in the given order.

    A range shuffle deals the rows by the order and each range is sorted and written.
    How many rows the ranges before it hold is a prefix sum over one count per range, so a
    row's place is that sum plus its number within its range. Rows that agree in the whole
    order are put in the order of a hash of all their columns; only rows that are equal
    altogether stay in one range. ``rows`` is read twice, first to find the ranges; pass a
    stored table if it is costly. An empty table gives no rows.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = rows.columns
    keys = [*(F.expr(o) if isinstance(o, str) else o for o in order), F.xxhash64(*names)]
    ranged = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    written = stored(ranged.withColumn("_row", F.monotonically_increasing_id()), purpose)
    numbered = written.withColumn("_range", F.shiftright("_row", ROW_BITS).cast("int"))
    # One row per range, whatever the number of rows.
    counts = numbered.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()
    starts, before = [], 0
    for number, n in sorted(map(tuple, counts)):
        starts.append((number, before))
        before += n
    offsets = F.broadcast(spark.createDataFrame(starts, "_range int, _before long"))
    return numbered.join(offsets, "_range").select(
        (F.col("_before") + F.col("_row").bitwiseAND((1 << ROW_BITS) - 1) + 1).alias("place"), *names
    )

"""The triage queue kept day by day: running a day again replaces that day alone."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns that name a finding: the rule, and the event or campaign that it found.
KEY = ("detection_type", "event_id", "campaign_key")
DAY = "detection_day"
#: Files of a day; its findings are spread over them by a hash of the key.
FILES_PER_DAY = 8
_MARK = "(mark)"


def finding_day(queue: DataFrame) -> DataFrame:
    """``queue`` with ``detection_day``, the day of the finding's event, and ``finding_id``, a
    digest of its key that is the same in every run. A finding without a day is refused on
    writing."""
    parts = ", ".join(f"coalesce(cast({c} AS string), '')" for c in KEY)
    return queue.selectExpr(
        "*", f"sha2(concat_ws('\\u001f', {parts}), 256) AS finding_id", f"cast(substring(timestamp, 1, 10) AS date) AS {DAY}"
    )


def replace_days(queue: DataFrame, path: str, days: Iterable[date], files_per_day: int = FILES_PER_DAY) -> None:
    """Put the findings of ``days`` at ``path`` in place of what is there for them.

    Only partitions of these days are written; all other days, and what they once found,
    stay. A day that finds nothing any more is emptied. Rows are unique by key and feed
    entry (of several, the one first in the order of its columns stays), so a run that is
    repeated leaves the same table. Files become visible when the job commits; a run that
    dies in its commit is repeated.
    """
    days = sorted(set(days))
    if not days:
        return
    listed = ", ".join(f"date'{d}'" for d in days)
    keyed = finding_day(queue)
    # ``raise_error`` has no value, so it is null where the day is known.
    checked = keyed.withColumn(DAY, F.expr(
        f"if({DAY} IS NULL, cast(raise_error(concat('finding without a day: ', finding_id)) AS date), {DAY})"
    )).where(f"{DAY} IN ({listed})")
    by = [*KEY, "intel_source", DAY]
    rest = [c for c in checked.columns if c not in by]
    one = checked.groupBy(*by).agg(F.min(F.struct(*rest)).alias("_row")).select(*by, "_row.*").select(*checked.columns)
    marks = queue.sparkSession.createDataFrame([(d,) for d in days], f"{DAY} DATE").select(*[
        F.col(DAY) if f.name == DAY else F.lit(_MARK if f.name == "finding_id" else None).cast(f.dataType).alias(f.name)
        for f in one.schema.fields
    ])
    spread = F.expr(f"pmod(xxhash64(finding_id), {files_per_day})")
    one.unionByName(marks).repartition(DAY, spread).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(DAY).parquet(path)


def stored_findings(spark: SparkSession, path: str, columns: T.StructType) -> DataFrame:
    """All findings kept at ``path``. ``columns`` is the schema of the queue written there;
    ``finding_id`` and ``detection_day`` follow. A bound on the day prunes folders."""
    schema = T.StructType([*columns.fields, T.StructField("finding_id", T.StringType()), T.StructField(DAY, T.DateType())])
    return spark.read.schema(schema).parquet(path).where(f"finding_id != '{_MARK}'")

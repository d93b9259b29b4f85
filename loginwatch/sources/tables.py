"""Reading and writing the hunt's tables.

The event log is laid out by ``login_date``, so every rule's date bound prunes
directories and the remaining filters reach the Parquet scan.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loginwatch import schemas


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few fixed rows as a plan-local relation (known size, no job needed)."""
    fields = T._parse_datatype_string(schema).fields
    arrow = {
        "string": pa.string(), "bigint": pa.int64(), "int": pa.int32(),
        "double": pa.float64(), "date": pa.date32(),
    }
    arrow_schema = pa.schema([(f.name, arrow[f.dataType.simpleString()]) for f in fields])
    columns = [pa.array([r[i] for r in rows], a.type) for i, a in enumerate(arrow_schema)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow_schema))


def write_login_log(attempts: DataFrame, path: str, mode: str = "append", files_per_day: int = 32) -> None:
    """Write the event log one directory per day, in ``files_per_day`` files.

    Rows of a day are spread by a hash of the event id, so one busy day or account is
    never a single writer.
    """
    part = F.expr(f"pmod(xxhash64(event_id), {files_per_day})")
    attempts.repartition("login_date", part).write.mode(mode).partitionBy("login_date").parquet(path)


def read_login_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.LOG_IN_ATTEMPTS).parquet(path)


def read_table(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """Read any table of :mod:`loginwatch.schemas` from parquet, orc, json or csv."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def read_distance_csv(spark: SparkSession, path: str) -> DataFrame:
    """The hunts' external distance file: ``country_a,country_b,distance_km``."""
    schema = schemas.COUNTRY_DISTANCE.replace("distance_km INT", "distance_km BIGINT")
    return spark.read.schema(schema).option("header", True).csv(path)


def write_json(records: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Nested records as JSON lines, one file per task."""
    records.write.mode(mode).json(path)


def write_findings(findings: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The triage queue as a table with one directory per severity."""
    findings.write.mode(mode).partitionBy("severity").parquet(path)

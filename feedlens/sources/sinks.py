"""Sink of the daily slices table.

The original creates the table if absent and appends each day.  Appending
is not safe under retries (a task retried after a partial write appends
twice), so a day is written as its own partition: re-running a day replaces
exactly that partition, and a day without rows empties it.

``write_slices`` and ``insert_slices`` keep a plain partitioned layout that any
tool reads; while such a day is being replaced, readers may find it half
written.  ``publish_slices`` makes the replacement one visible step (see
``sources.published``); the ETL job uses it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import as_date
from . import published
from .schema import DAILY_SLICES


def _ddl_columns() -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in DAILY_SLICES.fields)


def create_slices_table(spark: SparkSession, table: str, location: str | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS`` with the fixed schema, partitioned by
    event_date."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({_ddl_columns()}) USING parquet "
              f"PARTITIONED BY (event_date){loc}")


def _only(df: DataFrame, day) -> DataFrame:
    """``df``; a row of another day than ``day`` is an error, not dropped."""
    other = F.raise_error(F.lit(f"slices hold rows of another day than {day}")).cast("boolean")
    return df.filter(F.when(F.col("event_date") == F.lit(as_date(day)), F.lit(True)).otherwise(other))


def write_slices(df: DataFrame, path: str, day) -> None:
    """Write the slices of ``day`` as the partition ``event_date=<day>`` under
    ``path`` (Parquet), replacing it also when the day has no rows left."""
    cols = [f.name for f in DAILY_SLICES.fields if f.name != "event_date"]
    _only(df, day).select(cols).write.mode("overwrite").parquet(f"{path}/event_date={as_date(day).isoformat()}")


def insert_slices(df: DataFrame, table: str, day) -> None:
    """Same for a catalog table made by ``create_slices_table``."""
    cols = [f.name for f in DAILY_SLICES.fields if f.name != "event_date"]
    df.sparkSession.sql(f"INSERT OVERWRITE {table} PARTITION (event_date = DATE'{as_date(day).isoformat()}') "
                        "SELECT * FROM {rows}", rows=_only(df, day).select(cols))


def publish_slices(df: DataFrame, path: str, day) -> None:
    """Replace the slices of ``day`` in the published table at ``path``: readers
    see the old day or the new one, also if the job dies half way."""
    rows = df.select([F.col(f.name).cast(f.dataType) for f in DAILY_SLICES.fields])
    published.publish(_only(rows, day), path, F.col("event_date"), [as_date(day)])


def read_slices(spark: SparkSession, path: str, first=None, last=None) -> DataFrame:
    """Published slices, of all days or of [first, last]; only folders of those
    days are opened."""
    a, b = (as_date(d).isoformat() if d is not None else None for d in (first, last))
    return published.read(spark, path, DAILY_SLICES, lambda v: (a is None or v >= a) and (b is None or v <= b))

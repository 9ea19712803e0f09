"""Readers for production event tables (Parquet with a fixed schema).

No schema inference: a fixed StructType keeps the plan stable and lets the
scan prune columns and push day filters down to the row groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import as_date
from .schema import FEED_ACTIONS, MESSAGE_ACTIONS


def _read(spark: SparkSession, schema, path: str, day_column: str | None, days) -> DataFrame:
    """Read with a fixed schema.  For a table laid out in day directories
    (``<day_column>=YYYY-MM-DD``), ``days=(first, last)`` adds a predicate on
    the partition column, so whole directories are skipped
    (``PartitionFilters``); the time-range filters of the jobs then prune row
    groups inside the remaining files.  The partition column is dropped."""
    if day_column is None:
        return spark.read.schema(schema).parquet(path)
    full = T.StructType(schema.fields + [T.StructField(day_column, T.DateType())])
    df = spark.read.schema(full).parquet(path)
    if days is not None:
        first, last = (as_date(d) for d in days)
        df = df.filter(F.col(day_column).between(F.lit(first), F.lit(last)))
    return df.drop(day_column)


def read_feed_actions(spark: SparkSession, path: str, day_column: str | None = None,
                      days=None) -> DataFrame:
    return _read(spark, FEED_ACTIONS, path, day_column, days)


def read_message_actions(spark: SparkSession, path: str, day_column: str | None = None,
                         days=None) -> DataFrame:
    return _read(spark, MESSAGE_ACTIONS, path, day_column, days)


def jdbc_options(query: str, partition_column: str | None = None, lower=None, upper=None,
                 partitions: int | None = None) -> dict[str, str]:
    """Reader options of a remote query.  With a partition column (numeric, date
    or timestamp) and its bounds the query is read by ``partitions`` tasks, each
    with a range predicate of its own; rows outside the bounds go to the first
    and the last task, none is lost."""
    if partition_column is None:
        return {"query": query}
    if lower is None or upper is None or not partitions:
        raise ValueError("a partitioned read needs lower, upper and partitions")
    return {"dbtable": f"({query}) part_source", "partitionColumn": partition_column, "lowerBound": str(lower),
            "upperBound": str(upper), "numPartitions": str(partitions)}


def read_jdbc(spark: SparkSession, url: str, query: str, *, partition_column: str | None = None, lower=None,
              upper=None, partitions: int | None = None, **options) -> DataFrame:
    """Run SQL text on a remote database and get a DataFrame, by one task or, see
    ``jdbc_options``, by several.  Credentials come from ``options``."""
    reader = spark.read.format("jdbc").option("url", url)
    for k, v in (jdbc_options(query, partition_column, lower, upper, partitions) | options).items():
        reader = reader.option(k, v)
    return reader.load()


def sql_frame(spark: SparkSession, text: str, tables: dict[str, DataFrame], **params) -> DataFrame:
    """Run SQL text over DataFrames: every ``{name}`` of the text stands for
    ``tables[name]`` and every ``:name`` for a parameter, bound as a value and never
    pasted into the text.  Nothing is registered in the catalog, so queries with
    different tables under one name do not disturb each other."""
    return spark.sql(text, args=params, **tables)

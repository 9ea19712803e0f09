"""Helpers shared by the operators of this subpackage.

A *word* is a maximal run of characters that are not ASCII white space
(``[^\\x20\\x09-\\x0D]+``); on UTF-8 bytes that is exactly ``bytes.split()``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_path

#: Fixed value: the word pattern of all query contracts.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and return a
    DataFrame that reads it.  Cuts the lineage; a lost executor re-reads the
    files, which all executors share."""
    path = shared_path(df.sparkSession, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also when the
    body uses it inside a lambda over another array."""
    return F.transform(F.array(value), body)[0]


def n_words(text: Column) -> Column:
    """Number of words of a text, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def with_sums_before(df: DataFrame, by: list[str], order: list, values: list[str]) -> DataFrame:
    """Adds ``<value>_before``: the sum of ``value`` over the rows that come earlier
    in ``order`` (unique within ``by``), 0 for the first.

    No window holds a whole group: rows are dealt into ranges of (by, order), the
    sums of earlier ranges are added to the running sum inside each.  The ranges
    are written once, so every reader sees the same."""
    ranges = df.repartitionByRange(*[F.col(c) for c in by], *order).withColumn("_range", F.spark_partition_id())
    ranges = save(ranges, "ranges")
    place = [*by, "_range"]
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranges.groupBy(*place).agg(*[F.sum(v).alias(f"_s{i}") for i, v in enumerate(values)])
    sums = sums.select(*[F.col(c).alias(f"_p_{c}") for c in place],
                       *[F.coalesce(F.sum(f"_s{i}").over(earlier), F.lit(0)).alias(f"_b{i}") for i in range(len(values))])
    inside = Window.partitionBy(*place).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    here = ranges.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_i{i}") for i, v in enumerate(values)])
    same = F.lit(True)
    for c in place:
        same = same & F.col(c).eqNullSafe(F.col(f"_p_{c}"))
    return here.join(sums, same).select(
        *df.columns, *[(F.col(f"_i{i}") + F.col(f"_b{i}")).alias(f"{v}_before") for i, v in enumerate(values)])

"""Daily slices by gender, age and OS (the ETL's output table).

The three group-bys of the original are one ``GROUPING SETS`` aggregate:
one ``Expand`` (x3) over per-user rows and one shuffle.  The dimension name
comes from ``grouping_id()`` rather than from which key is non-NULL, so a
NULL key value keeps its own row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.schema import DAILY_SLICES, SLICE_COUNTERS
from .users import daily_user_activity, user_feed_totals, user_message_totals


def slices_of(activity: DataFrame) -> DataFrame:
    sums = [F.sum(c).cast("bigint").alias(c) for c in SLICE_COUNTERS]
    g = activity.groupingSets(
        [["event_date", "gender"], ["event_date", "age"], ["event_date", "os"]],
        "event_date", "gender", "age", "os",
    ).agg(F.grouping_id().alias("_gid"), *sums)
    # grouping_id() over (event_date, gender, age, os), bit set = rolled up:
    # 3 = by gender, 5 = by age, 6 = by os
    name = F.when(F.col("_gid") == 3, F.lit("gender")).when(F.col("_gid") == 5, F.lit("age")) \
        .when(F.col("_gid") == 6, F.lit("os"))
    value = (F.when(F.col("_gid") == 3, F.col("gender"))
             .when(F.col("_gid") == 5, F.col("age").cast("string"))
             .when(F.col("_gid") == 6, F.col("os")))
    out = g.select("event_date", name.alias("dimensions"), value.alias("dimensions_value"),
                   *SLICE_COUNTERS)
    return out.select([F.col(f.name).cast(f.dataType) for f in DAILY_SLICES.fields])


def daily_slices(feed: DataFrame, messages: DataFrame, as_of, how: str = "inner") -> DataFrame:
    """The ETL end to end for day ``as_of - 1``: per-user feed and message
    totals, full outer merge, three slices in one pass."""
    activity = daily_user_activity(user_feed_totals(feed, as_of),
                                   user_message_totals(messages, as_of, how=how))
    return slices_of(activity)

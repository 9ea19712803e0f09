"""Audience dashboards: retention, new users, campaign cohort, weekly
audience, activity drop by city, feed/messenger overlap.

Every job first reduces events to distinct (user, period) rows with a
partial aggregate (a hot user collapses to one row per period and task),
then works on those rows with windows partitioned by user - never a window
over all users in one task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import as_date, time_in_days

_GRAINS = ("day", "week", "month")


def period_start(grain: str, col: str = "time") -> Column:
    """First day of the period of an event time (weeks start on Monday)."""
    if grain not in _GRAINS:
        raise ValueError(f"grain must be one of {_GRAINS}")
    if grain == "day":
        return F.to_date(col)
    return F.to_date(F.date_trunc(grain, F.col(col)))


def periods_between(grain: str, start: Column, end: Column) -> Column:
    """Whole periods from ``start`` to ``end`` (both period starts)."""
    if grain == "day":
        return F.datediff(end, start)
    if grain == "week":
        return (F.datediff(end, start) / 7).cast("int")
    return F.months_between(end, start).cast("int")


def user_periods(activity: DataFrame, grain: str = "day") -> DataFrame:
    """Distinct (user_id, period, source) rows of an activity log.  The
    user's ``source`` is the smallest value seen in that period."""
    return (activity.filter(F.col("user_id").isNotNull())
            .groupBy("user_id", period_start(grain).alias("period"))
            .agg(F.min("source").alias("source")))


def with_cohort(up: DataFrame) -> DataFrame:
    """Adds cohort (first period of the user) and the user's source in that
    first period, by a window partitioned by user."""
    w = Window.partitionBy("user_id")
    first = F.min("period").over(w)
    first_source = F.min(F.when(F.col("period") == first, F.col("source"))).over(w)
    return up.select("user_id", "period", first.alias("cohort"),
                     first_source.alias("cohort_source"))


def retention(activity: DataFrame, grain: str = "day") -> DataFrame:
    """source, cohort, period_n, active_users, cohort_size, share.

    cohort = first active period of the user; period_n = periods since then;
    share = active users / cohort size (1.0 at period 0)."""
    c = with_cohort(user_periods(activity, grain))
    n = periods_between(grain, F.col("cohort"), F.col("period"))
    g = (c.groupBy(F.col("cohort_source").alias("source"), "cohort", n.alias("period_n"))
         .agg(F.count("*").alias("active_users")))
    size = F.max(F.when(F.col("period_n") == 0, F.col("active_users"))).over(
        Window.partitionBy("source", "cohort"))
    return (g.withColumn("cohort_size", size)
            .withColumn("share", F.col("active_users") / F.col("cohort_size")))


def new_users(activity: DataFrame, grain: str = "day") -> DataFrame:
    """period, source, new_users: users by their first active period."""
    first = (user_periods(activity, grain).groupBy("user_id")
             .agg(F.min_by("source", "period").alias("source"), F.min("period").alias("period")))
    return first.groupBy("period", "source").agg(F.count("*").alias("new_users"))


def campaign_retention(activity: DataFrame, cohort_day, horizons=(1, 14)) -> DataFrame:
    """Users first seen on ``cohort_day``: how many were active
    ``horizons`` days later, and their share of the cohort; a horizon without
    survivors has 0 users and share 0, an empty cohort gives no rows.

    Only events before the end of the last horizon are read, and one aggregate
    per user finds the first day and the horizons.

    Columns: cohort, day_n, cohort_size, active_users, share."""
    d = as_date(cohort_day)
    until = d + dt.timedelta(days=max(horizons) + 1)
    day = F.to_date("time")
    per_user = (activity.filter(F.col("user_id").isNotNull()
                                & (F.col("time") < F.lit(until).cast("timestamp_ntz")))
                .groupBy("user_id").agg(F.min(day).alias("first"), *[
                    F.bool_or(day == F.lit(d + dt.timedelta(days=h))).alias(f"on_{h}") for h in horizons])
                .filter(F.col("first") == F.lit(d)))
    one = per_user.agg(F.count("*").alias("cohort_size"), *[F.count_if(f"on_{h}").alias(f"n_{h}") for h in horizons])
    rows = F.array(*[F.struct(F.lit(h).alias("day_n"), F.col(f"n_{h}").alias("active_users")) for h in horizons])
    return (one.filter("cohort_size > 0").select("cohort_size", F.inline(rows))
            .select(F.lit(d).alias("cohort"), "day_n", "cohort_size", "active_users",
                    (F.col("active_users") / F.col("cohort_size")).alias("share")))


def weekly_audience(activity: DataFrame) -> DataFrame:
    """week, status, users with status in new / retained / returned / gone.

    new: first active week; retained: also active the week before;
    returned: active before but not the week before; gone: active the week
    before, not this week (counted in the week they are missing).  Weeks
    after the last observed week are not reported."""
    uw = activity.filter(F.col("user_id").isNotNull()).select(
        "user_id", period_start("week").alias("week")).distinct()
    w = Window.partitionBy("user_id").orderBy("week")
    prev, nxt = F.lag("week").over(w), F.lead("week").over(w)
    s = uw.select("week", prev.alias("prev"), nxt.alias("next"))
    status = (F.when(F.col("prev").isNull(), F.lit("new"))
              .when(F.datediff("week", "prev") == 7, F.lit("retained"))
              .otherwise(F.lit("returned")))
    active = s.groupBy("week", status.alias("status")).agg(F.count("*").alias("users"))
    gone_week = F.date_add("week", 7)
    gone = (s.filter(F.col("next").isNull() | (F.datediff("next", "week") > 7))
            .groupBy(gone_week.alias("week")).agg(F.count("*").alias("users"))
            .select("week", F.lit("gone").alias("status"), "users"))
    # the last observed week, from the per-week result itself (a few rows per
    # week, so this unpartitioned window is tiny; no second pass over users)
    last_week = F.max(F.when(F.col("status") != "gone", F.col("week"))).over(Window.partitionBy())
    both = active.unionByName(gone)
    return both.withColumn("_last", last_week).filter(F.col("week") <= F.col("_last")).drop("_last")


def city_activity_drop(feed: DataFrame, window_days: int = 7,
                       threshold: float = 0.8) -> DataFrame:
    """dt, city, users, avg_prev (mean of the ``window_days`` preceding days
    of the city), ratio = users / avg_prev, is_drop = ratio < threshold.

    Every city has a row for each day from its first to the last observed day,
    with 0 users where it has no event, so that an outage shows.
    """
    counts = (feed.select(F.to_date("time").alias("dt"), "city", "user_id").distinct()
              .groupBy("dt", "city").agg(F.count("user_id").alias("users")))
    # one row per city; the last day over all cities is a maximum of those rows
    spans = counts.groupBy("city").agg(F.min("dt").alias("lo"), F.max("dt").alias("hi"))
    spans = spans.withColumn("hi", F.max("hi").over(Window.partitionBy()))
    grid = spans.select(F.col("city").alias("c"), F.explode(F.sequence("lo", "hi")).alias("d"))
    daily = (grid.join(counts, grid["c"].eqNullSafe(counts["city"]) & (grid["d"] == counts["dt"]), "left")
             .select(F.col("d").alias("dt"), F.col("c").alias("city"), F.coalesce("users", F.lit(0)).alias("users")))
    w = Window.partitionBy("city").orderBy("dt").rowsBetween(-window_days, -1)
    avg_prev = F.avg("users").over(w)
    return (daily.withColumn("avg_prev", avg_prev)
            .withColumn("ratio", F.try_divide(F.col("users"), F.col("avg_prev")))
            .withColumn("is_drop", F.coalesce(F.col("ratio") < threshold, F.lit(False))))


def service_user_days(feed: DataFrame, messages: DataFrame) -> DataFrame:
    """(dt, user_id, in_feed, in_messenger) from one union + aggregate
    instead of a join of the two audiences."""
    f = feed.select(F.to_date("time").alias("dt"), "user_id",
                    F.lit(True).alias("f"), F.lit(False).alias("m"))
    m = messages.select(F.to_date("time").alias("dt"), "user_id",
                        F.lit(False).alias("f"), F.lit(True).alias("m"))
    return (f.unionByName(m).filter(F.col("user_id").isNotNull())
            .groupBy("dt", "user_id")
            .agg(F.bool_or("f").alias("in_feed"), F.bool_or("m").alias("in_messenger")))


def service_overlap(feed: DataFrame, messages: DataFrame) -> DataFrame:
    """dt, feed_users, messenger_users, both_users, feed_only_users,
    messenger_only_users (messenger audience = senders)."""
    u = service_user_days(feed, messages)
    f, m = F.col("in_feed"), F.col("in_messenger")
    return u.groupBy("dt").agg(
        F.count_if(f).alias("feed_users"), F.count_if(m).alias("messenger_users"),
        F.count_if(f & m).alias("both_users"), F.count_if(f & ~m).alias("feed_only_users"),
        F.count_if(~f & m).alias("messenger_only_users"))


def audience_by_source(feed: DataFrame, messages: DataFrame) -> DataFrame:
    """service, dt, source, users: distinct users per day and source."""
    f = feed.select(F.lit("feed").alias("service"), F.to_date("time").alias("dt"),
                    "source", "user_id")
    m = messages.select(F.lit("messenger").alias("service"), F.to_date("time").alias("dt"),
                        "source", "user_id")
    return (f.unionByName(m).select("service", "dt", "source", "user_id").distinct()
            .groupBy("service", "dt", "source").agg(F.count("user_id").alias("users")))


# ---- incremental cohort state ------------------------------------------------

FIRST_SEEN_SCHEMA = "user_id bigint, source string, first_day date"


def new_first_seen(activity_day: DataFrame, first_seen: DataFrame | None) -> DataFrame:
    """Users of one period's activity not yet in ``first_seen``: rows
    (user_id, source, first_day).

    The day's distinct users (partial aggregation) are anti-joined with the
    stored table on user_id; the whole history is never rescanned."""
    day_users = (activity_day.filter(F.col("user_id").isNotNull())
                 .groupBy("user_id", F.to_date("time").alias("period"))
                 .agg(F.min("source").alias("source"))
                 .groupBy("user_id")
                 .agg(F.min("period").alias("first_day"),
                      F.min_by("source", "period").alias("source")))
    if first_seen is not None:
        day_users = day_users.join(first_seen.select("user_id"), "user_id", "left_anti")
    return day_users.select("user_id", "source", "first_day")


def earliest(first_seen: DataFrame) -> DataFrame:
    """One row per user: the smallest stored first day and its source.  Days
    loaded out of order leave a user's later row behind; this passes over it."""
    return (first_seen.groupBy("user_id")
            .agg(F.min_by("source", "first_day").alias("source"), F.min("first_day").alias("first_day")))


def update_first_seen(spark, activity: DataFrame, day, path: str) -> DataFrame:
    """Write the users of ``day`` that have no earlier stored day as the
    partition ``first_day=<day>`` of the table at ``path`` and return the
    ``earliest`` rows.  Days may come in any order; re-running a day replaces
    its partition, also by nothing.  If a re-run takes users off a day, the
    later days have to be re-run too, as they left those users out."""
    from pyspark.errors import AnalysisException

    day = as_date(day)
    try:
        existing = spark.read.schema(FIRST_SEEN_SCHEMA).parquet(path).filter(F.col("first_day") < F.lit(day))
    except AnalysisException:   # first run: no table yet
        existing = None
    fresh = new_first_seen(activity.filter(time_in_days(day, day)), existing)
    fresh.select("user_id", "source").write.mode("overwrite").parquet(f"{path}/first_day={day.isoformat()}")
    return earliest(spark.read.schema(FIRST_SEEN_SCHEMA).parquet(path))


def retention_from_first_seen(activity: DataFrame, first_seen: DataFrame) -> DataFrame:
    """Daily retention (same columns as ``retention(..., "day")``) from
    distinct (user, day) activity and the stored first-seen table: a join on
    user_id instead of a window over each user's whole history."""
    ud = user_periods(activity, "day").select("user_id", "period")
    c = ud.join(earliest(first_seen).select("user_id", F.col("first_day").alias("cohort"),
                                  F.col("source").alias("cohort_source")), "user_id")
    n = F.datediff(F.col("period"), F.col("cohort"))
    g = (c.groupBy(F.col("cohort_source").alias("source"), "cohort", n.alias("period_n"))
         .agg(F.count("*").alias("active_users")))
    size = F.max(F.when(F.col("period_n") == 0, F.col("active_users"))).over(
        Window.partitionBy("source", "cohort"))
    return (g.withColumn("cohort_size", size)
            .withColumn("share", F.col("active_users") / F.col("cohort_size")))

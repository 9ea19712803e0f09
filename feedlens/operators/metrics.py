"""Per-day metrics of the feed and the messenger.

Exact distinct counts are computed in two phases: first ``groupBy(dt,
user_id)`` (map-side partial aggregation collapses a hot user to one row per
task and day), then ``groupBy(dt)`` over the user-day rows.  Conditional
distinct counts ("iOS users") become per-user boolean flags in the first
phase and ``count_if`` in the second, so no query needs Spark's ``Expand``
for several distinct aggregates at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day

# slice name -> (column, value)
SLICES = {
    "ios": ("os", "iOS"),
    "android": ("os", "Android"),
    "ads": ("source", "ads"),
    "organic": ("source", "organic"),
}


def slice_flag(name: str) -> Column:
    """Predicate of one slice, e.g. ``os = 'iOS'``."""
    col, value = SLICES[name]
    return F.col(col) == value


def ctr_percent(likes: str | Column = "likes", views: str | Column = "views") -> Column:
    """``round(likes / views * 100, 3)``; NULL when there are no views."""
    likes = F.col(likes) if isinstance(likes, str) else likes
    views = F.col(views) if isinstance(views, str) else views
    return F.round(F.try_divide(likes, views) * 100, 3)


def with_day(df: DataFrame, name: str = "dt", col: str = "time") -> DataFrame:
    return df.withColumn(name, day(col))


def feed_user_days(feed: DataFrame) -> DataFrame:
    """One row per (dt, user_id): views, likes and slice flags.

    A flag is true when any event of the user that day carries the value, so
    a user seen with two OS values on one day counts for both (as
    ``countIf(distinct user_id, os = ...)`` does)."""
    return (with_day(feed)
            .groupBy("dt", "user_id")
            .agg(F.count_if(F.col("action") == "view").alias("views"),
                 F.count_if(F.col("action") == "like").alias("likes"),
                 *[F.bool_or(slice_flag(k)).alias(k) for k in SLICES]))


def feed_role_days(feed: DataFrame) -> DataFrame:
    """One pass over the feed for two groupings: rows (role, dt, key,
    views, likes, slice flags) with role 'u' (key = user_id) and 'p'
    (key = post_id).

    Each event is emitted once per role (``inline`` of a two-element array)
    and one aggregate keyed by (role, dt, key) serves both.  Consumers must
    not filter this on ``role`` (the optimizer would push the filter below
    the aggregate and scan the events once per role); they use conditional
    aggregates instead."""
    f = with_day(feed)
    role = lambda name, key: F.struct(F.lit(name).alias("role"), F.col("dt"),
                                      F.col(key).cast("bigint").alias("key"), "action", "os",
                                      "source")
    rows = f.select(F.inline(F.array(role("u", "user_id"), role("p", "post_id"))))
    return (rows.groupBy("role", "dt", "key")
            .agg(F.count_if(F.col("action") == "view").alias("views"),
                 F.count_if(F.col("action") == "like").alias("likes"),
                 *[F.bool_or(slice_flag(k)).alias(k) for k in SLICES]))


def message_user_days(messages: DataFrame) -> DataFrame:
    """One row per (dt, sender): messages sent (non-NULL receivers) and
    slice flags."""
    return (with_day(messages)
            .groupBy("dt", "user_id")
            .agg(F.count("reciever_id").alias("messages"),
                 *[F.bool_or(slice_flag(k)).alias(k) for k in SLICES]))


def flag_count(flag: str) -> Column:
    """Number of user-day rows of known users whose flag is true."""
    return F.count_if(F.coalesce(F.col(flag), F.lit(False)) & F.col("user_id").isNotNull())


def dau_by_day(feed: DataFrame) -> DataFrame:
    """dt, dau: exact distinct users per day."""
    return (with_day(feed).select("dt", "user_id").distinct()
            .groupBy("dt").agg(F.count("user_id").alias("dau")))


def views_likes_by_day(feed: DataFrame) -> DataFrame:
    """dt, views, likes (``countIf``)."""
    return (with_day(feed).groupBy("dt")
            .agg(F.count_if(F.col("action") == "view").alias("views"),
                 F.count_if(F.col("action") == "like").alias("likes")))


def feed_daily(feed: DataFrame) -> DataFrame:
    """dt, dau, views, likes, ctr (percent, 3 digits)."""
    return (feed_user_days(feed).groupBy("dt")
            .agg(F.count("user_id").alias("dau"),
                 F.sum("views").alias("views"),
                 F.sum("likes").alias("likes"))
            .withColumn("ctr", ctr_percent()))


def ctr_by_day(feed: DataFrame) -> DataFrame:
    """dt, views, likes, ctr."""
    return views_likes_by_day(feed).withColumn("ctr", ctr_percent())


def posts_by_day(feed: DataFrame) -> DataFrame:
    """dt, post_count: exact distinct posts per day (two phases)."""
    return (with_day(feed).select("dt", "post_id").distinct()
            .groupBy("dt").agg(F.count("post_id").alias("post_count")))


def messages_by_day(messages: DataFrame) -> DataFrame:
    """dt, mess_dau (distinct senders), messages_count (``count(reciever_id)``)."""
    return (message_user_days(messages).groupBy("dt")
            .agg(F.count("user_id").alias("mess_dau"),
                 F.sum("messages").alias("messages_count")))


def users_by_flags(user_days: DataFrame, flags: list[str], prefix: str) -> DataFrame:
    """dt, {prefix}_{flag}_users for each flag of a user-day table."""
    return (user_days.groupBy("dt")
            .agg(*[flag_count(f).alias(f"{prefix}_{f}_users") for f in flags]))


def users_by_os(feed: DataFrame, messages: DataFrame) -> DataFrame:
    """service, dt, ios_users, android_users for the feed and the messenger."""
    def one(ud, name):
        return (ud.groupBy("dt").agg(flag_count("ios").alias("ios_users"),
                                     flag_count("android").alias("android_users"))
                .select(F.lit(name).alias("service"), "*"))
    return one(feed_user_days(feed), "feed").unionByName(one(message_user_days(messages), "messenger"))


def users_by_source(feed: DataFrame, messages: DataFrame) -> DataFrame:
    """service, dt, ads_users, organic_users for the feed and the messenger."""
    def one(ud, name):
        return (ud.groupBy("dt").agg(flag_count("ads").alias("ads_users"),
                                     flag_count("organic").alias("organic_users"))
                .select(F.lit(name).alias("service"), "*"))
    return one(feed_user_days(feed), "feed").unionByName(one(message_user_days(messages), "messenger"))

"""Daily aggregate store: what the reports need of a day, written once.

    <store>/feed_daily         one row per day: audience, posts, traffic by slice, user sketch
    <store>/message_daily      the same of the messenger
    <store>/feed_activity      activity bitmaps of the feed      (operators.activity)
    <store>/message_activity   activity bitmaps of the messenger

A load takes any range of days, scans each event table once for it and replaces
those days in all four published tables.  Reports read the store and no event:
the senders of all time, which decide between feed-only users and users of both
services, come from the messenger's bitmaps, so a day's split follows later
messages as the original's does.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import as_date, last_full_days, time_in_days
from ..operators import activity
from ..operators.metrics import SLICES, ctr_percent, slice_flag, with_day
from ..sources import published
from . import reports

#: log2 of the registers of a user sketch: a standard error of 0.8 percent.
LG_K = 14

_FEED = ", ".join(["dt date", *[f"{c} bigint" for c in (
    "dau", "views", "likes", "post_count", *[f"{s}_{k}" for s in SLICES for k in ("users", "views", "likes", "rows")])],
    "users_sketch binary"])
_MESSAGES = ", ".join(["dt date", *[f"{c} bigint" for c in (
    "mess_dau", "messages_count", *[f"{s}_{k}" for s in SLICES for k in ("users", "messages", "rows")])],
    "users_sketch binary"])


def feed_day_rows(feed: DataFrame) -> DataFrame:
    """One row per day of ``feed``.  Each event is emitted once as its user's
    and once as its post's (``inline``) and aggregated by (role, day, key), combined
    map-side; the second aggregate is over user-days and post-days."""
    role = lambda name, key: F.struct(F.lit(name).alias("role"), "dt", F.col(key).cast("bigint").alias("key"),
                                      "action", "os", "source")
    rows = with_day(feed).select(F.inline(F.array(role("u", "user_id"), role("p", "post_id"))))
    view, like = F.col("action") == "view", F.col("action") == "like"
    sums = {"views": view, "likes": like}
    for s in SLICES:
        sums |= {f"{s}_views": slice_flag(s) & view, f"{s}_likes": slice_flag(s) & like, f"{s}_rows": slice_flag(s)}
    per_key = rows.groupBy("role", "dt", "key").agg(*[F.count_if(c).alias(k) for k, c in sums.items()])
    is_user = F.col("role") == "u"
    known = is_user & F.col("key").isNotNull()
    return per_key.groupBy("dt").agg(
        F.count_if(known).alias("dau"),
        *[F.sum(F.when(is_user, F.col(k))).alias(k) for k in ("views", "likes")],
        F.count_if(~is_user & F.col("key").isNotNull()).alias("post_count"),
        *[c for s in SLICES for c in (
            F.count_if(known & (F.col(f"{s}_rows") > 0)).alias(f"{s}_users"),
            *[F.sum(F.when(is_user, F.col(f"{s}_{k}"))).alias(f"{s}_{k}") for k in ("views", "likes", "rows")])],
        F.hll_sketch_agg(F.when(known, F.col("key")), F.lit(LG_K)).alias("users_sketch"))


def message_day_rows(messages: DataFrame) -> DataFrame:
    """One row per day of ``messages``: senders, messages (rows with a receiver)."""
    rows = with_day(messages)
    per_user = rows.groupBy("dt", "user_id").agg(
        F.count("reciever_id").alias("n"),
        *[c for s in SLICES for c in (F.count(F.when(slice_flag(s), F.col("reciever_id"))).alias(f"{s}_n"),
                                      F.count_if(slice_flag(s)).alias(f"{s}_r"))])
    return per_user.groupBy("dt").agg(
        F.count("user_id").alias("mess_dau"), F.sum("n").alias("messages_count"),
        *[c for s in SLICES for c in (
            F.count_if((F.col(f"{s}_r") > 0) & F.col("user_id").isNotNull()).alias(f"{s}_users"),
            F.sum(f"{s}_n").alias(f"{s}_messages"), F.sum(f"{s}_r").alias(f"{s}_rows"))],
        F.hll_sketch_agg("user_id", F.lit(LG_K)).alias("users_sketch"))


def _days(first, last) -> list[str]:
    a, b = as_date(first), as_date(last)
    return [(a + _dt.timedelta(days=k)).isoformat() for k in range((b - a).days + 1)]


def load(spark: SparkSession, feed: DataFrame, messages: DataFrame, first, last, store: str) -> None:
    """Write, or replace, the days [first, last] in the store.  The states are
    published first: a report sees the day's rows only with them in place."""
    f, m = feed.filter(time_in_days(first, last)), messages.filter(time_in_days(first, last))
    activity.update(spark, f, first, last, f"{store}/feed_activity")
    activity.update(spark, m, first, last, f"{store}/message_activity")
    published.publish(message_day_rows(m), f"{store}/message_daily", F.col("dt"), _days(first, last))
    published.publish(feed_day_rows(f), f"{store}/feed_daily", F.col("dt"), _days(first, last))


def feed_daily(spark: SparkSession, store: str, keep=None) -> DataFrame:
    return published.read(spark, f"{store}/feed_daily", _FEED, keep)


def message_daily(spark: SparkSession, store: str, keep=None) -> DataFrame:
    return published.read(spark, f"{store}/message_daily", _MESSAGES, keep)


def _from(as_of, n_days: int) -> str:
    return (as_date(as_of) - _dt.timedelta(days=n_days)).isoformat()


def main_metric_report(spark: SparkSession, store: str, as_of, n_days: int = 7) -> DataFrame:
    """``reports.main_metric_report`` from the rows of the window and of the last
    day before it, which the names of the stored days tell."""
    first = _from(as_of, n_days)
    before = max((d for d in published.parts(spark, f"{store}/feed_daily") if d < first), default=first)
    daily = feed_daily(spark, store, lambda d: d >= before).select("dt", "dau", "views", "likes", ctr_percent().alias("ctr"))
    return reports.key_metrics(daily, as_of, n_days)


def full_report(spark: SparkSession, store: str, as_of, n_days: int = 7) -> DataFrame:
    """``reports.full_report`` without an event: day rows, and the split of each
    day's feed users by the sender set from the two activity states."""
    first = _from(as_of, n_days)
    inside = lambda d: d >= first
    last = max(published.parts(spark, f"{store}/feed_daily"), default=first)
    f = feed_daily(spark, store, inside).select(
        "dt", F.col("dau").alias("feed_dau"), "views", "likes", "post_count",
        *[F.col(f"{s}_users").alias(f"feed_{s}_users") for s in SLICES])
    m = message_daily(spark, store, inside).select(
        "dt", "mess_dau", "messages_count", *[F.col(f"{s}_users").alias(f"mess_{s}_users") for s in SLICES])
    split = activity.overlap_by_day(activity.load(spark, f"{store}/feed_activity", first, max(first, last)),
                                    activity.known_users(activity.load(spark, f"{store}/message_activity")),
                                    first, max(first, last))
    split = split.select("dt", F.col("users_with").alias("all_app_users"), F.col("users_without").alias("feed_users"))
    j = (f.join(m, "dt").join(split, "dt").filter((F.col("feed_users") > 0) & (F.col("all_app_users") > 0))
         .filter(last_full_days(as_of, n_days)))
    return j.select(
        "dt", "feed_dau", "mess_dau", "post_count", "messages_count", "feed_users",
        "feed_ios_users", "feed_android_users", "mess_ios_users", "mess_android_users",
        "all_app_users", "views", "likes", ctr_percent().alias("ctr"),
        "feed_ads_users", "feed_organic_users", "mess_ads_users", "mess_organic_users").orderBy(F.desc("dt"))


def _traffic(daily: DataFrame, as_of, n_days: int, kinds: dict[str, str]) -> DataFrame:
    keep = F.lit(True)
    for s in SLICES:
        keep = keep & (F.col(f"{s}_rows") > 0)
    cols = [F.col(f"{s}_{k}").alias(f"{s}_{name}") for s in SLICES for k, name in kinds.items()]
    return daily.filter(keep & last_full_days(as_of, n_days)).select("dt", *cols).orderBy(F.desc("dt"))


def feed_traffic(spark: SparkSession, store: str, as_of, n_days: int = 7) -> DataFrame:
    first = _from(as_of, n_days)
    return _traffic(feed_daily(spark, store, lambda d: d >= first), as_of, n_days, {"views": "views", "likes": "likes"})


def message_traffic(spark: SparkSession, store: str, as_of, n_days: int = 7) -> DataFrame:
    first = _from(as_of, n_days)
    return _traffic(message_daily(spark, store, lambda d: d >= first), as_of, n_days, {"messages": "mess_count"})


def main_metrics(spark: SparkSession, store: str) -> DataFrame:
    """``reports.main_metrics``: one row per stored day."""
    f = feed_daily(spark, store).select("dt", "dau", "views", "likes", ctr_percent().alias("ctr"))
    return f.join(message_daily(spark, store).select("dt", "mess_dau", "messages_count"), "dt", "full")


def rolling_users(spark: SparkSession, store: str, days: int = 7) -> DataFrame:
    """dt, users, users_estimate, error_pct: distinct feed users of ``days`` days
    by the exact bitmaps, and by the union of the stored daily sketches - which
    needs ``days`` small rows a day whatever the number of users - with the
    estimate's measured error in percent.

    Every stored day is sent to the days whose window holds it."""
    exact = activity.active_users(activity.load(spark, f"{store}/feed_activity"), days)
    daily = feed_daily(spark, store).select(
        F.explode(F.sequence("dt", F.date_add("dt", days - 1))).alias("day"), "users_sketch")
    union = daily.groupBy("day").agg(F.hll_sketch_estimate(F.hll_union_agg("users_sketch")).alias("users_estimate"))
    return (exact.join(union, F.col("dt") == F.col("day"))
            .select("dt", "users", "users_estimate",
                    (F.abs(F.col("users_estimate") - F.col("users")) * 100.0 / F.col("users")).alias("error_pct")))

"""Composite reports: key metrics, whole-app report, traffic by slice.

Shapes differ from the original SQL on purpose:

* the report window is applied to the raw events (a pushed-down range on
  ``time``) before any aggregate, instead of after eight joined aggregates;
* each table is scanned once with conditional aggregates instead of once
  per CTE;
* the per-day rows the original obtains from inner joins of many CTEs are
  reproduced by explicit guards ("each slice has a row that day").
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import as_date, last_full_days, time_last_full_days
from ..operators import bloom
from ..operators.metrics import (SLICES, ctr_percent, feed_daily, feed_role_days,
                                 flag_count, message_user_days, messages_by_day, slice_flag,
                                 with_day)

KEY_METRICS = ["dau", "views", "likes", "ctr"]


def prev_day_metrics(daily: DataFrame, metrics=KEY_METRICS) -> DataFrame:
    """prev_* = value of the previous existing day (0 on the first day),
    dev_* = value - prev_*.

    The window has no partition key: its input is one row per day, so the
    single task it runs in holds a few thousand rows at most."""
    w = Window.orderBy("dt")
    out = daily
    for m in metrics:
        out = out.withColumn(f"prev_{m}", F.lag(m, 1, 0).over(w))
    for m in metrics:
        out = out.withColumn(f"dev_{m}", F.col(m) - F.col(f"prev_{m}"))
    return out


def _midnight(d: _dt.date):
    return F.lit(d.isoformat()).cast("timestamp_ntz")


def last_day_before(feed: DataFrame, day) -> _dt.date | None:
    """The latest day with an event before ``day``: one maximum."""
    found = feed.filter(F.col("time") < _midnight(as_date(day))).agg(F.max("time")).first()[0]
    return found.date() if found else None


def main_metric_report(feed: DataFrame, as_of, n_days: int = 7, before: _dt.date | None = None) -> DataFrame:
    """DAU, views, likes, CTR of the last ``n_days`` full days with the
    previous day's values and the change (newest first).

    "Previous" is the previous existing day, which for the first day of the
    window may lie any time before it.  That day (``before`` if the caller
    knows it) is the latest one before the window, looked for in the week before
    it and, if that is empty, in all history; only it and later days are
    aggregated."""
    first = as_date(as_of) - _dt.timedelta(days=n_days)
    if before is None:
        week = feed.filter(F.col("time") >= _midnight(first - _dt.timedelta(days=7)))
        before = last_day_before(week, first) or last_day_before(feed, first)
    src = feed.filter(F.col("time") >= _midnight(before or first))
    return key_metrics(feed_daily(src), as_of, n_days)


def key_metrics(daily: DataFrame, as_of, n_days: int = 7) -> DataFrame:
    """The key-metric report from one row per day (dt, dau, views, likes, ctr)."""
    report = prev_day_metrics(daily).filter(last_full_days(as_of, n_days))
    return report.select("dt", *KEY_METRICS, *[f"prev_{m}" for m in KEY_METRICS],
                         *[f"dev_{m}" for m in KEY_METRICS]).orderBy(F.desc("dt"))


def senders(messages: DataFrame) -> DataFrame:
    """Users who ever sent a message (no date bound, as in the original)."""
    return messages.select("user_id").filter(F.col("user_id").isNotNull()).distinct()


def full_report(feed: DataFrame, messages: DataFrame, as_of, n_days: int = 7,
                known_senders: DataFrame | None = None) -> DataFrame:
    """Whole-app report per day: feed and messenger audience, posts,
    messages, feed-only users against users of both services, users by OS
    and by source.  A day is kept only when it has messages, feed-only users
    and both-service users (the original's inner joins).

    ``known_senders`` (user_id, distinct) is the maintained sender set, e.g.
    ``activity.known_users`` of the messenger's state; without it the message
    table is read over all history for it."""
    feed_w = feed.filter(time_last_full_days(as_of, n_days))
    msgs_w = messages.filter(time_last_full_days(as_of, n_days))

    # one scan of the feed window: user-days and post-days come from one
    # aggregate; the sender flag joins only user rows (condition in the ON
    # clause, so nothing is pushed below the shared aggregate)
    g = feed_role_days(feed_w)
    snd = (senders(messages) if known_senders is None else known_senders).select(F.col("user_id").alias("_sender"), F.lit(True).alias("sends"))
    j = g.join(snd, (F.col("role") == "u") & (F.col("key") == F.col("_sender")), "left")
    user = (F.col("role") == "u") & F.col("key").isNotNull()
    feed_day = j.groupBy("dt").agg(
        F.count_if(user).alias("feed_dau"),
        F.sum(F.when(F.col("role") == "u", F.col("views"))).alias("views"),
        F.sum(F.when(F.col("role") == "u", F.col("likes"))).alias("likes"),
        F.count_if(user & F.col("sends").isNull()).alias("feed_users"),
        F.count_if(user & F.col("sends").isNotNull()).alias("all_app_users"),
        *[F.count_if(user & F.coalesce(F.col(f), F.lit(False))).alias(f"feed_{f}_users")
          for f in SLICES],
        F.count_if((F.col("role") == "p") & F.col("key").isNotNull()).alias("post_count"),
    )
    mess_day = message_user_days(msgs_w).groupBy("dt").agg(
        F.count("user_id").alias("mess_dau"),
        F.sum("messages").alias("messages_count"),
        *[flag_count(f).alias(f"mess_{f}_users") for f in SLICES],
    )
    j = (feed_day.join(mess_day, "dt")
         .filter((F.col("feed_users") > 0) & (F.col("all_app_users") > 0)))
    return j.select(
        "dt", "feed_dau", "mess_dau", "post_count", "messages_count", "feed_users",
        "feed_ios_users", "feed_android_users", "mess_ios_users", "mess_android_users",
        "all_app_users", "views", "likes", ctr_percent().alias("ctr"),
        "feed_ads_users", "feed_organic_users", "mess_ads_users", "mess_organic_users",
    ).orderBy(F.desc("dt"))


_TRAFFIC_SLICES = ["ios", "android", "ads", "organic"]


def feed_traffic(feed: DataFrame, as_of, n_days: int = 7) -> DataFrame:
    """Views and likes per day by OS and by source; a day is kept only when
    each of the four slices has at least one event."""
    f = with_day(feed.filter(time_last_full_days(as_of, n_days)))
    is_view, is_like = F.col("action") == "view", F.col("action") == "like"
    aggs = []
    for s in _TRAFFIC_SLICES:
        aggs += [F.count_if(slice_flag(s) & is_view).alias(f"{s}_views"),
                 F.count_if(slice_flag(s) & is_like).alias(f"{s}_likes")]
    guards = [F.count_if(slice_flag(s)).alias(f"_n_{s}") for s in _TRAFFIC_SLICES]
    g = f.groupBy("dt").agg(*aggs, *guards)
    keep = F.lit(True)
    for s in _TRAFFIC_SLICES:
        keep = keep & (F.col(f"_n_{s}") > 0)
    cols = [c for s in _TRAFFIC_SLICES for c in (f"{s}_views", f"{s}_likes")]
    return g.filter(keep).select("dt", *cols).orderBy(F.desc("dt"))


def message_traffic(messages: DataFrame, as_of, n_days: int = 7) -> DataFrame:
    """Messages per day by OS and by source (``count(reciever_id)``); a day
    is kept only when each slice has at least one message row."""
    m = with_day(messages.filter(time_last_full_days(as_of, n_days)))
    aggs = [F.count(F.when(slice_flag(s), F.col("reciever_id"))).alias(f"{s}_mess_count")
            for s in _TRAFFIC_SLICES]
    guards = [F.count_if(slice_flag(s)).alias(f"_n_{s}") for s in _TRAFFIC_SLICES]
    g = m.groupBy("dt").agg(*aggs, *guards)
    keep = F.lit(True)
    for s in _TRAFFIC_SLICES:
        keep = keep & (F.col(f"_n_{s}") > 0)
    return g.filter(keep).select("dt", *[f"{s}_mess_count" for s in _TRAFFIC_SLICES]) \
        .orderBy(F.desc("dt"))


def _feed_user_days(feed: DataFrame) -> DataFrame:
    """Distinct (dt, user_id) of the feed: partial aggregation map-side, so a
    user with a huge share of events is one row per task and day before any
    join."""
    return with_day(feed).select("dt", "user_id").filter(F.col("user_id").isNotNull()) \
        .distinct()


def users_feed_only(feed: DataFrame, messages: DataFrame | None,
                    known_senders: DataFrame | None = None) -> DataFrame:
    """dt, feed_users: distinct feed users per day who never sent a message
    (anti join of distinct user-days to the sender set; NULL-safe unlike
    SQL ``NOT IN``).  ``known_senders``: see ``full_report``."""
    snd = senders(messages) if known_senders is None else known_senders
    return (_feed_user_days(feed).join(snd, "user_id", "left_anti")
            .groupBy("dt").agg(F.count("user_id").alias("feed_users")))


def users_both_services(feed: DataFrame, messages: DataFrame | None,
                        known_senders: DataFrame | None = None, n_senders: int | None = None) -> DataFrame:
    """dt, all_app_users: distinct feed users per day who ever sent a
    message (semi join of distinct user-days to the sender set).

    With the maintained sender set and an upper bound of its size, a Bloom
    filter of the senders thins the feed at the scan, before its aggregate."""
    snd = senders(messages) if known_senders is None else known_senders
    if known_senders is not None and n_senders is not None:
        feed = bloom.prefilter(feed, snd, "user_id", n_senders)
    return (_feed_user_days(feed).join(snd, "user_id", "left_semi")
            .groupBy("dt").agg(F.count("user_id").alias("all_app_users")))


def main_metrics(feed: DataFrame, messages: DataFrame) -> DataFrame:
    """Dashboard data set: feed DAU, views, likes, CTR and messenger DAU and
    message count per day (full outer on the day)."""
    return feed_daily(feed).join(messages_by_day(messages), "dt", "full") \
        .select("dt", "dau", "views", "likes", "ctr", "mess_dau", "messages_count")


def report_latest_day(main_report: DataFrame, full: DataFrame) -> DataFrame:
    """The newest row of each report as (report, report_day, metric, value,
    prev, dev, line) rows - what the daily message is built from.

    ``orderBy(desc).limit(1)`` is a top-1 (TakeOrderedAndProject): each task
    keeps one row."""
    def latest(df):
        return df.orderBy(F.desc("dt")).limit(1)

    def stack(df, report, triples):
        parts = ", ".join(f"'{m}', cast({v} as double), cast({p} as double), cast({d} as double)"
                          for m, v, p, d in triples)
        return df.select(
            F.lit(report).alias("report"),
            F.date_format("dt", "dd-MM-yyyy").alias("report_day"),
            F.expr(f"stack({len(triples)}, {parts}) as (metric, value, prev, dev)"))

    main_rows = stack(latest(main_report), "main",
                      [(m, m, f"prev_{m}", f"dev_{m}") for m in KEY_METRICS])
    full_metrics = ["feed_dau", "mess_dau", "ctr", "views", "likes", "post_count",
                    "messages_count", "feed_users", "all_app_users", "feed_ads_users",
                    "mess_ads_users", "feed_organic_users", "mess_organic_users",
                    "feed_ios_users", "feed_android_users", "mess_ios_users",
                    "mess_android_users"]
    full_rows = stack(latest(full), "full", [(m, m, "null", "null") for m in full_metrics])
    rows = main_rows.unionByName(full_rows)
    text = F.when(F.col("metric") == "ctr", F.format_string("%.3f", "value")) \
        .otherwise(F.format_string("%d", F.col("value").cast("bigint")))
    return rows.withColumn("line", F.concat_ws(": ", "metric", text))

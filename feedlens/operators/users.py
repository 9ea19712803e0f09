"""Per-user daily totals and their joins (the daily ETL's extract + merge).

All inputs are aggregated per user before any join, so a join never sees
more than one row per (user, attribute set); a hot user cannot skew it.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import as_date, day, yesterday

USER_KEYS = ["event_date", "user_id", "gender", "age", "os"]


def gender_label(col: str = "gender") -> Column:
    """``if(gender = 0, 'male', 'female')``; NULL counts as female."""
    return F.when(F.col(col) == 0, F.lit("male")).otherwise(F.lit("female"))


def user_feed_totals(feed: DataFrame, as_of) -> DataFrame:
    """Likes and views per user on day ``as_of - 1``, keyed by the user's
    (os, gender, age) of the event."""
    return (feed.filter(yesterday(as_of))
            .groupBy(day("time").alias("event_date"), "user_id", "os",
                     gender_label().alias("gender"), "age")
            .agg(F.count_if(F.col("action") == "like").alias("likes"),
                 F.count_if(F.col("action") == "view").alias("views"))
            .select("event_date", "user_id", "likes", "views", "os", "gender", "age"))


def user_message_totals(messages: DataFrame, as_of, how: str = "inner") -> DataFrame:
    """Sent and received counters per user on day ``as_of - 1``.

    Sender totals are grouped by (user, os, age, gender); receiver totals by
    the receiver.  ``how='inner'`` (the original) drops users who only sent
    or only received; ``how='full'`` keeps them with NULL counters and, for
    pure receivers, NULL attributes.  A sender with several attribute rows
    gets the received counts on each row.

    One pass over the day's messages: each message is emitted once as the
    sender's row and once as the receiver's row (``inline`` of a two-element
    array), and a single aggregate keyed by (role, user, attributes) counts
    messages and distinct partners for both roles.
    """
    d = as_date(as_of) - _dt.timedelta(days=1)
    m = messages.filter(yesterday(as_of))
    null_s, null_i = F.lit(None).cast("string"), F.lit(None).cast("int")
    as_sender = F.struct(F.lit("s").alias("role"), F.col("user_id").alias("uid"),
                         F.col("reciever_id").alias("other"), F.col("os").alias("os"),
                         F.col("age").alias("age"), gender_label().alias("gender"))
    as_receiver = F.struct(F.lit("r").alias("role"), F.col("reciever_id").alias("uid"),
                           F.col("user_id").alias("other"), null_s.alias("os"),
                           null_i.alias("age"), null_s.alias("gender"))
    roles = m.select(F.inline(F.array(as_sender, as_receiver)))
    if how == "full":
        roles = roles.filter((F.col("role") == "s") | F.col("uid").isNotNull())
    per_role = (roles.groupBy("role", "uid", "os", "age", "gender")
                .agg(F.count("other").alias("n"), F.count_distinct("other").alias("d")))
    # receiver counts reach every sender row of the same user through a
    # window by user (a user has one receiver row and a few sender rows);
    # no filter on the role before it, so the messages are scanned once
    w = Window.partitionBy("uid")
    is_s = F.col("role") == "s"
    x = per_role.select(
        "*",
        F.max(F.when(~is_s, F.col("n"))).over(w).alias("_rn"),
        F.max(F.when(~is_s, F.col("d"))).over(w).alias("_rd"),
        F.count_if(is_s).over(w).alias("_ns"))
    if how == "inner":
        keep = is_s & F.col("uid").isNotNull() & F.col("_rn").isNotNull()
    elif how == "full":
        keep = is_s | (F.col("_ns") == 0)
    else:
        raise ValueError("how must be 'inner' or 'full'")
    return x.filter(keep).select(
        F.lit(d).alias("event_date"), F.col("uid").alias("user_id"),
        F.when(is_s, F.col("n")).alias("messages_sent"),
        F.when(is_s, F.col("d")).alias("users_sent"),
        F.when(is_s, F.col("_rn")).otherwise(F.col("n")).alias("messages_received"),
        F.when(is_s, F.col("_rd")).otherwise(F.col("d")).alias("users_received"),
        "os", "gender", "age")


def _null_safe_on(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])


def daily_user_activity(feed_totals: DataFrame, message_totals: DataFrame) -> DataFrame:
    """Full outer merge on (event_date, user_id, gender, age, os).

    Keys match NULL to NULL (as a pandas merge does); missing counters become
    0 and stay BIGINT.  Text keys are not filled."""
    a, b = feed_totals.alias("a"), message_totals.alias("b")
    j = a.join(b, _null_safe_on(a, b, USER_KEYS), "full")
    keys = [F.coalesce(a[k], b[k]).alias(k) for k in USER_KEYS]
    counters = ([F.coalesce(a[c], F.lit(0)).cast("bigint").alias(c) for c in ("likes", "views")]
                + [F.coalesce(b[c], F.lit(0)).cast("bigint").alias(c)
                   for c in ("messages_sent", "users_sent", "messages_received", "users_received")])
    return j.select(*keys, *counters)

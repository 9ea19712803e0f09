"""Activity bitmaps: who was active on which days, as mergeable state.

A row of the state is (block, user_id, source, bits): a block is nine weeks from
a Monday, bit i of ``bits`` says that the user was active on day i of the block
with that source.  Days merge by OR, so days may be loaded in any order and in
any grouping; a day that is loaded again is cleared first, so its corrections
take effect, users who leave it included.  The state is one published table with
a part per block: a daily update reads and replaces one block.

Retention, new users, the weekly audience, active users of a rolling window and
the senders of the messenger come from bit arithmetic on this state, without the
events.  Users are counted by bit pattern before patterns are spelled out into
days, so a dashboard shuffles patterns, not user-days.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import as_date, time_in_days
from ..sources import published

WEEKS = 9
DAYS = 7 * WEEKS
#: Monday from which blocks count.
ORIGIN = _dt.date(1970, 1, 5)
SCHEMA = "block int, user_id bigint, source string, bits bigint"
_WEEK = (1 << WEEKS) - 1


def _day_number(day: Column) -> Column:
    return F.datediff(day, F.lit(ORIGIN))


def _date(number: Column) -> Column:
    return F.date_add(F.lit(ORIGIN), number.cast("int"))


def activity_bits(events: DataFrame) -> DataFrame:
    """State rows of ``events`` (user_id, time, source): one aggregate, combined
    map-side, so a hot user is one row per task, block and source.  Rows without
    a user are left out."""
    n = _day_number(F.to_date("time"))
    block = F.floor(n / DAYS).cast("int")
    bit = F.expr("shiftleft(1L, pmod(n, %d))" % DAYS)
    return (events.filter(F.col("user_id").isNotNull()).select(block.alias("block"), n.alias("n"), "user_id", "source")
            .groupBy("block", "user_id", "source").agg(F.bit_or(bit).alias("bits")))


def update(spark: SparkSession, events: DataFrame, first, last, path: str) -> None:
    """Load the days [first, last] of ``events`` into the state at ``path``,
    replacing what it held of them.  Only blocks with such days are touched; loads
    of different days of one block may run at once."""
    a, b = ((as_date(d) - ORIGIN).days for d in (first, last))
    blocks = list(range(a // DAYS, b // DAYS + 1))
    mask = lambda k: sum(1 << i for i in range(DAYS) if a <= k * DAYS + i <= b)
    keep = {k: ~mask(k) for k in blocks}
    cleared = F.col("bits")
    for k, m in keep.items():
        cleared = F.when(F.col("block") == k, F.col("bits").bitwiseAND(F.lit(m))).otherwise(cleared)
    new = activity_bits(events.filter(time_in_days(first, last)))

    def merged(old: DataFrame) -> DataFrame:
        return (old.withColumn("bits", cleared).unionByName(new).groupBy("block", "user_id", "source")
                .agg(F.bit_or("bits").alias("bits")).filter("bits != 0"))

    published.rewrite(spark, path, SCHEMA, F.col("block"), blocks, merged)


def load(spark: SparkSession, path: str, first=None, last=None) -> DataFrame:
    """State rows; with a range only the blocks that hold days of it."""
    a, b = ((as_date(d) - ORIGIN).days // DAYS if d is not None else None for d in (first, last))
    return published.read(spark, path, SCHEMA, lambda v: (a is None or int(v) >= a) and (b is None or int(v) <= b))


def _lowest(bits: str) -> str:
    """SQL: index of the lowest set bit."""
    return f"bit_count(({bits} & -{bits}) - 1)"


def _users(state: DataFrame) -> DataFrame:
    """block, user_id, bits over all sources."""
    return state.groupBy("block", "user_id").agg(F.bit_or("bits").alias("bits"))


def first_seen(state: DataFrame, grain: str = "day") -> DataFrame:
    """user_id, first (first active day, or Monday of the first active week) and
    the user's smallest known source in that period."""
    if grain not in ("day", "week"):
        raise ValueError("grain must be 'day' or 'week'")
    days = 1 if grain == "day" else 7
    number = F.expr(f"block * {DAYS} + {_lowest('bits')}")
    period = (F.floor(number / days) * days).cast("int")
    # a NULL source comes after every known one
    rows = state.select("user_id", F.struct(period.alias("n"), F.col("source").isNull().alias("unknown"), "source").alias("x"))
    one = rows.groupBy("user_id").agg(F.min("x").alias("x"))
    return one.select("user_id", _date(F.col("x.n")).alias("first"), F.col("x.source").alias("source"))


def known_users(state: DataFrame) -> DataFrame:
    """user_id of everybody the state has seen: for the messenger's state, the
    users who ever sent a message."""
    return state.select("user_id").distinct()


def days_of(state: DataFrame, first, last) -> DataFrame:
    """dt, user_id of the active days in [first, last]."""
    users = _users(state)
    spelled = users.select("user_id", "block", F.explode(_positions(F.col("bits"), DAYS)).alias("i"))
    dt = _date(F.col("block") * DAYS + F.col("i"))
    return spelled.select(dt.alias("dt"), "user_id").filter(F.col("dt").between(F.lit(as_date(first)), F.lit(as_date(last))))


def overlap_by_day(state: DataFrame, others: DataFrame, first, last) -> DataFrame:
    """dt, users_with, users_without: the state's users of each day in [first,
    last] who are, or are not, among ``others`` (user_id, distinct).  Bits outside
    the range are cut first; users are counted by bits and membership, and the
    patterns spelled out."""
    a, b = ((as_date(d) - ORIGIN).days for d in (first, last))
    bits = F.lit(0).cast("bigint")
    for k in range(a // DAYS, b // DAYS + 1):
        mask = sum(1 << i for i in range(DAYS) if a <= k * DAYS + i <= b)
        bits = F.when(F.col("block") == k, F.col("bits").bitwiseAND(F.lit(mask))).otherwise(bits)
    users = _users(state.filter(F.col("block").between(a // DAYS, b // DAYS))).withColumn("bits", bits).filter("bits != 0")
    known = others.select(F.col("user_id").alias("_o"), F.lit(True).alias("_with"))
    j = users.join(known, F.col("user_id") == F.col("_o"), "left")
    patterns = j.groupBy("block", "bits", F.col("_with").isNotNull().alias("with")).agg(F.count("*").alias("users"))
    spelled = patterns.select("block", "with", "users", F.explode(_positions(F.col("bits"), DAYS)).alias("i"))
    return spelled.groupBy(_date(F.col("block") * DAYS + F.col("i")).alias("dt")).agg(
        F.sum(F.when(F.col("with"), F.col("users")).otherwise(0)).alias("users_with"),
        F.sum(F.when(~F.col("with"), F.col("users")).otherwise(0)).alias("users_without"))


def _positions(bits: Column, n: int) -> Column:
    return F.filter(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.call_function("getbit", bits, i) == 1)


def retention(state: DataFrame, grain: str = "day") -> DataFrame:
    """source, cohort, period_n, active_users, cohort_size, share: the rows of
    ``cohorts.retention`` for days or weeks."""
    first = first_seen(state, grain)
    users = _users(state)
    if grain == "week":
        users = users.withColumn("bits", F.expr(_week_word("bits")))
    joined = users.join(first.select(F.col("user_id").alias("_u"), F.col("first").alias("cohort"), "source"),
                        F.col("user_id") == F.col("_u"))
    patterns = joined.groupBy("source", "cohort", "block", "bits").agg(F.count("*").alias("users"))
    n = DAYS if grain == "day" else WEEKS
    step = DAYS // n
    at = F.col("block") * DAYS + F.col("i") * step
    spelled = patterns.select("source", "cohort", "users", "block", F.explode(_positions(F.col("bits"), n)).alias("i"))
    period = ((at - _day_number(F.col("cohort"))) / step).cast("int")
    g = spelled.groupBy("source", "cohort", period.alias("period_n")).agg(F.sum("users").alias("active_users"))
    size = F.max(F.when(F.col("period_n") == 0, F.col("active_users"))).over(Window.partitionBy("source", "cohort"))
    return (g.withColumn("cohort_size", size)
            .withColumn("share", F.col("active_users") / F.col("cohort_size")))


def new_users(state: DataFrame, grain: str = "day") -> DataFrame:
    """period, source, new_users."""
    return (first_seen(state, grain).groupBy(F.col("first").alias("period"), "source")
            .agg(F.count("*").alias("new_users")))


def campaign_retention(state: DataFrame, cohort_day, horizons=(1, 14)) -> DataFrame:
    """The rows of ``cohorts.campaign_retention``: users first seen on
    ``cohort_day`` and how many were active ``horizons`` days later, from the
    blocks up to the last horizon."""
    d = as_date(cohort_day)
    at = {h: (d - ORIGIN).days + h for h in (0, *horizons)}
    users = _users(state.filter(F.col("block") <= max(at.values()) // DAYS))
    on = lambda n: F.bool_or((F.col("block") == n // DAYS) & (F.call_function("getbit", F.col("bits"), F.lit(n % DAYS)) == 1))
    first = F.min(F.expr(f"block * {DAYS} + {_lowest('bits')}"))
    per_user = users.groupBy("user_id").agg(first.alias("first"), *[on(at[h]).alias(f"on_{h}") for h in horizons])
    one = per_user.filter(F.col("first") == at[0]).agg(
        F.count("*").alias("cohort_size"), *[F.count_if(f"on_{h}").alias(f"n_{h}") for h in horizons])
    rows = F.array(*[F.struct(F.lit(h).alias("day_n"), F.col(f"n_{h}").alias("active_users")) for h in horizons])
    return (one.filter("cohort_size > 0").select("cohort_size", F.inline(rows))
            .select(F.lit(d).alias("cohort"), "day_n", "cohort_size", "active_users",
                    (F.col("active_users") / F.col("cohort_size")).alias("share")))


def _week_word(bits: str) -> str:
    """SQL: bit w says that the user was active in week w of the block."""
    weeks = [f"CASE WHEN shiftright({bits}, {7 * w}) & 127L != 0 THEN {1 << w} ELSE 0 END" for w in range(WEEKS)]
    return " + ".join(weeks).join(("CAST(", " AS BIGINT)"))


def weekly_audience(state: DataFrame) -> DataFrame:
    """week, status, users (new / retained / returned / gone): the rows of
    ``cohorts.weekly_audience``.

    Per user and block the four statuses are four words of nine bits, from the
    block's weeks, the last week of the block before and whether there was any
    earlier block; users are counted by these words, and only the distinct
    words are spelled out into weeks."""
    words = _users(state).select("block", "user_id", F.expr(_week_word("bits")).alias("w"))
    by_user = Window.partitionBy("user_id").orderBy("block")
    x = words.select("block", "w", F.lag("block").over(by_user).alias("pb"), F.lag("w").over(by_user).alias("pw"),
                     F.lead("block").over(by_user).alias("nb"))
    near = "coalesce(pb = block - 1, false)"
    x = x.select("block", "w", F.expr(f"shiftleft(w, 1) & {_WEEK} | CASE WHEN {near} THEN shiftright(pw, {WEEKS - 1}) & 1L ELSE 0L END").alias("before"),
                 # weeks after the user's first one
                 F.expr(f"CASE WHEN pb IS NOT NULL THEN {_WEEK}L ELSE {_WEEK} & ~((w & -w) * 2 - 1) END").alias("later"),
                 # active in the last week, and no block that follows says so
                 F.expr(f"shiftright(w, {WEEKS - 1}) & 1L & CASE WHEN coalesce(nb = block + 1, false) THEN 0L ELSE 1L END").alias("over"))
    status = {"retained": "w & before", "new": "w & ~later", "returned": "w & ~before & later",
              "gone": f"(before & ~w & {_WEEK}) | shiftleft(over, {WEEKS})"}
    counted = x.groupBy("block", *[F.expr(e).alias(s) for s, e in status.items()]).agg(F.count("*").alias("users"))
    each = F.array(*[F.struct(F.lit(s).alias("status"), F.col(s).alias("bits")) for s in status])
    spelled = counted.select("block", "users", F.inline(each)).filter("bits != 0").select(
        "block", "users", "status", F.explode(_positions(F.col("bits"), WEEKS + 1)).alias("i"))
    out = (spelled.groupBy(_date(F.col("block") * DAYS + F.col("i") * 7).alias("week"), "status")
           .agg(F.sum("users").alias("users")))
    # weeks after the last observed one are not reported: a few rows per week
    last = F.max(F.when(F.col("status") != "gone", F.col("week"))).over(Window.partitionBy())
    return out.withColumn("_last", last).filter(F.col("week") <= F.col("_last")).drop("_last")


def users_by_source(state: DataFrame) -> DataFrame:
    """dt, source, users: the rows of ``cohorts.audience_by_source`` of one service."""
    patterns = state.groupBy("block", "source", "bits").agg(F.count("*").alias("users"))
    return (patterns.select("block", "source", "users", F.explode(_positions(F.col("bits"), DAYS)).alias("i"))
            .groupBy(_date(F.col("block") * DAYS + F.col("i")).alias("dt"), "source").agg(F.sum("users").alias("users")))


def service_overlap(feed_state: DataFrame, message_state: DataFrame) -> DataFrame:
    """The rows of ``cohorts.service_overlap``: one aggregate by user and block
    over both states, then counts of bit pairs."""
    none = F.lit(0).cast("bigint")
    f = feed_state.select("block", "user_id", F.col("bits").alias("f"), none.alias("m"))
    m = message_state.select("block", "user_id", none.alias("f"), F.col("bits").alias("m"))
    pairs = (f.unionByName(m).groupBy("block", "user_id").agg(F.bit_or("f").alias("f"), F.bit_or("m").alias("m"))
             .groupBy("block", "f", "m").agg(F.count("*").alias("users")))
    spelled = pairs.select("block", "f", "m", "users", F.explode(_positions(F.expr("f | m"), DAYS)).alias("i"))
    on = lambda c: F.call_function("getbit", F.col(c), F.col("i")) == 1
    count = lambda cond: F.sum(F.when(cond, F.col("users")).otherwise(0))
    return spelled.groupBy(_date(F.col("block") * DAYS + F.col("i")).alias("dt")).agg(
        count(on("f")).alias("feed_users"), count(on("m")).alias("messenger_users"),
        count(on("f") & on("m")).alias("both_users"), count(on("f") & ~on("m")).alias("feed_only_users"),
        count(~on("f") & on("m")).alias("messenger_only_users"))


def active_users(state: DataFrame, days: int = 7) -> DataFrame:
    """dt, users: distinct users of the ``days`` days up to and including dt, for
    every day from the first to the last observed one.

    A user's day becomes a run of ``days`` days; runs of one block and its
    overhang into the next are words again, so a user counts once a day."""
    if not 1 <= days <= DAYS:
        raise ValueError(f"days must be between 1 and {DAYS}")
    users = _users(state)
    run, full = "bits", (1 << DAYS) - 1
    here, over = "0L", "0L"
    for k in range(days):
        here += f" | (shiftleft({run}, {k}) & {full}L)"
        over += f" | shiftrightunsigned({run}, {DAYS - k})" if k else ""
    both = users.select("user_id", F.inline(F.array(
        F.struct(F.col("block"), F.expr(here).alias("bits")),
        F.struct((F.col("block") + 1).alias("block"), F.expr(over).alias("bits"))))).filter("bits != 0")
    patterns = (both.groupBy("block", "user_id").agg(F.bit_or("bits").alias("bits"))
                .groupBy("block", "bits").agg(F.count("*").alias("users")))
    out = (patterns.select("block", "users", F.explode(_positions(F.col("bits"), DAYS)).alias("i"))
           .groupBy(_date(F.col("block") * DAYS + F.col("i")).alias("dt")).agg(F.sum("users").alias("users")))
    # the last observed day, from the union of all users' bits in the last block
    days_seen = users.groupBy("block").agg(F.bit_or("bits").alias("bits")).select(
        F.expr(f"block * {DAYS} + length(bin(bits)) - 1").alias("n"))
    return out.filter(F.col("dt") <= days_seen.agg(_date(F.max("n"))).scalar())

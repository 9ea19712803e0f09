"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query maps the driver's test tables onto the event tables (see
``sources.fixtures``) and runs one job of the library over all of them.
Double columns are rounded to 6 digits at the very end so that results
compare exactly with an independent SQL engine.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import last_full_days, time_in_days, time_last_full_days, yesterday
from ..operators import activity, cohorts, experiments, metrics, slices, users
from ..session import shared_path
from ..sources import fixtures, readers, sinks
from ..streaming import realtime
from . import daily_store, reports

# fixed parameters of the checks (FIXTURES.md section 2)
AS_OF = _dt.date(2024, 1, 31)
AA_WEEK = (_dt.date(2024, 1, 8), _dt.date(2024, 1, 14))
AA_GROUPS = (2, 3)
AB_WEEK = (_dt.date(2024, 1, 15), _dt.date(2024, 1, 21))
AB_PAIRS = {"03": (0, 3), "12": (1, 2)}
SIMS, SAMPLE_SIZE, SEED = 10_000, 500, 42
DISTINCT_SIMS, DISTINCT_SIZE = 2_000, 20   # the test tables have few users an arm
HIST_BINS = 20
PVALUE_BINS = 50
CAMPAIGN_DAY = _dt.date(2024, 1, 2)
CAMPAIGN_HORIZONS = (1, 14)
CITY_WINDOW, CITY_THRESHOLD = 7, 0.8

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select([F.round(F.col(f.name), digits).alias(f.name)
                      if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                      for f in df.schema.fields])


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = run
        return run
    return deco


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


def _feed(spark, d):
    return fixtures.feed_actions(spark, d)


def _msgs(spark, d):
    return fixtures.message_actions(spark, d)


# ---- filters ---------------------------------------------------------------

@query("filter_yesterday")
def _filter_yesterday(spark, d):
    """Feed events of day as_of - 1 (range on the event time, pushed down)."""
    return _feed(spark, d).filter(yesterday(AS_OF))


@query("filter_day_range")
def _filter_day_range(spark, d):
    """Feed events of the A/A week in groups 2 and 3."""
    return _feed(spark, d).filter(time_in_days(*AA_WEEK) & F.col("exp_group").isin(*AA_GROUPS))


@query("filter_last_7_days")
def _filter_last_7_days(spark, d):
    """Feed events of the last 7 full days before as_of, with their day."""
    f = metrics.with_day(_feed(spark, d).filter(time_last_full_days(AS_OF, 7)))
    return f.filter(last_full_days(AS_OF, 7))


# ---- per-day metrics -------------------------------------------------------

@query("dau_by_day")
def _dau(spark, d):
    return metrics.dau_by_day(_feed(spark, d))


@query("views_likes_by_day")
def _views_likes(spark, d):
    return metrics.views_likes_by_day(_feed(spark, d))


@query("ctr_by_day")
def _ctr(spark, d):
    return metrics.ctr_by_day(_feed(spark, d))


@query("posts_by_day")
def _posts(spark, d):
    return metrics.posts_by_day(_feed(spark, d))


@query("messages_by_day")
def _messages(spark, d):
    return metrics.messages_by_day(_msgs(spark, d))


@query("users_by_os")
def _users_by_os(spark, d):
    return metrics.users_by_os(_feed(spark, d), _msgs(spark, d))


@query("users_by_source")
def _users_by_source(spark, d):
    return metrics.users_by_source(_feed(spark, d), _msgs(spark, d))


@query("prev_day_metrics")
def _prev_day(spark, d):
    return reports.prev_day_metrics(metrics.feed_daily(_feed(spark, d)))


# ---- joins and user totals ---------------------------------------------------

@query("users_feed_only")
def _feed_only(spark, d):
    return reports.users_feed_only(_feed(spark, d), _msgs(spark, d))


@query("users_both_services")
def _both(spark, d):
    return reports.users_both_services(_feed(spark, d), _msgs(spark, d))


@query("user_feed_totals")
def _user_feed_totals(spark, d):
    return users.user_feed_totals(_feed(spark, d), AS_OF)


@query("user_message_totals")
def _user_message_totals(spark, d):
    return users.user_message_totals(_msgs(spark, d), AS_OF)


@query("daily_user_activity")
def _daily_user_activity(spark, d):
    return users.daily_user_activity(users.user_feed_totals(_feed(spark, d), AS_OF),
                                     users.user_message_totals(_msgs(spark, d), AS_OF))


@query("daily_slices")
def _daily_slices(spark, d):
    return slices.daily_slices(_feed(spark, d), _msgs(spark, d), AS_OF)


@query("user_message_totals_full")
def _user_message_totals_full(spark, d):
    """Also users who only sent or only received."""
    return users.user_message_totals(_msgs(spark, d), AS_OF, how="full")


@query("daily_slices_published")
def _daily_slices_published(spark, d):
    """The day's slices through the published table: a first version, then the
    corrected one, read back."""
    f, m = _feed(spark, d), _msgs(spark, d)
    path, day = shared_path(spark, f"slices/{uuid.uuid4().hex}"), AS_OF - _dt.timedelta(days=1)
    sinks.publish_slices(slices.daily_slices(f, m, AS_OF, how="full"), path, day)
    sinks.publish_slices(slices.daily_slices(f, m, AS_OF), path, day)
    return sinks.read_slices(spark, path, day, day)


#: Day by source: the audience and traffic of both services, as SQL text.
SOURCE_REPORT = """
WITH f AS (
  SELECT to_date(time) AS dt, source, count(DISTINCT user_id) AS feed_users,
         count_if(action = 'view') AS views, count_if(action = 'like') AS likes
  FROM {feed} WHERE time >= CAST(:first AS TIMESTAMP_NTZ) AND time < CAST(:until AS TIMESTAMP_NTZ)
  GROUP BY 1, 2),
m AS (
  SELECT to_date(time) AS dt, source, count(DISTINCT user_id) AS senders, count(reciever_id) AS messages
  FROM {messages} WHERE time >= CAST(:first AS TIMESTAMP_NTZ) AND time < CAST(:until AS TIMESTAMP_NTZ)
  GROUP BY 1, 2)
SELECT dt, source, coalesce(feed_users, 0) AS feed_users, coalesce(views, 0) AS views, coalesce(likes, 0) AS likes,
       coalesce(senders, 0) AS senders, coalesce(messages, 0) AS messages,
       round(coalesce(messages, 0) / nullif(senders, 0), 6) AS messages_per_sender
FROM f FULL JOIN m USING (dt, source)
"""


@query("source_report_sql")
def _source_report_sql(spark, d):
    """SQL text with parameters over the two event tables."""
    return readers.sql_frame(spark, SOURCE_REPORT, {"feed": _feed(spark, d), "messages": _msgs(spark, d)},
                             first=AS_OF - _dt.timedelta(days=7), until=AS_OF)


# ---- reports -----------------------------------------------------------------

@query("main_metric_report")
def _main_metric_report(spark, d):
    return reports.main_metric_report(_feed(spark, d), AS_OF)


@query("full_report")
def _full_report(spark, d):
    return reports.full_report(_feed(spark, d), _msgs(spark, d), AS_OF)


@query("feed_traffic")
def _feed_traffic(spark, d):
    return reports.feed_traffic(_feed(spark, d), AS_OF)


@query("message_traffic")
def _message_traffic(spark, d):
    return reports.message_traffic(_msgs(spark, d), AS_OF)


@query("report_latest_day")
def _report_latest_day(spark, d):
    f, m = _feed(spark, d), _msgs(spark, d)
    return reports.report_latest_day(reports.main_metric_report(f, AS_OF),
                                     reports.full_report(f, m, AS_OF))


@query("main_metrics")
def _main_metrics(spark, d):
    return reports.main_metrics(_feed(spark, d), _msgs(spark, d))


# ---- experiments -------------------------------------------------------------

def _aa_users(spark, d):
    return experiments.user_ctr(_feed(spark, d), *AA_WEEK, AA_GROUPS)


def _ab_base(spark, d):
    """Per-user CTR of the A/B week for every group of every pair."""
    groups = sorted({g for pair in AB_PAIRS.values() for g in pair})
    return experiments.user_ctr(_feed(spark, d), *AB_WEEK, groups)


def _ab_tagged(base):
    """User rows of every A/B pair, tagged with their test: one pass over the
    base, a row per pair its group belongs to."""
    pairs = F.array(*[F.struct(F.lit(p).alias("test"), F.lit(c).alias("group_a"), F.lit(t).alias("group_b"))
                      for p, (c, t) in AB_PAIRS.items()])
    group = F.col("exp_group")
    mine = F.filter(pairs, lambda x: (x["group_a"] == group) | (x["group_b"] == group))
    return base.select("*", F.inline(mine))


@query("user_ctr")
def _user_ctr(spark, d):
    return _aa_users(spark, d)


@query("group_sizes")
def _group_sizes(spark, d):
    return experiments.group_sizes(_aa_users(spark, d), *AA_GROUPS)


@query("group_overlap")
def _group_overlap(spark, d):
    return experiments.group_overlap(_aa_users(spark, d), *AA_GROUPS)


@query("duplicate_rows")
def _duplicate_rows(spark, d):
    """Repeated (user, post, action) rows of the raw feed in the A/A week."""
    week = fixtures.feed_actions(spark, d).filter(time_in_days(*AA_WEEK))
    return experiments.duplicate_rows(week.select("user_id", "post_id", "action"))


@query("control_ctr")
def _control_ctr(spark, d):
    """CTR of each pair's control group: one grouped aggregate."""
    tagged = _ab_tagged(_ab_base(spark, d)).filter(F.col("exp_group") == F.col("group_a"))
    return (tagged.groupBy("test", F.col("group_a").alias("control_group"))
            .agg(F.sum("likes").alias("likes"), F.sum("views").alias("views"))
            .withColumn("control_ctr", F.try_divide(F.col("likes"), F.col("views"))))


@query("linearized_likes")
def _linearized_likes(spark, d):
    return experiments.linearized(_ab_tagged(_ab_base(spark, d))).drop("group_a", "group_b")


@query("ctr_histogram")
def _ctr_histogram(spark, d):
    return experiments.histogram(_aa_users(spark, d), "ctr", HIST_BINS, group_col="exp_group")


@query("linearized_histogram")
def _linearized_histogram(spark, d):
    return experiments.linearized_histograms(_ab_tagged(_ab_base(spark, d)), HIST_BINS)


@query("welch_ctr")
def _welch_ctr(spark, d):
    """Welch tests of per-user CTR: the A/A pair and both A/B pairs, in one
    grouped aggregate."""
    tagged = experiments.tag_test(_aa_users(spark, d), "aa", *AA_GROUPS)
    return experiments.welch_tests(tagged.unionByName(_ab_tagged(_ab_base(spark, d))), "ctr")


@query("welch_linearized")
def _welch_linearized(spark, d):
    """Welch tests of linearized likes for both A/B pairs, from the moments of
    one aggregate."""
    return experiments.linearized_tests(_ab_tagged(_ab_base(spark, d)))


@query("ab_test_03")
def _ab_test_03(spark, d):
    return experiments.ab_test(_feed(spark, d), *AB_WEEK, *AB_PAIRS["03"]).drop("log10_p")


@query("ab_test_12")
def _ab_test_12(spark, d):
    return experiments.ab_test(_feed(spark, d), *AB_WEEK, *AB_PAIRS["12"]).drop("log10_p")


def _aa_sims(spark, d):
    return experiments.aa_resample(spark, _aa_users(spark, d), *AA_GROUPS, sims=SIMS,
                                   sample_size=SAMPLE_SIZE, seed=SEED)


@query("aa_resample")
def _aa_resample(spark, d):
    return _aa_sims(spark, d)


@query("aa_resample_distinct")
def _aa_resample_distinct(spark, d):
    """Simulated A/A tests on samples of distinct users."""
    return experiments.aa_resample(spark, _aa_users(spark, d), *AA_GROUPS, sims=DISTINCT_SIMS,
                                   sample_size=DISTINCT_SIZE, seed=SEED, replace=False)


@query("aa_pvalue_histogram")
def _aa_pvalue_histogram(spark, d):
    return experiments.pvalue_histogram(_aa_sims(spark, d), PVALUE_BINS)


@query("aa_false_positive_rate")
def _aa_false_positive_rate(spark, d):
    return experiments.false_positive_rate(_aa_sims(spark, d))


@query("aa_split_check")
def _aa_split_check(spark, d):
    return experiments.aa_split_check(spark, _feed(spark, d), *AA_WEEK, *AA_GROUPS, sims=SIMS,
                                      sample_size=SAMPLE_SIZE, seed=SEED)


# ---- dashboards --------------------------------------------------------------

@query("audience_by_source")
def _audience_by_source(spark, d):
    return cohorts.audience_by_source(_feed(spark, d), _msgs(spark, d))


@query("retention_feed")
def _retention_feed(spark, d):
    return cohorts.retention(_feed(spark, d), "day")


@query("retention_messages")
def _retention_messages(spark, d):
    return cohorts.retention(_msgs(spark, d), "day")


@query("retention_orders")
def _retention_orders(spark, d):
    """Monthly retention on the long-run order log (FIXTURES.md section 3)."""
    return cohorts.retention(fixtures.order_activity(spark, d), "month")


@query("new_users_by_day")
def _new_users(spark, d):
    f = cohorts.new_users(_feed(spark, d), "day").select(F.lit("feed").alias("service"), "*")
    m = cohorts.new_users(_msgs(spark, d), "day").select(F.lit("messenger").alias("service"), "*")
    return f.unionByName(m)


@query("campaign_retention")
def _campaign_retention(spark, d):
    return cohorts.campaign_retention(_feed(spark, d), CAMPAIGN_DAY, CAMPAIGN_HORIZONS)


@query("weekly_audience")
def _weekly_audience(spark, d):
    return cohorts.weekly_audience(fixtures.order_activity(spark, d))


@query("city_activity_drop")
def _city_activity_drop(spark, d):
    return cohorts.city_activity_drop(_feed(spark, d), CITY_WINDOW, CITY_THRESHOLD)


@query("service_overlap")
def _service_overlap(spark, d):
    return cohorts.service_overlap(_feed(spark, d), _msgs(spark, d))


# ---- dashboards from activity bitmaps ------------------------------------------

def _activity(spark, events):
    """Activity state of all days of ``events``, loaded out of order: the
    later half, then the earlier half."""
    lo, hi = (t.date() for t in events.agg(F.min("time"), F.max("time")).first())
    mid = lo + (hi - lo) // 2
    path = shared_path(spark, f"activity/{uuid.uuid4().hex}")
    for first, last in ((mid, hi), (lo, mid - _dt.timedelta(days=1))):
        if first <= last:
            activity.update(spark, events, first, last, path)
    return activity.load(spark, path)


@query("retention_feed_incremental")
def _retention_feed_incremental(spark, d):
    return activity.retention(_activity(spark, _feed(spark, d)))


@query("retention_messages_incremental")
def _retention_messages_incremental(spark, d):
    return activity.retention(_activity(spark, _msgs(spark, d)))


@query("retention_feed_weekly")
def _retention_feed_weekly(spark, d):
    return activity.retention(_activity(spark, _feed(spark, d)), "week")


@query("new_users_incremental")
def _new_users_incremental(spark, d):
    f = activity.new_users(_activity(spark, _feed(spark, d))).select(F.lit("feed").alias("service"), "*")
    m = activity.new_users(_activity(spark, _msgs(spark, d))).select(F.lit("messenger").alias("service"), "*")
    return f.unionByName(m)


@query("weekly_audience_feed")
def _weekly_audience_feed(spark, d):
    return activity.weekly_audience(_activity(spark, _feed(spark, d)))


@query("weekly_audience_messages")
def _weekly_audience_messages(spark, d):
    return activity.weekly_audience(_activity(spark, _msgs(spark, d)))


@query("weekly_audience_incremental")
def _weekly_audience_incremental(spark, d):
    """The order log's weekly audience from its activity state (years of blocks)."""
    return activity.weekly_audience(_activity(spark, fixtures.order_activity(spark, d)))


@query("active_users_7d")
def _active_users_7d(spark, d):
    """Distinct feed users of each day and the six days before it."""
    return activity.active_users(_activity(spark, _feed(spark, d)), 7)


@query("campaign_retention_incremental")
def _campaign_retention_incremental(spark, d):
    return activity.campaign_retention(_activity(spark, _feed(spark, d)), CAMPAIGN_DAY, CAMPAIGN_HORIZONS)


@query("service_overlap_incremental")
def _service_overlap_incremental(spark, d):
    return activity.service_overlap(_activity(spark, _feed(spark, d)), _activity(spark, _msgs(spark, d)))


@query("audience_by_source_incremental")
def _audience_by_source_incremental(spark, d):
    f = activity.users_by_source(_activity(spark, _feed(spark, d))).select(F.lit("feed").alias("service"), "*")
    m = activity.users_by_source(_activity(spark, _msgs(spark, d))).select(F.lit("messenger").alias("service"), "*")
    return f.unionByName(m)


@query("users_both_services_state")
def _both_state(spark, d):
    """Users of both services per day: the senders from the messenger's
    activity state, a Bloom filter of them at the feed scan."""
    senders = activity.known_users(_activity(spark, _msgs(spark, d)))
    return reports.users_both_services(_feed(spark, d), None, senders, senders.count())


@query("users_feed_only_state")
def _feed_only_state(spark, d):
    return reports.users_feed_only(_feed(spark, d), None, activity.known_users(_activity(spark, _msgs(spark, d))))


# ---- reports from the daily store ----------------------------------------------

def _store(spark, d):
    """A store of all days of both event tables."""
    f, m = _feed(spark, d), _msgs(spark, d)
    lo, hi = (t.date() for t in f.select("time").union(m.select("time")).agg(F.min("time"), F.max("time")).first())
    store = shared_path(spark, f"store/{uuid.uuid4().hex}")
    daily_store.load(spark, f, m, lo, hi, store)
    return store


@query("main_metric_report_store")
def _main_metric_report_store(spark, d):
    return daily_store.main_metric_report(spark, _store(spark, d), AS_OF)


@query("full_report_store")
def _full_report_store(spark, d):
    return daily_store.full_report(spark, _store(spark, d), AS_OF)


@query("feed_traffic_store")
def _feed_traffic_store(spark, d):
    return daily_store.feed_traffic(spark, _store(spark, d), AS_OF)


@query("message_traffic_store")
def _message_traffic_store(spark, d):
    return daily_store.message_traffic(spark, _store(spark, d), AS_OF)


@query("main_metrics_store")
def _main_metrics_store(spark, d):
    return daily_store.main_metrics(spark, _store(spark, d))


@query("active_users_sketch")
def _active_users_sketch(spark, d):
    """Rolling seven-day users, exact, and whether the union of the daily
    sketches is within 2 percent of them."""
    r = daily_store.rolling_users(spark, _store(spark, d), 7)
    return r.select("dt", "users", (F.col("error_pct") <= 2).alias("within_2_pct"))


# ---- live metrics (batch twins of the streams) -------------------------------

@query("realtime_feed")
def _realtime_feed(spark, d):
    return realtime.feed_window_metrics(_feed(spark, d))


@query("realtime_feed_buckets")
def _realtime_feed_buckets(spark, d):
    """Windows from the bucketed totals that the live stream stores."""
    path = shared_path(spark, f"live/{uuid.uuid4().hex}")
    changed = realtime.window_buckets(_feed(spark, d).withColumn("time", F.col("time").cast("timestamp")), "feed")
    realtime.upsert_windows(changed, path, "feed")
    out = realtime.live_windows(spark, path, "feed")
    return out.select(*[F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")],
                      *[c for c in out.columns if not c.startswith("window_")])


@query("realtime_messages")
def _realtime_messages(spark, d):
    return realtime.message_window_metrics(_msgs(spark, d))

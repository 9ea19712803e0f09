"""Job entry points on Parquet event tables (fixture rows written to disk)."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from feedlens.operators import cohorts
from feedlens.plans import daily_store, jobs, reports
from feedlens.sources import fixtures, readers, sinks
from feedlens.streaming import realtime

from .conftest import SF_SMALL


def test_jobs_end_to_end(spark):
    base = tempfile.mkdtemp(prefix="feedlens-jobs-")
    feed_p, msg_p = os.path.join(base, "feed"), os.path.join(base, "messages")
    fixtures.feed_actions(spark, SF_SMALL).write.parquet(feed_p)
    fixtures.message_actions(spark, SF_SMALL).write.parquet(msg_p)

    out = os.path.join(base, "slices")
    all_rows = lambda: sorted(map(tuple, sinks.read_slices(spark, out).collect()))
    jobs.daily_etl(spark, feed_p, msg_p, out, "2024-01-30")
    jobs.daily_etl(spark, feed_p, msg_p, out, "2024-01-31")
    first = all_rows()
    jobs.daily_etl(spark, feed_p, msg_p, out, "2024-01-31")          # retry
    assert all_rows() == first
    assert {r[0].isoformat() for r in first} == {"2024-01-29", "2024-01-30"}

    rep = jobs.daily_reports(spark, feed_p, msg_p, os.path.join(base, "reports"), "2024-01-31")
    assert rep["main_metric_report"].count() == 7

    ab = jobs.ab_test(spark, feed_p, os.path.join(base, "ab"), "2024-01-15", "2024-01-21", 0, 3)
    assert {r.metric for r in ab.collect()} == {"ctr", "linearized_likes"}

    summary = jobs.aa_check(spark, feed_p, os.path.join(base, "aa"), "2024-01-08",
                            "2024-01-14", 2, 3, sims=50, sample_size=20).first()
    assert summary.sims == 50 and summary.n_overlap == 0 and summary.n_duplicates == 0


def test_day_directories_are_pruned(spark):
    from pyspark.sql import functions as F

    from feedlens.sources import readers

    base = tempfile.mkdtemp(prefix="feedlens-days-")
    feed_p, msg_p = os.path.join(base, "feed"), os.path.join(base, "messages")
    (fixtures.feed_actions(spark, SF_SMALL).withColumn("dt", F.to_date("time"))
     .write.partitionBy("dt").parquet(feed_p))
    (fixtures.message_actions(spark, SF_SMALL).withColumn("dt", F.to_date("time"))
     .write.partitionBy("dt").parquet(msg_p))
    pruned = readers.read_feed_actions(spark, feed_p, "dt", ("2024-01-29", "2024-01-29"))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "2024-01-29" in plan
    assert pruned.columns == fixtures.feed_actions(spark, SF_SMALL).columns

    a = jobs.daily_etl(spark, feed_p, msg_p, os.path.join(base, "s1"), "2024-01-30",
                       day_column="dt")
    b = jobs.daily_etl(spark, feed_p, msg_p, os.path.join(base, "s2"), "2024-01-30")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_command_line_entry(spark):
    base = tempfile.mkdtemp(prefix="feedlens-cli-")
    feed_p, msg_p = os.path.join(base, "feed"), os.path.join(base, "messages")
    fixtures.feed_actions(spark, SF_SMALL).write.parquet(feed_p)
    fixtures.message_actions(spark, SF_SMALL).write.parquet(msg_p)
    out = os.path.join(base, "slices")
    jobs.main(["etl", "--feed", feed_p, "--messages", msg_p, "--out", out, "--as-of", "2024-01-30"])
    ab_out = os.path.join(base, "ab")
    jobs.main(["ab", "--feed", feed_p, "--out", ab_out, "--first", "2024-01-15",
               "--last", "2024-01-21", "--groups", "0", "3"])
    assert sinks.read_slices(spark, out).count() > 0
    assert spark.read.parquet(os.path.join(ab_out, "ab_0_3")).count() == 2
    with pytest.raises(SystemExit):
        jobs.main(["dashboards", "--out", out])


def _same(a, b):
    order = sorted(a.columns)
    assert order == sorted(b.columns)
    assert sorted(map(repr, map(tuple, a.select(order).collect()))) == sorted(map(repr, map(tuple, b.select(order).collect())))


def test_store_reports_dashboards_and_streams_by_command_line(spark):
    base = tempfile.mkdtemp(prefix="feedlens-store-")
    p = lambda name: os.path.join(base, name)
    feed, msgs = fixtures.feed_actions(spark, SF_SMALL), fixtures.message_actions(spark, SF_SMALL)
    for df, name in ((feed, "feed"), (msgs, "messages")):
        df.withColumn("dt", F.to_date("time")).write.partitionBy("dt").parquet(p(name))
    common = ["--feed", p("feed"), "--messages", p("messages"), "--day-column", "dt"]
    jobs.main(["backfill", *common, "--store", p("store"), "--first", "2024-01-01", "--last", "2024-01-29"])
    jobs.main(["etl", *common, "--store", p("store"), "--out", p("slices"), "--as-of", "2024-01-31"])
    jobs.main(["report", "--store", p("store"), "--out", p("stored"), "--as-of", "2024-01-31"])
    jobs.main(["report", *common, "--out", p("raw"), "--as-of", "2024-01-31"])
    for name in ("main_metric_report", "full_report", "feed_traffic", "message_traffic", "report_latest_day"):
        _same(spark.read.parquet(p(f"stored/{name}/as_of=2024-01-31")), spark.read.parquet(p(f"raw/{name}/as_of=2024-01-31")))
    _same(spark.read.parquet(p("raw/full_report/as_of=2024-01-31")), reports.full_report(feed, msgs, "2024-01-31"))
    _same(spark.read.parquet(p("raw/main_metric_report/as_of=2024-01-31")), reports.main_metric_report(feed, "2024-01-31"))

    jobs.main(["dashboards", "--store", p("store"), "--out", p("boards"), "--cohort-day", "2024-01-02",
               "--feed", p("feed"), "--day-column", "dt", "--first", "2024-01-01", "--last", "2024-01-30"])
    board = lambda name: spark.read.parquet(p(f"boards/{name}"))
    _same(board("retention_feed"), cohorts.retention(feed))
    _same(board("retention_messages"), cohorts.retention(msgs))
    _same(board("service_overlap"), cohorts.service_overlap(feed, msgs))
    _same(board("audience_by_source"), cohorts.audience_by_source(feed, msgs))
    _same(board("campaign_retention"), cohorts.campaign_retention(feed, "2024-01-02"))
    _same(board("city_activity_drop"), cohorts.city_activity_drop(feed))
    _same(board("main_metrics"), reports.main_metrics(feed, msgs))
    weekly = board("weekly_audience")
    _same(weekly.filter("service = 'messenger'").drop("service"), cohorts.weekly_audience(msgs))
    assert board("rolling_users").filter("error_pct > 2").count() == 0

    stream = p("stream")
    feed.withColumn("time", F.col("time").cast("timestamp")).write.parquet(stream)
    jobs.main(["live", "--feed", stream, "--out", p("live"), "--once"])
    live = realtime.live_windows(spark, p("live/feed"), "feed")
    batch = realtime.feed_window_metrics(feed)
    assert live.count() == batch.count() and live.agg(F.sum("views")).first() == batch.agg(F.sum("views")).first()


def test_reports_from_the_store_open_no_event_file(spark):
    base = tempfile.mkdtemp(prefix="feedlens-scan-")
    p = lambda name: os.path.join(base, name)
    feed, msgs = fixtures.feed_actions(spark, SF_SMALL), fixtures.message_actions(spark, SF_SMALL)
    for df, name in ((feed, "feed"), (msgs, "messages")):
        df.withColumn("dt", F.to_date("time")).write.partitionBy("dt").parquet(p(name))
    jobs.backfill(spark, p("feed"), p("messages"), p("store"), "2024-01-01", "2024-01-30", "dt")
    for name in ("main_metric_report", "full_report", "feed_traffic", "message_traffic"):
        df = getattr(daily_store, name)(spark, p("store"), "2024-01-31")
        files = df.inputFiles()
        assert files and all("/store/" in f for f in files), name
    days = {f.split("__part=")[1].split("/")[0] for f in
            daily_store.feed_traffic(spark, p("store"), "2024-01-31").inputFiles()}
    assert days == {f"2024-01-{d}" for d in range(24, 31)}

    # from events: every scan of the window's tables is cut to its directories
    pruned = readers.read_feed_actions(spark, p("feed"), "dt", ("2024-01-24", "9999-12-31"))
    plan = reports.full_report(pruned, pruned.withColumn("reciever_id", F.col("post_id")), "2024-01-31",
                               known_senders=spark.range(1).select(F.col("id").alias("user_id")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in text.splitlines() if "FileScan parquet" in line]
    assert scans and all("PartitionFilters: [isnotnull(dt" in line for line in scans)


def test_previous_day_far_back(spark):
    """The previous existing day lies long before the week that is looked at first."""
    base = tempfile.mkdtemp(prefix="feedlens-gap-")
    feed = fixtures.feed_actions(spark, SF_SMALL)
    gap = feed.filter((F.to_date("time") <= F.lit("2024-01-05")) | (F.to_date("time") >= F.lit("2024-01-26")))
    msgs = fixtures.message_actions(spark, SF_SMALL)
    f, m = os.path.join(base, "f"), os.path.join(base, "m")
    gap.withColumn("dt", F.to_date("time")).write.partitionBy("dt").parquet(f)
    msgs.withColumn("dt", F.to_date("time")).write.partitionBy("dt").parquet(m)
    got = jobs.daily_reports(spark, f, m, os.path.join(base, "r"), "2024-01-31", day_column="dt")["main_metric_report"]
    want = reports.main_metric_report(gap, "2024-01-31")
    _same(got, want)
    assert min(r.prev_dau for r in got.collect()) > 0
    jobs.backfill(spark, f, m, os.path.join(base, "s"), "2024-01-01", "2024-01-30", "dt")
    _same(daily_store.main_metric_report(spark, os.path.join(base, "s"), "2024-01-31"), want)

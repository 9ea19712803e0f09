"""Cohort invariants on the order log and the feed."""
from pyspark.sql import functions as F

from feedlens.operators import cohorts
from feedlens.sources import fixtures

from .conftest import SF_SMALL


def test_retention_day_zero_share_is_one(spark):
    r = cohorts.retention(fixtures.order_activity(spark, SF_SMALL), "month")
    zero = r.filter("period_n = 0").collect()
    assert zero and all(x.share == 1.0 for x in zero)
    assert r.filter("share > 1 OR period_n < 0").count() == 0


def test_new_users_add_up_to_all_users(spark):
    acts = fixtures.order_activity(spark, SF_SMALL)
    total = cohorts.new_users(acts, "month").agg(F.sum("new_users")).first()[0]
    assert total == acts.select("user_id").distinct().count()


def test_weekly_audience_statuses_add_up(spark):
    acts = fixtures.order_activity(spark, SF_SMALL)
    w = cohorts.weekly_audience(acts)
    active = (acts.select("user_id", F.to_date(F.date_trunc("week", "time")).alias("week"))
              .distinct().groupBy("week").count())
    parts = (w.filter("status != 'gone'").groupBy("week").agg(F.sum("users").alias("s"))
             .join(active, "week"))
    assert parts.filter("s != count").count() == 0
    assert parts.count() == active.count()


def test_campaign_retention_shares(spark):
    c = cohorts.campaign_retention(fixtures.feed_actions(spark, SF_SMALL), "2024-01-02", (1, 14))
    for r in c.collect():
        assert 0 <= r.active_users <= r.cohort_size
        assert abs(r.share - r.active_users / r.cohort_size) < 1e-12


def test_incremental_first_seen_equals_full_retention(spark):
    import datetime as dt
    import tempfile

    feed = fixtures.feed_actions(spark, SF_SMALL)
    path = tempfile.mkdtemp(prefix="feedlens-first-seen-") + "/first_seen"
    start = dt.date(2024, 1, 1)
    for i in (2, 1, 0, *range(3, 30), 3):     # out of order, one day twice
        fs = cohorts.update_first_seen(spark, feed, start + dt.timedelta(days=i), path)
    assert fs.count() == feed.select("user_id").distinct().count()
    inc = sorted(map(tuple, cohorts.retention_from_first_seen(feed, fs).collect()))
    full = sorted(map(tuple, cohorts.retention(feed, "day").collect()))
    assert inc == full
    # a day that is empty on re-run loses its rows
    day = fs.agg(F.min("first_day")).first()[0]
    left = cohorts.update_first_seen(spark, feed.filter("false"), day, path)
    assert left.filter(F.col("first_day") == F.lit(day)).count() == 0


def test_campaign_horizon_without_survivors_has_a_row(spark):
    import datetime as dt
    rows = [(u, dt.datetime(2024, 1, 5 + k, 9), "ads") for u in range(4) for k in (0, 1)] + [(9, dt.datetime(2024, 1, 2), "ads"), (9, dt.datetime(2024, 1, 5), "ads")]
    a = spark.createDataFrame(rows, "user_id long, time timestamp_ntz, source string")
    got = {r.day_n: (r.cohort_size, r.active_users, r.share) for r in cohorts.campaign_retention(a, "2024-01-05", (1, 14)).collect()}
    assert got == {1: (4, 4, 1.0), 14: (4, 0, 0.0)}
    assert cohorts.campaign_retention(a, "2024-02-05", (1,)).collect() == []


def test_city_without_users_on_a_day_is_a_drop(spark):
    import datetime as dt
    rows = [(u, dt.datetime(2024, 1, 1 + k, 9), c) for u in range(10) for k in range(9) for c in ("x", "y", None) if c != "x" or k != 7]
    f = spark.createDataFrame(rows, "user_id long, time timestamp_ntz, city string")
    got = {(r.city, r.dt.day): (r.users, r.is_drop) for r in cohorts.city_activity_drop(f).collect()}
    assert len(got) == 27 and got["x", 8] == (0, True) and got["y", 8] == (10, False) and got[None, 9] == (10, False)

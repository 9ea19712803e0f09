"""Hand-made cases (FIXTURES.md section 4) on tiny frames."""
import datetime as dt

from pyspark.sql import functions as F

from feedlens.operators import experiments, metrics, slices, users
from feedlens.plans import reports
from feedlens.sources import fixtures
from feedlens.sources.schema import FEED_ACTIONS, MESSAGE_ACTIONS

AS_OF = dt.date(2024, 1, 31)
Y = dt.datetime(2024, 1, 30, 12, 0)


def feed(spark, rows):
    """rows: (user_id, time, action, os, exp_group) + defaults for the rest."""
    full = [(u, t, a, 1, os, u % 2, 20, "ads" if u % 2 else "organic", "c", g)
            for u, t, a, os, g in rows]
    return spark.createDataFrame(full, FEED_ACTIONS)


def msgs(spark, rows):
    """rows: (sender, receiver, time, os)."""
    full = [(s, r, t, os, None if s is None else s % 2, 30, "ads") for s, r, t, os in rows]
    return spark.createDataFrame(full, MESSAGE_ACTIONS)


def test_user_without_views_has_null_ctr_and_leaves_the_test(spark):
    t = dt.datetime(2024, 1, 9, 10)
    f = feed(spark, [(1, t, "like", "iOS", 2)] +
             [(u, t, a, "iOS", g) for u, g in ((2, 2), (3, 2), (4, 3), (5, 3), (6, 3))
              for a in ("view", "view", "like")])
    u = experiments.user_ctr(f, "2024-01-08", "2024-01-14", [2, 3])
    assert u.filter("user_id = 1").first().ctr is None
    w = experiments.welch_test(u, "ctr", 2, 3).first()
    assert (w.n_a, w.n_b) == (2, 3)
    check = experiments.aa_split_check(spark, f, "2024-01-08", "2024-01-14", 2, 3,
                                       sims=20, sample_size=5).first()
    assert check.n_no_views == 1 and check.n_a == 3 and check.n_b == 3


def test_sender_only_and_receiver_only(spark):
    m = msgs(spark, [(10, 11, Y, "iOS"), (11, 10, Y, "iOS"), (20, 30, Y, "iOS")])
    inner = {r.user_id for r in users.user_message_totals(m, AS_OF).collect()}
    full = {r.user_id for r in users.user_message_totals(m, AS_OF, how="full").collect()}
    assert inner == {10, 11}
    assert full == {10, 11, 20, 30}


def test_sender_with_two_os_values_gets_received_counts_twice(spark):
    m = msgs(spark, [(1, 2, Y, "iOS"), (1, 3, Y, "Android"), (2, 1, Y, "iOS"),
                     (3, 1, Y, "iOS")])
    rows = users.user_message_totals(m, AS_OF).filter("user_id = 1").collect()
    assert len(rows) == 2
    assert all(r.messages_received == 2 and r.users_received == 2 for r in rows)


def _full_report_days(spark, f, m):
    return {r.dt for r in reports.full_report(f, m, AS_OF).collect()}


def test_full_report_drops_days_like_inner_joins(spark):
    d1, d2, d3 = (dt.datetime(2024, 1, day, 9) for day in (27, 28, 29))
    f = feed(spark, [(1, d1, "view", "iOS", 0), (2, d1, "view", "iOS", 0),
                     (1, d2, "view", "iOS", 0), (2, d2, "view", "iOS", 0),
                     (1, d3, "view", "iOS", 0)])
    m = msgs(spark, [(1, 2, d1, "iOS"), (1, 2, d3, "iOS")])
    # d2: no messages that day -> dropped; d3: no feed-only user -> dropped
    assert _full_report_days(spark, f, m) == {d1.date()}


def test_previous_day_is_previous_existing_day_and_first_day_is_zero(spark):
    d1, d3 = dt.datetime(2024, 1, 27, 9), dt.datetime(2024, 1, 29, 9)
    f = feed(spark, [(1, d1, "view", "iOS", 0), (1, d3, "view", "iOS", 0),
                     (2, d3, "like", "iOS", 0)])
    rows = {r.dt: r for r in reports.main_metric_report(f, AS_OF).collect()}
    first, later = rows[d1.date()], rows[d3.date()]
    assert (first.prev_dau, first.dev_dau, first.prev_ctr) == (0, 1, 0.0)
    assert later.prev_dau == 1 and later.dev_dau == 1 and later.prev_views == 1


def test_as_of_day_dropped_later_day_kept(spark):
    f = feed(spark, [(1, dt.datetime(2024, 1, 31, 5), "view", "iOS", 0),
                     (1, dt.datetime(2024, 2, 1, 5), "view", "iOS", 0),
                     (1, dt.datetime(2024, 1, 30, 5), "view", "iOS", 0)])
    days = {r.dt for r in reports.main_metric_report(f, AS_OF).collect()}
    assert days == {dt.date(2024, 1, 30), dt.date(2024, 2, 1)}


def test_null_os_keeps_its_own_slice_row(spark):
    f = feed(spark, [(1, Y, "view", None, 0), (2, Y, "view", "iOS", 0)])
    m = msgs(spark, [(1, 2, Y, None)])
    s = slices.daily_slices(f, m, AS_OF, how="full").filter("dimensions = 'os'").collect()
    values = {r.dimensions_value for r in s}
    assert values == {None, "iOS"}


def test_null_in_sender_set_does_not_empty_the_anti_join(spark):
    f = feed(spark, [(1, Y, "view", "iOS", 0), (2, Y, "view", "iOS", 0)])
    m = msgs(spark, [(2, 1, Y, "iOS"), (None, 1, Y, "iOS")])
    only = reports.users_feed_only(f, m).collect()
    assert [(r.dt, r.feed_users) for r in only] == [(Y.date(), 1)]


def test_slices_sum_to_totals(spark):
    f = feed(spark, [(u, Y, a, "iOS" if u % 3 else "Android", 0)
                     for u in range(1, 9) for a in ("view", "like", "view")])
    m = msgs(spark, [(u, (u + 1) % 9, Y, "iOS") for u in range(1, 9)])
    s = slices.daily_slices(f, m, AS_OF)
    per_dim = s.groupBy("dimensions").agg(F.sum("views").alias("v"), F.sum("likes").alias("l"))
    totals = {(r.v, r.l) for r in per_dim.collect()}
    assert len(totals) == 1
    assert totals.pop() == (16, 8)


def test_feed_only_plus_both_equals_dau(spark):
    t = dt.datetime(2024, 1, 20, 9)
    f = feed(spark, [(u, t, "view", "iOS", 0) for u in range(10)])
    m = msgs(spark, [(u, 0, t, "iOS") for u in range(0, 10, 3)])
    only = {r.dt: r.feed_users for r in reports.users_feed_only(f, m).collect()}
    both = {r.dt: r.all_app_users for r in reports.users_both_services(f, m).collect()}
    dau = {r.dt: r.dau for r in metrics.dau_by_day(f).collect()}
    assert all(only[d] + both[d] == dau[d] for d in dau)


def test_key_metric_report_lookback_is_exact(spark):
    # the previous existing day may lie far before the window
    far, d1 = dt.datetime(2023, 12, 1, 9), dt.datetime(2024, 1, 26, 9)
    f = feed(spark, [(1, far, "view", "iOS", 0), (2, far, "view", "iOS", 0),
                     (1, d1, "view", "iOS", 0)])
    auto = {r.dt: r for r in reports.main_metric_report(f, AS_OF).collect()}
    assert set(auto) == {d1.date()} and auto[d1.date()].prev_dau == 2
    # the previous day is in the week before the window
    d0 = dt.datetime(2024, 1, 20, 9)
    g = feed(spark, [(1, far, "view", "iOS", 0), (1, d0, "view", "iOS", 0),
                     (2, d0, "like", "iOS", 0), (1, d1, "view", "iOS", 0)])
    auto = {r.dt: r for r in reports.main_metric_report(g, AS_OF).collect()}
    assert set(auto) == {d1.date()} and auto[d1.date()].prev_dau == 2
    # no day before the window
    only = reports.main_metric_report(feed(spark, [(1, d1, "view", "iOS", 0)]), AS_OF).collect()
    assert len(only) == 1 and only[0].prev_dau == 0


def test_every_event_is_a_feed_row_or_a_message(spark):
    d = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{d}/events.parquet").count()
    assert fixtures.feed_actions(spark, d).count() + fixtures.message_actions(spark, d).count() == n

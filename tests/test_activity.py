"""Activity bitmaps against plain Python and against the from-scratch jobs."""
import datetime as dt
import os
import random
import tempfile
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from feedlens.operators import activity, cohorts
from feedlens.sources import published

SCHEMA = "user_id bigint, time timestamp_ntz, source string"


def events(spark, rows):
    return spark.createDataFrame([(u, dt.datetime.combine(d, dt.time(h)), s) for u, d, h, s in rows], SCHEMA)


def invented(seed, n_users=60, span=400):
    """Users with few and many days over several blocks; two days are the edges
    of a block, some sources unknown."""
    rng = random.Random(seed)
    start = dt.date(2023, 11, 1)
    edge = activity.ORIGIN + dt.timedelta(days=activity.DAYS * 313)
    rows = []
    for u in range(n_users):
        for _ in range(rng.choice([1, 2, 5, 30])):
            d = start + dt.timedelta(days=min(rng.randrange(span), rng.randrange(span)))
            rows.append((u, d, rng.randrange(24), rng.choice(["ads", "organic", None])))
        if u % 5 == 0:
            rows += [(u, edge - dt.timedelta(days=k), 1, "ads") for k in (0, 1, 8)]
    rows += [(None, start, 0, "ads")]
    return rows


def loaded(spark, df, ranges):
    path = os.path.join(tempfile.mkdtemp(prefix="feedlens-activity-"), "state")
    for first, last in ranges:
        activity.update(spark, df, first, last, path)
    return path


def rows_of(df, *cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


@pytest.fixture(scope="module")
def case(spark):
    rows = invented(3)
    df = events(spark, rows)
    days = [d for _, d, _, _ in rows]
    lo, hi = min(days), max(days)
    cut = [lo + dt.timedelta(days=k) for k in (0, 40, 41, 200)]
    ranges = [(cut[3], hi), (cut[0], cut[1] - dt.timedelta(days=1)), (cut[2], cut[3] - dt.timedelta(days=1)), (cut[1], cut[1]),
              (cut[2], cut[2])]
    path = loaded(spark, df, ranges)
    return rows, df, path


def test_dashboards_equal_those_from_scratch(spark, case):
    rows, df, path = case
    state = activity.load(spark, path)
    cols = ["source", "cohort", "period_n", "active_users", "cohort_size", "share"]
    for grain in ("day", "week"):
        assert rows_of(activity.retention(state, grain), *cols) == rows_of(cohorts.retention(df, grain), *cols)
        new = ["period", "source", "new_users"]
        assert rows_of(activity.new_users(state, grain), *new) == rows_of(cohorts.new_users(df, grain), *new)
    week = ["week", "status", "users"]
    got = rows_of(activity.weekly_audience(state), *week)
    assert got == rows_of(cohorts.weekly_audience(df), *week)
    assert {s for _, s, _ in got} == {"new", "retained", "returned", "gone"}


def test_weekly_audience_against_plain_python(spark, case):
    rows, _, path = case
    weeks = defaultdict(set)
    for u, d, _, _ in rows:
        if u is not None:
            weeks[u].add(d - dt.timedelta(days=d.weekday()))
    last, step, want = max(w for v in weeks.values() for w in v), dt.timedelta(days=7), Counter()
    for v in weeks.values():
        for w in v:
            kind = "new" if w == min(v) else "retained" if w - step in v else "returned"
            want[w, kind] += 1
            if w + step not in v and w + step <= last:
                want[w + step, "gone"] += 1
    got = {(r.week, r.status): r.users for r in activity.weekly_audience(activity.load(spark, path)).collect()}
    assert got == dict(want)


@pytest.mark.parametrize("days", [1, 7, 63])
def test_rolling_users_against_plain_python(spark, case, days):
    rows, _, path = case
    seen = defaultdict(set)
    for u, d, _, _ in rows:
        if u is not None:
            seen[d].add(u)
    lo, hi, want = min(seen), max(seen), {}
    for k in range((hi - lo).days + 1):
        d = lo + dt.timedelta(days=k)
        users = set().union(*[seen[d - dt.timedelta(days=j)] for j in range(days) if d - dt.timedelta(days=j) in seen])
        if users:
            want[d] = len(users)
    got = {r.dt: r.users for r in activity.active_users(activity.load(spark, path), days).collect()}
    assert got == want


def test_a_corrected_day_replaces_what_it_said(spark):
    d = dt.date(2024, 1, 10)
    first = events(spark, [(1, d, 1, "ads"), (2, d, 1, "ads"), (1, d + dt.timedelta(days=1), 1, "organic")])
    path = loaded(spark, first, [(d, d + dt.timedelta(days=1))])
    activity.update(spark, events(spark, [(2, d, 5, "organic")]), d, d, path)       # user 1 leaves the day
    state = activity.load(spark, path)
    got = {r.user_id: (r.first, r.source) for r in activity.first_seen(state).collect()}
    assert got == {1: (d + dt.timedelta(days=1), "organic"), 2: (d, "organic")}
    activity.update(spark, events(spark, []), d, d, path)                            # nobody is left
    assert {r.user_id for r in activity.first_seen(activity.load(spark, path)).collect()} == {1}


def test_only_touched_blocks_are_read(spark, case):
    _, _, path = case
    before = published.parts(spark, path)
    assert len(before) > 3
    d = activity.ORIGIN + dt.timedelta(days=activity.DAYS * int(max(before)))
    activity.update(spark, events(spark, []), d, d, path)
    after = published.parts(spark, path)
    assert {k for k in before if before[k] != after.get(k)} == {max(before)}
    part = activity.load(spark, path, d, d)
    assert {r.block for r in part.select("block").distinct().collect()} <= {int(max(before))}


def test_empty_state(spark):
    none = activity.load(spark, tempfile.mkdtemp() + "/none")
    assert activity.retention(none).collect() == [] and activity.weekly_audience(none).collect() == []
    assert activity.active_users(none).collect() == []

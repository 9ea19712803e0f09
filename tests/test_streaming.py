"""Streaming window metrics equal the batch twin on windows the watermark
has closed."""
import os
import tempfile

from pyspark.sql import functions as F

from feedlens.sources import fixtures
from feedlens.streaming import realtime

from .conftest import SF_SMALL


def _as_stream_files(df, n_files):
    """Write the rows as Parquet files in event-time order (one write per
    time slice, so file modification times follow event time as in a live
    feed)."""
    path = os.path.join(tempfile.mkdtemp(prefix="feedlens-stream-"), "in")
    days = 30 // n_files + 1
    for i in range(n_files):
        lo = F.lit(f"2024-01-01 00:00:00").cast("timestamp_ntz") + F.expr(f"INTERVAL {i * days} DAYS")
        hi = lo + F.expr(f"INTERVAL {days} DAYS")
        part = df.filter((F.col("time") >= lo) & (F.col("time") < hi))
        (part.withColumn("time", F.col("time").cast("timestamp"))
             .coalesce(1).write.mode("append").parquet(path))
    return path


def _rows(df):
    return sorted((r.window_start.replace(tzinfo=None), tuple(r)[2:]) for r in df.collect())


def test_feed_stream_equals_batch_on_closed_windows(spark):
    feed = fixtures.feed_actions(spark, SF_SMALL)
    src = _as_stream_files(feed, 6)
    q = realtime.start(realtime.realtime_feed(realtime.read_feed_stream(spark, src, 1)),
                       "rt_feed_test", in_memory=True, checkpoint=os.path.join(src, "..", "ckpt"))
    q.awaitTermination(300)
    streamed = spark.table("rt_feed_test")
    batch = realtime.feed_window_metrics(feed)
    s = _rows(streamed)
    assert len(s) > 0
    last = max(w for w, _ in s)
    b = [(w.replace(tzinfo=None), v) for w, v in _rows(batch) if w <= last]
    assert s == b


def test_message_stream_equals_batch_on_closed_windows(spark):
    msgs = fixtures.message_actions(spark, SF_SMALL)
    src = _as_stream_files(msgs, 4)
    q = realtime.start(realtime.realtime_messages(realtime.read_message_stream(spark, src, 1)),
                       "rt_msgs_test", in_memory=True, checkpoint=os.path.join(src, "..", "ckpt"))
    q.awaitTermination(300)
    s = _rows(spark.table("rt_msgs_test"))
    assert len(s) > 0
    last = max(w for w, _ in s)
    b = [(w, v) for w, v in _rows(realtime.message_window_metrics(msgs)) if w <= last]
    assert s == b


def test_approximate_users_stream(spark):
    feed = fixtures.feed_actions(spark, SF_SMALL)
    src = _as_stream_files(feed, 3)
    q = realtime.start(realtime.realtime_feed(realtime.read_feed_stream(spark, src, 1),
                                              exact=False),
                       "rt_feed_approx", in_memory=True, checkpoint=os.path.join(src, "..", "ckpt"))
    q.awaitTermination(300)
    approx = {r.window_start.replace(tzinfo=None): r for r in spark.table("rt_feed_approx").collect()}
    exact = {r.window_start: r for r in realtime.feed_window_metrics(feed).collect()}
    assert approx
    for w, r in approx.items():
        e = exact[w]
        assert (r.views, r.likes) == (e.views, e.likes)
        assert abs(r.active_users - e.active_users) <= max(1, 0.05 * e.active_users)


def test_no_memory_sink_unless_asked_for(spark):
    import pytest

    with pytest.raises(ValueError, match="sink_path"):
        realtime.start(spark.readStream.format("rate").load(), "nowhere")


def _live(spark, path, kind):
    out = realtime.live_windows(spark, path, kind)
    return sorted((r.window_start.replace(tzinfo=None), tuple(r)[2:]) for r in out.collect())


def test_open_windows_show_and_end_as_the_batch_says(spark):
    """After the first file its windows are stored although no watermark has
    closed them; in the end every window, the last ones included, is exact."""
    for kind, events, twin, stream in (
            ("feed", fixtures.feed_actions, realtime.feed_window_metrics, realtime.read_feed_stream),
            ("messages", fixtures.message_actions, realtime.message_window_metrics, realtime.read_message_stream)):
        rows = events(spark, SF_SMALL)
        base = tempfile.mkdtemp(prefix="feedlens-live-")
        src, out = os.path.join(base, "in"), os.path.join(base, "out")
        lo = rows.agg(F.min("time")).first()[0]
        cut = F.lit(lo).cast("timestamp_ntz") + F.expr("INTERVAL 2 MINUTES")      # inside the first window
        put = lambda part: (part.withColumn("time", F.col("time").cast("timestamp"))
                            .coalesce(1).write.mode("append").parquet(src))
        put(rows.filter(F.col("time") < cut))
        realtime.start_live(stream(spark, src), kind, out, once=True).awaitTermination(300)
        early = _live(spark, out, kind)
        assert len(early) >= 1 and early == _rows(twin(rows.filter(F.col("time") < cut)))
        put(rows.filter(F.col("time") >= cut))
        realtime.start_live(stream(spark, src), kind, out, once=True).awaitTermination(300)
        assert _live(spark, out, kind) == _rows(twin(rows))
        realtime.start_live(stream(spark, src), kind, out, once=True).awaitTermination(300)   # nothing new
        assert _live(spark, out, kind) == _rows(twin(rows))
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_the_same_batch_twice_leaves_the_same_rows(spark):
    rows = fixtures.feed_actions(spark, SF_SMALL).withColumn("time", F.col("time").cast("timestamp"))
    path = os.path.join(tempfile.mkdtemp(prefix="feedlens-upsert-"), "t")
    changed = realtime.window_buckets(rows, "feed", buckets=3)
    realtime.upsert_windows(changed, path, "feed")
    once = _live(spark, path, "feed")
    realtime.upsert_windows(changed.filter("bucket = 1"), path, "feed")
    realtime.upsert_windows(changed.limit(0), path, "feed")
    assert _live(spark, path, "feed") == once == _rows(realtime.feed_window_metrics(rows))

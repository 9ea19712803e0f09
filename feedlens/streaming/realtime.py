"""Live window metrics of the feed and the messenger.

The same functions run on a batch DataFrame (the "twin" used by the checks)
and on a streaming one.  Exact distinct users per window come from two
chained aggregations: ``groupBy(window, user_id)`` then ``groupBy(window of
window_time)``; in a stream both are stateful and run in append mode with
the watermark propagated between them, so no approximate sketch is needed.

Open windows: ``start_live`` runs in update mode.  Users are dealt into buckets
by a hash, so a window's state is many small keys instead of one; each batch
gives the new totals of the (window, bucket) keys it changed, and they replace
the stored ones in a published table, so ``live_windows`` shows a window from its
first event on and its final numbers in the end.  State lives in RocksDB.

Streams read Parquet files with a fixed schema (TIMESTAMP event time, since
watermarks refuse TIMESTAMP_NTZ); the checkpoint goes under the session's
shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.metrics import ctr_percent
from ..session import shared_path
from ..sources import published
from ..sources.schema import FEED_ACTIONS_STREAM, MESSAGE_ACTIONS_STREAM

WINDOW = "5 minutes"
WATERMARK = "10 minutes"


def _per_user_then_window(df: DataFrame, window: str, per_user: list, totals: list,
                          users_alias: str) -> DataFrame:
    u = df.groupBy(F.window("time", window).alias("w"), "user_id").agg(*per_user)
    g = u.groupBy(F.window(F.window_time("w"), window).alias("w")).agg(
        F.count("user_id").alias(users_alias), *totals)
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *[c for c in g.columns if c != "w"])


def _one_pass(df: DataFrame, window: str, totals: list, users_alias: str,
              rsd: float) -> DataFrame:
    g = df.groupBy(F.window("time", window).alias("w")).agg(
        F.approx_count_distinct("user_id", rsd).alias(users_alias), *totals)
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *[c for c in g.columns if c != "w"])


def feed_window_metrics(feed: DataFrame, window: str = WINDOW, exact: bool = True,
                        rsd: float = 0.01) -> DataFrame:
    """window_start, window_end, active_users, views, likes, ctr per tumbling
    window.  ``exact=False`` counts users with ``approx_count_distinct``
    (HyperLogLog++, relative error ``rsd``) in one aggregation: less state
    per window when the user count per window is very large."""
    if not exact:
        out = _one_pass(feed, window,
                        [F.count_if(F.col("action") == "view").alias("views"),
                         F.count_if(F.col("action") == "like").alias("likes")],
                        "active_users", rsd)
        return out.withColumn("ctr", ctr_percent())
    out = _per_user_then_window(
        feed, window,
        [F.count_if(F.col("action") == "view").alias("v"),
         F.count_if(F.col("action") == "like").alias("l")],
        [F.sum("v").alias("views"), F.sum("l").alias("likes")],
        "active_users")
    return out.withColumn("ctr", ctr_percent())


def message_window_metrics(messages: DataFrame, window: str = WINDOW, exact: bool = True,
                           rsd: float = 0.01) -> DataFrame:
    """window_start, window_end, active_senders, messages per window
    (``exact=False``: approximate senders, as in ``feed_window_metrics``)."""
    if not exact:
        return _one_pass(messages, window, [F.count("reciever_id").alias("messages")],
                         "active_senders", rsd)
    return _per_user_then_window(
        messages, window,
        [F.count("reciever_id").alias("m")],
        [F.sum("m").alias("messages")],
        "active_senders")


def read_feed_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(FEED_ACTIONS_STREAM)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def read_message_stream(spark: SparkSession, path: str,
                        max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(MESSAGE_ACTIONS_STREAM)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def realtime_feed(stream: DataFrame, window: str = WINDOW, watermark: str = WATERMARK,
                  exact: bool = True) -> DataFrame:
    """Streaming feed metrics; a window is emitted once the watermark
    passes its end."""
    return feed_window_metrics(stream.withWatermark("time", watermark), window, exact)


def realtime_messages(stream: DataFrame, window: str = WINDOW, watermark: str = WATERMARK,
                      exact: bool = True) -> DataFrame:
    return message_window_metrics(stream.withWatermark("time", watermark), window, exact)


#: Parts of a window's users, each a key of the state.
BUCKETS = 32
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _totals(kind: str) -> list:
    if kind == "feed":
        return [F.count_if(F.col("action") == "view").alias("views"), F.count_if(F.col("action") == "like").alias("likes")]
    return [F.count("reciever_id").alias("messages")]


def window_buckets(events: DataFrame, kind: str, window: str = WINDOW, buckets: int = BUCKETS) -> DataFrame:
    """window_start, window_end, bucket, users and totals: exact distinct users of
    one bucket of a window (``kind``: 'feed' or 'messages').  A user is in one
    bucket, so buckets add up.  Works on batch and streaming events; in update
    mode a stream gives the keys that changed."""
    bucket = F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int")
    g = events.groupBy(F.window("time", window).alias("w"), bucket.alias("bucket")).agg(
        F.size(F.collect_set("user_id")).cast("bigint").alias("users"), *_totals(kind))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *[c for c in g.columns if c != "w"])


def _live_schema(kind: str) -> str:
    totals = ("views", "likes") if kind == "feed" else ("messages",)
    return ("window_start timestamp, window_end timestamp, bucket int, users bigint, "
            + ", ".join(f"{c} bigint" for c in totals))


def _day() -> Column:
    return F.date_format("window_start", "yyyy-MM-dd")


def upsert_windows(changed: DataFrame, path: str, kind: str) -> None:
    """Replace the stored totals of the keys in ``changed``; only the days they
    fall into are rewritten.  The same batch again leaves the same rows."""
    spark = changed.sparkSession
    changed = changed.persist()
    try:
        days = [r[0] for r in changed.select(_day().alias("d")).distinct().collect()]   # days touched by one batch
        if not days:
            return
        keys = ["window_start", "bucket"]

        def merged(old: DataFrame) -> DataFrame:
            return old.join(changed.select(*keys), keys, "left_anti").select(changed.columns).unionByName(changed)

        published.rewrite(spark, path, _live_schema(kind), _day(), days, merged)
    finally:
        changed.unpersist()


def live_windows(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The windows stored so far, open ones included: the columns of
    ``feed_window_metrics`` or ``message_window_metrics``."""
    rows = published.read(spark, path, _live_schema(kind))
    users = "active_users" if kind == "feed" else "active_senders"
    totals = [c for c in rows.columns if c not in ("window_start", "window_end", "bucket", "users")]
    out = rows.groupBy("window_start", "window_end").agg(
        F.sum("users").alias(users), *[F.sum(c).alias(c) for c in totals])
    return out.withColumn("ctr", ctr_percent()) if kind == "feed" else out


def start_live(stream: DataFrame, kind: str, path: str, once: bool = False, window: str = WINDOW,
               watermark: str = WATERMARK, buckets: int = BUCKETS, checkpoint: str | None = None) -> StreamingQuery:
    """Start a stream of live windows into the published table at ``path``.

    Update mode: a window is stored after the first batch that saw it and
    replaced by every later one; the watermark only bounds the state.  ``once``
    works through what has arrived and stops."""
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    changed = window_buckets(stream.withWatermark("time", watermark), kind, window, buckets)
    w = (changed.writeStream.outputMode("update")
         .option("checkpointLocation", checkpoint or f"{path}/checkpoint")
         .foreachBatch(lambda batch, _: upsert_windows(batch, path, kind)))
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime="1 minute")).start()


def start(df: DataFrame, name: str, sink_path: str | None = None,
          checkpoint: str | None = None, available_now: bool = True, in_memory: bool = False) -> StreamingQuery:
    """Start a metrics stream in append mode: closed windows as Parquet at
    ``sink_path`` (exactly-once with the checkpoint).  ``in_memory`` keeps them in
    a table ``name`` of the driver instead, for tests and small looks only."""
    if not sink_path and not in_memory:
        raise ValueError("name a sink_path, or ask for in_memory")
    spark = df.sparkSession
    ckpt = checkpoint or shared_path(spark, f"streams/{name}")
    w = df.writeStream.outputMode("append").option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    if sink_path:
        return w.format("parquet").option("path", sink_path).start()
    return w.format("memory").queryName(name).start()

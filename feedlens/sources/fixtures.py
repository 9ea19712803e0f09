"""Test inputs: the driver's tables mapped onto the two event tables.

The mapping is fixed by FIXTURES.md section 2 (the oracle SQL uses the same
text); it only shapes rows into the expected schema and does none of the
jobs' work.  The joins with ``nation`` and ``customer`` are left to the planner (AQE broadcasts a side when it is small,
otherwise it is a shuffle join on the customer key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schema import FEED_ACTIONS, MESSAGE_ACTIONS


# column types of the driver's test tables (read with a fixed schema: no
# footer inference on every plan)
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
}

# logical plans only (no data): building the same fixture plan again for
# every query of a session costs Py4J round-trips and nothing else
_PLANS: dict = {}


def _memo(kind: str, spark: SparkSession, sf_dir: str, build) -> DataFrame:
    try:
        app = spark.sparkContext.applicationId
    except Exception:            # Spark Connect: no context on the client
        app = getattr(spark, "session_id", None)
    key = (kind, id(spark), app, sf_dir)
    if key not in _PLANS:
        _PLANS[key] = build()
    return _PLANS[key]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _sender_attributes() -> list:
    uid = F.col("user_id")
    android = (uid % 4 >= 2) == (F.col("event_id") % 11 != 0)
    return [
        F.when(android, F.lit("Android")).otherwise(F.lit("iOS")).alias("os"),
        (uid % 2).cast("int").alias("gender"),
        (F.lit(15) + (uid * 7) % 50).cast("int").alias("age"),
        F.when(uid % 8 >= 4, F.lit("organic")).otherwise(F.lit("ads")).alias("source"),
    ]


def _is_message():
    return F.coalesce((F.col("event_type") == "purchase") & (F.col("user_id") % 3 != 0), F.lit(False))


def _props_number():
    return F.regexp_extract(F.col("props"), "[0-9]+", 0).try_cast("bigint")


def feed_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``feed_actions`` rows: every event that is no message.  A view stays a
    view, a click stands for a like, any other type keeps its name."""
    return _memo("feed", spark, sf_dir, lambda: _feed_actions(spark, sf_dir))


def message_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``message_actions`` rows: purchases of two thirds of the users (the
    other purchases are feed rows, so no event is lost).

    The receiver id uses ``max(user_id) + 1`` over all events, a scalar
    subquery (one value, computed by its own aggregate)."""
    return _memo("messages", spark, sf_dir, lambda: _message_actions(spark, sf_dir))


def order_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-run activity log (FIXTURES.md section 3): one row per order,
    ``user_id``, ``time`` and the user's acquisition ``source``."""
    return _memo("orders", spark, sf_dir, lambda: _order_activity(spark, sf_dir))


def _feed_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = (_table(spark, sf_dir, "events")
         .filter(~_is_message())
         .select("event_id", "user_id", "ts", "event_type", "props"))
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (e.join(c, e.user_id == c.c_custkey, "left")
          .join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left"))
    moved = F.when(F.col("event_id") % 97 == 0, 1).otherwise(0)   # some users change group
    out = j.select(
        F.col("user_id"),
        F.col("ts").alias("time"),
        F.when(F.col("event_type") == "click", F.lit("like")).otherwise(F.col("event_type")).alias("action"),
        _props_number().alias("post_id"),
        *_sender_attributes(),
        F.col("n_name").alias("city"),
        ((F.col("user_id") + moved) % 5).cast("int").alias("exp_group"),
    )
    return out.select([F.col(f.name).cast(f.dataType) for f in FEED_ACTIONS.fields])


def _message_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    modulus = events.agg(F.max("user_id") + 1).scalar()
    e = (events.filter(_is_message())
         .select("event_id", "user_id", "ts", "props"))
    out = e.select(
        F.col("user_id"),
        ((F.col("user_id") * 31 + _props_number()) % modulus).alias("reciever_id"),
        F.col("ts").alias("time"),
        *_sender_attributes(),
    )
    return out.select([F.col(f.name).cast(f.dataType) for f in MESSAGE_ACTIONS.fields])


def _order_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    return o.select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("time"),
        F.when(F.col("o_custkey") % 8 >= 4, F.lit("organic")).otherwise(F.lit("ads")).alias("source"),
    )

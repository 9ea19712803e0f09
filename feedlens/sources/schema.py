"""Explicit schemas of the two event tables and the slices output table."""

from pyspark.sql import types as T

FEED_ACTIONS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("time", T.TimestampNTZType()),
    T.StructField("action", T.StringType()),      # 'view' | 'like'
    T.StructField("post_id", T.LongType()),
    T.StructField("os", T.StringType()),          # 'iOS' | 'Android'
    T.StructField("gender", T.IntegerType()),     # 0 = male, else female
    T.StructField("age", T.IntegerType()),
    T.StructField("source", T.StringType()),      # 'ads' | 'organic'
    T.StructField("city", T.StringType()),
    T.StructField("exp_group", T.IntegerType()),  # 0..4
])

# all attributes describe the sender; the receiver column keeps its spelling
MESSAGE_ACTIONS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("reciever_id", T.LongType()),
    T.StructField("time", T.TimestampNTZType()),
    T.StructField("os", T.StringType()),
    T.StructField("gender", T.IntegerType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("source", T.StringType()),
])

SLICE_COUNTERS = ["views", "likes", "messages_received", "messages_sent",
                  "users_received", "users_sent"]

DAILY_SLICES = T.StructType(
    [T.StructField("event_date", T.DateType()),
     T.StructField("dimensions", T.StringType()),
     T.StructField("dimensions_value", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in SLICE_COUNTERS])

# streams need TIMESTAMP (watermarks refuse TIMESTAMP_NTZ)
FEED_ACTIONS_STREAM = T.StructType(
    [f if f.name != "time" else T.StructField("time", T.TimestampType())
     for f in FEED_ACTIONS.fields])
MESSAGE_ACTIONS_STREAM = T.StructType(
    [f if f.name != "time" else T.StructField("time", T.TimestampType())
     for f in MESSAGE_ACTIONS.fields])

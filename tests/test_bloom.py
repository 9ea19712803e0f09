"""The blocked Bloom filter: nothing lost, little left, and before the aggregate."""
from pyspark.sql import functions as F

from feedlens.operators import bloom
from feedlens.plans import reports
from feedlens.sources import fixtures

from .conftest import SF_MID


def test_no_key_is_lost_and_few_others_stay(spark):
    n = 20_000
    keys = spark.range(0, n).select((F.col("id") * 7 + 3).alias("user_id")).union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    rows = spark.range(0, 7 * n).select(F.col("id").alias("user_id"), F.lit("x").alias("p")).union(
        spark.sql("SELECT CAST(NULL AS BIGINT), 'y'"))
    blocks = bloom.blocks_for(n)
    assert blocks == -(-n * bloom.BITS_PER_KEY // bloom.BITS)
    filter_ = bloom.build(keys, "user_id", blocks)
    assert filter_.count() == blocks and filter_.filter(F.size("_bw") != 64).count() == 0
    kept = bloom.probe(rows, "user_id", filter_, blocks)
    assert kept.columns == ["user_id", "p"]
    assert kept.join(keys, "user_id", "left_semi").count() == n
    others = kept.join(keys, "user_id", "left_anti").count()
    assert others < 0.03 * 6 * n


def test_too_large_a_filter_is_not_broadcast(spark):
    rows = spark.range(10).select(F.col("id").alias("user_id"))
    assert bloom.prefilter(rows, rows, "user_id", 10 ** 9) is rows
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert bloom.prefilter(rows, rows, "user_id", 10) is rows
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_the_filter_thins_the_feed_before_its_aggregate(spark):
    feed = fixtures.feed_actions(spark, SF_MID)
    some = feed.select("user_id").filter("user_id % 10 = 3").distinct()
    df = reports.users_both_services(feed, None, some, some.count())
    want = reports.users_both_services(feed, some)
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, want.collect()))
    plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda word: next(i for i, line in enumerate(plan) if word in line)
    assert depth("getbit") > depth("Aggregate [dt")          # further down the tree: nearer the scan

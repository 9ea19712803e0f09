"""Distributed resampling: dense index, seeded draws, calibration."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from feedlens.functions.sampling import hash_bucket, indexed_members
from feedlens.operators import experiments
from feedlens.sources import fixtures

from .conftest import SF_MID


def test_index_is_dense_and_equals_a_global_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7).alias("user_id"))
    idx, sizes = indexed_members(df, "g", "user_id", buckets=16)
    ref = df.withColumn("b", hash_bucket("user_id", 16)).withColumn(
        "ref", F.row_number().over(Window.partitionBy("g").orderBy("b", "user_id")) - 1)
    joined = idx.join(ref, ["g", "user_id"])
    assert joined.filter(F.col("idx") != F.col("ref")).count() == 0
    assert joined.count() == 5000
    assert {(r.g, r.n) for r in sizes.collect()} == {(0, 1667), (1, 1667), (2, 1666)}


def test_resample_is_seeded_and_sized(spark):
    users = experiments.user_ctr(fixtures.feed_actions(spark, SF_MID), "2024-01-08",
                                 "2024-01-14", [2, 3])
    a = experiments.aa_resample(spark, users, 2, 3, sims=50, sample_size=40, seed=7)
    b = experiments.aa_resample(spark, users, 2, 3, sims=50, sample_size=40, seed=7)
    c = experiments.aa_resample(spark, users, 2, 3, sims=50, sample_size=40, seed=8)
    ra, rb, rc = (sorted(map(tuple, x.collect())) for x in (a, b, c))
    assert ra == rb and ra != rc
    assert len(ra) == 50 and all(r[1] == 40 and r[2] == 40 for r in ra)


def test_aa_false_positive_share_is_near_alpha(spark):
    # both arms from one distribution (many members): about 5 % of the
    # resampled tests reject at 0.05 and p is roughly uniform
    # both arms hold the same multiset of values (pairs 2k, 2k+1 share one)
    members = spark.range(0, 20000).select(
        (F.col("id") % 2 + 2).cast("int").alias("exp_group"),
        F.col("id").alias("user_id"),
        (F.abs(F.xxhash64(F.expr("id div 2"))) % 1000 / 1000.0).alias("ctr"))
    sims = experiments.aa_resample(spark, members, 2, 3, sims=2000, sample_size=200, seed=1)
    share = experiments.false_positive_rate(sims).first().share_pct
    assert 3.0 <= share <= 7.0
    hist = {r.bin: r.n for r in experiments.pvalue_histogram(sims, 10).collect()}
    assert sum(hist.values()) == 2000
    assert all(120 <= hist.get(b, 0) <= 280 for b in range(1, 11))


def test_without_replacement_gives_distinct_users(spark):
    members = spark.range(0, 2400).select(
        (F.col("id") % 2 + 2).cast("int").alias("exp_group"),
        F.col("id").alias("user_id"),
        (F.col("id") * 1.0).alias("ctr"))          # value identifies the user
    from feedlens.functions.sampling import resample_without_replacement
    rows = resample_without_replacement(spark, members, "exp_group", "ctr", [2, 3],
                                        sims=30, sample_size=1000, seed=5)
    per = rows.groupBy("sim", "exp_group").agg(F.count("*").alias("n"),
                                              F.count_distinct("ctr").alias("d"))
    got = per.collect()
    assert len(got) == 60
    assert all(r.n == 1000 and r.d == 1000 for r in got)
    # arm membership respected
    assert rows.filter((F.col("ctr") % 2 + 2).cast("int") != F.col("exp_group")).count() == 0


def test_without_replacement_calibration(spark):
    # identical arm populations; sampling 10 % without replacement shrinks
    # the true spread of t by sqrt(0.9), so slightly fewer than 5 % reject
    members = spark.range(0, 6000).select(
        (F.col("id") % 2 + 2).cast("int").alias("exp_group"),
        F.col("id").alias("user_id"),
        (F.abs(F.xxhash64(F.expr("id div 2"))) % 1000 / 1000.0).alias("ctr"))
    sims = experiments.aa_resample(spark, members, 2, 3, sims=600, sample_size=300, seed=3,
                                   replace=False)
    assert sims.count() == 600
    share = experiments.false_positive_rate(sims).first().share_pct
    assert 1.0 <= share <= 7.5


def test_without_replacement_takes_all_of_a_small_arm(spark):
    members = spark.range(0, 40).select(
        F.when(F.col("id") < 5, 2).otherwise(3).cast("int").alias("exp_group"),
        F.col("id").alias("user_id"), (F.col("id") * 1.0).alias("ctr"))
    from feedlens.functions.sampling import resample_without_replacement
    got = resample_without_replacement(spark, members, "exp_group", "ctr", [2, 3, 4], sims=20, sample_size=12, seed=1)
    per = {(r.sim, r.exp_group): sorted(r.v) for r in
           got.groupBy("sim", "exp_group").agg(F.collect_list("ctr").alias("v")).collect()}
    assert len(per) == 40                       # nothing of the empty arm
    assert all(v == [0.0, 1.0, 2.0, 3.0, 4.0] if g == 2 else len(set(v)) == 12 for (_, g), v in per.items())
    assert len({tuple(v) for (_, g), v in per.items() if g == 3}) > 15


def test_permutation_is_a_permutation_and_even(spark):
    """Every position has its own image for any n and key; over the keys each image
    is about equally likely, also in pairs."""
    from feedlens.functions.sampling import with_permuted_index

    n, keys = 23, 4000
    df = spark.range(0, n * keys).select((F.col("id") % n).alias("d"), F.expr(f"id div {n}").alias("s"),
                                         F.lit(n).cast("bigint").alias("n"))
    out = with_permuted_index(df, 7, ["s"], "d")
    assert out.groupBy("s").agg(F.count_distinct("idx").alias("k"), F.min("idx").alias("lo"), F.max("idx").alias("hi")) \
        .filter((F.col("k") != n) | (F.col("lo") != 0) | (F.col("hi") != n - 1)).count() == 0
    first = [r["count"] for r in out.filter("d = 0").groupBy("idx").count().collect()]
    assert len(first) == n and max(first) < 1.35 * keys / n and min(first) > 0.65 * keys / n
    pairs = out.filter("d < 2").groupBy("s").agg(F.max(F.when(F.col("d") == 0, F.col("idx"))).alias("a"),
                                                 F.max(F.when(F.col("d") == 1, F.col("idx"))).alias("b"))
    gaps = [r["count"] for r in pairs.groupBy(((F.col("b") - F.col("a") + n) % n).alias("g")).count().collect()]
    assert len(gaps) == n - 1 and max(gaps) < 1.4 * keys / (n - 1) and min(gaps) > 0.6 * keys / (n - 1)

"""A/A and A/B experiment analysis.

Per-user metrics stay in Spark; both arms of a test come from one
aggregate with conditional columns; the Welch test is column arithmetic on
that one row (see ``functions.stats``).  The A/A resampling loop of the
original (10,000 iterations in one thread) is one distributed join and one
``groupBy(sim)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import time_in_days
from ..functions.sampling import (DEFAULT_BUCKETS, resample_with_replacement,
                                  resample_without_replacement)
from ..functions.stats import equal_width_bin, with_welch
from ..session import materialize

ALPHA = 0.05


#: Simulated tests whose p-values one task computes.
SIMS_PER_TASK = 200


def user_ctr(feed: DataFrame, first, last, groups) -> DataFrame:
    """exp_group, user_id, likes, views, ctr = likes / views (NULL without
    views) over the inclusive day range, for the given groups."""
    return (feed.filter(time_in_days(first, last) & F.col("exp_group").isin(*groups))
            .groupBy("exp_group", "user_id")
            .agg(F.count_if(F.col("action") == "like").alias("likes"),
                 F.count_if(F.col("action") == "view").alias("views"))
            .withColumn("ctr", F.try_divide(F.col("likes"), F.col("views"))))


def _arm(metric: str, group_col: str, g) -> dict[str, Column]:
    v = F.when(F.col(group_col) == g, F.col(metric))
    return {"n": F.count(v), "mean": F.avg(v), "var": F.var_samp(v)}


def welch_test(users: DataFrame, metric: str, group_a, group_b, alpha: float = ALPHA,
               group_col: str = "exp_group") -> DataFrame:
    """One row: metric, group_a, group_b, n/mean/var per arm, t, df, p,
    reject (p < alpha), log10_p.  NULL metric values leave the test."""
    a, b = _arm(metric, group_col, group_a), _arm(metric, group_col, group_b)
    s = users.agg(*[c.alias(f"{k}_a") for k, c in a.items()],
                  *[c.alias(f"{k}_b") for k, c in b.items()])
    return with_welch(s).select(
        F.lit(metric).alias("metric"), F.lit(group_a).alias("group_a"),
        F.lit(group_b).alias("group_b"),
        "n_a", "n_b", "mean_a", "mean_b", "var_a", "var_b", "t", "df", "p",
        (F.col("p") < alpha).alias("reject"), "log10_p")


def welch_tests(tagged: DataFrame, metric: str, alpha: float = ALPHA,
                group_col: str = "exp_group") -> DataFrame:
    """Several Welch tests at once: ``tagged`` holds user rows with columns
    ``test``, ``group_a`` and ``group_b`` (the arms of that test).  One
    ``groupBy(test)`` with arm-conditional aggregates and one p-value
    projection serve every test.  Columns as ``welch_test`` plus ``test``."""
    g = F.col(group_col)
    v = F.col(metric)
    in_a, in_b = g == F.col("group_a"), g == F.col("group_b")
    s = tagged.groupBy("test", "group_a", "group_b").agg(
        F.count(F.when(in_a, v)).alias("n_a"), F.avg(F.when(in_a, v)).alias("mean_a"),
        F.var_samp(F.when(in_a, v)).alias("var_a"),
        F.count(F.when(in_b, v)).alias("n_b"), F.avg(F.when(in_b, v)).alias("mean_b"),
        F.var_samp(F.when(in_b, v)).alias("var_b"))
    return with_welch(s).select(
        "test", F.lit(metric).alias("metric"), "group_a", "group_b",
        "n_a", "n_b", "mean_a", "mean_b", "var_a", "var_b", "t", "df", "p",
        (F.col("p") < alpha).alias("reject"))


def tag_test(users: DataFrame, test: str, group_a, group_b,
             group_col: str = "exp_group") -> DataFrame:
    """Rows of one test's two arms, labelled for ``welch_tests``."""
    return users.filter(F.col(group_col).isin(group_a, group_b)).select(
        F.lit(test).alias("test"), F.lit(group_a).alias("group_a"),
        F.lit(group_b).alias("group_b"), "*")


def control_ctr(users: DataFrame, control, group_col: str = "exp_group") -> DataFrame:
    """One row: group-level CTR of the control, sum(likes) / sum(views)."""
    c = users.filter(F.col(group_col) == control)
    return c.agg(F.lit(control).alias("control_group"),
                 F.sum("likes").alias("likes"), F.sum("views").alias("views")) \
        .withColumn("control_ctr", F.try_divide(F.col("likes"), F.col("views")))


def linearized_likes(users: DataFrame, control, group_col: str = "exp_group") -> DataFrame:
    """Adds ``linearized_likes = likes - CTR_control * views`` to every user;
    the control CTR is a scalar subquery (one value)."""
    ctr_c = control_ctr(users, control, group_col).select("control_ctr").scalar()
    return users.withColumn("linearized_likes", F.col("likes") - ctr_c * F.col("views"))


def _pair_moments(users: DataFrame, keys: list[str], group_col: str = "exp_group") -> DataFrame:
    """One row per ``keys`` (which hold group_a and group_b) with the moments
    of likes, views and CTR in both arms: one aggregate, no second look at the
    users."""
    aggs = []
    for arm in "ab":
        here = F.col(group_col) == F.col(f"group_{arm}")
        likes, views = F.when(here, F.col("likes")), F.when(here, F.col("views"))
        ctr = F.when(here, F.col("ctr"))
        for name, c in {"n": F.count(likes), "l": F.avg(likes), "v": F.avg(views), "ll": F.var_samp(likes),
                        "vv": F.var_samp(views), "lv": F.covar_samp(likes, views), "sl": F.sum(likes),
                        "sv": F.sum(views), "cn": F.count(ctr), "cm": F.avg(ctr), "cv": F.var_samp(ctr)}.items():
            aggs.append(c.alias(f"{name}_{arm}"))
    return users.groupBy(*keys).agg(*aggs)


def _linearized_arms() -> list[Column]:
    """n, mean and variance of ``likes - r * views`` in both arms from their
    moments (r: control CTR, arm a): var = var(l) + r^2 var(v) - 2 r cov(l, v)."""
    r, out = F.try_divide(F.col("sl_a"), F.col("sv_a")), []
    for arm in "ab":
        c = lambda name: F.col(f"{name}_{arm}")  # noqa: E731, B023
        out += [F.when(r.isNotNull(), c("n")).otherwise(0).alias(f"n_{arm}"),
                (c("l") - r * c("v")).alias(f"mean_{arm}"),
                F.greatest(c("ll") + r * r * c("vv") - 2 * r * c("lv"), F.lit(0.0)).alias(f"var_{arm}")]
    return out


def _ctr_arms() -> list[Column]:
    return [F.col(f"{c}_{arm}").alias(f"{name}_{arm}") for arm in "ab" for c, name in
            (("cn", "n"), ("cm", "mean"), ("cv", "var"))]


def linearized_tests(tagged: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """``welch_tests`` on linearized likes of user rows tagged by ``tag_test``
    (group_a is the control), from per-arm moments alone."""
    keys = ["test", "group_a", "group_b"]
    m = _pair_moments(tagged, keys).select(*keys, *_linearized_arms())
    return with_welch(m).select(
        "test", F.lit("linearized_likes").alias("metric"), "group_a", "group_b",
        "n_a", "n_b", "mean_a", "mean_b", "var_a", "var_b", "t", "df", "p",
        (F.col("p") < alpha).alias("reject"))


def control_ratios(rows: DataFrame, weight: str | None = None) -> DataFrame:
    """``ratio_test, control_ctr``: CTR of each test's control (group_a) from tagged
    user rows, or from rows that stand for ``weight`` users each."""
    w = F.lit(1) if weight is None else F.col(weight)
    control = F.col("exp_group") == F.col("group_a")
    return rows.groupBy(F.col("test").alias("ratio_test")).agg(F.try_divide(
        F.sum(F.when(control, F.col("likes") * w)), F.sum(F.when(control, F.col("views") * w))).alias("control_ctr"))


def linearized(rows: DataFrame, weight: str | None = None) -> DataFrame:
    """Tagged user rows with ``linearized_likes`` by their test's control CTR: a join
    with one row per test, which reads the same shuffle as the rows."""
    r = control_ratios(rows, weight)
    return (rows.join(r, F.col("test") == F.col("ratio_test"))
            .withColumn("linearized_likes", F.col("likes") - F.col("control_ctr") * F.col("views"))
            .drop("ratio_test", "control_ctr"))


def linearized_histograms(tagged: DataFrame, bins: int) -> DataFrame:
    """test, exp_group, bin, bin_lo, bin_hi, n: histograms of linearized likes over
    each test's range.

    Users are first counted by their likes and views, which are few pairs; the
    control CTR, the range and the bins all come from these counts, so the events
    are read once whatever the number of tests."""
    pairs = (tagged.groupBy("test", "group_a", "exp_group", "likes", "views")
             .agg(F.count("*").alias("users")))
    rows = linearized(pairs, "users").filter(F.col("linearized_likes").isNotNull())
    x = F.col("linearized_likes")
    # the counts are used here too: both sides of the join plan the same shuffle
    seen = F.when(F.col("users") > 0, x)
    ranges = rows.groupBy(F.col("test").alias("range_test")).agg(
        F.min(seen).cast("double").alias("lo"), F.max(seen).cast("double").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    return (rows.join(ranges, F.col("test") == F.col("range_test"))
            .groupBy("test", "exp_group", equal_width_bin(x, F.col("lo"), F.col("hi"), bins).alias("bin"), "lo", "hi")
            .agg(F.sum("users").alias("n"))
            .select("test", "exp_group", "bin", (F.col("lo") + (F.col("bin") - 1) * width).alias("bin_lo"),
                    (F.col("lo") + F.col("bin") * width).alias("bin_hi"), "n"))


def ab_test(feed: DataFrame, first, last, control, treatment, alpha: float = ALPHA) -> DataFrame:
    """Welch tests of per-user CTR and of linearized likes for one pair of
    groups; ``linearized_more_sensitive`` tells whether the linearized
    metric gave the lower p-value (by ``log10_p``, which also tells apart what
    underflows).

    One scan and one aggregate over per-user rows: the linearized metric is a
    combination of likes and views, so its mean and variance follow from their
    moments and the control CTR (delta method for a fixed ratio), without a
    second pass over the users and without a job while the plan is built.  An
    empty week gives both rows with counts 0 and NULL statistics."""
    users = user_ctr(feed, first, last, [control, treatment])
    arms = users.select("*", F.lit(control).alias("group_a"), F.lit(treatment).alias("group_b"))
    # no grouping key: one row also without events
    m = _pair_moments(arms, [])
    both = F.array(F.struct(F.lit("ctr").alias("metric"), *_ctr_arms()),
                   F.struct(F.lit("linearized_likes").alias("metric"), *_linearized_arms()))
    tests = with_welch(m.select(F.inline(both)))
    p_of = lambda name: F.max(F.when(F.col("metric") == name, F.col("log10_p"))).over(
        Window.partitionBy())       # two rows
    return tests.select(
        "metric", F.lit(control).alias("group_a"), F.lit(treatment).alias("group_b"),
        "n_a", "n_b", "mean_a", "mean_b", "var_a", "var_b", "t", "df", "p",
        (F.col("p") < alpha).alias("reject"), "log10_p",
        (p_of("linearized_likes") < p_of("ctr")).alias("linearized_more_sensitive"))


def group_sizes(users: DataFrame, group_a, group_b, group_col: str = "exp_group") -> DataFrame:
    """One row: users per arm, their absolute difference and their sum."""
    s = users.agg(F.count_if(F.col(group_col) == group_a).alias("n_a"),
                  F.count_if(F.col(group_col) == group_b).alias("n_b"))
    return s.select(F.lit(group_a).alias("group_a"), F.lit(group_b).alias("group_b"),
                    "n_a", "n_b", F.abs(F.col("n_a") - F.col("n_b")).alias("abs_diff"),
                    (F.col("n_a") + F.col("n_b")).alias("total"))


def group_overlap(users: DataFrame, group_a, group_b, group_col: str = "exp_group") -> DataFrame:
    """One row: number of users present in both arms (set intersection),
    from one grouping by user with an arm flag each - one pass, no join."""
    g = F.col(group_col)
    per_user = (users.filter(g.isin(group_a, group_b)).groupBy("user_id")
                .agg(F.bool_or(g == group_a).alias("in_a"), F.bool_or(g == group_b).alias("in_b")))
    return per_user.agg(F.count_if(F.col("in_a") & F.col("in_b")).alias("n_overlap"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: rows, distinct rows, duplicated rows (rows - distinct).
    NULLs compare equal, as in a pandas ``duplicated()``.  One pass: group
    by all columns with a count, then sum the counts."""
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    return copies.agg(F.sum("_copies").alias("n_rows"), F.count("*").alias("n_distinct")) \
        .withColumn("n_duplicates", F.col("n_rows") - F.col("n_distinct"))


def histogram(df: DataFrame, value_col: str, bins: int, group_col: str | None = None,
              lo=None, hi=None) -> DataFrame:
    """Counts per equal-width bin (1..bins) of ``value_col``, per group.

    The rows are first counted per (group, value).  The range defaults to
    [min, max] of the column over all groups, taken from those counts in one
    subquery; it and the bins read the same shuffle, so the source is scanned
    once.  NULL values leave; only non-empty bins appear."""
    keys = [group_col] if group_col else []
    x = F.col("_x")
    values = (df.select(*keys, F.col(value_col).alias("_x"))
              .groupBy(*keys, "_x").agg(F.count("_x").alias("_n")))
    if lo is None or hi is None:
        # every column of the counts is used, so that both readers plan the same exchange
        seen = values.agg(F.struct(F.min(x).cast("double").alias("lo"), F.max(x).cast("double").alias("hi"),
                                   F.sum("_n").alias("n"), *[F.count(k).alias("k") for k in keys])).scalar()
    lo_c = F.lit(float(lo)) if lo is not None else seen["lo"]
    hi_c = F.lit(float(hi)) if hi is not None else seen["hi"]
    # the NULL value has count 0: no filter on the value, which the optimizer
    # would push below the count and evaluate twice
    g = (values.select(*keys, equal_width_bin(x, lo_c, hi_c, bins).alias("bin"), "_n")
         .groupBy(*keys, "bin").agg(F.sum("_n").alias("n")).filter("n > 0"))
    width = (hi_c - lo_c) / bins
    return g.select(*keys, "bin", (lo_c + (F.col("bin") - 1) * width).alias("bin_lo"),
                    (lo_c + F.col("bin") * width).alias("bin_hi"), "n")


def aa_resample(spark: SparkSession, users: DataFrame, group_a, group_b, sims: int = 10_000,
                sample_size: int = 500, seed: int = 42, metric: str = "ctr",
                buckets: int = DEFAULT_BUCKETS, replace: bool = True) -> DataFrame:
    """One row per simulated A/A test: ``sample_size`` users drawn from each
    arm (with replacement by default, as the original code does; ``replace=
    False`` for distinct users, as its text asks), Welch test on ``metric``.

    Columns: sim, n_a, n_b, mean_a, mean_b, var_a, var_b, t, df, p."""
    resample = resample_with_replacement if replace else resample_without_replacement
    draws = resample(spark, users, "exp_group", metric, [group_a, group_b],
                     sims, sample_size, seed, buckets)
    a, b = _arm(metric, "exp_group", group_a), _arm(metric, "exp_group", group_b)
    per_sim = draws.groupBy("sim").agg(*[c.alias(f"{k}_a") for k, c in a.items()],
                                       *[c.alias(f"{k}_b") for k, c in b.items()])
    # one row per simulation is tiny, so AQE would coalesce it into one task;
    # the p-value integral is CPU work per row: a task per SIMS_PER_TASK
    per_sim = per_sim.repartition(max(1, -(-sims // SIMS_PER_TASK)), "sim")
    return with_welch(per_sim).select("sim", "n_a", "n_b", "mean_a", "mean_b", "var_a",
                                      "var_b", "t", "df", "p")


def pvalue_histogram(sims: DataFrame, bins: int = 50) -> DataFrame:
    """Distribution of the simulated p-values over [0, 1]."""
    return histogram(sims, "p", bins, lo=0.0, hi=1.0)


def false_positive_rate(sims: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """One row: simulations, how many gave p <= alpha, and that share in %."""
    return sims.agg(F.count("p").alias("sims"),
                    F.count_if(F.col("p") <= alpha).alias("n_significant")) \
        .withColumn("share_pct", F.try_divide(F.col("n_significant"), F.col("sims")) * 100)


def aa_summary(users: DataFrame, sims: DataFrame, group_a, group_b,
               alpha: float = ALPHA) -> DataFrame:
    """One row from per-user CTRs and simulated tests: arm sizes, overlap,
    duplicates, users without views (NULL CTR, left out of the tests),
    Welch test on the full arms, share of simulated p <= alpha."""
    sizes = group_sizes(users, group_a, group_b)
    overlap = group_overlap(users, group_a, group_b).select("n_overlap").scalar()
    dups = duplicate_rows(users).select("n_duplicates").scalar()
    no_views = users.agg(F.count_if(F.col("ctr").isNull())).scalar()
    test = welch_test(users, "ctr", group_a, group_b, alpha) \
        .select(F.struct("t", "df", "p")).scalar()
    fpr = false_positive_rate(sims, alpha).select(F.struct("sims", "share_pct")).scalar()
    return sizes.select("group_a", "group_b", "n_a", "n_b", "abs_diff", "total",
                        overlap.alias("n_overlap"), dups.alias("n_duplicates"),
                        no_views.alias("n_no_views"), test["t"].alias("t"),
                        test["df"].alias("df"), test["p"].alias("p"),
                        fpr["sims"].alias("sims"), fpr["share_pct"].alias("share_pct"))


def aa_split_check(spark: SparkSession, feed: DataFrame, first, last, group_a, group_b,
                   sims: int = 10_000, sample_size: int = 500, seed: int = 42,
                   alpha: float = ALPHA, replace: bool = True) -> DataFrame:
    """The A/A notebook as one row (see ``aa_summary``), resampling
    included; the per-user table is materialized once (checkpoint) for the
    many checks that read it."""
    users = materialize(user_ctr(feed, first, last, [group_a, group_b]))
    simulated = aa_resample(spark, users, group_a, group_b, sims, sample_size, seed,
                            replace=replace)
    return aa_summary(users, simulated, group_a, group_b, alpha)

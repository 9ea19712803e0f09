"""Mixing sources to target weights by hash-threshold histograms.

Every document has a uniform hash.  A source whose target is q times its size
takes each document floor(q) times, and once more the documents whose hash
lies below the source's threshold.  The threshold is found without sorting:
words are summed by source and hash bucket, cumulated buckets show in which
bucket the budget ends, and only that bucket is split again, until it holds a
single hash.  Documents are then filtered by their hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import n_words, save, with_sums_before

#: The hash has 60 bits; each refinement fixes as many.
HASH_BITS, STEP_BITS = 60, 12
#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: No source is taken more than so often.
MOST = 3


def place(key: Column) -> Column:
    """Uniform 60-bit hash of a key (the first 15 hex digits of its md5)."""
    return F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size`` -> also ``target``: the sum of all sizes shared
    by weight, no source above ``MOST`` times its size.

    The capped shares are min(MOST * size, level * weight) for one level.
    Sources fill up in the order of MOST * size / weight, so the level follows
    from running sums over the sources.  There may be a source per web site:
    ranks and sums are taken range by range, never over all sources in a task."""
    named = sizes.withColumn("one", F.lit(1).cast("long"))
    w = with_sums_before(named, [], [F.col("source").asc_nulls_last()], ["one"])
    w = (w.withColumn("rank", F.col("one_before"))
         .withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int")))
         .withColumn("full_at", MOST * F.col("source_size") / F.col("weight")))
    w = with_sums_before(w.select("source", "source_size", "rank", "weight", "full_at"), [],
                         [F.col("full_at"), F.col("rank")], ["source_size", "weight"])
    w = save(w, "targets")
    total, weights = w.agg(F.sum("source_size"), F.sum("weight")).first()
    level = (F.lit(total) - MOST * F.col("source_size_before")) / (F.lit(weights) - F.col("weight_before"))
    # the level of the first source that does not fill up holds for all
    common = (w.withColumn("level", level).filter(F.col("level") <= F.col("full_at"))
              .agg(F.min(F.struct("full_at", "rank", "level"))["level"]).first()[0])
    return w.select("source", "source_size", F.least(
        (MOST * F.col("source_size")).cast("double"),
        F.col("weight") * F.lit(float("inf") if common is None else common)).alias("target"))


def _thresholds(words: DataFrame, budgets: DataFrame) -> DataFrame:
    """``source, budget`` -> ``source, threshold``: documents with a hash
    below it come nearest to ``budget`` words.  ``words`` has (source, hash,
    size).  NULL sources are matched as such."""
    open_ = budgets.select("source", F.lit(0).cast("long").alias("lo"), F.col("budget").alias("left"))
    for step in range(1, HASH_BITS // STEP_BITS + 1):
        shift = HASH_BITS - step * STEP_BITS
        if step == 1:
            part = words.withColumn("bucket", F.shiftright("hash", shift))
        else:
            o = open_.select(F.col("source").alias("s"), "lo")
            part = (words.join(o,
                               words["source"].eqNullSafe(o["s"])
                               & (F.shiftright("hash", shift + STEP_BITS) == F.shiftright("lo", shift + STEP_BITS)))
                    .drop("s", "lo").withColumn("bucket", F.shiftright("hash", shift)))
        hist = part.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
        run = Window.partitionBy("source").orderBy("bucket")
        hist = hist.withColumn("below", F.sum("n").over(run) - F.col("n"))
        o = open_.select(F.col("source").alias("s"), "left", "lo")
        hit = (o.join(hist, o["s"].eqNullSafe(hist["source"]) & (hist["below"] <= o["left"])
                      & (hist["below"] + hist["n"] > o["left"]), "left")
               .select(F.col("s").alias("source"), "left", "lo", "bucket", "below", "n"))
        # no bucket reaches beyond the budget: all remaining hashes are below the threshold
        open_ = save(hit.select(
            "source",
            F.coalesce(F.shiftleft("bucket", shift),
                       F.col("lo") + F.lit(1 << (shift + STEP_BITS))).alias("lo"),
            (F.col("left") - F.coalesce("below", F.lit(0))).alias("left"),
            F.coalesce("n", F.lit(0)).alias("n")), "open")
    # the last bucket is one hash: it goes in when that comes nearer
    return open_.select("source", F.when((F.col("n") > 0) & (2 * F.col("left") >= F.col("n")),
                                         F.col("lo") + 1).otherwise(F.col("lo")).alias("threshold"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """One row per input row: ``id``, ``source``, ``size`` (words),
    ``source_size``, ``target`` (of its source), ``copies`` (0 to 3) and
    ``taken`` (= size * copies).

    A NULL source is a source of its own, the last; NULL or empty texts have
    size 0 and cost nothing.  The hash is that of the id: repeated rows of an
    id, and rows with a NULL id, are taken or left together.  Whole documents
    are taken, so a source misses its target by at most half the words of one
    hash.  Very long texts are counted whole; other columns are not read; an
    empty table gives no rows.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                      n_words(F.col(text_col)).alias("size"),
                      place(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("hash"))
    words = save(src, "words")
    plan = save(targets(words.groupBy("source").agg(F.sum("size").cast("long").alias("source_size")))
                .withColumn("whole", F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))),
                                                F.lit(0)).cast("int"))
                .withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")), "plan")
    cut = _thresholds(words, plan).withColumnRenamed("source", "s")
    both = plan.join(cut, plan["source"].eqNullSafe(cut["s"])).drop("source")
    out = words.join(both, words["source"].eqNullSafe(both["s"]))
    copies = F.least(F.col("whole") + (F.col("hash") < F.col("threshold")).cast("int"), F.lit(MOST))
    return out.select("id", "source", "size", "source_size", "target", copies.cast("int").alias("copies"),
                      (F.col("size") * copies).cast("long").alias("taken"))

"""Seeded, distributed resampling with and without replacement.

* ``indexed_members``: a dense 0-based index of the members of each group,
  ordered by (hash bucket, order column).  It is built without a window over
  a whole group: members are spread over ``buckets`` md5 buckets, the
  per-(group, bucket) counts (at most groups x buckets rows) give each
  bucket's offset, and ``row_number`` runs inside each (group, bucket).  A
  group holding a third of all rows is thus split over ``buckets`` tasks.
* ``with_draw_index``: draw ``d`` of simulation ``s`` in group ``g`` picks a
  62-bit hash of (seed, s, g, d) modulo the group size.  The hash is two words
  of a multiply / xor-shift mix over 31 bits: BIGINT arithmetic that never
  overflows, so other SQL engines compute the same draws.  A linear formula
  ``(a*s + b*d) mod n`` is not used: it would cover members evenly and remove
  sampling variance.
* ``with_permuted_index``: sampling without replacement by a keyed permutation
  of [0, n) (swap-or-not rounds: Hoang, Morris, Rogaway 2012): draw ``d`` is the
  image of ``d``, so draws are distinct without a redraw, a window or a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 256


def _hex_prefix_int(text: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def hash_bucket(col: str, buckets: int) -> Column:
    """md5 bucket of a value (first 16 bits of the hex digest mod buckets).

    The result is declared non-NULL (coalesce): a nullable join key makes
    the optimizer infer ``isnotnull(<key expression>)`` and push it below
    the projection, which evaluates the md5 twice."""
    return F.coalesce(F.pmod(_hex_prefix_int(F.col(col).cast("string"), 4), F.lit(buckets)),
                      F.lit(-1))


def indexed_members(df: DataFrame, group_col: str, order_col: str,
                    buckets: int = DEFAULT_BUCKETS, index_col: str = "idx") -> tuple[DataFrame, DataFrame]:
    """Add a dense 0-based ``index_col`` per ``group_col``, ordered by
    (md5 bucket of ``order_col``, ``order_col``).  ``order_col`` must be
    unique within a group for the index to be deterministic.

    Returns (indexed rows, group sizes ``(group_col, n)``)."""
    b = df.withColumn("_bucket", hash_bucket(order_col, buckets))
    counts = b.groupBy(group_col, "_bucket").agg(F.count("*").alias("_cnt"))
    before = Window.partitionBy(group_col).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = counts.select(group_col, "_bucket",
                            F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_offset"))
    sizes = counts.groupBy(group_col).agg(F.sum("_cnt").alias("n"))
    within = Window.partitionBy(group_col, "_bucket").orderBy(order_col)
    indexed = (b.withColumn("_rn", F.row_number().over(within))
               .join(offsets, [group_col, "_bucket"])
               .withColumn(index_col, F.col("_offset") + F.col("_rn") - 1)
               .drop("_bucket", "_offset", "_rn"))
    return indexed, sizes


MASK = (1 << 31) - 1
#: Odd multipliers of the mix.
MIX = (0x2C1B3C6D, 0x297A2D39)
#: Keyed swaps of the permutation.
ROUNDS = 16


def _mixed(df: DataFrame, x: str) -> DataFrame:
    """``x`` (0 .. 2^31 - 1) mixed in place.  One projection per step: a value
    used twice is not inlined, so each step is computed once per row."""
    df = df.withColumn(x, F.expr(f"((`{x}` ^ shiftright(`{x}`, 16)) * {MIX[0]}L) & {MASK}L"))
    df = df.withColumn(x, F.expr(f"((`{x}` ^ shiftright(`{x}`, 15)) * {MIX[1]}L) & {MASK}L"))
    return df.withColumn(x, F.expr(f"`{x}` ^ shiftright(`{x}`, 16)"))


def with_draw_index(df: DataFrame, seed: int, keys: list[str], n: str = "n", out: str = "idx") -> DataFrame:
    """Adds ``out``: a seeded uniform index in [0, n) for the row's ``keys``
    (integers from 0 to 2^31 - 1); -1 (no member) when n is 0.  Non-NULL on
    purpose, see ``hash_bucket``."""
    df = df.withColumn("_h1", F.lit(seed & MASK).cast("bigint"))
    for k in keys:
        df = _mixed(df.withColumn("_h1", F.expr(f"`_h1` ^ CAST(`{k}` AS BIGINT)")), "_h1")
    df = _mixed(df.withColumn("_h2", F.expr(f"(`_h1` + {MIX[0]}L) & {MASK}L")), "_h2")
    h = F.col("_h1") * F.lit(1 << 31) + F.col("_h2")
    return df.withColumn(out, F.coalesce(F.when(F.col(n) > 0, h % F.col(n)), F.lit(-1).cast("bigint"))) \
        .drop("_h1", "_h2")


def with_permuted_index(df: DataFrame, seed: int, keys: list[str], position: str, n: str = "n",
                        out: str = "idx") -> DataFrame:
    """Adds ``out``: the image of ``position`` (0 <= position < n) under a
    permutation of [0, n) keyed by ``seed`` and the row's ``keys``.

    Each round maps x to its partner (K - x) mod n if a hash bit of the larger
    of the two is set; the pair shares that bit, so a round is a permutation
    for any n.  The rounds run in one ``aggregate`` over the round numbers."""
    df = df.withColumn("_k", F.lit((seed * 2 + 1) & MASK).cast("bigint"))
    for k in keys:
        df = _mixed(df.withColumn("_k", F.expr(f"`_k` ^ CAST(`{k}` AS BIGINT)")), "_k")
    bound = lambda value, name, body: f"transform(array({value}), {name} -> {body})[0]"
    step = lambda x, s, m: f"((({x} ^ shiftright({x}, {s})) * {m}L) & {MASK}L)"
    # round key, partner, hash bit of the larger one
    key = bound(f"(_k + r * {MIX[1]}L) & {MASK}L", "a", bound(step("a", 16, MIX[0]), "b", step("b", 15, MIX[1])))
    bit = bound(f"(greatest(x, p) ^ k) & {MASK}L", "c",
                bound(step("c", 16, MIX[0]), "d", f"shiftright({step('d', 15, MIX[1])}, 30)"))
    swap = bound(key, "k", bound(f"(k % `{n}` + `{n}` - x) % `{n}`", "p", f"if({bit} = 1, p, x)"))
    rounds = f"aggregate(sequence(1L, {ROUNDS}L), CAST(`{position}` AS BIGINT), (x, r) -> {swap})"
    return df.withColumn(out, F.coalesce(F.expr(rounds), F.lit(-1).cast("bigint"))).drop("_k")


def broadcast_limit_bytes(spark) -> int:
    """The session's broadcast threshold in bytes (-1 = never broadcast)."""
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    raw = str(raw).strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
             "g": 1 << 30, "gb": 1 << 30}
    for suffix in sorted(units, key=len, reverse=True):
        if raw.endswith(suffix):
            return int(float(raw[: -len(suffix)]) * units[suffix])
    return int(raw)


# bytes of one indexed member row in a broadcast hash relation, with slack:
# group (int) + idx (long) + value (double) + row and hash-table overhead
_MEMBER_ROW_BYTES = 64


def resample_with_replacement(spark, members: DataFrame, group_col: str, value_col: str,
                              groups: list, sims: int, sample_size: int, seed: int,
                              buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Rows (sim, group, value): ``sims`` samples of ``sample_size`` members
    drawn with replacement from each group of ``groups``.

    The draws are generated by ``spark.range`` (distributed, nothing built on
    the driver) and matched to members by an equi-join on (group, index).

    The indexed members are checkpointed (reliable, under the session's
    checkpoint folder): they are read twice (sizes, join), the bucket offsets
    must not be recomputed differently after an executor loss, and their row
    count is then known exactly.  They are broadcast to the draws only when
    that count times a row size is below the session's broadcast threshold;
    otherwise both sides are shuffled on (group, idx).  Group sizes have one
    row per requested group and are always broadcast.
    Output size is sims x sample_size x len(groups) rows.
    """
    indexed, sizes = _members_and_sizes(spark, members, group_col, value_col, groups, buckets)
    n_members = indexed.count()
    limit = broadcast_limit_bytes(spark)
    small = 0 <= n_members * _MEMBER_ROW_BYTES <= limit

    draws = _draws(spark, sizes, group_col, groups, sims, sample_size)
    draws = with_draw_index(draws, seed, ["sim", group_col, "draw"]).select("sim", group_col, "idx")
    side = F.broadcast(indexed) if small else indexed
    return draws.join(side, [group_col, "idx"]).select("sim", group_col, value_col)


def _members_and_sizes(spark, members: DataFrame, group_col: str, value_col: str,
                       groups: list, buckets: int):
    from ..session import ensure_checkpoint_dir

    m = members.filter(F.col(group_col).isin(*groups) & F.col(value_col).isNotNull())
    indexed, _ = indexed_members(m.select(group_col, "user_id", value_col), group_col,
                                 "user_id", buckets=buckets)
    ensure_checkpoint_dir(spark)
    indexed = indexed.select(group_col, "idx", value_col).checkpoint(eager=True)
    sizes = indexed.groupBy(group_col).agg(F.count("*").alias("n"))
    return indexed, sizes


def _draws(spark, sizes: DataFrame, group_col: str, groups: list, sims: int, sample_size: int) -> DataFrame:
    """(sim, draw, group, n): one row per draw, generated on the executors."""
    k = len(groups)
    group = F.element_at(F.array(*[F.lit(g) for g in groups]), (F.col("id") % k + 1).cast("int"))
    d = spark.range(0, sims * sample_size * k).select(
        F.expr(f"(id div {k}) div {sample_size}").alias("sim"),
        F.expr(f"(id div {k}) % {sample_size}").alias("draw"), group.alias(group_col))
    return d.join(F.broadcast(sizes), group_col)


def resample_without_replacement(spark, members: DataFrame, group_col: str, value_col: str,
                                 groups: list, sims: int, sample_size: int, seed: int,
                                 buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Rows (sim, group, value): ``sample_size`` distinct members per
    simulation and group, or all members of a group that has fewer.

    Draw d of a simulation is the image of d under a permutation of the arm's
    indexes keyed by (seed, sim, group): distinct by construction, so there is
    no candidate round, window or shuffle before the member join."""
    indexed, sizes = _members_and_sizes(spark, members, group_col, value_col, groups, buckets)
    n_members = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    small = 0 <= n_members * _MEMBER_ROW_BYTES <= broadcast_limit_bytes(spark)
    draws = _draws(spark, sizes, group_col, groups, sims, sample_size).filter("draw < n")
    draws = with_permuted_index(draws, seed, ["sim", group_col], "draw").select("sim", group_col, "idx")
    side = F.broadcast(indexed) if small else indexed
    return draws.join(side, [group_col, "idx"]).select("sim", group_col, value_col)

"""Sharding by balanced label propagation, DataFrame operations only.

Documents are linked when they share a link key.  Labels (shards) start as a
hash of the row.  In each round the rows of a key are counted by shard, the
key names as target its fullest shard that still has room, and its other rows
move there under that shard's quota: hash buckets of the movers are summed,
and the buckets that fit into the free room move.  A key that no single shard
can hold fills one shard after the other.  Rows without links are only
filler: they get the places that remain, which makes the shards even.  Keys with a large share of a shard's
rows are placed first, the others around them.

Law ``rows``: counts are at most one apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import save, with_sums_before

#: Hash buckets of movers per target shard, the grain of the quotas.
QUOTA_BUCKETS = 1024
#: A shard is full when less than one part in so many of its quota is free.
FULL = 64
#: Share of a quota by which small keys may overfill a shard in the first round.
SLACK = 0.5
#: A key is large if it has more than this share of a shard's rows.
LARGE = 1 / 8


def _number(df: DataFrame, by: str, order: list[str]) -> DataFrame:
    """Adds ``slot``: gapless from 0 within each ``by`` in ``order``, range by
    range, so that no key, copy or shard is one window."""
    counted = with_sums_before(df.withColumn("_one", F.lit(1).cast("long")), [by], [F.col(c) for c in order], ["_one"])
    return counted.withColumn("slot", F.col("_one_before")).drop("_one", "_one_before")


def _pick(values: list[int], at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(int(v)) for v in values]), (at + 1).cast("int"))


def _by_room(room: list[int], at: Column) -> Column:
    """The shard whose places hold the number ``at`` of all free places."""
    ends = [sum(room[:k + 1]) for k in range(len(room))]
    return F.size(F.filter(F.array(*[F.lit(e) for e in ends]), lambda e: e <= at)).cast("int")


def _used(df: DataFrame, n_shards: int) -> list[int]:
    """Rows by shard (one number a shard)."""
    n = {r.shard: r.c for r in df.groupBy("shard").agg(F.count("*").alias("c")).collect()}
    return [n.get(k, 0) for k in range(n_shards)]


def _propagate(linked: DataFrame, quota: list[int], rounds: int, slack: float) -> DataFrame:
    """Moves labels of ``linked`` (key, row_hash, shard, ...) round by round.
    The first round may overfill a shard by the share ``slack`` of its quota, so
    that full shards can swap rows; at half of the rounds it may not."""
    n_shards = len(quota)
    for turn in range(rounds):
        counts = linked.groupBy("key", "shard").agg(F.count("*").alias("here"))
        used = _used(linked, n_shards)
        over = 1 + slack * max(0.0, 1 - 2 * turn / rounds)
        free = [int(quota[k] * over) - used[k] for k in range(n_shards)]
        # a shard with next to no room counts as full, or it would block its keys
        free = [f if f > 0 and FULL * f >= quota[k] else 0 for k, f in enumerate(free)]
        # the fullest shard with room; ties by a hash, so that targets spread
        rank = F.struct("here", F.xxhash64("key", "shard"))
        target = (counts.withColumn("room", _pick(free, F.col("shard")))
                  .groupBy("key").agg(F.max_by("shard", F.when(F.col("room") > 0, rank)).alias("target"),
                                      F.max_by("here", F.when(F.col("room") > 0, rank)).alias("there"),
                                      F.count("*").alias("labels")))
        target = target.filter((F.col("labels") > 1) & F.col("target").isNotNull()).select("key", "target", "there")
        # a row leaves only for a shard with more neighbours (ties: one direction)
        own = counts.join(target, "key").filter(
            (F.col("shard") != F.col("target"))
            & (F.struct("here", F.xxhash64("key", "shard")) < F.struct(F.col("there"), F.xxhash64("key", "target"))))
        wish = own.select("key", "shard", "target", "here")
        # rows of a key move together; a key too large for the room moves in parts
        big = F.col("here") > F.greatest(F.lit(1), (_pick(free, F.col("target")) / 8).cast("long"))
        state = (linked.join(wish.withColumn("big", big).drop("here"), ["key", "shard"], "left")
                 .withColumn("bucket", F.when(F.col("target").isNotNull(), F.pmod(
                     F.when(F.col("big"), F.xxhash64("key", "row_number")).otherwise(F.xxhash64("key")),
                     F.lit(QUOTA_BUCKETS)))))
        state = save(state.drop("big"), "moves")
        run = Window.partitionBy("target").orderBy("bucket")
        fits = (state.filter(F.col("target").isNotNull()).groupBy("target", "bucket").agg(F.count("*").alias("c"))
                .withColumn("upto", F.sum("c").over(run))
                .filter(F.col("upto") <= _pick(free, F.col("target")))
                .groupBy("target").agg(F.max("bucket").alias("last"), F.max("upto").alias("moved")).collect())   # one row a shard
        last = [-1] * n_shards
        for r in fits:
            last[r.target] = r.last
        linked = state.select(
            *[c for c in state.columns if c not in ("shard", "target", "bucket")],
            F.when(F.col("target").isNotNull() & (F.col("bucket") <= _pick(last, F.coalesce("target", F.lit(0)))),
                   F.col("target")).otherwise(F.col("shard")).cast("int").alias("shard"))
        if not fits:
            break
    return linked


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
          link: Column | None = None, n_shards: int = 24, rounds: int = 12) -> DataFrame:
    """One row per input row: ``id``, ``size`` (UTF-8 bytes of the text plus
    8), ``text_crc32``, ``law`` ('rows'), ``shard``, ``slot`` (gapless from 0
    in each shard), ``grown_shard`` (NULL under this law).

    ``link`` is the link key, by default equal texts; rows with a NULL text
    have no link (size 8, crc32 0), empty texts are equal texts.  Shard counts
    are at most one apart.  A key with more rows than a shard holds is split
    over as few shards as the rounds reach.  Rows with a NULL id are placed
    like others; identical repeated rows are linked and take different slots;
    other columns are not read; an empty table gives no rows.
    """
    text = F.col(text_col)
    src = docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        (F.sha2(text, 256) if link is None else link).alias("key"),
        F.xxhash64(F.col(id_col).cast("string"), text).alias("row_hash"))
    # a number of its own tells equal rows apart
    src = save(src.withColumn("row_number", F.monotonically_increasing_id())
               .withColumn("shard", F.pmod(F.xxhash64("row_hash"), F.lit(n_shards)).cast("int")), "rows")
    n_rows = src.count()
    quota = [n_rows // n_shards + (k < n_rows % n_shards) for k in range(n_shards)]
    several = src.filter(F.col("key").isNotNull()).groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    # large keys first, each row for itself; the rest then fits around them
    large = F.col("n") > max(1, int(LARGE * n_rows / n_shards))
    several = save(several, "keys")
    # a large key's rows find their number without meeting in one task: there are at
    # most n_shards / LARGE such keys; rows without a key stay out of the joins
    hot = F.broadcast(several.filter(large))
    keyed, free = src.filter(F.col("key").isNotNull()), src.filter(F.col("key").isNull())
    parted = save(keyed.join(hot, "key")
                  .unionByName(keyed.join(hot.select("key"), "key", "left_anti").join(several.filter(~large), "key", "left"))
                  .unionByName(free.withColumn("n", F.lit(None).cast("long"))), "parted")
    first = _propagate(parted.filter(large), quota, rounds, 0.0)
    room = [max(0, q - u) for q, u in zip(quota, _used(first, n_shards))]
    at = F.pmod(F.xxhash64("row_hash"), F.lit(max(1, sum(room))))
    rest = parted.filter((F.col("n") > 1) & ~large).withColumn("shard", F.least(_by_room(room, at), F.lit(n_shards - 1)))
    linked = first.unionByName(_propagate(rest, room, rounds, SLACK))
    # numbered by key, so that what is over a quota is whole keys; by row in large keys
    linked = linked.withColumn("key_hash", F.when(large, F.col("row_hash")).otherwise(F.xxhash64("key"))).drop("n")
    single = parted.filter(F.col("n").isNull() | (F.col("n") < 2)).drop("n").withColumn("key_hash", F.col("row_hash"))

    order = ["key_hash", "id", "text_crc32", "row_number"]
    placed = save(_number(linked, "shard", order), "placed")
    over = F.col("slot") >= _pick(quota, F.col("shard"))
    # rows over the quota (rare: more linked rows than places) join the filler
    pool = (placed.filter(over).drop("slot").unionByName(single)
            .withColumn("one", F.lit(0)))
    used = _used(placed.filter(~over), n_shards)
    room = [q - u for q, u in zip(quota, used)]
    filler = _number(pool, "one", order)
    # place i of all free places is in the shard that holds it, behind its linked rows
    first_slot = [used[k] - sum(room[:k]) for k in range(n_shards)]
    filler = (filler.withColumn("shard", _by_room(room, F.col("slot")))
              .withColumn("slot", F.col("slot") + _pick(first_slot, F.col("shard"))))
    cols = ["id", "size", "text_crc32", "shard", "slot", "key"]
    out = placed.filter(~over).select(*cols).unionByName(filler.select(*cols))
    return out.select("id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                      F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))

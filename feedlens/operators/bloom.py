"""A blocked Bloom filter as a table, for pre-filtering scans by a key set.

The first hash of a key picks a block of ``BITS`` bits, further hashes pick the
key's bits inside it.  The filter is an aggregate (``bit_or`` of words, combined
map-side), one row per block.  A probe is one broadcast join on the block number
and a test of a few bits, so rows without a match leave at the scan, before the
aggregate and the exact join; the exact join then takes out the false positives
(about one in a hundred at ten bits a key).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sampling import broadcast_limit_bytes

BITS = 4096          # of a block: 64 words
BITS_PER_KEY = 10
PROBES = 6
_WORDS = BITS // 64
#: Bytes of one broadcast row, with the overhead of the hash table.
_ROW_BYTES = BITS // 8 + 96


def blocks_for(n_keys: int, bits_per_key: int = BITS_PER_KEY) -> int:
    return max(1, -(-n_keys * bits_per_key // BITS))


def _block(key: Column, n_blocks: int) -> Column:
    """Declared non-NULL, or the optimizer adds ``isnotnull(<hash>)`` to the scan
    and hashes every key twice."""
    return F.coalesce(F.pmod(F.xxhash64(F.lit(1), key), F.lit(n_blocks)), F.lit(-1).cast("bigint"))


def _places(key: Column) -> list[Column]:
    """The key's bits in its block: 12-bit pieces of two hashes."""
    h = [F.xxhash64(F.lit(s), key) for s in (2, 3)]
    return [F.shiftrightunsigned(h[i // 5], 12 * (i % 5)).bitwiseAND(F.lit(BITS - 1)).cast("int") for i in range(PROBES)]


def build(keys: DataFrame, column: str, n_blocks: int) -> DataFrame:
    """``_bb`` (block), ``_bw`` (its words) of the non-NULL keys."""
    k = F.col(column)
    bits = (keys.filter(k.isNotNull())
            .select(_block(k, n_blocks).alias("_bb"), F.explode(F.array(*_places(k))).alias("p"))
            .select("_bb", F.shiftright("p", 6).alias("w"), F.expr("shiftleft(1L, p & 63)").alias("bits")))
    words = bits.groupBy("_bb", "w").agg(F.bit_or("bits").alias("bits"))
    pairs = F.map_from_entries(F.collect_list(F.struct("w", "bits")))        # at most 64 entries
    return words.groupBy("_bb").agg(pairs.alias("m")).select(
        "_bb", F.transform(F.sequence(F.lit(0), F.lit(_WORDS - 1)), lambda i: F.coalesce(F.col("m")[i], F.lit(0))).alias("_bw"))


def probe(rows: DataFrame, column: str, filter_: DataFrame, n_blocks: int) -> DataFrame:
    """Rows whose key may be in the filter: all that are, and few others."""
    k = F.col(column)
    hit = F.lit(True)
    for p in _places(k):
        hit = hit & (F.lit(1) == F.call_function("getbit", F.col("_bw")[F.shiftright(p, 6)], p.bitwiseAND(F.lit(63))))
    joined = rows.withColumn("_bk", _block(k, n_blocks)).join(F.broadcast(filter_), F.col("_bk") == F.col("_bb"))
    return joined.filter(hit).drop("_bk", "_bb", "_bw")


def prefilter(rows: DataFrame, keys: DataFrame, column: str, n_keys: int) -> DataFrame:
    """``rows`` without most rows whose ``column`` is not among ``keys``.  The
    filter is broadcast only if its size, known from ``n_keys`` (an upper
    bound), is below the session's broadcast threshold; beyond it the rows stay
    as they are, for the exact join that follows."""
    n_blocks = blocks_for(n_keys)
    limit = broadcast_limit_bytes(rows.sparkSession)
    if limit < 0 or n_blocks * _ROW_BYTES > limit:
        return rows
    return probe(rows, column, build(keys, column, n_blocks), n_blocks)

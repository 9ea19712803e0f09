"""Hard negatives of anchors by exact integer inner products.

Anchors and candidates are dealt into blocks of bounded size; a task holds one
anchor block and one candidate block, multiplies tile after tile by Strassen's
recursion on int64 (zero padding to even sides, additions exact modulo 2^64, so
the product is exact whenever the scores fit) and keeps, for every anchor, a
heap of its best rows.  Heaps of different tiles merge: the best of the bests
are the best of all.  The first pass keeps each anchor's positives, the second
the rows of other labels whose score lies in a positive's window.

Defined cases: rows with a NULL label, a NULL vector or a NULL or non-finite
component take no part; vectors shorter than others count as padded with
zeros; a NULL id is no anchor and comes last in ties; repeated rows are rows of
their own, so an anchor's copy is one of its other rows; an anchor without
positives, or a positive without rows in its window, has no result rows; an
empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import save

#: Sides under which the recursion stops.
LEAF = 16
#: Rows of an anchor block and of a candidate block: what one task holds.
ANCHORS, CANDIDATES = 4096, 16384
#: Rows of the tiles that are multiplied.
TILE_ANCHORS, TILE_CANDIDATES = 256, 4096
#: Fewest candidates of a block, while there are not two blocks a core.
LEAST = 1024
_LAST_ID = (1 << 63) - 1
_NONE = -(1 << 63)


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of int64 matrices by seven half-size products; odd sides are
    padded with zeros.  Arithmetic is modulo 2^64."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b.T, ((0, n % 2), (0, k % 2))).T     # keeps its columns contiguous
        return strassen(a, b, leaf)[:m, :n]
    h, i, j = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:h, :i], a[:h, i:], a[h:, :i], a[h:, i:]
    b11, b12, b21, b22 = b[:i, :j], b[:i, j:], b[i:, :j], b[i:, j:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((m, n), dtype=a.dtype)
    out[:h, :j] = p1 + p4 - p5 + p7
    out[:h, j:] = p3 + p5
    out[h:, :j] = p2 + p4
    out[h:, j:] = p1 - p2 + p3 + p6
    return out


def _sizes(column: pa.ChunkedArray) -> np.ndarray:
    return np.diff(column.combine_chunks().offsets.to_numpy())


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of a list column as int64, padded with zeros to ``width``."""
    sizes, flat = _sizes(column), column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


class Heaps:
    """The ``k`` best (score, then smaller id) of every anchor so far."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), _NONE, dtype=np.int64)
        self.id = np.full((n, k), _LAST_ID, dtype=np.int64)

    def push(self, at: slice, score: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """Merge one tile; ``ids`` (ascending) name its columns."""
        left = np.where(allowed, score, _NONE)
        rows = np.arange(len(left))
        best, names = [self.score[at]], [self.id[at]]
        for _ in range(min(self.k, left.shape[1])):
            j = left.argmax(axis=1)               # the first of equals: the smallest id
            best.append(left[rows, j][:, None])
            names.append(ids[j][:, None])
            left[rows, j] = _NONE
        best, names = np.hstack(best), np.hstack(names)
        order = np.lexsort((names, ~best), axis=1)[:, :self.k]     # ~x falls as x rises, without overflow
        self.score[at] = np.take_along_axis(best, order, axis=1)
        self.id[at] = np.take_along_axis(names, order, axis=1)

    def rows(self, anchors: np.ndarray, place: int = 0) -> pa.Table:
        full = self.score > _NONE
        return pa.table({"anchor": np.repeat(anchors, full.sum(axis=1)),
                         "place": np.full(int(full.sum()), place, dtype=np.int64),
                         "score": self.score[full], "id": self.id[full]})


def _tiles(anchors: pa.Table, candidates: pa.Table):
    """(slice of anchors, scores, slice of the ordered candidates) tile by tile,
    and the ids, labels and rows of the candidates in order of their ids."""
    order = np.argsort(candidates["id"].to_numpy(), kind="stable")
    ids, labels, rows = (candidates[c].to_numpy()[order] for c in ("id", "label", "row"))
    width = int(max(_sizes(anchors["vector"]).max(initial=1), _sizes(candidates["vector"]).max(initial=1)))
    a, c = matrix(anchors["vector"], width), matrix(candidates["vector"], width)[order]

    def tiles():
        for i in range(0, len(a), TILE_ANCHORS):
            for j in range(0, len(c), TILE_CANDIDATES):
                left, right = slice(i, min(i + TILE_ANCHORS, len(a))), slice(j, min(j + TILE_CANDIDATES, len(c)))
                yield left, strassen(a[left], c[right].T), right

    return tiles(), ids, labels, rows


_HEAP = "anchor long, place long, score long, id long"
_EMPTY = pa.schema([(c, pa.int64()) for c in ("anchor", "place", "score", "id")]).empty_table()


def _positives(count: int):
    def best(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        if not len(anchors) or not len(candidates):     # a block may be empty
            return _EMPTY
        heaps = Heaps(len(anchors), count)
        tiles, ids, labels, rows = _tiles(anchors, candidates)
        own, mine = anchors["label"].to_numpy(), anchors["row"].to_numpy()
        for left, score, right in tiles:
            same = (own[left][:, None] == labels[right]) & (mine[left][:, None] != rows[right])
            heaps.push(left, score, same, ids[right])
        return heaps.rows(mine)
    return best


def _negatives(count: int, low: tuple[int, int], high: tuple[int, int]):
    def best(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        if not len(anchors) or not len(candidates):
            return _EMPTY
        known = _sizes(anchors["positives"])
        bounds = matrix(anchors["positives"], int(known.max(initial=1)))
        heaps = [Heaps(len(anchors), count) for _ in range(bounds.shape[1])]
        tiles, ids, labels, _ = _tiles(anchors, candidates)
        own = anchors["label"].to_numpy()
        for left, score, right in tiles:
            other = own[left][:, None] != labels[right]
            for place, heap in enumerate(heaps):
                p = bounds[left, place][:, None]
                inside = (low[1] * score >= low[0] * p) & (high[1] * score <= high[0] * p) & (known[left] > place)[:, None]
                heap.push(left, score, other & inside, ids[right])
        mine = anchors["row"].to_numpy()
        return pa.concat_tables([h.rows(mine, place + 1) for place, h in enumerate(heaps)])
    return best


def _merged(heaps: DataFrame, keys: list[str], count: int) -> DataFrame:
    """The best ``count`` of each key's heaps, with ``rank`` from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return heaps.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)


def quantized(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``row, id, label, vector`` of the rows that take part: components become
    floor(scale * x).  ``vectors`` has ``id``, ``label`` and ``vector``."""
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return vectors.filter(F.col("label").isNotNull() & F.col("vector").isNotNull() & fine).select(
        F.monotonically_increasing_id().alias("row"), F.coalesce(F.col("id").cast("long"), F.lit(_LAST_ID)).alias("id"),
        F.col("label").cast("long").alias("label"),
        F.transform("vector", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")).alias("vector"))


def mine(vectors: DataFrame, is_anchor, *, positives: int = 5, negatives: int = 3, low: tuple[int, int] = (1, 2),
         high: tuple[int, int] = (19, 20), scale: int = 256, anchor_block: int = ANCHORS,
         candidate_block: int = CANDIDATES) -> DataFrame:
    """``anchor_id, positive_id, place, rank, negative_id, positive_score,
    negative_score``.

    ``vectors`` has ``id`` (integer), ``label`` (integer) and ``vector`` (array of
    numbers); ``is_anchor`` is a predicate on ``id``.  The positives of an anchor
    are the ``positives`` best other rows of its label; for each, the ``negatives``
    best rows of other labels with low * p <= score <= high * p (``low`` and
    ``high`` are fractions).  Better: higher score, then smaller id.

    Every row is sent to a task per anchor block and every anchor to a task per
    candidate block; blocks are dealt by a hash of the row, so no label, id or
    copy gathers in one of them."""
    rows = save(quantized(vectors, scale), "vectors")
    spark = rows.sparkSession
    chosen = rows.filter(is_anchor & (F.col("id") != _LAST_ID))
    n_rows, n_anchors = rows.count(), chosen.count()
    few = min(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), n_rows // LEAST)
    n_c = max(1, -(-n_rows // candidate_block), few)
    n_a = max(1, -(-n_anchors // anchor_block))
    dealt = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # columns of their own: two sides that share columns of one table lose some
    others = rows.select(*[F.col(c).alias(c) for c in rows.columns])
    candidates = others.withColumn("c", dealt(n_c)).withColumn("a", every(n_a)).groupBy("a", "c")

    def tiled(anchors: DataFrame, best) -> DataFrame:
        sides = anchors.withColumn("a", dealt(n_a)).withColumn("c", every(n_c)).groupBy("a", "c")
        return sides.cogroup(candidates).applyInArrow(best, _HEAP)

    found = _merged(tiled(chosen, _positives(positives)), ["anchor"], positives)
    found = save(found.select("anchor", F.col("rank").alias("place"), F.col("score").alias("positive_score"),
                              F.col("id").alias("positive_id")), "positives")
    windows = found.groupBy("anchor").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("place", "positive_score"))), lambda x: x["positive_score"]).alias("positives"))
    known = chosen.join(windows, F.col("row") == F.col("anchor")).drop("anchor")
    near = _merged(tiled(known, _negatives(negatives, low, high)), ["anchor", "place"], negatives)
    near = near.select(F.col("anchor").alias("n_anchor"), F.col("place").alias("n_place"), "rank",
                       F.col("score").alias("negative_score"), F.col("id").alias("negative_id"))
    names = chosen.select("row", F.col("id").alias("anchor_id"))
    out = (found.join(near, (F.col("anchor") == F.col("n_anchor")) & (F.col("place") == F.col("n_place")))
           .join(names, F.col("anchor") == F.col("row")))
    real = lambda c: F.nullif(F.col(c), F.lit(_LAST_ID)).alias(c)
    return out.select("anchor_id", real("positive_id"), "place", "rank", real("negative_id"), "positive_score", "negative_score")

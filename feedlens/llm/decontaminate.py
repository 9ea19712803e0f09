"""Benchmark decontamination: size-partitioned MinHash containment search.

The minimum of a random hash function over an item's shingles is a shingle
drawn at random from the item.  The share of such *anchors* that a document
holds therefore estimates how much of the item the document contains,
whatever the document's length; a Jaccard signature could not, because a
short item has next to no similarity with a long document.

Items are partitioned by size (the bit length of their number of shingles).
Every partition has its own number of anchors and its own number of them that a
document must hold; the more shingles, the more anchors, and in the partitions of
small items every shingle is an anchor.  A document that reaches the number is
verified by the exact share of the item's shingles.

Documents are read once, whatever the size of the benchmark: a bitmap of all
items' shingles, bounded by ``MOST_BITS``, is broadcast, and a document gives the
shingles that the bitmap may hold - all that it shares with any item, and few
others.  These few meet the table of anchors in a join, and the candidates the
items' sets in another; neither the index nor the benchmark passes through the
driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save
from .shingles import WordIds, hash_family, mix, shared, shingle_set

SEED = 977
#: Partitions (bit lengths of the shingle count) up to this keep every shingle as
#: an anchor; the others have so many anchors a bit, drawn with replacement.
WHOLE_BITS, ANCHORS_PER_BIT = 4, 8
#: Bits a shingle gets in the bitmap, bits it sets, and the bitmap's bound (16 MB).
#: Beyond the bound more foreign shingles pass the bitmap, and nothing is lost.
BITS_PER_SHINGLE, PROBES, MOST_BITS = 32, 3, 1 << 27
_BUCKET = 32768          # bits of one bitmap row in Spark
#: Fixed value: ASCII punctuation and white space become spaces.
_PUNCT = bytes.maketrans(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~\t\n\x0b\x0c\r", b" " * 37)


def passage_words(text: str | None) -> list[bytes]:
    """Words in lower case, without ASCII punctuation."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_PUNCT).split()


def anchors_needed(n_anchors: int, similarity: float, miss: float = 1e-9) -> int:
    """Largest m such that a document with a share of ``similarity`` of the
    item holds fewer than m of its anchors with probability below ``miss``
    (anchors are draws with replacement: a binomial tail)."""
    tail = 0.0
    for m in range(n_anchors + 1):
        tail += math.comb(n_anchors, m) * similarity ** m * (1 - similarity) ** (n_anchors - m)
        if tail > miss:
            return max(m, 1)
    return n_anchors


def plan_of(n: int, similarity: float) -> tuple[int, int]:
    """Anchors of an item of ``n`` shingles (0: all of them), and how many of them a
    document must hold, by the item's size partition."""
    bits = n.bit_length()
    if bits <= WHOLE_BITS:
        return 0, math.ceil(similarity * n - 1e-9)
    drawn = ANCHORS_PER_BIT * bits
    return drawn, anchors_needed(drawn, similarity)


def place(values: np.ndarray, probe: int, bits: int) -> np.ndarray:
    """Position of each value's bit number ``probe`` in a bitmap of ``bits`` (a
    power of two)."""
    salt = np.uint64((probe + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return (mix(values + salt) & np.uint64(bits - 1)).astype(np.int64)


def _item_rows(width: int, similarity: float):
    """id, text -> id, n, shingles, anchors (value and weight), needed."""
    a, b = hash_family(ANCHORS_PER_BIT * 64, SEED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds()
        for batch in batches:
            out = []
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                words = passage_words(text.as_py())
                if len(words) < width:
                    continue
                s = shingle_set(words, width, ids)
                drawn, needed = plan_of(len(s), similarity)
                values, times = s, np.ones(len(s), np.int64)
                if drawn:
                    at = np.array([np.argmin(mix(s * a[j] + b[j])) for j in range(drawn)])
                    values, times = np.unique(s[at], return_counts=True)
                out.append((key, len(s), s.tobytes(), values.view(np.int64).tolist(), times.tolist(), needed))
            cols = list(zip(*out)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary()),
                 pa.array(cols[3], pa.list_(pa.int64())), pa.array(cols[4], pa.list_(pa.int64())), pa.array(cols[5], pa.int64())],
                names=["id", "n", "shingles", "anchors", "weights", "needed"])
    return run


def _set_places(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in batch.column("shingles"):
                v = np.frombuffer(s.as_py(), np.uint64)
                p = np.unique(np.concatenate([place(v, k, bits) for k in range(PROBES)]))
                yield pa.RecordBatch.from_arrays([pa.array(p + 1)], names=["place"])    # Spark counts bits from 1
    return run


def bitmap_of(items: DataFrame, n_shingles: int) -> tuple[np.ndarray, int]:
    """The bitmap of the items' shingles as bytes, and its number of bits.  Its rows
    are aggregated in Spark; at most ``MOST_BITS`` bits come to the driver."""
    bits = min(MOST_BITS, max(_BUCKET, 1 << (BITS_PER_SHINGLE * n_shingles).bit_length()))
    rows = (items.select("shingles").mapInArrow(_set_places(bits), "place long")
            .groupBy(F.bitmap_bucket_number("place").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap")))
    out = np.zeros(bits // 8, np.uint8)
    for r in rows.toLocalIterator():
        at = (r.bucket - 1) * (_BUCKET // 8)
        out[at:at + _BUCKET // 8] = np.frombuffer(r.bitmap, np.uint8)
    return out, bits


def _hits(bitmap, bits: int, width: int, id_type: pa.DataType):
    """id, text -> id, digest of the text, the shingles that the bitmap may hold;
    documents without any are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, bitmap_ = WordIds(), bitmap.value
        for batch in batches:
            for i in range(0, batch.num_rows, 512):          # bounded output batches
                part, out = batch.slice(i, 512), []
                for row, text in zip(part.column("id"), part.column("text")):
                    words = passage_words(text.as_py())
                    if len(words) < width:
                        continue
                    s = shingle_set(words, width, ids)
                    left = s
                    for k in range(PROBES):                  # a probe at a time: most shingles leave at once
                        p = place(left, k, bits)
                        left = left[(bitmap_[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1]
                        if not len(left):
                            break
                    if len(left):
                        digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                        out.append((row.as_py(), digest, left.view(np.int64).tolist()))
                cols = list(zip(*out)) if out else [[]] * 3
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], id_type), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.list_(pa.int64()))],
                    names=["id", "digest", "hits"])
    return run


def _verified(part: int, whole: int):
    """Candidate pairs with the exact number of shared shingles, of those that
    hold enough of the item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = []
            for hits, s in zip(batch.column("hits"), batch.column("shingles")):
                found = np.array(hits.as_py(), np.int64).view(np.uint64)
                n.append(shared(np.sort(found), np.frombuffer(s.as_py(), np.uint64)))
            n = np.array(n, np.int64)
            size = batch.column("n").to_numpy()
            keep = pa.array(whole * n >= part * size)
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), batch.column("item_id"), batch.column("n"), pa.array(n)],
                names=["digest", "item_id", "n_item", "n_shared"]).filter(keep)
    return run


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_id_col: str = "item_id", item_text_col: str = "text", *,
                    width: int = 5, part: int = 80, whole: int = 100) -> DataFrame:
    """``doc_id``, ``item_id``, ``n_item``, ``n_shared``: every document that
    holds at least ``part / whole`` of an item's ``width``-word shingles.

    Words are lower-cased and split at white space and ASCII punctuation.
    Items and documents with NULL or empty text or fewer than ``width`` words
    match nothing (too short to be evidence).  Rows with a NULL id are searched
    and give rows with a NULL id; NULL item ids likewise.  Repeated documents or
    items give their rows once per distinct pair.  Document ids are strings or
    whole numbers.  Very long documents are searched whole; other columns are not
    read; empty tables give no rows.
    """
    spark = docs.sparkSession
    kind = "string" if docs.schema[id_col].dataType.typeName() == "string" else "long"
    id_type = pa.string() if kind == "string" else pa.int64()
    src = docs.select(F.col(id_col).cast(kind).alias("id"), F.col(text_col).alias("text"))
    sized = save(items.select(F.col(item_id_col).cast("long").alias("id"), F.col(item_text_col).alias("text"))
                 .mapInArrow(_item_rows(width, part / whole),
                             "id long, n long, shingles binary, anchors array<long>, weights array<long>, needed long")
                 .distinct(), "items")
    # items with equal sets are one entry of the index
    index = save(sized.groupBy(F.sha2("shingles", 256).alias("item")).agg(
        *[F.min(c).alias(c) for c in ("n", "shingles", "anchors", "weights", "needed")]), "index")
    total = index.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    schema = f"doc_id {kind}, item_id long, n_item long, n_shared long"
    if not total:
        return spark.createDataFrame([], schema)
    bitmap, bits = bitmap_of(index, total)
    found = save(src.mapInArrow(_hits(spark.sparkContext.broadcast(bitmap), bits, width, id_type),
                                f"id {kind}, digest binary, hits array<long>"), "hits")
    # documents with equal sets share their hits and are searched once
    texts = found.groupBy("digest").agg(F.min("hits").alias("hits"))
    texts = save(texts, "texts")
    anchors = index.select("item", "needed", F.inline(F.arrays_zip("anchors", "weights"))).select(
        "item", "needed", F.col("anchors").alias("anchor"), "weights")
    held = (texts.select("digest", F.explode("hits").alias("value")).join(anchors, F.col("value") == F.col("anchor"))
            .groupBy("digest", "item", "needed").agg(F.sum("weights").alias("held")).filter("held >= needed"))
    pairs = save(held.select("digest", "item"), "candidates")
    sets = pairs.join(index.select("item", "n", "shingles"), "item").join(texts, "digest")
    exact = save(sets.select("digest", F.col("item").alias("item_id"), "n", "hits", "shingles")
                 .mapInArrow(_verified(part, whole), "digest binary, item_id string, n_item long, n_shared long"), "contained")
    named = sized.select(F.sha2("shingles", 256).alias("item"), F.col("id").alias("named_id"))
    return (exact.join(named, F.col("item_id") == F.col("item")).select("digest", F.col("named_id").alias("item_id"), "n_item", "n_shared")
            .join(found.select("digest", F.col("id").alias("doc_id")), "digest")
            .select("doc_id", "item_id", "n_item", "n_shared").distinct())

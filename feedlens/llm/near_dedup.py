"""MinHash near-duplicate detection.

1. One pass over the texts: shingle set, its digest, many universal hash
   minima, banded into keys.  Texts with equal shingle sets form a class; its
   smallest id stands for it, so copies are never compared.
2. Class representatives that share a band key are candidates.  A bucket is
   not expanded into pairs: its members are compared with a *hub* of the
   bucket, pairs that already lie in one component are skipped, and only
   buckets still split between components get more hubs, eight times as many
   each round, until every pair of such a bucket is decided.
   Pairs that cannot be similar are left out by exact bounds: on the shingles
   of a text that occur in any other candidate, and, in the later rounds, on
   those that it has in common with the central member of its bucket.
3. A candidate pair is verified on its signatures (minima that agree) and
   then on the full shingle sets.
4. Verified links become components by alternating large-star / small-star.
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
from .components import components
from .shingles import WordIds, band_keys, hash_family, minima, shared, shingle_set

SEED = 20240229
#: Bands whose hubs are compared in the first round; links found there spare
#: the comparisons of the other bands.
FIRST_BANDS = 4
#: Hubs a bucket gains from one round to the next.
GROWTH = 8
#: Members of a bucket that meet its hubs in one task: a larger bucket is dealt
#: into so many parts, and its hubs go to each of them.
PART_MEMBERS = 1000


def band_rows(similarity: float, n_hashes: int, miss: float = 1e-6) -> int:
    """Most minima per band for which a pair of exactly ``similarity`` shares
    no band with a probability of at most ``miss``."""
    rows = 1
    for r in range(2, 17):
        if (1 - similarity ** r) ** (n_hashes // r) <= miss:
            rows = r
    return rows


def text_words(text: str | None) -> list[bytes]:
    """Words of a text, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _fingerprints(width: int, n_hashes: int, rows: int):
    """id, text -> id, n, digest of the set, band keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = hash_family(n_hashes, SEED)
        ids = WordIds()
        for batch in batches:
            n, digest, keys = [], [], []
            for text in batch.column("text"):
                s = shingle_set(text_words(text.as_py()), width, ids)
                n.append(len(s))
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                keys.append(band_keys(minima(s, a, b), rows) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], names=["id", "n", "digest", "keys"])
    return run


def _sets(width: int, n_hashes: int):
    """id, text -> id, shingle set and signature as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = hash_family(n_hashes, SEED)
        ids = WordIds()
        for batch in batches:
            for i in range(0, batch.num_rows, 256):      # bounded output batches
                part = batch.slice(i, 256)
                sets = [shingle_set(text_words(t.as_py()), width, ids) for t in part.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([s.tobytes() for s in sets], pa.binary()),
                     pa.array([(minima(s, a, b) >> np.uint64(32)).astype(np.uint32).tobytes()
                               for s in sets], pa.binary())], names=["id", "shingles", "minima"])
    return run


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, shingle set -> a row per shingle."""
    for batch in batches:
        for i in range(batch.num_rows):                  # one document at a time
            s = np.frombuffer(batch.column("shingles")[i].as_py(), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(s), pa.array(np.full(len(s), batch.column("id")[i].as_py()), pa.int64())], names=["shingle", "id"])


def _verified(part: int, whole: int, floor: int):
    """Pairs whose signatures agree often enough and whose sets hold
    ``whole * intersection >= part * union``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for ma, mb, sa, sb in zip(*(batch.column(c) for c in ("ma", "mb", "sa", "sb"))):
                agree = (np.frombuffer(ma.as_py(), np.uint32) == np.frombuffer(mb.as_py(), np.uint32)).sum()
                ok = False
                if agree >= floor:
                    x, y = np.frombuffer(sa.as_py(), np.uint64), np.frombuffer(sb.as_py(), np.uint64)
                    both = shared(x, y)
                    ok = whole * both >= part * (len(x) + len(y) - both)
                keep.append(ok)
            yield batch.select(["ca", "cb"]).filter(pa.array(keep, pa.bool_()))
    return run


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that two sets have in common."""
    for batch in batches:
        p = [shared(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64))
             for x, y in zip(batch.column("sa"), batch.column("sb"))]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(p, pa.int64())], names=["id", "b", "p"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                    width: int = 5, part: int = 80, whole: int = 100,
                    n_hashes: int = 224) -> DataFrame:
    """One row per input row: ``id``, ``n_shingles``, ``component_id``, ``kept``.

    Texts are linked when ``whole * |A & B| >= part * |A | B|`` for their sets
    of ``width``-word shingles; ``component_id`` is the smallest id reachable.

    NULL or empty texts and texts of white space have an empty set: they are
    linked with nothing and kept.  A row with a NULL id cannot be named in a
    link: its component is NULL and it is kept.  Repeated rows keep their
    common id and share one result.  If one id has several texts, each row is
    placed by its own text, and texts for which the id stands as the
    representative are one node.  Only the two named columns are read.  Very
    long texts are hashed in blocks; an empty table gives no rows.
    """
    rows = band_rows(part / whole, n_hashes)
    sim = part / whole
    floor = math.floor(n_hashes * sim - 6 * math.sqrt(n_hashes * sim * (1 - sim)))
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    prints = save(src.mapInArrow(_fingerprints(width, n_hashes, rows),
                                 "id long, n long, digest binary, keys array<long>"), "prints")
    sets = prints.filter((F.col("n") > 0) & F.col("id").isNotNull())
    classes = save(sets.groupBy("digest").agg(F.min("id").alias("rep")), "classes")

    # band rows of the representatives, of buckets with two members or more
    reps = classes.select(F.col("rep").alias("id"), "digest")
    banded = (sets.join(reps, ["id", "digest"]).select("id", F.posexplode("keys").alias("band", "key"))
              .distinct())
    sizes = banded.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    buckets = save(banded.join(sizes, "key"), "buckets")
    members = buckets.select("id").distinct()
    wanted = save(src.join(members, "id", "left_semi").filter(F.col("text").isNotNull())
                  .mapInArrow(_sets(width, n_hashes), "id long, shingles binary, minima binary"), "sets")

    # An intersection has at most the shingles that some other candidate shares
    # (``s``), which bounds the similarity of a pair and spares its comparison.
    lone = (wanted.mapInArrow(_shingle_rows, "shingle long, id long").groupBy("shingle")
            .agg(F.count("*").alias("df"), F.min("id").alias("id")).filter("df = 1").groupBy("id").agg(F.count("*").alias("u")))
    facts = save(wanted.groupBy("id").agg(F.min(F.octet_length("shingles") / 8).cast("long").alias("n"),
                                          F.max(F.octet_length("shingles") / 8).cast("long").alias("most"),
                                          (F.min(F.xxhash64("shingles")) == F.max(F.xxhash64("shingles"))).alias("one"))
                 .join(lone, "id", "left").select("id", "n", "one", (F.col("most") - F.coalesce("u", F.lit(0))).alias("s")), "facts")

    def possible(s, n_x, n_y):
        """Whether an intersection of ``s`` shingles would make a link."""
        return whole * s >= part * (n_x + n_y - s)

    known = buckets.select("key", "band", "id").join(facts, "id")
    least = known.groupBy("key").agg(F.min("n").alias("least"))
    known = known.join(least, "key").filter(possible(F.col("s"), F.col("n"), F.greatest("least", "s"))).drop("least")
    sizes = known.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    buckets = save(known.join(sizes, "key"), "buckets")

    labels = save(buckets.select("id").distinct().withColumn("comp", F.col("id")), "labels")
    # a member is a hub once its place in [0, 1) is below GROWTH**round / bucket size
    place = (F.xxhash64("id", "key").cast("double") / F.lit(2.0 ** 64)) + F.lit(0.5)
    left = wanted.select(F.col("id").alias("a"), F.col("shingles").alias("sa"), F.col("minima").alias("ma"))
    right = wanted.select(F.col("id").alias("b"), F.col("shingles").alias("sb"), F.col("minima").alias("mb"))

    def linked(near: DataFrame) -> DataFrame:
        """``labels`` after the pairs of members and hubs ``near`` are verified."""
        low = F.col("id") < F.col("hub_id")
        pairs = save(near.select(F.least("id", "hub_id").alias("a"), F.greatest("id", "hub_id").alias("b"),
                                 F.when(low, F.col("comp")).otherwise(F.col("hub_comp")).alias("ca"),
                                 F.when(low, F.col("hub_comp")).otherwise(F.col("comp")).alias("cb")
                                 ).distinct(), "pairs")
        if pairs.isEmpty():
            return labels
        links = (pairs.join(left, "a").join(right, "b").select("ca", "cb", "ma", "mb", "sa", "sb")
                 .mapInArrow(_verified(part, whole, floor), "ca long, cb long").distinct())
        roots = components(links.select(F.col("ca").alias("u"), F.col("cb").alias("v")))
        return save(labels.join(roots.withColumnRenamed("node", "comp"), "comp", "left")
                    .select("id", F.coalesce("root", "comp").alias("comp")), "labels")

    bucket_parts = F.greatest(F.lit(1), F.ceil(F.col("size") / PART_MEMBERS)).cast("int")

    def hubs_of(members: DataFrame, *columns: str) -> DataFrame:
        return members.select(*[F.col(c).alias(f"hub_{c}") for c in ("key", "id", "comp", "n", "s", *columns)],
                              F.explode(F.sequence(F.lit(0), bucket_parts - 1)).alias("hub_part"))

    def dealt(members: DataFrame) -> DataFrame:
        return members.withColumn("part", F.pmod(F.xxhash64("id"), bucket_parts).cast("int"))

    # the member with the least of its own is likely to be near to most; ties
    # fall alike in all buckets, so that their hubs are few
    central = F.min(F.struct(~F.col("one"), (1 - F.col("s") / F.col("n")).alias("own"), F.xxhash64("id").alias("tie"), "id",
                             "one", "n", "s")).alias("h")
    apart = ((F.col("key") == F.col("hub_key")) & (F.col("part") == F.col("hub_part"))
             & (F.col("comp") != F.col("hub_comp")))
    for bands in (F.col("band") < FIRST_BANDS, F.lit(True)):
        m = buckets.filter(bands).join(labels, "id")
        hubs = m.groupBy("key").agg(central, F.max("size").alias("size")).select("key", "size", "h.*").join(labels, "id")
        labels = linked(dealt(m).join(hubs_of(hubs), apart & possible(F.least("s", "hub_s"), F.col("n"), F.col("hub_n"))))

    def split(members: DataFrame) -> DataFrame:
        """Keys of the buckets that hold several components."""
        return (members.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                .filter("lo < hi").select("key"))

    # The rest is compared in ever more pairs, so their bound is made tighter.
    # With ``p`` shingles in common with the central member and ``rest`` shared
    # ones beside those, two members have at most the lesser p and the lesser
    # rest in common.  (An id with several texts has no p: ``s`` bounds both.)
    # A pair meets in the first of its common buckets alone.
    m = buckets.join(labels, "id")
    live = save(m.join(split(m), "key", "left_semi").drop("comp"), "live")
    centres = live.groupBy("key").agg(central).select("key", F.col("h.id").alias("b"), F.col("h.one").alias("sure"))
    live = live.join(centres, "key")
    common = (live.filter("one AND sure").select(F.col("id").alias("a"), "b").distinct().join(left, "a").join(right, "b")
              .select("a", "b", "sa", "sb").mapInArrow(_overlaps, "id long, b long, p long").distinct())
    shares = live.groupBy("id").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    live = save(live.join(common, ["id", "b"], "left").join(shares, "id")
                .select("key", "id", "n", "s", "size", "keys", place.alias("place"),
                        F.least("s", F.coalesce("p", "s")).alias("p"),
                        F.when(F.col("p").isNull(), F.col("s")).otherwise(F.greatest(F.lit(0), F.col("s") - F.col("p"))).alias("rest")),
                "live")
    most = F.least("s", "hub_s", F.least("p", "hub_p") + F.least("rest", "hub_rest"))
    later = F.struct("place", "id") > F.struct("hub_place", "hub_id")
    meet = F.element_at(F.array_intersect("keys", "hub_keys"), 1) == F.col("key")
    largest = live.agg(F.max("size")).first()[0] or 0
    for step in range(1, math.ceil(math.log(largest, GROWTH)) + 1 if largest else 0):
        m = save(live.join(labels, "id"), "live")
        open_keys = save(split(m), "open")
        if open_keys.isEmpty():
            break
        bound = F.lit(float(GROWTH ** step)) / F.col("size")
        earlier = bound / GROWTH if step > 1 else F.lit(0.0)
        hubs = hubs_of(m.filter((F.col("place") < bound) & (F.col("place") >= earlier)).join(open_keys, "key", "left_semi"),
                       "p", "rest", "place", "keys")
        labels = linked(dealt(m).join(hubs, apart & later & possible(most, F.col("n"), F.col("hub_n")) & meet))

    found = (classes.join(labels.withColumnRenamed("id", "rep"), "rep", "left")
             .select("digest", F.coalesce("comp", "rep").alias("comp")))
    return (prints.select("id", "n", "digest").join(found, "digest", "left")
            .select("id", F.col("n").alias("n_shingles"),
                    F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, F.col("comp"))
                           .otherwise(F.col("id"))).alias("component_id"))
            .withColumn("kept", F.col("id").isNull() | (F.col("component_id") == F.col("id"))))

"""Trie of conversation prefixes, rolled up by depth bands.

A node is a distinct sequence of first turns (role, text).  Subtree totals need
every node's ancestors; exploding each node to all of them costs the square of
the depth, and passing totals up level by level costs a round per level.  Depth
bands bound both: depths are cut into bands of ``height`` levels, a node
explodes only to the ancestors in its own band, and the totals of whole
subtrees then move from band to band through the band roots (one small round
per band).  A band root's completed total explodes to the ancestors in the band
above it, at most ``height`` rows.

A prefix is known by its depth and the sum of position-salted hashes of its
turns in three 40-bit lanes (120 bits), so a prefix costs a running sum, not a
growing text.  Positions and running sums are taken in two levels (blocks of
``BLOCK`` turn numbers, bands), so a very long conversation is not one window.

Defined cases: rows without a conversation id belong to no conversation; NULL
turn numbers come first; equal turn numbers are ordered by role, then text
(repeated rows keep their number of turns); NULL role or text is empty; an empty
table has no node at all; extra columns are ignored.  Conversations of more than
2^23 turns would overflow a lane and raise an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import save

HEIGHT = 32
#: Turn numbers of one window when turns get their positions.
BLOCK = 1024
#: Conversation ids of one chunk of a node's list of ends.
CHUNK = 4096
_LANE = (1 << 40) - 1
KEY = ["k1", "k2", "k3"]


def _same(left: list[str], right: list[str]):
    cond = F.lit(True)
    for a, b in zip(left, right):
        cond = cond & (F.col(a) == F.col(b))
    return cond


def _running(df: DataFrame, outer: list[str], block: str, order: list, values: list[str]) -> DataFrame:
    """Adds ``<value>_to``: the running sum of ``value`` within ``outer`` by
    (block, order), inclusive.  Sums per block, then inside each block."""
    so_far = Window.partitionBy(*outer).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    before = df.groupBy(*outer, block).agg(*[F.sum(v).alias(f"_s_{v}") for v in values])
    before = before.select(*[F.col(c).alias(f"_{c}") for c in [*outer, block]],
                           *[F.coalesce(F.sum(f"_s_{v}").over(so_far), F.lit(0)).alias(f"_b_{v}") for v in values])
    inside = Window.partitionBy(*outer, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    here = df.select("*", *[F.sum(v).over(inside).alias(f"_i_{v}") for v in values])
    joined = here.join(before, _same([*outer, block], [f"_{c}" for c in [*outer, block]]))
    return joined.select(*df.columns, *[(F.col(f"_i_{v}") + F.col(f"_b_{v}")).alias(f"{v}_to") for v in values])


def positions(messages: DataFrame) -> DataFrame:
    """``conv, pos, role, text`` with the 0-based position of every turn.

    ``messages`` has ``conv``, ``turn``, ``role`` and ``text``."""
    rows = messages.filter("conv IS NOT NULL").select(
        "conv", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.floor(F.col("turn") / BLOCK).cast("long"), F.lit(-(1 << 62))).alias("block"),
        F.lit(1).cast("long").alias("one"))
    # role and text order equal turn numbers alone
    order = [F.asc_nulls_first("turn"), "role", "text"]
    return _running(rows, ["conv"], "block", order, ["one"]).select(
        "conv", (F.col("one_to") - 1).alias("pos"), "role", "text")


def prefixes(turns: DataFrame, convs: DataFrame, *, height: int = HEIGHT) -> DataFrame:
    """``conv, depth, k1, k2, k3, bytes``: every prefix of every conversation.

    ``turns`` has ``conv``, ``pos`` (0-based, without gaps), ``role`` and
    ``text``; ``convs`` has ``conv``: each has the root prefix (depth 0, keys 0),
    turns or not."""
    h = [F.xxhash64(F.lit(seed), "pos", "role", "text") for seed in (1, 2)]
    t = turns.select("conv", (F.col("pos") + 1).alias("depth"), F.octet_length("text").cast("long").alias("bytes"),
                     h[0].alias("h1"), h[1].alias("h2"))
    lane = [F.col("h1").bitwiseAND(F.lit(_LANE)), F.col("h2").bitwiseAND(F.lit(_LANE)),
            F.shiftrightunsigned("h1", 40) * F.lit(1 << 16) + F.shiftrightunsigned("h2", 48)]
    t = t.select("conv", "depth", "bytes", F.floor(F.col("depth") / height).cast("long").alias("band"),
                 *[c.alias(k) for c, k in zip(lane, KEY)])
    t = _running(t, ["conv"], "band", ["depth"], KEY)
    t = t.select("conv", "depth", *[F.col(f"{k}_to").alias(k) for k in KEY], "bytes")
    zero = F.lit(0).cast("long")
    return t.union(convs.select("conv", zero.alias("depth"), *[zero.alias(k) for k in KEY], zero.alias("bytes")))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's ids, from its chunks in order; a node's chunks
    follow each other, in one or several batches, and only the state of the
    hash is kept between them."""
    at, state, first = None, None, True

    out: dict[str, list] = {c: [] for c in ("depth", *KEY, "sha")}

    def close():
        for c, v in zip(("depth", *KEY), at):
            out[c].append(v)
        out["sha"].append(state.hexdigest())

    for batch in batches:
        cols = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("depth", *KEY, "ids")]
        for *key, ids in zip(*cols):
            if key != at:
                if at is not None:
                    close()
                at, state, first = key, hashlib.sha256(), True
            state.update(("" if first else ",").encode() + ids.encode())
            first = False
        if len(out["sha"]) >= 4096:
            yield pa.RecordBatch.from_pydict(out)
            out = {c: [] for c in out}
    if at is not None:
        close()
    if out["sha"]:
        yield pa.RecordBatch.from_pydict(out)


def ends(keyed: DataFrame, lengths: DataFrame) -> DataFrame:
    """``depth, k1, k2, k3, sha``: the digest of the ascending ids of the
    conversations that end at a node.  Ids are packed into chunks of at most
    ``CHUNK`` neighbouring ids first, so a node where very many conversations end
    is a few rows, and its digest is a stream over them."""
    last = keyed.join(lengths.select(F.col("conv").alias("_c"), F.col("n").alias("_n")),
                      (F.col("conv") == F.col("_c")) & (F.col("depth") == F.col("_n")))
    chunk = F.floor(F.col("conv") / CHUNK).cast("long")
    chunks = (last.groupBy("depth", *KEY, chunk.alias("chunk"))
              .agg(F.array_join(F.sort_array(F.collect_list("conv")), ",").alias("ids")))
    return (chunks.repartition("depth", *KEY).sortWithinPartitions("depth", *KEY, "chunk")
            .mapInArrow(_digests, "depth long, k1 long, k2 long, k3 long, sha string"))


def trie(turns: DataFrame, convs: DataFrame, *, height: int = HEIGHT) -> DataFrame:
    """One row per node of the trie of the conversations ``convs`` (``conv``,
    distinct) with the turns ``turns`` (``conv, pos, role, text``).

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (root: NULL),
    ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes of the subtree),
    ``saved_tokens`` (over the subtree, (n_convs - 1) times the bytes of the
    node's last text) and ``ends_sha256``.  Ids are integers."""
    keyed = save(prefixes(turns, convs, height=height), "trie-prefixes")
    band = lambda c: F.floor(F.col(c) / height).cast("long")
    nodes = save(keyed.groupBy("depth", *KEY).agg(F.min("conv").alias("rep"), F.count("*").alias("n_convs"),
                                                  F.max("bytes").alias("bytes")), "trie-nodes")
    # the path of a node's smallest member passes through all its ancestors
    path = keyed.select(F.col("conv").alias("p_conv"), F.col("depth").alias("p_depth"),
                        *[F.col(k).alias(f"p_{k}") for k in KEY])
    parents = (nodes.filter("depth > 0")
               .join(path, (F.col("rep") == F.col("p_conv")) & (F.col("depth") - 1 == F.col("p_depth"))))
    children = parents.groupBy("p_depth", *[f"p_{k}" for k in KEY]).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, _same(["depth", *KEY], ["p_depth", *[f"p_{k}" for k in KEY]]), "left").select(
        "depth", *KEY, "rep", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("own"), "bytes")
    nodes = save(nodes, "trie-nodes")

    def rolled(rows: DataFrame, where) -> DataFrame:
        """Sums of ``leaves`` and ``saved`` of ``rows`` (rep, depth) at the ancestors of ``where``."""
        return (rows.join(path, (F.col("rep") == F.col("p_conv")) & where)
                .groupBy(F.col("p_depth").alias("depth"), *[F.col(f"p_{k}").alias(k) for k in KEY])
                .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))

    leaf = (F.col("n_children") == 0).cast("long")
    plain = nodes.select("rep", "depth", leaf.alias("leaves"), F.col("own").alias("saved"), band("depth").alias("band"))
    inside = save(rolled(plain, (band("p_depth") == F.col("band")) & (F.col("p_depth") <= F.col("depth"))), "trie-band")
    bands = nodes.agg(F.max(band("depth"))).first()[0] or 0
    total = inside
    if bands:
        # band roots with the band root above them, deepest band first
        top = inside.filter((F.col("depth") > 0) & (F.col("depth") % height == 0)).join(
            nodes.select(*[F.col(c).alias(f"n_{c}") for c in ("depth", *KEY)], "rep"),
            _same(["depth", *KEY], [f"n_{c}" for c in ("depth", *KEY)]))
        top = top.join(path, (F.col("rep") == F.col("p_conv")) & (F.col("depth") - height == F.col("p_depth")))
        top = save(top.select("depth", *KEY, "rep", "leaves", "saved", *[F.col(f"p_{k}").alias(f"u_{k}") for k in KEY]),
                   "trie-roots")
        done, below = [], None
        for b in range(bands, 0, -1):
            here = top.filter(F.col("depth") == b * height)
            if below is not None:
                more = below.groupBy(*[F.col(f"u_{k}").alias(f"m_{k}") for k in KEY]).agg(
                    F.sum("leaves").alias("m_leaves"), F.sum("saved").alias("m_saved"))
                here = here.join(more, _same(KEY, [f"m_{k}" for k in KEY]), "left").select(
                    "depth", *KEY, "rep", *[(F.col(c) + F.coalesce(f"m_{c}", F.lit(0))).alias(c) for c in ("leaves", "saved")],
                    *[f"u_{k}" for k in KEY])
            below = save(here, "trie-round")
            done.append(below)
        whole = done[0]
        for d in done[1:]:
            whole = whole.union(d)
        above = rolled(whole.select("rep", "depth", "leaves", "saved"),
                       band("p_depth") == band("depth") - 1)
        total = inside.union(above.select(inside.columns)).groupBy("depth", *KEY).agg(
            F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))

    reps = nodes.select(*[F.col(c).alias(f"q_{c}") for c in ("depth", *KEY)], F.col("rep").alias("parent"))
    lengths = keyed.groupBy("conv").agg(F.max("depth").alias("n"))
    digests = ends(keyed, lengths).select(*[F.col(c).alias(f"e_{c}") for c in ("depth", *KEY)], "sha")
    up = parents.select(*[F.col(c).alias(f"c_{c}") for c in ("depth", *KEY)], "p_depth", *[f"p_{k}" for k in KEY])
    up = up.join(reps, _same(["p_depth", *[f"p_{k}" for k in KEY]], [f"q_{c}" for c in ("depth", *KEY)])).select(
        *[f"c_{c}" for c in ("depth", *KEY)], "parent")
    own = ["depth", *KEY]
    total = total.select(*[F.col(c).alias(f"t_{c}") for c in own], "leaves", "saved")
    out = (nodes.join(total, _same(own, [f"t_{c}" for c in own]))
           .join(up, _same(own, [f"c_{c}" for c in own]), "left")
           .join(digests, _same(own, [f"e_{c}" for c in own]), "left"))
    return out.select(
        F.col("rep").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def branched(turns: DataFrame) -> DataFrame:
    """Conversations rebuilt to share beginnings: ``conv`` c gets the first h
    turns of conversation c - c % 5 (all if fewer, none if absent), then its own
    turns after its first h; h = unsigned crc32 of the decimal id, mod 9.

    ``turns`` has ``conv, pos, role, text``; so has the result."""
    shared = 9
    counts = turns.groupBy("conv").agg(F.count("*").alias("n"))
    plan = counts.select(F.col("conv").alias("c"), (F.col("conv") - F.col("conv") % 5).alias("base"),
                         (F.crc32(F.col("conv").cast("string")) % shared).alias("h"))
    sizes = counts.select(F.col("conv").alias("b"), F.col("n").alias("nb"))
    plan = plan.join(sizes, F.col("base") == F.col("b"), "left").select(
        "c", "base", "h", F.least(F.col("h"), F.coalesce("nb", F.lit(0))).alias("taken"))
    heads = turns.filter(F.col("pos") < shared)
    first = plan.join(heads, (F.col("base") == F.col("conv")) & (F.col("pos") < F.col("h"))).select(
        F.col("c").alias("conv"), "pos", "role", "text")
    rest = turns.join(plan, (F.col("conv") == F.col("c")) & (F.col("pos") >= F.col("h"))).select(
        "conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "role", "text")
    return first.union(rest)

"""Chat formatting of reply trees.

Messages form trees by their parent.  Iterative self-joins double the jump
of every message that has not reached its root (parent, grandparent, 4th, 8th
ancestor ...), so a thread of n replies takes log n joins.  Leaves are ranked by the score of their branch,
the chosen leaves are expanded through the same jump tables into their
root-to-leaf paths, and each path becomes one formatted conversation.

Template of a turn: ``### <role>: <text></turn>\\n``.  Inside roles and texts a
backslash precedes every backslash and every ``#``, and parts every ``</``
(roles also escape ``:``), so no control string can occur inside them, and
dropping one backslash of each pair restores the original.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import save

OPEN, AFTER_ROLE, CLOSE = "### ", ": ", "</turn>\n"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("#"), F.lit("\\#"))
    return F.replace(out, F.lit("</"), F.lit("<\\/"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\:"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    turns = []
    for turn in formatted.split(CLOSE)[:-1]:
        m = re.match(r"### ((?:[^\\:]|\\.)*): ", turn, flags=re.S)
        turns.append((unescape(m[1]), unescape(turn[m.end():])))
    return turns


def _key(c: Column) -> Column:
    """A never-NULL key, NULL apart from every value."""
    return F.when(c.isNull(), "n").otherwise(F.concat(F.lit("v"), c.cast("string")))


def nodes_of(messages: DataFrame) -> DataFrame:
    """``conv, node, id, up, role, text, score``: every differing row is a node of
    its own, also with a NULL id or one that other rows carry; ``up`` is its
    parent's node (of several rows with the parent's id the one with the least
    hash), NULL for a root.  ``conv``, ``id`` and ``parent`` are keys of ``_key``."""
    given = ["conv", "id", "parent", "role", "text", "score"]
    node = F.xxhash64("id", *[x for c in given[2:] for x in (c, F.col(c).isNull())])
    rows = save(messages.select(*given, node.alias("node")).groupBy("conv", "node")
                .agg(*[F.min(c).alias(c) for c in given[1:]]), "nodes")
    known = rows.groupBy(F.col("conv").alias("c"), F.col("id").alias("p")).agg(F.min("node").alias("up"))
    return save(rows.join(known, (F.col("conv") == F.col("c")) & (F.col("parent") == F.col("p")), "left")
                .select("conv", "node", "id", "up", "role", "text", F.coalesce("score", F.lit(0.0)).alias("score")), "nodes")


def _climbed(nodes: DataFrame, rounds: int) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """Every node's depth, branch score and root by doubled jumps: the settled
    nodes, the jump tables, and what is still climbing after ``rounds`` (nodes
    whose parents run in a circle) with ``least``, the smallest (id, node) that
    they have passed."""
    first = save(nodes.select("conv", "node", "id", "up", F.col("up").isNotNull().cast("long").alias("depth"), "score",
                              F.coalesce("up", "node").alias("root"), F.struct("id", "node").alias("least")), "jump")
    # depth, score and root so far cover the messages up to `up`; messages that
    # have reached their root leave the joins
    done, climbing, jumps = first.filter("up IS NULL"), first.filter("up IS NOT NULL"), []
    for _ in range(rounds):
        if climbing.isEmpty():
            break
        jumps.append(climbing)
        far = done.union(climbing).select(
            F.col("conv").alias("c"), F.col("node").alias("i"), F.col("up").alias("up2"), F.col("depth").alias("d2"),
            F.col("score").alias("s2"), F.col("root").alias("r2"), F.col("least").alias("l2"))
        step = save(climbing.join(far, (F.col("conv") == F.col("c")) & (F.col("up") == F.col("i")))
                    .select("conv", "node", "id", F.col("up2").alias("up"), (F.col("depth") + F.col("d2")).alias("depth"),
                            (F.col("score") + F.col("s2")).alias("score"), F.col("r2").alias("root"),
                            F.least("least", "l2").alias("least")), "jump")
        done, climbing = done.union(step.filter("up IS NULL")), step.filter("up IS NOT NULL")
    return done, jumps, climbing


def without_circles(nodes: DataFrame, stuck: DataFrame) -> DataFrame:
    """``nodes`` with every circle opened at its smallest (id, node), which becomes
    a root.  ``stuck`` climbed further than any circle is long, so the nodes that
    its jumps reach are those on circles, and ``least`` is a circle's smallest."""
    on = stuck.select(F.col("conv").alias("c"), F.col("up").alias("i")).distinct()
    tops = (stuck.join(on, (F.col("conv") == F.col("c")) & (F.col("node") == F.col("i")))
            .filter(F.col("least.node") == F.col("node")).select(F.col("conv").alias("top_conv"), F.col("node").alias("top")))
    joined = nodes.join(tops, (F.col("conv") == F.col("top_conv")) & (F.col("node") == F.col("top")), "left")
    return save(joined.select("conv", "node", "id", F.when(F.col("top").isNull(), F.col("up")).alias("up"),
                              "role", "text", "score"), "nodes")


def best_paths(nodes: DataFrame, *, branches: int = 1) -> DataFrame:
    """``conv, leaf, leaf_node, place, node`` of the chosen root-to-leaf paths.

    A node without a parent, or whose parent is missing, is a root, and so is
    the smallest id of a circle of parents.  Of every root the ``branches``
    leaves with the highest sum of scores stay (NULL: 0; ties: the longer
    branch, then the smaller leaf id)."""
    longest = nodes.groupBy("conv").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    done, jumps, stuck = _climbed(nodes, longest.bit_length() + 1)
    if not stuck.isEmpty():
        nodes = without_circles(nodes, stuck)
        done, jumps, _ = _climbed(nodes, longest.bit_length() + 1)
    parents = nodes.filter("up IS NOT NULL").select("conv", F.col("up").alias("node")).distinct()
    leaves = done.join(parents, ["conv", "node"], "left_anti")
    order = Window.partitionBy("conv", "root").orderBy(F.desc("score"), F.desc("depth"), "id", "node")
    chosen = leaves.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= branches)
    path = chosen.select("conv", F.col("id").alias("leaf"), F.col("node").alias("leaf_node"), "node", F.col("depth").alias("place"))
    for k, step in enumerate(jumps):
        up = step.select(F.col("conv").alias("c"), F.col("node").alias("i"), "up")
        above = (path.join(up, (F.col("conv") == F.col("c")) & (F.col("node") == F.col("i")))
                 .select("conv", "leaf", "leaf_node", F.col("up").alias("node"), (F.col("place") - 2 ** k).alias("place")))
        path = save(path.union(above), "path")
    return path


def format_paths(nodes: DataFrame, paths: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """``conv, leaf, formatted, loss`` (array of start, end in code points of the
    formatted text: the escaped texts of ``loss_role``)."""
    own = nodes.select("conv", "node", "role", "text")
    t = paths.join(own, ["conv", "node"]).select(
        "conv", "leaf", "leaf_node", "place", "role",
        F.concat(F.lit(OPEN), escape_role(F.coalesce("role", F.lit(""))), F.lit(AFTER_ROLE)).alias("head"),
        escape(F.coalesce("text", F.lit(""))).alias("body"))
    t = t.withColumn("turn", F.concat("head", "body", F.lit(CLOSE)))
    by = ["conv", "leaf", "leaf_node"]
    run = Window.partitionBy(*by).orderBy("place")
    t = t.withColumn("start", F.sum(F.length("turn").cast("long")).over(run) - F.length("turn") + F.length("head"))
    loss = F.when(F.col("role") == loss_role, F.struct("start", (F.col("start") + F.length("body")).alias("end")))
    t = t.select(*by, F.struct("place", "turn", loss.alias("loss")).alias("t"))
    return (t.groupBy(*by).agg(F.sort_array(F.collect_list("t")).alias("turns"))
            .select("conv", "leaf", F.array_join("turns.turn", "").alias("formatted"),
                    F.filter("turns.loss", lambda x: x.isNotNull()).alias("loss")))


def conversations(messages: DataFrame, *, branches: int = 1, loss_role: str = "assistant") -> DataFrame:
    """Formatted conversations of ``messages`` (conv, id, parent, role, text,
    score): ``conv, leaf, formatted, loss``, one row per chosen path.

    NULL texts and roles count as empty; a NULL conv is a conversation of its
    own; rows with a NULL id, and differing rows of one id, are messages of
    their own (replies to that id go to one of them); rows equal in all these
    columns are one message; parents that run in a circle start at its
    smallest id; other columns are not read; very long threads take log n
    joins; an empty table gives no rows.  ``conv`` keeps its type, ``leaf`` is a
    string.
    """
    m = messages.select(_key(F.col("conv")).alias("conv"), F.col("conv").alias("given"), _key(F.col("id")).alias("id"),
                        F.when(F.col("parent").isNotNull(), _key(F.col("parent"))).alias("parent"),
                        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
                        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    kind = m.schema["given"].dataType
    nodes = nodes_of(m)
    out = format_paths(nodes, best_paths(nodes, branches=branches), loss_role)
    return out.withColumn("conv", F.when(F.substring("conv", 1, 1) == "v", F.expr("substring(conv, 2)")).cast(kind))


def chain(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
          role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Messages of plain conversations: each turn replies to the one before.
    Rows with equal turns follow each other by role and text; NULL turns first."""
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    t = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
                    F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    t = t.withColumn("id", F.row_number().over(order))
    return t.select("conv", "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), "role", "text",
                    F.lit(0.0).alias("score"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
    for batch in batches:
        n, turns, chars, loss, length = [], [], [], [], []
        for formatted, spans in zip(batch.column("formatted"), batch.column("loss")):
            text = formatted.as_py()
            back = parse(text)
            learned = "".join(unescape(text[s["start"]:s["end"]]) for s in spans.as_py())
            n.append(len(back))
            turns.append(sha("".join(f"{r}\n{t}\n" for r, t in back)))
            chars.append(len(learned))
            loss.append(sha(learned))
            length.append(len(text))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), pa.array(n, pa.int64()), pa.array(turns, pa.string()), pa.array(chars, pa.int64()),
             pa.array(loss, pa.string()), pa.array(length, pa.int64())],
            names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of formatted conversations, from the formatted text alone."""
    kind = formatted.schema["conv"].dataType.simpleString()
    return formatted.select("conv", "formatted", "loss").mapInArrow(
        _digests, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")

"""Token counts by a two-tier lookup of pre-tokens.

Byte-level BPE encodes each pre-token by itself, so a text has the sum of its
pre-tokens' lengths.  Tier one is a broadcast table of the most frequent
pre-tokens of the corpus with their lengths; tier two is a cache in each
Python worker, which asks the tokenizer for what it misses.  Pre-tokens are
never shuffled: for tier one every map task sends only its own
``LOCAL_TOP`` heaviest pre-tokens.
"""

from __future__ import annotations

import heapq
import json
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Heaviest pre-tokens a map task reports, and entries of the broadcast table.
LOCAL_TOP, TABLE_SIZE = 2_000, 16_384
#: Entries of a worker's cache; it is emptied when full (speed only).
CACHE_SIZE = 500_000
#: Distinct pre-tokens a map task counts at once; beyond it the lighter half
#: of the counts is forgotten (the table only steers speed).
COUNT_SIZE = 200_000

#: Fixed value: how byte-level BPE of this vocabulary family splits text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Lengths(dict):
    """pre-token -> number of tokens; starts with the broadcast table."""

    def __init__(self, table: dict[str, int], tokenizer) -> None:
        super().__init__(table)
        self.table, self.tokenizer = table, tokenizer

    def __missing__(self, piece: str) -> int:
        if len(self) >= CACHE_SIZE:
            self.clear()
            self.update(self.table)
        n = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        self[piece] = n
        return n


def splitter(path: str):
    """text -> (pieces, number of special tokens), as the tokenizer file at
    ``path`` splits a text: special strings first (they count one token
    each), the rest by the byte-level pattern."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    added = spec.get("added_tokens") or []
    if (spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space")
            or any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added)):
        raise ValueError(f"{path}: not a plain byte-level BPE; its pieces are not independent")
    special = [t["content"] for t in added]
    parts = regex.compile(PATTERN).findall
    cut = regex.compile("|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None

    def split(text: str) -> tuple[list[str], int]:
        if cut is None:
            return parts(text), 0
        spans = cut.split(text)
        if len(spans) == 1:
            return parts(text), 0
        return [p for s in spans for p in parts(s)], len(spans) - 1
    return split


def _heaviest(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, counts = splitter(path), Counter()
        for batch in batches:
            for text in batch.column(0):
                counts.update(split(text.as_py() or "")[0])
                if len(counts) > COUNT_SIZE:
                    counts = Counter(dict(counts.most_common(COUNT_SIZE // 2)))
        top = heapq.nlargest(LOCAL_TOP, counts.items(), key=lambda x: (x[1], x[0]))
        yield pa.RecordBatch.from_pydict({"piece": [p for p, _ in top], "n": [n for _, n in top]},
                                         schema=pa.schema([("piece", pa.string()), ("n", pa.int64())]))
    return run


def frequent_pieces(texts: DataFrame, path: str) -> list[str]:
    """The at most ``TABLE_SIZE`` heaviest pre-tokens over all texts."""
    local = texts.mapInArrow(_heaviest(path), "piece string, n long")
    top = local.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(TABLE_SIZE)
    return [r.piece for r in top.collect()]


def _count(path: str, table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer
        split = splitter(path)
        lengths = Lengths(table.value, Tokenizer.from_file(path)).__getitem__
        for batch in batches:
            out = []
            for text in batch.column("text"):
                pieces, special = split(text.as_py() or "")
                out.append(sum(map(lengths, pieces)) + special)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_bytes"), pa.array(out, pa.int64())],
                names=["id", "n_bytes", "n_tokens"])
    return run


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", *,
                 limit: int = 512) -> DataFrame:
    """One row per input row: ``id``, ``n_bytes``, ``n_tokens``, ``over_limit``
    (more than ``limit`` tokens).

    ``path`` names a byte-level BPE file for ``tokenizers``, installed on
    every worker.  Counts are those of ``encode(text,
    add_special_tokens=False)`` on the whole text.  NULL and empty texts have
    0 bytes and 0 tokens; a NULL id stays NULL; repeated rows are counted
    each; other columns are not read; an empty table gives no rows.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    pieces = frequent_pieces(src.select("text"), path)
    tok = Tokenizer.from_file(path)
    sizes = [len(e.ids) for e in tok.encode_batch(pieces, add_special_tokens=False)] if pieces else []
    table = spark.sparkContext.broadcast(dict(zip(pieces, sizes)))
    kind = src.schema["id"].dataType.simpleString()
    return (src.select("id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
            .mapInArrow(_count(path, table), f"id {kind}, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))

"""The registered queries of the numbered operators: each applies its
operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, hard_negatives, html_text, mixing, near_dedup, prefix_trie, quality, secrets, sharding, token_counts, toxicity, warc
from .common import save, table


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of ``documents``: 3-word shingles, 85 % similarity."""
    out = near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=3, part=85, whole=100)
    return out.withColumnRenamed("id", "doc_id")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back through the index;
    a revisit gets its payload's size from the response with its digest."""
    folder = warc.archive_folder(spark)
    index = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    back = warc.read_records(index, folder)          # checks each response's digests
    number = lambda c: F.regexp_extract(c, "([0-9-]+)>$", 1).try_cast("long")
    # one response stands for a digest; sizes of 0 are equal payloads too
    back = back.select(number("record_id").alias("page_id"), "record_type", F.col("digest").alias("payload_digest"),
                       number("refers_to").alias("refers_to"),
                       F.when(F.col("record_type") == "response", F.octet_length("payload").cast("long")).alias("own"))
    full = (back.filter("record_type = 'response'").groupBy(F.col("payload_digest").alias("d"))
            .agg(F.max("own").alias("bytes")))
    return (back.join(full, F.col("payload_digest") == F.col("d"), "left")
            .select("page_id", F.coalesce("own", "bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the target weights of their sources."""
    out = mixing.mix(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of equal counts, equal texts together."""
    return sharding.shard(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    out = secrets.scan(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_assign", "n_access", "n_hex",
                      F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans", "n_markov")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality verdict on all documents, against references of labelled good ones."""
    docs = table(spark, sf_dir, "documents")
    out = quality.judge(docs, references=quality.labelled_references(docs, table(spark, sf_dir, "labels")))
    return out.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents by byte_bpe_50k.json."""
    import public_tokenizers

    out = token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.withColumnRenamed("id", "doc_id")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document contains, over all documents."""
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -7, formatted and read back."""
    probe = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)],
                                 "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(more)
    return chat.read_back(chat.conversations(chat.chain(rows)))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learnt from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), "toxic")
    model = toxicity.fit(toxicity.labelled_sample(docs, labels))
    return toxicity.score(docs, model).withColumnRenamed("id", "doc_id")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th vector among all vectors."""
    e = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = e.select(F.col("vec_id").alias("id"), label.alias("label"), F.col("embedding").alias("vector"))
    out = hard_negatives.mine(rows, F.col("id") % 50 == 0)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of the prefixes of all conversations, rebuilt to share beginnings."""
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("conv"), "turn", "role", "text")
    turns = save(prefix_trie.positions(rows), "turns")
    convs = turns.select("conv").distinct()
    return prefix_trie.trie(prefix_trie.branched(turns), convs)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    found = [op1_near_dedup, op2_warc, op3_html_text, op4_mixing, op5_sharding, op6_secrets, op7_quality,
             op8_token_counts, op9_decontamination, op10_chat, op11_toxicity, op12_hard_negatives,
             op13_prefix_trie]
    return {f.__name__: f for f in found} | {"pipeline": corpus_pipeline.run}


#: DuckDB SQL.  Sources, budgets and hashes of the mix: the running sum of
#: words in hash order tells which documents a threshold takes.
MIXING_SQL = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM d GROUP BY source),
c AS (  -- the level at which the k sources that fill up first are full
  SELECT a.source, a.source_size, a.w,
         (SELECT (SELECT sum(source_size) FROM s)
                 - coalesce(sum(3 * b.source_size) FILTER (3 * b.source_size / b.w < 3 * a.source_size / a.w), 0) FROM s b)
         / (SELECT sum(b.w) FROM s b WHERE 3 * b.source_size / b.w >= 3 * a.source_size / a.w) AS level
  FROM s a),
t AS (
  SELECT source, source_size,
         least(3.0 * source_size, w * (SELECT min_by(level, 3 * source_size / w) FROM c WHERE level <= 3 * source_size / w)) AS target
  FROM c),
q AS (
  SELECT source, source_size, target, coalesce(floor(target / nullif(source_size, 0)), 0)::INT AS whole FROM t),
r AS (
  SELECT d.doc_id, d.source, d.size, q.source_size, q.target, q.whole, q.target - q.whole * q.source_size AS budget,
         sum(size) OVER (PARTITION BY d.source ORDER BY h) AS upto,
         sum(size) OVER (PARTITION BY d.source, h) AS tied
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target, source,
       least(whole + CASE WHEN upto <= budget OR (upto - tied <= budget AND 2 * (budget - (upto - tied)) >= tied AND tied > 0)
                          THEN 1 ELSE 0 END, 3)::INT AS copies,
       (size * least(whole + CASE WHEN upto <= budget OR (upto - tied <= budget AND 2 * (budget - (upto - tied)) >= tied AND tied > 0)
                                  THEN 1 ELSE 0 END, 3))::BIGINT AS taken
FROM r
"""


#: DuckDB SQL.  All scores of all anchors, ranked twice.
NEGATIVES_SQL = """
WITH e AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.id AS anchor_id, a.label = b.label AS same, b.id,
         list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i]))::BIGINT AS score
  FROM e a JOIN e b ON a.id <> b.id WHERE a.id % 50 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT p.anchor_id, positive_id, positive_score, s.id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id)::INT AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
       AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""

#: DuckDB SQL.  Prefixes by growing digests, subtrees by membership: a node
#: lies below every prefix of its smallest member that is not longer than it.
TRIE_SQL = """
WITH tab AS (  -- CRC-32 of each byte
  SELECT list(v ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)),
                          lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) r(i))),
t AS (
  SELECT conv_id AS conv, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT conv, count(*) AS n FROM t GROUP BY conv),
c AS (
  SELECT conv, conv - conv % 5 AS base, conv::VARCHAR AS s,
         xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(conv::VARCHAR) + 1), lambda k: ascii(substr(conv::VARCHAR, k, 1)))),
                         lambda a, b: xor(tab[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % 9 AS h
  FROM n, tab),
p AS (SELECT c.conv, base, h, least(h, coalesce(n.n, 0)) AS taken FROM c LEFT JOIN n ON n.conv = c.base),
rb AS (
  SELECT p.conv, t.pos, r, x FROM p JOIN t ON t.conv = p.base AND t.pos < p.h
  UNION ALL
  SELECT p.conv, t.pos - h + taken, r, x FROM p JOIN t ON t.conv = p.conv AND t.pos >= p.h),
k AS (
  SELECT conv, pos + 1 AS depth, strlen(x)::BIGINT AS bytes,
         md5(string_agg(md5(strlen(r)::VARCHAR || ':' || r || x), '') OVER (PARTITION BY conv ORDER BY pos)) AS key FROM rb
  UNION ALL SELECT conv, 0, 0, '' FROM n),
nodes AS (SELECT depth, key, min(conv) AS rep, count(*) AS n_convs, max(bytes) AS bytes FROM k GROUP BY depth, key),
par AS (SELECT m.depth, m.key, k.key AS up FROM nodes m JOIN k ON k.conv = m.rep AND k.depth = m.depth - 1),
kids AS (SELECT depth - 1 AS depth, up AS key, count(*) AS n FROM par GROUP BY 1, 2),
full_nodes AS (
  SELECT m.*, coalesce(kids.n, 0) AS n_children FROM nodes m LEFT JOIN kids ON kids.depth = m.depth AND kids.key = m.key),
sub AS (
  SELECT a.depth, a.key, count(*) FILTER (d.n_children = 0) AS n_leaves, sum((d.n_convs - 1) * d.bytes) AS saved
  FROM full_nodes d JOIN k a ON a.conv = d.rep AND a.depth <= d.depth GROUP BY a.depth, a.key),
last AS (
  SELECT k.depth, k.key, sha256(string_agg(k.conv::VARCHAR, ',' ORDER BY k.conv)) AS sha
  FROM k JOIN (SELECT conv, max(depth) AS depth FROM k GROUP BY conv) e ON e.conv = k.conv AND e.depth = k.depth
  GROUP BY k.depth, k.key)
SELECT m.rep::BIGINT AS conv_id, m.depth::BIGINT AS depth, q.rep::BIGINT AS parent_conv_id, m.n_convs::BIGINT AS n_convs,
       m.n_children::BIGINT AS n_children, sub.n_leaves::BIGINT AS n_leaves, sub.saved::BIGINT AS saved_tokens,
       coalesce(last.sha, sha256('')) AS ends_sha256
FROM full_nodes m JOIN sub ON sub.depth = m.depth AND sub.key = m.key
LEFT JOIN par ON par.depth = m.depth AND par.key = m.key
LEFT JOIN nodes q ON q.depth = m.depth - 1 AND q.key = par.up
LEFT JOIN last ON last.depth = m.depth AND last.key = m.key
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_mixing": MIXING_SQL, "op12_hard_negatives": NEGATIVES_SQL, "op13_prefix_trie": TRIE_SQL}

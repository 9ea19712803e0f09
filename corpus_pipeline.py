"""The corpus pipeline: quality rules, near-dedup, benchmark decontamination,
mixing, sharding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and reread as the next stage's documents.  All but the last
return the columns of ``documents``.  Extra columns are carried through, whatever
their names.

Every stage decides by row, whatever other rows carry the row's id, also for
NULL ids.  A row is known by a 64-bit hash of all its columns; rows that are equal
in every column are one row to the decisions (two different rows share a hash with
a probability of 2^-64).  An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.llm import decontaminate, mixing, near_dedup, quality, sharding
from feedlens.llm.common import save, table


def _unused(docs: DataFrame, name: str) -> str:
    """``name``, changed until no column has it."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a hash of each row's columns, and the name of that column.
    NULLs count, so a value in another column gives another hash."""
    key = _unused(docs, "row_key")
    cols = [F.map_entries(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`")
            for f in docs.schema.fields]
    return docs.withColumn(key, F.xxhash64(*cols, *[c.isNull() for c in cols])), key


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the divergence test, whose
    references come from the labelled documents of ``sf_dir``.  NULL and empty
    texts fail the base rules; repeated rows share their verdict."""
    keyed, key = _keyed(docs)
    known = quality.labelled_references(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    good = quality.judge(keyed, key, references=known).filter("kept").select(F.col("id").alias("good")).distinct()
    return keyed.join(good, keyed[key] == good["good"], "left_semi").drop(key)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8): the row
    with the smallest id, a NULL id last, and of several such rows one.  A text
    that is similar to no other stays, also if its id has other texts; a NULL or
    empty text is similar to nothing, and a repeated row stays once."""
    keyed, key = _keyed(docs)
    v = near_dedup.near_duplicates(keyed, key, "text", width=5, part=80, whole=100)
    # one row per node, and how often its row is repeated
    v = save(v.groupBy("id").agg(F.min("component_id").alias("component"), F.count("*").alias("n")), "dedup")
    ids = keyed.select(F.col(key).alias("k"), "doc_id").distinct()
    best = (v.join(ids, v["id"] == ids["k"]).groupBy("component")
            .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "id", "n")).alias("x")))
    best = save(best.select(F.col("x.id").alias("best"), F.col("x.n").alias("times")), "kept")
    out = keyed.join(best.select("best"), keyed[key] == best["best"], "left_semi")
    repeated = best.filter("times > 1").select("best")
    if not repeated.isEmpty():                   # repeated rows: one of each
        once = out.join(repeated, out[key] == repeated["best"], "left_anti")
        more = out.join(repeated, out[key] == repeated["best"], "left_semi")
        out = once.unionByName(more.dropDuplicates([key]))
    return out.drop(key)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item.  A NULL or empty text contains
    none; repeated rows share their verdict."""
    keyed, key = _keyed(docs)
    hits = decontaminate.contained_items(keyed, table(spark, sf_dir, "benchmark"), key)
    bad = hits.select(F.col("doc_id").alias("bad")).distinct()
    return keyed.join(bad, keyed[key] == bad["bad"], "left_anti").drop(key)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it (0 to 3 rows), so that each
    source's words come near its target.  A NULL source is a source of its own; a
    NULL or empty text has no words and is taken like others of its hash; repeated
    rows are taken alike."""
    keyed, key = _keyed(docs)
    v = mixing.mix(keyed, key, "text", "source").groupBy("id").agg(F.min("copies").alias("copies"))
    copies = _unused(keyed, "copies")
    v = v.select(F.col("id").alias("taken_id"), F.col("copies").alias(copies)).filter(F.col(copies) > 0)
    out = keyed.join(v, keyed[key] == v["taken_id"]).select(*[keyed[f"`{c}`"] for c in keyed.columns], v[copies])
    again = _unused(out, "again")
    return (out.withColumn(again, F.explode(F.sequence(F.lit(1), F.col(copies))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every row, repeated rows and rows with a NULL id or
    text included."""
    return sharding.shard(docs).withColumnRenamed("id", "doc_id")


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates),
          ("benchmark decontamination", decontamination), ("mixing", mix), ("sharding", shards)]

#: SQL cannot express MinHash components or label propagation; the tests hold
#: the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs

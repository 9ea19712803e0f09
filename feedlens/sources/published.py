"""Tables whose parts (days, blocks, hours) are replaced in one visible step.

A part is written to a folder of its own, which no reader looks at; then one
small manifest file, made only if it does not exist yet, names the current
folder of every part.  Readers follow the newest complete manifest, so they see
a part as it was or as it is, never half of it, and a job that dies between
writing and publishing leaves the table as it was.  Two writers that publish at
once cannot lose each other's parts: the one whose manifest already exists
reads it and tries again.

    <path>/data/<run>/part=<value>/...      rows
    <path>/manifests/<number>.json          {"parts": {value: folder}}

Files go through Hadoop's file system API, so any store Spark can write works
that creates a file only once if asked to.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_PART = "__part"


class Conflict(RuntimeError):
    """A part changed between reading it and publishing what was made of it."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str) -> list[int]:
    jvm, fs = _fs(spark, path)
    folder = jvm.org.apache.hadoop.fs.Path(f"{path}/manifests")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _manifest(spark: SparkSession, path: str, number: int) -> dict | None:
    """Manifest ``number``; None if its writer died while writing it."""
    jvm, fs = _fs(spark, path)
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(f"{path}/manifests/{number:012d}.json"))
    try:
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        return json.loads(text)
    except ValueError:
        return None


def parts(spark: SparkSession, path: str) -> dict[str, str]:
    """Folder of every part of the table, empty if there is no table yet."""
    for number in reversed(_numbers(spark, path)):
        found = _manifest(spark, path, number)
        if found is not None:
            return found["parts"]
    return {}


def _commit(spark: SparkSession, path: str, changes: dict[str, str | None], seen: dict[str, str] | None = None) -> None:
    """Publish ``changes`` (None takes a part away) on top of the newest manifest.
    With ``seen``, only if the changed parts are still those."""
    jvm, fs = _fs(spark, path)
    while True:
        numbers = _numbers(spark, path)
        old = parts(spark, path)
        if seen is not None and any(old.get(k) != seen.get(k) for k in changes):
            raise Conflict(f"{path} was changed meanwhile")
        now = {k: v for k, v in (old | changes).items() if v is not None}
        target = jvm.org.apache.hadoop.fs.Path(f"{path}/manifests/{(numbers[-1] if numbers else 0) + 1:012d}.json")
        try:
            out = fs.create(target, False)
        except Exception as e:
            java = getattr(e, "java_exception", None)
            if java is not None and ("AlreadyExists" in java.getClass().getName() or "already exists" in str(java)):
                continue                    # another writer published first
            raise
        try:
            out.write(bytearray(json.dumps({"parts": now}, sort_keys=True), "utf-8"))
        finally:
            out.close()
        return


def publish(df: DataFrame, path: str, part: Column, values: list, seen: dict[str, str] | None = None) -> None:
    """Replace the parts ``values`` of the table at ``path`` by the rows of
    ``df``; ``part`` gives a row's part.  A value without rows becomes an empty
    part, a row of another part is an error.  ``df`` may read the same table; what
    is made of a part's old rows goes with ``seen``, the ``parts`` that were read,
    and raises ``Conflict`` if another writer has replaced them since."""
    spark = df.sparkSession
    names = [str(v) for v in values]
    own = part.cast("string")
    other = F.raise_error(F.concat(F.lit("a row belongs to another part: "), F.coalesce(own, F.lit("NULL")))).cast("string")
    folder = f"{path}/data/{uuid.uuid4().hex}"
    rows = df.withColumn(_PART, F.when(own.isin(*names), own).otherwise(other))
    # few files a part, and no part of any size in one task
    rows.hint("rebalance", _PART).write.partitionBy(_PART).parquet(folder)
    jvm, fs = _fs(spark, path)
    full = {v: f"{folder}/{_PART}={v}" for v in names}
    written = {v: f for v, f in full.items() if fs.exists(jvm.org.apache.hadoop.fs.Path(f))}
    _commit(spark, path, {v: written.get(v) for v in names}, seen)


def read(spark: SparkSession, path: str, schema, keep=None, seen: dict[str, str] | None = None) -> DataFrame:
    """The published rows; ``keep(value)`` chooses parts by name before any file
    is opened; ``seen`` are the ``parts`` of an earlier moment.  No table, or no
    part that is kept, gives no rows."""
    now = parts(spark, path) if seen is None else seen
    folders = [f for v, f in sorted(now.items()) if keep is None or keep(v)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete folders that the newest manifest does not name, and older
    manifests.  Only while no job reads or writes the table; returns how many
    folders went."""
    jvm, fs = _fs(spark, path)
    P = jvm.org.apache.hadoop.fs.Path
    current, gone = set(parts(spark, path).values()), 0
    runs = {f.rsplit("/", 1)[0] for f in current}
    if fs.exists(P(f"{path}/data")):
        for run in fs.listStatus(P(f"{path}/data")):
            here = f"{path}/data/{run.getPath().getName()}"
            if here not in runs:
                gone += bool(fs.delete(P(here), True))
                continue
            for p in fs.listStatus(P(here)):
                name = p.getPath().getName()
                if name.startswith(_PART) and f"{here}/{name}" not in current:
                    gone += bool(fs.delete(P(f"{here}/{name}"), True))
    for number in _numbers(spark, path)[:-1]:
        fs.delete(P(f"{path}/manifests/{number:012d}.json"), False)
    return gone


def rewrite(spark: SparkSession, path: str, schema, part: Column, values: list, change, tries: int = 5) -> None:
    """Replace the parts ``values`` by ``change(old rows of them)``; done again on
    the new rows if another writer replaced them meanwhile."""
    names = {str(v) for v in values}
    for left in range(tries - 1, -1, -1):
        seen = parts(spark, path)
        try:
            return publish(change(read(spark, path, schema, names.__contains__, seen)), path, part, values, seen)
        except Conflict:
            if not left:
                raise

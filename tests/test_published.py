"""Published tables: a day is seen as it was or as it is."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from feedlens.sources import published

SCHEMA = "dt string, n long"


def put(spark, path, rows, values):
    published.publish(spark.createDataFrame(rows, SCHEMA), path, F.col("dt"), values)


def seen(spark, path, keep=None):
    return sorted(map(tuple, published.read(spark, path, SCHEMA, keep).collect()))


@pytest.fixture
def path():
    return os.path.join(tempfile.mkdtemp(prefix="feedlens-published-"), "t")


def test_replace_add_and_empty(spark, path):
    assert seen(spark, path) == [] and published.parts(spark, path) == {}
    put(spark, path, [("a", 1), ("a", 2), ("b", 3)], ["a", "b"])
    put(spark, path, [("a", 9)], ["a"])
    assert seen(spark, path) == [("a", 9), ("b", 3)]
    put(spark, path, [], ["b"])
    assert seen(spark, path) == [("a", 9)]
    with pytest.raises(Exception, match="belongs to another part: c"):
        put(spark, path, [("c", 1)], ["a"])
    assert seen(spark, path) == [("a", 9)]
    assert seen(spark, path, lambda v: v == "z") == []


def test_a_job_that_dies_before_publishing_changes_nothing(spark, path, monkeypatch):
    put(spark, path, [("a", 1), ("b", 2)], ["a", "b"])
    reader = published.read(spark, path, SCHEMA)

    def dies(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(published, "_commit", dies)
        with pytest.raises(RuntimeError):
            put(spark, path, [("a", 7)], ["a"])
    assert seen(spark, path) == [("a", 1), ("b", 2)]
    put(spark, path, [("a", 8)], ["a"])
    assert sorted(map(tuple, reader.collect())) == [("a", 1), ("b", 2)]     # an open reader keeps its rows
    assert seen(spark, path) == [("a", 8), ("b", 2)]


def test_a_torn_manifest_is_passed_over(spark, path):
    put(spark, path, [("a", 1)], ["a"])
    with open(f"{path}/manifests/{2:012d}.json", "w") as f:
        f.write('{"parts": {"a"')
    assert seen(spark, path) == [("a", 1)]
    put(spark, path, [("b", 2)], ["b"])
    assert seen(spark, path) == [("a", 1), ("b", 2)]


def test_writers_at_once_keep_each_others_parts(spark, path, monkeypatch):
    put(spark, path, [("a", 1)], ["a"])
    real, raced = published._numbers, []

    def numbers(s, p):
        found = real(s, p)
        if not raced:                       # another writer publishes right after this one looked
            raced.append(True)
            put(spark, path, [("b", 2)], ["b"])
        return found

    monkeypatch.setattr(published, "_numbers", numbers)
    put(spark, path, [("c", 3)], ["c"])
    monkeypatch.undo()
    assert seen(spark, path) == [("a", 1), ("b", 2), ("c", 3)]


def test_a_table_may_be_rewritten_from_itself(spark, path):
    put(spark, path, [("a", 1), ("b", 2)], ["a", "b"])
    more = published.read(spark, path, SCHEMA, lambda v: v == "a").withColumn("n", F.col("n") + 1)
    published.publish(more, path, F.col("dt"), ["a"])
    assert seen(spark, path) == [("a", 2), ("b", 2)]
    gone = published.vacuum(spark, path)
    assert gone == 1 and seen(spark, path) == [("a", 2), ("b", 2)]


def test_a_rewrite_is_done_again_when_the_part_changed(spark, path, monkeypatch):
    put(spark, path, [("a", 1)], ["a"])
    real, raced = published.publish, []

    def publish(df, *args):
        if not raced:                       # another writer replaces the part after it was read
            raced.append(True)
            real(spark.createDataFrame([("a", 100)], SCHEMA), path, F.col("dt"), ["a"])
        return real(df, *args)

    monkeypatch.setattr(published, "publish", publish)
    published.rewrite(spark, path, SCHEMA, F.col("dt"), ["a"], lambda old: old.withColumn("n", F.col("n") + 1))
    monkeypatch.undo()
    assert seen(spark, path) == [("a", 101)]
    old = published.parts(spark, path)
    put(spark, path, [("a", 5)], ["a"])
    with pytest.raises(published.Conflict):
        published.publish(spark.createDataFrame([("a", 6)], SCHEMA), path, F.col("dt"), ["a"], old)
    assert seen(spark, path) == [("a", 5)]

"""The slices sink: create-if-absent, re-running a day replaces that day."""
import os
import tempfile

import pytest

from feedlens.operators import slices
from feedlens.sources import fixtures, sinks

from .conftest import SF_SMALL


def test_rerun_of_a_day_leaves_the_same_rows(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="feedlens-sink-"), "daily_slices")
    f, m = fixtures.feed_actions(spark, SF_SMALL), fixtures.message_actions(spark, SF_SMALL)
    day1 = slices.daily_slices(f, m, "2024-01-30")
    day2 = slices.daily_slices(f, m, "2024-01-29")
    sinks.write_slices(day1, out, "2024-01-29")
    sinks.write_slices(day2, out, "2024-01-28")
    first = sorted(map(tuple, spark.read.parquet(out).collect()))
    sinks.write_slices(day1, out, "2024-01-29")          # retry of one day
    again = sorted(map(tuple, spark.read.parquet(out).collect()))
    assert first == again
    expected = day1.count() + day2.count()
    assert len(again) == expected
    with pytest.raises(Exception, match="another day"):
        sinks.write_slices(day1, os.path.join(os.path.dirname(out), "other"), "2024-01-28")
    sinks.write_slices(day1.filter("false"), out, "2024-01-29")   # corrected to nothing
    assert spark.read.parquet(out).count() == day2.count()


def test_catalog_table_insert_is_idempotent(spark):
    loc = os.path.join(tempfile.mkdtemp(prefix="feedlens-tbl-"), "t")
    sinks.create_slices_table(spark, "slices_test", loc)
    sinks.create_slices_table(spark, "slices_test", loc)   # if absent: no error
    f, m = fixtures.feed_actions(spark, SF_SMALL), fixtures.message_actions(spark, SF_SMALL)
    day = slices.daily_slices(f, m, "2024-01-30")
    sinks.insert_slices(day, "slices_test", "2024-01-29")
    sinks.insert_slices(day, "slices_test", "2024-01-29")
    assert spark.table("slices_test").count() == day.count()
    sinks.insert_slices(day.filter("false"), "slices_test", "2024-01-29")
    assert spark.table("slices_test").count() == 0
    spark.sql("DROP TABLE slices_test")


def test_a_failed_publish_leaves_the_old_day(spark, monkeypatch):
    from feedlens.sources import published

    path = os.path.join(tempfile.mkdtemp(prefix="feedlens-sink-"), "slices")
    f, m = fixtures.feed_actions(spark, SF_SMALL), fixtures.message_actions(spark, SF_SMALL)
    day = slices.daily_slices(f, m, "2024-01-30")
    sinks.publish_slices(day, path, "2024-01-29")
    first = sorted(map(tuple, sinks.read_slices(spark, path).collect()))
    assert len(first) == day.count() > 0
    with monkeypatch.context() as mp:
        mp.setattr(published, "_commit", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            sinks.publish_slices(day.limit(1), path, "2024-01-29")
    assert sorted(map(tuple, sinks.read_slices(spark, path).collect())) == first
    sinks.publish_slices(slices.daily_slices(f, m, "2024-01-29"), path, "2024-01-28")
    assert sorted(map(tuple, sinks.read_slices(spark, path, "2024-01-29").collect())) == first
    with pytest.raises(Exception, match="another day"):
        sinks.publish_slices(day, path, "2024-01-28")
    sinks.publish_slices(day.limit(0), path, "2024-01-29")
    assert sinks.read_slices(spark, path, "2024-01-29", "2024-01-29").count() == 0


def test_jdbc_options():
    """A partitioned read names its query as a table and bounds its ranges."""
    from feedlens.sources.readers import jdbc_options

    assert jdbc_options("SELECT 1") == {"query": "SELECT 1"}
    got = jdbc_options("SELECT * FROM t", "day", "2024-01-01", "2024-02-01", 16)
    assert got == {"dbtable": "(SELECT * FROM t) part_source", "partitionColumn": "day", "lowerBound": "2024-01-01",
                   "upperBound": "2024-02-01", "numPartitions": "16"}
    with pytest.raises(ValueError, match="lower"):
        jdbc_options("SELECT 1", "day")


def test_sql_text_binds_its_parameters(spark):
    """Parameters are values, never text, and table names are the caller's frames."""
    from feedlens.sources.readers import sql_frame

    a = spark.createDataFrame([(1, "x"), (2, "y'; DROP")], "n long, s string")
    text = "SELECT n FROM {t} WHERE s = :s AND n >= :low"
    assert [r.n for r in sql_frame(spark, text, {"t": a}, s="y'; DROP", low=1).collect()] == [2]
    assert sql_frame(spark, text, {"t": a.filter("n = 1")}, s="y'; DROP", low=1).collect() == []
    assert not spark.catalog.tableExists("t")

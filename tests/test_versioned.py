"""Tables that are replaced whole or not at all."""

import os

import pytest
from pyspark.sql import functions as F

from carepulse.sources import versioned


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def frame(spark, values, schema="k int, v string"):
    return spark.createDataFrame(values, schema)


def test_publish_replaces_and_keeps_the_version_before(spark, tmpdir_path):
    table = tmpdir_path + "/t"
    assert versioned.current_version(spark, table) is None
    with pytest.raises(FileNotFoundError):
        versioned.read_table(spark, table)
    first = versioned.publish(frame(spark, [(1, "a"), (2, None)]), table)
    early = versioned.read_table(spark, table)
    versioned.publish(frame(spark, [(3, "c")]), table)
    assert rows(versioned.read_table(spark, table)) == [(3, "c")]
    assert rows(first) == rows(early) == [(1, "a"), (2, None)]   # a scan that was planned before keeps its rows
    versioned.publish(frame(spark, [(4, "d")]), table)
    assert len(os.listdir(table + "/versions")) == 2


@pytest.mark.parametrize("where", ["task", "pointer"])
def test_a_write_that_dies_leaves_the_old_rows(spark, tmpdir_path, monkeypatch, where):
    table = tmpdir_path + "/t"
    versioned.publish(frame(spark, [(1, "a"), (2, "b"), (3, "c")]), table)
    new = frame(spark, [(i, "x") for i in range(100)])
    if where == "task":   # a task of the write fails after others have written
        new = new.repartition(4).withColumn("v", F.when(F.col("k") == 77, F.raise_error(F.lit("broken"))).otherwise(F.col("v")))
    else:                 # the driver dies between the data and the pointer
        monkeypatch.setattr(versioned, "_switch", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(Exception):  # noqa: B017 - whatever the writer raises
        versioned.publish(new, table)
    assert rows(versioned.read_table(spark, table)) == [(1, "a"), (2, "b"), (3, "c")]
    monkeypatch.undo()
    versioned.publish(frame(spark, [(9, "z")]), table)   # and the next write works, and clears up
    assert rows(versioned.read_table(spark, table)) == [(9, "z")] and len(os.listdir(table + "/versions")) == 2


def test_a_table_can_be_made_from_itself(spark, tmpdir_path):
    table = tmpdir_path + "/t"
    versioned.publish(frame(spark, [(1, "a")]), table)
    versioned.publish(versioned.read_table(spark, table).unionByName(frame(spark, [(2, "b")])), table)
    assert rows(versioned.read_table(spark, table)) == [(1, "a"), (2, "b")]


def test_partitions_empty_tables_and_listing(spark, tmpdir_path):
    out = versioned.publish(frame(spark, [(1, "a"), (2, "b"), (3, None)]), tmpdir_path + "/p", ["v"])
    assert rows(out) == [(1, "a"), (2, "b"), (3, None)] and out.columns == ["k", "v"]
    empty = versioned.publish(frame(spark, []), tmpdir_path + "/e")
    assert empty.count() == 0 and versioned.read_table(spark, tmpdir_path + "/e", "k int, v string").columns == ["k", "v"]
    os.makedirs(tmpdir_path + "/dead/versions/x")   # a first write that died
    assert versioned.list_tables(spark, tmpdir_path) == ["e", "p"]
    assert versioned.list_tables(spark, tmpdir_path + "/none") == []

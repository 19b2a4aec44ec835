"""Append-only targets with a key filter beside them."""

import os
import random

from pyspark.sql import functions as F
from test_plans import plan

from carepulse.operators import membership
from carepulse.sources import files, keyed


def _frame(spark, keys):
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i int")


def _load(spark, keys, target, room):
    """What ``append_new_rows`` does, with a filter that has room for few keys."""
    got = keyed.unseen(_frame(spark, keys), "k", target, room=room)
    assert sorted(r.i for r in got.collect()) == [i for i, k in enumerate(keys) if k not in _keys(spark, target)]
    got.write.mode("append").parquet(target)


def _keys(spark, target):
    return {r.k for r in spark.read.parquet(target).collect()} - {None} if os.path.isdir(target) else set()


def test_loads_and_other_writers_and_dead_loads(spark, tmpdir_path):
    """Rows that others appended, loads that died before or after the append: no new key is lost, no known one repeated."""
    rnd, target = random.Random(4), os.path.join(tmpdir_path, "t")
    word = lambda: rnd.choice([None, "é", "", *map(str, range(40))])
    for step in range(5):
        _load(spark, sorted({word() for _ in range(12)}, key=str), target, room=10)
        if step == 1:      # another writer, without the filter
            _frame(spark, ["other", "39"]).write.mode("append").parquet(target)
        if step == 2:      # the filter has caught up, the append died
            keyed.unseen(_frame(spark, ["late"]), "k", target, room=10)
        if step == 3:      # the table was written anew by a compaction that dropped a key
            rows = [(r.k, r.i) for r in spark.read.parquet(target).collect() if r.k != "other"]
            spark.createDataFrame(rows, "k string, i int").write.mode("overwrite").parquet(target)
    _load(spark, ["late", "other", "39", None], target, room=10)
    assert {"late", "other"} <= _keys(spark, target)


def test_new_keys_do_not_read_the_files_that_the_filter_has(spark, tmpdir_path):
    target = os.path.join(tmpdir_path, "t")
    assert files.append_new_rows(_frame(spark, [f"C{i}" for i in range(500)]), target, "k") == 500
    assert files.append_new_rows(_frame(spark, ["C7", "D1", "D2"]), target, "k") == 2
    assert keyed.unseen(_frame(spark, ["C7", "D1", "E0"]), "k", target).select("k").collect() == [("E0",)]   # has caught up
    for name in os.listdir(target):     # unreadable from now on, under the same name, length and time
        path = os.path.join(target, name)
        if name.endswith(".parquet"):
            at = os.stat(path)
            with open(path, "wb") as f:
                f.write(b"x" * at.st_size)
            os.utime(path, ns=(at.st_atime_ns, at.st_mtime_ns))
    got = keyed.unseen(_frame(spark, ["E1", "E2"]), "k", target)
    assert sorted(r.k for r in got.collect()) == ["E1", "E2"] and "parquet" not in plan(got).lower()


def test_a_full_filter_is_built_anew_larger(spark, tmpdir_path):
    target = os.path.join(tmpdir_path, "t")
    spark.range(3000).select(F.concat(F.lit("C"), F.col("id")).alias("k"), F.lit(0).alias("i")).write.parquet(target)
    _, blocks = keyed.key_filter_of(spark, target, "k", room=1)
    assert blocks == membership.blocks_for(6000)
    spark.range(3000, 30_000).select(F.concat(F.lit("C"), F.col("id")).alias("k"), F.lit(0).alias("i")).write.mode("append").parquet(target)
    bits, more = keyed.key_filter_of(spark, target, "k", room=1)
    assert more == 4 * blocks
    assert bits.agg(F.sum(F.bitmap_count("BITS"))).head()[0] > 30_000
    known = keyed.unseen(spark.read.parquet(target), "k", target)
    assert known.count() == 0

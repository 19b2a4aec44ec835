"""Mergeable distinct counts, surrogate keys that go on, and key filters."""

import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_plans import nodes, plan

from carepulse.operators import chatbot, distinct, membership


def conversations(spark, seed, n, ids):
    rnd = random.Random(seed)
    rows = [(f"T{rnd.randrange(ids)}" if rnd.random() > 0.05 else None, rnd.choice(["big", "big", "x", "y", None]), dt.date(2026, 1, 1) + dt.timedelta(rnd.randrange(120))) for _ in range(n)]
    return spark.createDataFrame(rows, "transcript_id string, tenant_name string, created_at date")


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def test_bitmaps_of_two_loads_give_the_counts_of_all(spark):
    """More ids than a bucket has bits; conversations that several months, tenants and both loads have."""
    first = spark.range(40_000).select(F.concat(F.lit("T"), F.col("id")).alias("transcript_id"), F.lit("big").alias("tenant_name"), F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("created_at"))
    first = first.unionByName(conversations(spark, 1, 800, 900))
    second = conversations(spark, 2, 800, 60_000)
    keys = chatbot.dense_keys(first, "transcript_id", distinct.KEY).checkpoint()
    more = chatbot.extend_keys(keys, second, "transcript_id", distinct.KEY).checkpoint()
    both = keys.unionByName(more)
    n = both.count()
    assert both.agg(F.min(distinct.KEY), F.max(distinct.KEY), F.countDistinct(distinct.KEY), F.countDistinct("transcript_id")).head() == (1, n, n, n)
    merged = distinct.merge_bitmaps(distinct.conversation_bitmaps(first, keys), distinct.conversation_bitmaps(second, both)).checkpoint()
    everything = first.unionByName(second)
    assert rows(distinct.monthly_from_bitmaps(merged)) == rows(chatbot.conversations_monthly(everything))
    assert rows(distinct.total_from_bitmaps(merged)) == rows(chatbot.conversations_total(everything))
    assert merged.filter("TENANT_NAME = 'big'").select("BUCKET").distinct().count() > 2


def test_bitmaps_of_nothing(spark):
    none = conversations(spark, 1, 0, 1)
    out = distinct.conversation_bitmaps(none, chatbot.dense_keys(none, "transcript_id", distinct.KEY))
    assert distinct.monthly_from_bitmaps(out).count() == 0 and distinct.total_from_bitmaps(out).count() == 0


def test_few_values_are_one_partition(spark):
    keys = chatbot.dense_keys(conversations(spark, 3, 50, 20), "transcript_id", "K")
    assert keys.rdd.getNumPartitions() <= 2
    assert [r.K for r in keys.orderBy("transcript_id").collect()] == list(range(1, keys.count() + 1))


def test_a_total_does_not_read_conversations_again(spark, tmpdir_path):
    x = conversations(spark, 4, 300, 100)
    distinct.conversation_bitmaps(x, chatbot.dense_keys(x, "transcript_id", distinct.KEY)).write.parquet(tmpdir_path + "/b")
    p = plan(distinct.total_from_bitmaps(spark.read.parquet(tmpdir_path + "/b")))
    assert nodes(p, "Scan parquet") == 1 and nodes(p, "SortMergeJoin") + nodes(p, "BroadcastHashJoin") == 0


@pytest.fixture(scope="module")
def frame(spark):
    return lambda values: spark.createDataFrame([(v, i) for i, v in enumerate(values)], "k string, i int")


keys = st.lists(st.one_of(st.none(), st.text("ab1é", max_size=3), st.integers(0, 60).map(str)), max_size=25)


@settings(max_examples=8, deadline=None)
@given(known=keys, more=keys, loaded=keys, blocks=st.sampled_from([1, 3]))
def test_no_new_key_is_dropped_and_no_known_one_kept(frame, known, more, loaded, blocks):
    stored = membership.merge_filters(membership.key_filter(frame(known), "k", blocks), membership.key_filter(frame(more), "k", blocks))
    target = frame(known + more)
    got = membership.new_rows(frame(loaded), "k", stored, blocks, target)
    have = set(known + more) - {None}
    assert sorted(r.i for r in got.collect()) == [i for i, k in enumerate(loaded) if k not in have]


def test_new_keys_alone_do_not_read_the_target(spark, tmpdir_path):
    spark.range(5000).select(F.concat(F.lit("C"), F.col("id")).alias("k")).write.parquet(tmpdir_path + "/t")
    target = spark.read.parquet(tmpdir_path + "/t")
    blocks = membership.blocks_for(5000)
    stored = membership.key_filter(target, "k", blocks).checkpoint()
    spark.range(5000, 9000).select(F.concat(F.lit("C"), F.col("id")).alias("k")).write.parquet(tmpdir_path + "/n")
    fresh = spark.read.parquet(tmpdir_path + "/n")
    flagged = membership.with_maybe_known(fresh, "k", stored, blocks)
    wrong = flagged.filter("_MAYBE").count()
    assert wrong < 40   # under one in a hundred
    sure = flagged.filter("not _MAYBE").drop("_MAYBE").checkpoint()
    p = plan(membership.new_rows(sure, "k", stored, blocks, target))
    assert "Scan parquet" not in p
    assert membership.new_rows(target, "k", stored, blocks, target).count() == 0

"""Token filters and bucketed layers: by value, on awkward rows, and by their plans."""

import uuid

import pytest
from pyspark.sql import functions as F

from maskline.operators import tokenfilter as tf
from maskline.sources import layout


def test_filters_keep_all_known_tokens_and_few_others(spark):
    known = spark.range(5_000).select(F.sha2(F.col("id").cast("string"), 256).alias("token"))
    words = tf.words_for(5_000)
    assert words * 64 >= 5_000 * tf.PER_TOKEN > words * 32 - 1
    held = tf.build(known, "token", words)
    asked = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("token"))
    assert tf.maybe(known, "token", held, words).count() == 5_000
    row = tf.reach(asked, "token", held, words).first()
    assert row["n_rows"] == 20_000 and 5_000 <= row["n_through"] < 5_000 + 15_000 * 0.03
    plan = tf.maybe(asked, "token", held, words)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "BroadcastNestedLoopJoin" not in plan


def test_filters_of_parts_merge_to_that_of_the_whole(spark, tmp_path):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,), ("",)], "token string")
    parts = tf.build(df.where("token = 'a'"), "token", 4).unionByName(tf.build(df.where("token is null or token <> 'a'"), "token", 4))
    whole = sorted(tf.build(df, "token", 4).collect())
    assert sorted(tf.merged(parts).collect()) == whole
    tf.save(tf.merged(parts), f"file://{tmp_path}", "v1")
    assert sorted(tf.load(spark, f"file://{tmp_path}", "v1").collect()) == whole
    with pytest.raises(Exception, match="(?i)exists"):
        tf.save(parts, f"file://{tmp_path}", "v1")


def test_rows_with_their_originals(spark):
    walk = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("", 4)], "token string, original int")
    rows = spark.createDataFrame([("a", 10), ("a", 10), ("c", 11), (None, 12), ("", 13)], "t string, _bits int")
    held = tf.build(walk, "token", 1)
    got = sorted(map(tuple, tf.known_rows(rows, "t", walk, held, 1).collect()))
    assert got == [("", 13, 4), ("a", 10, 1), ("a", 10, 1)]
    assert tf.known_rows(rows, "t", walk.limit(0), tf.build(walk.limit(0), "token", 1), 1).count() == 0
    with pytest.raises(Exception, match="another number of words"):
        tf.maybe(rows, "t", held, 2).count()
    assert tf.maybe(rows, "t", held, 2 * tf.MOST_WORDS) is rows


def test_bucketed_layers_join_without_a_shuffle(spark, tmp_path):
    run = uuid.uuid4().hex
    facts = spark.range(3_000).select(F.when(F.col("id") % 50 > 0, F.concat(F.lit("t"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 40))).alias("token"), (F.col("id") % 4 + 2020).cast("int").alias("y"), F.col("id"))
    dim = spark.range(60).select(F.concat(F.lit("t"), F.col("id")).alias("token"), (F.col("id") * 2).alias("v"))
    for name, salt in (("f1", 1), ("f3", 3)):
        layout.save_bucketed(facts, f"{name}_{run}", "token", 4, f"file://{tmp_path}/{name}", "y", salt)
    layout.save_bucketed(dim, f"d_{run}", "token", 4, f"file://{tmp_path}/d")
    want = sorted(map(tuple, facts.where("y = 2021").join(dim, "token").select("token", "id", "v").collect()))
    assert want
    for name in ("f1", "f3"):
        got = layout.joined(spark.table(f"{name}_{run}").where("y = 2021"), spark.table(f"d_{run}"), "token")
        assert layout.shuffles(got) == 0 and "PartitionFilters: [isnotnull(y" in got._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, layout.require_no_shuffle(got).select("token", "id", "v").collect())) == want
    assert sum(1 for f in (tmp_path / "f1" / "y=2021").glob("*.parquet")) <= 4
    with pytest.raises(AssertionError, match="shuffles"):
        layout.require_no_shuffle(layout.joined(facts, dim, "token"))


def test_layers_of_no_rows_and_wrong_numbers(spark, tmp_path):
    run = uuid.uuid4().hex
    empty = spark.createDataFrame([], "token string, v int")
    layout.save_bucketed(empty, f"e_{run}", "token", 2, f"file://{tmp_path}/e")
    assert spark.table(f"e_{run}").count() == 0
    with pytest.raises(ValueError):
        layout.save_bucketed(empty, f"x_{run}", "token", 0)
    assert [layout.buckets_for(n) for n in (0, 1, 256 << 20, (256 << 20) + 1, 100 << 40)] == [1, 1, 1, 2, layout.MOST_BUCKETS]
    assert [tf.words_for(n) for n in (0, 5, 6)] == [1, 1, 2]

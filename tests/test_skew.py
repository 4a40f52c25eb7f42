"""A third of all rows share one key: no operator may gather them in one task."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from sluice.operators import merge, quality
from sluice.plans.table import Table

N = 90_000


@pytest.fixture
def hot(spark):
    """Keys 0..N, but every third row has key 1; spread over many input tasks."""
    key = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id"))
    return spark.range(0, N, 1, 16).select(key.alias("k"), F.col("id").alias("v"), F.repeat(F.lit("x"), 50).alias("pad"))


@pytest.fixture
def no_broadcast(spark):
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_target_key_is_split(spark, hot, no_broadcast):
    batch = spark.range(0, N, 2, 4).select(F.col("id").alias("k"), (-F.col("id")).alias("v"))
    for merged in (
        merge.upsert_rows(hot, batch, "k"),
        merge.untouched_rows(hot, batch, "k"),
    ):
        assert "skew=true" in final_plan(merged)


def test_upsert_is_right_under_skew(spark, hot, no_broadcast):
    batch = spark.range(0, N, 2, 4).select(F.col("id").alias("k"), F.lit(-1).cast("bigint").alias("v"))
    merged = merge.upsert_rows(hot, batch, "k")
    odd = hot.filter("k % 2 = 1").count()
    assert merged.filter("v >= 0").count() == odd
    inserted = batch.join(hot, "k", "left_anti").count()
    assert merged.count() == N + inserted


def test_rows_without_key_take_part_in_no_join(spark, no_broadcast):
    nulls = spark.range(0, N, 1, 8).select(F.lit(None).cast("bigint").alias("k"), F.col("id").alias("v"))
    batch = spark.range(3).select(F.col("id").alias("k"), F.col("id").alias("v")).unionByName(nulls)
    merged = merge.upsert_rows(nulls, batch, "k")
    assert merged.count() == 2 * N + 3


def test_newest_of_a_hot_key(spark, hot):
    latest = merge.dedupe_batch(hot, "k", "latest", ["v"])
    top = N - 3
    assert rows(latest.filter("k = 1"), "v") == [(top,)]
    assert latest.count() == hot.select("k").distinct().count()


def test_duplicates_of_a_hot_key(spark, hot):
    assert rows(quality.duplicate_keys(hot, "k")) == [(1, N // 3 + 1)]


def test_a_hot_partition_is_rewritten_by_many_tasks(spark, hot, path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
    try:
        table = Table(spark, path)
        part = F.when(F.col("k") == 1, "hot").otherwise("cold").alias("p")
        table.upsert(hot.select("k", "v", "pad", part), "k", ["p"], dedupe="none")
        # Key 1 and many others: files of both partitions are hit.
        batch = spark.range(1, N, 5).select(F.col("id").alias("k"), F.lit("cold").alias("p"))
        inserted = batch.join(hot, "k", "left_anti").count()
        first = set(table.snapshot().paths)
        table.upsert(batch.withColumn("p", part), "k")
        assert table.read().count() == N + inserted
        assert table.read().filter("p = 'hot'").count() == N // 3 + 1
        fresh = [p for p in table.snapshot().paths if p not in first and p.endswith("p=hot")]
        assert sum(table._folder.usage(p)[0] for p in fresh) > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")

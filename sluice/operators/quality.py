"""Checks on loaded tables. Each returns a small DataFrame and counts with partial aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions import quoted


# Key types no wider than the hash that would stand for them.
_NARROW = (
    T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
    T.DateType, T.TimestampType, T.TimestampNTZType,
)


def repeated(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with how often, as ``key, n``.

    A wide key is not shuffled for all rows: eight bytes of hash stand for it, added up before the
    shuffle, and only keys whose hash occurs twice are counted by their values. On a nearly unique key
    that is almost none. Of the source only the key is read, twice.
    """
    k = F.col(quoted(key))
    if not isinstance(df.schema[key].dataType, _NARROW):
        hashed = df.select(k, F.xxhash64(k).alias("__hash"))
        twice = hashed.groupBy("__hash").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
        df = hashed.join(twice.select("__hash"), "__hash", "left_semi").select(k)
    return df.groupBy(k).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with how often; NULL is a key like others."""
    return repeated(df, key)


def duplicate_rate(df: DataFrame, key: str) -> DataFrame:
    """One row: all rows, keys that repeat, and their share in percent (0 for an empty table).

    Rows are counted apart from keys, so that a key that occurs once need not reach a group.
    """
    one = F.lit(1)
    rows = df.agg(F.count(one).alias("n")).select("n", F.lit(0).cast("bigint").alias("d"))
    keys = repeated(df, key).agg(F.count(one).alias("d")).select(F.lit(0).cast("bigint").alias("n"), "d")
    totals = rows.unionByName(keys).agg(F.sum("n").alias("total"), F.sum("d").alias("dups"))
    rate = F.when(F.col("total") > 0, F.round(F.col("dups") / F.col("total") * 100, 2)).otherwise(
        F.lit(0.0)
    )
    return totals.withColumn("rate", rate)


def count_by(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per group."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def landed_count(table: DataFrame, run_id: str) -> DataFrame:
    """One row: how many rows of the table carry this run's id."""
    return table.filter(F.col("_ingestion_id") == run_id).agg(F.count(F.lit(1)).alias("tc"))


def judge_counts(sc: int, tc: int, min_rows: int = 0) -> tuple[int, str]:
    """Rows that arrived and verdict: a load succeeds if all it sent arrived and it sent enough."""
    return tc, "SUCCESS" if sc >= min_rows and sc == tc else "FAILED"


def reconcile(
    source: DataFrame, table: DataFrame | None, run_id: str, min_rows: int = 0
) -> DataFrame:
    """One row ``sc, tc, status``; a target that cannot be read counts as empty."""
    sent = source.agg(F.count(F.lit(1)).alias("n")).select(F.lit("sc").alias("side"), "n")
    sides = sent
    if table is not None:
        sides = sent.unionByName(
            landed_count(table, run_id).select(F.lit("tc").alias("side"), F.col("tc").alias("n"))
        )
    side = lambda name: F.coalesce(F.sum(F.when(F.col("side") == name, F.col("n"))), F.lit(0))
    both = sides.agg(
        side("sc").cast("bigint").alias("sc"), side("tc").cast("bigint").alias("found")
    )
    enough = F.col("sc") >= min_rows
    return both.select(
        "sc",
        F.col("found").alias("tc"),
        F.when(enough & (F.col("sc") == F.col("found")), "SUCCESS")
        .otherwise("FAILED")
        .alias("status"),
    )

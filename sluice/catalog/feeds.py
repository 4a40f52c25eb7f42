"""Stored answers of a REST feed, made from a table, for the paged readers to request."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.runtime import scratch_dir

_SPLIT_BITS = 33  # monotonically_increasing_id puts the partition number above this bit


def _page_rows(df: DataFrame, record: Column, per_page: int) -> DataFrame:
    """``split, n, records``: the n-th page of an input split, never more than per_page records.

    The pages are written once, because the row numbers behind them belong to one evaluation.
    """
    path = scratch_dir(df.sparkSession, "pages")
    row = F.monotonically_increasing_id()
    numbered = df.select(
        F.shiftright(row, _SPLIT_BITS).alias("split"),
        F.floor(row.bitwiseAND((1 << _SPLIT_BITS) - 1) / per_page).cast("int").alias("n"),
        record.alias("record"),
    )
    pages = numbered.groupBy("split", "n").agg(F.collect_list("record").alias("records"))
    pages.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def numbered_pages(df: DataFrame, record: Column, per_page: int) -> tuple[str, int]:
    """A folder of pages 1..n with records at ``result.data``, and n."""
    pages = _page_rows(df, record, per_page)
    # One row per input split: few, whatever the number of pages.
    counts = pages.groupBy("split").agg(F.count(F.lit(1)).alias("pages")).orderBy("split").collect()
    first, offsets = 1, []
    for row in counts:
        offsets.append((row["split"], first))
        first += row["pages"]
    if not offsets:
        raise ValueError("no rows to page")
    spark = df.sparkSession
    starts = spark.createDataFrame(offsets, "split bigint, first bigint")
    path = scratch_dir(spark, "feed")
    body = F.to_json(F.struct(F.struct(F.col("records").alias("data")).alias("result")))
    (
        pages.join(starts, "split")
        .select((F.col("first") + F.col("n")).alias("page"), body.alias("value"))
        .write.partitionBy("page")
        .text(path)
    )
    return path, first - 1


def chained_pages(df: DataFrame, record: Column, per_page: int) -> tuple[str, list[str], int]:
    """A folder of pages that name their successor at ``paging.next``: one chain per input split.

    Returns the folder, the first cursor of every chain and the length of the longest.
    """
    pages = _page_rows(df, record, per_page)
    ends = pages.groupBy("split").agg(F.max("n").alias("last"))
    cursor = lambda n: F.concat_ws("-", F.col("split"), n)
    path = scratch_dir(df.sparkSession, "feed")
    step = F.when(F.col("n") < F.col("last"), cursor(F.col("n") + 1))
    body = F.to_json(
        F.struct(F.col("records").alias("items"), F.struct(step.alias("next")).alias("paging"))
    )
    (
        pages.join(ends, "split")
        .select(cursor(F.col("n")).alias("cursor"), body.alias("value"))
        .write.partitionBy("cursor")
        .text(path)
    )
    chains = ends.orderBy("split").collect()
    return path, [f"{r['split']}-0" for r in chains], max(r["last"] for r in chains) + 1

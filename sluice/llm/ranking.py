"""Places of rows within groups, counted over all tasks: no group needs to fit one of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import saved

#: ``monotonically_increasing_id`` holds the task in the bits above these.
_TASK_SHIFT = 33


def ranked(df: DataFrame, group: list[str], order: list[str], label: str) -> DataFrame:
    """``df`` with ``i``, each row's place from 0 in its group, and ``n``, the rows of the group.

    Rows are dealt by ranges of ``group`` and ``order``, so a group of any size lies in consecutive
    tasks; equal rows are told apart by a repeatable draw and may part. The places inside a task are
    counted where the rows are sorted; what came before in other tasks is one number per task and
    group. Nulls come first. ``df`` must give the same rows again when it is read again, and have no
    columns ``i``, ``n``, ``_at``, ``_task``, ``_draw``. An empty table gives an empty one.
    """
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*group, *order, "_draw"]
    dealt = df.withColumn("_draw", F.rand(20240607)).repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
    placed = saved(dealt.drop("_draw").withColumn("_at", F.monotonically_increasing_id()), label)
    placed = placed.withColumn("_task", F.shiftright("_at", _TASK_SHIFT))
    parts = placed.groupBy(*group, "_task").agg(F.count("*").alias("n"), F.min("_at").alias("_at"))
    whole = Window.partitionBy(*group)
    before = F.sum("n").over(whole.orderBy("_task").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    parts = parts.select(*[F.col(c).alias(f"_{c}") for c in group], F.col("_task").alias("_part"), (before - F.col("_at")).alias("_shift"), F.sum("n").over(whole).alias("n"))
    same = reduce(lambda a, c: a & F.col(c).eqNullSafe(F.col(f"_{c}")), group, F.col("_task") == F.col("_part"))
    return placed.join(parts, same).select(*df.columns, (F.col("_at") + F.col("_shift")).alias("i"), "n")

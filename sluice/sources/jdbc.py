"""Relational tables and subqueries over JDBC, read in parallel ranges."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from sluice.sources.registry import ReadContext, register
from sluice.spec import SourceSpec, SpecError

DEFAULT_DRIVER = "org.postgresql.Driver"
_NAMES = {
    "url": "url",
    "dbtable": "dbtable",
    "user": "user",
    "password": "password",
    "partition_column": "partitionColumn",
    "lower_bound": "lowerBound",
    "upper_bound": "upperBound",
    "num_partitions": "numPartitions",
    "fetch_size": "fetchsize",
}


def jdbc_options(options: Mapping[str, Any]) -> dict[str, str]:
    """Reader options of Spark's JDBC source; what the spec leaves out is not passed at all."""
    for name in ("url", "dbtable"):
        if not options.get(name):
            raise SpecError(f"source_config.{name} is missing")
    for pair in (("partition_column", "num_partitions"), ("lower_bound", "upper_bound")):
        given = [name for name in pair if options.get(name) is not None]
        if len(given) == 1:
            raise SpecError(f"{given[0]} needs {' and '.join(set(pair) - set(given))} as well")
    if options.get("lower_bound") is not None and options.get("partition_column") is None:
        raise SpecError("bounds need partition_column and num_partitions as well")
    read = {_NAMES[k]: str(v) for k, v in options.items() if k in _NAMES and v is not None}
    read["driver"] = options.get("driver") or DEFAULT_DRIVER
    return read


def with_ends(
    spark: SparkSession, options: Mapping[str, Any], bound: tuple[str, str] | None
) -> dict[str, Any]:
    """The options with the ends of the range filled in, asked of the database in one row.

    Fixed ends go stale as a table grows: all newer rows then fall into the last range and are
    read by one task. A bounded load on the same column starts its ranges at the bound. A table
    without rows is read in one piece.
    """
    column = options["partition_column"]
    ends = f"(SELECT MIN({column}) AS low, MAX({column}) AS high FROM {options['dbtable']}) ends"
    whole = {k: v for k, v in options.items() if k not in ("partition_column", "num_partitions")}
    row = (
        spark.read.format("jdbc").options(**jdbc_options({**whole, "dbtable": ends})).load().head()
    )
    low, high = row[0], row[1]
    if low is None or high is None:
        return whole
    if bound and bound[0] == column and isinstance(high, int) and bound[1].lstrip("-").isdigit():
        low = min(max(low, int(bound[1])), high)
    return {**options, "lower_bound": str(low), "upper_bound": str(high)}


@register("postgres", "jdbc")
def read_jdbc(spark: SparkSession, source: SourceSpec, context: ReadContext) -> DataFrame:
    """A whole table or subquery; filters and column choices made later reach the database.

    The ends only set the stride of the ranges: rows outside them are read as well. Without
    ``lower_bound`` and ``upper_bound`` they are asked of the table.
    """
    options = dict(source.options)
    jdbc_options(options)
    if options.get("partition_column") is not None and options.get("lower_bound") is None:
        options = with_ends(spark, options, context.bound)
    return spark.read.format("jdbc").options(**jdbc_options(options)).load()

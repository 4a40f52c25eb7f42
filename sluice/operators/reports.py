"""Reports over loaded tables and the audit log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import quoted


def _speed(rows: str, seconds: str) -> Column:
    """Rows per second; NULL where no time was measured."""
    return F.round(F.col(rows) / F.when(F.col(seconds) > 0, F.col(seconds)), 2)


def throughput(audit: DataFrame) -> DataFrame:
    """Speed of every run in the audit log, newest run first."""
    speeds = audit.select(
        "ts",
        "job_name",
        "status",
        "source_count",
        "duration",
        _speed("source_count", "duration").alias("speed_rec_per_sec"),
    )
    return newest_first(speeds, "ts")


def newest_first(df: DataFrame, *columns: str) -> DataFrame:
    return df.orderBy(*[F.col(c).desc() for c in columns])


def latest_n(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """The n newest rows; every task keeps only its own n, so nothing is sorted as a whole."""
    return newest_first(df, *columns).limit(n)


def compare_load_types(audit: DataFrame) -> DataFrame:
    """One row: mean duration of full and of incremental runs, and what the latter save."""
    of = lambda kind: F.round(F.avg(F.when(F.col("ingestion_type") == kind, F.col("duration"))), 2)
    means = audit.agg(of("FULL").alias("full_avg"), of("INCREMENTAL").alias("incr_avg"))
    saved = F.col("full_avg") - F.col("incr_avg")
    share = saved / F.when(F.col("full_avg") != 0, F.col("full_avg")) * 100
    return means.select(
        "full_avg",
        "incr_avg",
        F.round(saved, 2).alias("saved"),
        F.round(share, 2).alias("saved_pct"),
    )


def scenario_timings(audit: DataFrame) -> DataFrame:
    """Per job: runs, most rows in a run, and mean duration."""
    return audit.groupBy("job_name").agg(
        F.count(F.lit(1)).alias("runs"),
        F.max("source_count").alias("source_count"),
        F.round(F.avg("duration"), 2).alias("duration"),
    )


def describe(df: DataFrame) -> DataFrame:
    """A row per column (position, name, type, nullable), each with the table's row count."""
    columns = F.array(
        *[
            F.struct(
                F.lit(i).alias("pos"),
                F.lit(f.name).alias("name"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.lit(f.nullable).alias("nullable"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )
    total = df.agg(F.count(F.lit(1)).alias("total_records"))
    return total.select(F.inline(columns), "total_records")


def sample_rows(df: DataFrame, n: int, *columns: str) -> DataFrame:
    """The first n rows that come, for a look at a table."""
    return df.select(*[F.col(c) if "." in c else F.col(quoted(c)) for c in columns]).limit(n)

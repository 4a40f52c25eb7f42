"""Incremental loads: keep what lies beyond the bound, and what came late at the bound itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions import quoted, row_digest, typed_bound
from sluice.spec import JobSpec

#: Target column that tells rows at the bound apart: a hash of the row as the source had it.
ROW_DIGEST = "_row_digest"
#: Copies of one row that one step of an explode makes.
_COPIES = 1_000_000


def newer_than(df: DataFrame, column: str, bound: str) -> DataFrame:
    """Rows strictly beyond the bound; rows at the bound and NULLs are left out."""
    return df.filter(F.col(column) > typed_bound(df, column, bound))


def with_digest(df: DataFrame) -> DataFrame:
    """Rows with a digest of their values as the source had them."""
    return df.withColumn(ROW_DIGEST, row_digest(df))


def from_bound(df: DataFrame, column: str, bound: str, known: DataFrame) -> DataFrame:
    """Rows beyond the bound, and those at it that ``known`` does not hold.

    Both have ``_row_digest``; of ``known`` only rows at the bound count. Rows that are equal are
    told apart by how many there are: what the source has more of than was known comes through.
    They are counted per digest before any shuffle, so neither many ties nor many copies of
    one row meet in a task.
    """
    at = F.col(column) == typed_bound(df, column, bound)
    before = known.filter(F.col(column) == typed_bound(known, column, bound))
    before = before.groupBy(ROW_DIGEST).agg(F.count(F.lit(1)).alias("__known"))
    names = [F.col(quoted(c)) for c in df.columns]
    tied = df.filter(at).groupBy(ROW_DIGEST).agg(
        F.count(F.lit(1)).alias("__here"), F.first(F.struct(*names)).alias("__row")
    )
    more = F.col("__here") - F.coalesce("__known", F.lit(0))
    late = tied.join(before, ROW_DIGEST, "left").select("__row", more.alias("__more")).filter("__more > 0")
    blocks = F.explode(F.sequence(F.lit(0), F.expr(f"(__more - 1) div {_COPIES}")))
    late = late.select("__row", "__more", blocks.alias("__block"))
    rest = F.least(F.col("__more") - F.col("__block") * _COPIES, F.lit(_COPIES)).cast("int")
    late = late.select(F.col("__row"), F.explode(F.sequence(F.lit(1), rest)).alias("__copy"))
    rows = late.select(*[F.col("__row").getField(c).alias(c) for c in df.columns])
    return newer_than(df, column, bound).unionByName(rows)


def incremental(df: DataFrame, spec: JobSpec, known: DataFrame | None = None) -> DataFrame:
    """The bounded part of the source, or all of it when the spec gives no usable bound.

    With ``late_rows`` in the spec rows carry their digest, and ``known``, what the target holds,
    says which of those at the bound were loaded before.
    """
    if spec.late_rows:
        df = with_digest(df)
    if not spec.incremental:
        return df
    if spec.late_rows and known is not None:
        return from_bound(df, spec.incremental_column, spec.last_ingestion_value, known)
    return newer_than(df, spec.incremental_column, spec.last_ingestion_value)


def next_bound(df: DataFrame, column: str, job_name: str) -> DataFrame:
    """One row: the greatest value seen, which the next run of the job starts from."""
    return df.agg(F.max(F.col(column)).alias("next_value")).select(
        F.lit(job_name).alias("job_name"), "next_value"
    )

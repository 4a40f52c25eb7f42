"""Run metadata and the column rules of a spec."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions import array_of_strings, present_columns, quoted, rebuilt_struct
from sluice.runtime import clock_column
from sluice.spec import Rule, SpecError

INGEST_DATE = "_ingest_date"


def with_run_metadata(
    df: DataFrame, run_id: str, load_type: str, source_name: str, clock: dt.datetime
) -> DataFrame:
    """Five columns that say which run brought a row. Added before the rules, which may use them."""
    return df.withColumns(
        {
            "_ingestion_id": F.lit(run_id),
            "_ingestion_type": F.lit(load_type.upper()),
            "_source_name": F.lit(source_name),
            "_ingestion_status": F.lit("SUCCESS"),
            "_ingested_at": clock_column(clock),
        }
    )


def with_ingest_date(
    df: DataFrame, partition_by: Iterable[str]
) -> tuple[DataFrame, tuple[str, ...]]:
    """Date of the load, and the partition columns with that date among them."""
    columns = tuple(partition_by)
    if "_ingested_at" not in df.columns:
        return df, columns
    df = df.withColumn(INGEST_DATE, F.to_date("_ingested_at"))
    return df, columns if INGEST_DATE in columns else (*columns, INGEST_DATE)


def fill_na(df: DataFrame, columns: Iterable[str], value: str | int | float | bool) -> DataFrame:
    """Replace NULL (and NaN) where the value's type fits the column."""
    subset = present_columns(df, columns)
    return df.fillna(value, subset=subset) if subset else df


def upper_case(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return _replace(df, {c: F.upper(F.col(quoted(c))) for c in present_columns(df, columns)})


def cast_type(df: DataFrame, columns: Iterable[str], data_type: str) -> DataFrame:
    """Change types; a value that does not fit becomes NULL."""
    names = present_columns(df, columns)
    return _replace(df, {c: F.col(quoted(c)).try_cast(data_type) for c in names})


def add_ingestion_timestamp(df: DataFrame, clock: dt.datetime) -> DataFrame:
    return df.withColumn("ingested_at", clock_column(clock))


def apply_rule(df: DataFrame, rule: Rule, clock: dt.datetime) -> DataFrame:
    match rule.type:
        case "fill_na":
            return fill_na(df, rule.columns, rule.value)
        case "upper_case":
            return upper_case(df, rule.columns)
        case "cast_type":
            return cast_type(df, rule.columns, rule.data_type)
        case "add_ingestion_timestamp":
            return add_ingestion_timestamp(df, clock)
    raise SpecError(f"unknown rule type {rule.type!r}")


def apply_rules(df: DataFrame, rules: Iterable[Rule], clock: dt.datetime) -> DataFrame:
    """All rules in their order, each seeing what the ones before it made."""
    return reduce(lambda rows, rule: apply_rule(rows, rule, clock), rules, df)


def strings_in_arrays(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Array columns of any element type as ``array<string>``."""
    return _replace(df, {c: array_of_strings(df, c) for c in present_columns(df, columns)})


def rebuilt_structs(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Struct columns rebuilt field by field, NULL where the struct is NULL."""
    return _replace(df, {c: rebuilt_struct(df, c) for c in present_columns(df, columns)})


def flat_key(df: DataFrame, key: str | None) -> tuple[DataFrame, str | None]:
    """A key inside a struct (``a.b``) copied to a top-level column ``a_b``."""
    if not key or "." not in key or key in df.columns:
        return df, key
    name = key.replace(".", "_")
    return df.withColumn(name, F.col(key)), name


def project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Output name to dotted path, as a flat projection."""
    return df.select(*[F.col(path).alias(name) for name, path in columns.items()])


def _replace(df: DataFrame, columns: dict) -> DataFrame:
    return df.withColumns(columns) if columns else df

"""Text formats without a declared schema, read and parsed once.

Spark infers the types of CSV and JSON in a pass of its own and then reads the source again. Here the
values go to a staged copy as they are, what they could be is noted in the same pass, and the
typed rows are read from the copy.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions import quoted
from sluice.runtime import scratch_dir
from sluice.sources.registry import ReadContext

#: Column of the lines that are no record, as Spark's own reader names it.
CORRUPT = "_corrupt_record"

# The kinds a CSV value can be, narrowest first, and what each looks like.
KINDS = ("int", "bigint", "decimal(38,0)", "double", "date", "timestamp", "boolean", "string")
_WHOLE = r"^[+-]?[0-9]+$"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(NaN|Infinity|Inf)$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}"
_BOOLEAN = r"^(?i:true|false)$"


def kind_of(value: Column) -> Column:
    """The bit of the narrowest of ``KINDS`` that holds a text; NULL for NULL."""
    fits = lambda pattern, kind: value.rlike(pattern) & value.try_cast(kind).isNotNull()
    return (
        F.when(value.isNull(), F.lit(None).cast("int"))
        .when(fits(_WHOLE, "int"), 1 << 0)
        .when(fits(_WHOLE, "bigint"), 1 << 1)
        .when(fits(_WHOLE, "decimal(38,0)"), 1 << 2)
        .when(fits(_NUMBER, "double"), 1 << 3)
        .when(fits(_DATE, "date"), 1 << 4)
        .when(fits(_TIME, "timestamp"), 1 << 5)
        .when(value.rlike(_BOOLEAN), 1 << 6)
        .otherwise(1 << 7)
    )


def joined_kind(seen: int | None) -> str:
    """The kind of a column, given the set of kinds its values are, one bit each.

    Numbers join to the widest among them, dates and times to timestamp, all else to string. A
    column without values is a string.
    """
    kinds = [i for i in range(len(KINDS)) if (seen or 0) >> i & 1]
    if not kinds:
        return "string"
    if kinds[-1] <= 3 or kinds[0] == kinds[-1]:
        return KINDS[kinds[-1]]
    return "timestamp" if set(kinds) <= {4, 5} else "string"


def csv_rows(spark: SparkSession, path: str, options: Mapping[str, str], context: ReadContext) -> DataFrame:
    """CSV files with a header. Every file is read once; the types come from an aggregate on the way."""
    text = spark.read.options(**options).option("header", "true").csv(path)
    if not text.columns:
        return text
    bits = [F.bit_or(kind_of(F.col(quoted(c)))).alias(f"k{i}") for i, c in enumerate(text.columns)]
    staged, seen = _staged(text, bits, context, "csv")
    # A date takes part in a timestamp column as its midnight.
    return staged.select(
        *[F.col(quoted(c)).cast(joined_kind(seen.get(f"k{i}"))).alias(c) for i, c in enumerate(text.columns)]
    )


def json_rows(spark: SparkSession, path: str, options: Mapping[str, str], context: ReadContext) -> DataFrame:
    """JSON lines, each an object or an array of objects, parsed once to VARIANT.

    One row per object. The schema is that of all objects; fields whose values disagree are
    strings (``variant_conflicts`` names them), whole numbers are bigint, other numbers double.
    Where a line or element is no object, a column ``_corrupt_record`` holds its text.
    """
    lines = spark.read.options(**options).text(path).filter(F.trim("value") != "")
    body = F.try_parse_json("value")
    whole = lines.select("value", body.alias("body"))
    parts = F.coalesce(F.try_variant_get("body", "$", "array<variant>"), F.array("body"))
    found = whole.select("value", F.explode(parts).alias("record"))
    kind = F.schema_of_variant("record")
    is_object = F.coalesce(kind.startswith("OBJECT"), F.lit(False))
    records = found.select(
        F.when(is_object, F.col("record")).alias("record"),
        F.when(~is_object, F.coalesce(F.when(F.col("record").isNotNull(), F.to_json("record")), F.col("value"))).alias(CORRUPT),
    )
    staged, seen = _staged(
        records, [F.schema_of_variant_agg("record").alias("kind"), F.count(CORRUPT).alias("corrupt")], context, "json"
    )
    struct = variant_struct(seen.get("kind") or "VOID")
    columns = [F.col("typed").getField(f.name).alias(f.name) for f in struct.fields]
    corrupt = [F.col(CORRUPT)] if seen.get("corrupt") else []
    if not columns:
        return staged.select(CORRUPT)
    return staged.select(F.col("record").cast(struct).alias("typed"), CORRUPT).select(*columns, *corrupt)


def variant_struct(kind: str) -> T.StructType:
    """A variant's schema as a struct: decimals as double, fields without one type as string."""
    if not kind.startswith("OBJECT<"):
        return T.StructType([])
    ddl = _outside_names(kind, lambda s: re.sub(r"\bDECIMAL\(\d+, ?\d+\)", "DOUBLE", s))
    ddl = _outside_names(ddl, lambda s: re.sub(r"\bFLOAT\b", "DOUBLE", s))
    ddl = _outside_names(ddl, lambda s: re.sub(r"(?<=[ <])(VARIANT|VOID|OBJECT<>)(?=[,>]|$)", "STRING", s))
    ddl = _outside_names(ddl, lambda s: s.replace("OBJECT<", "STRUCT<"))
    return T._parse_datatype_string(ddl)


def variant_conflicts(kind: str) -> list[str]:
    """Top-level fields of a variant's schema whose values have no common type."""
    if not kind.startswith("OBJECT<"):
        return []
    marked = _outside_names(kind, lambda s: re.sub(r"(?<=[ <])(VOID|OBJECT<>)(?=[,>])", "STRING", s))
    ddl = _outside_names(marked, lambda s: s.replace("OBJECT<", "STRUCT<"))
    return [f.name for f in T._parse_datatype_string(ddl).fields if isinstance(f.dataType, T.VariantType)]


def _outside_names(kind: str, change) -> str:
    """Change a schema's text, but not the names of fields, which may look like types.

    Names stand before a colon, quoted with backticks unless they are plain.
    """
    out, at = [], 0
    for name in re.finditer(r"`(?:[^`]|``)*`(?=:)|(?<=[<\s])[^\s`<>:,()]+(?=:)", kind):
        out += [change(kind[at : name.start()]), name.group()]
        at = name.end()
    return "".join([*out, change(kind[at:])])


def _staged(
    rows: DataFrame, notes: list[Column], context: ReadContext, label: str
) -> tuple[DataFrame, dict]:
    """Write rows to a scratch copy that lives as long as the run, with notes taken in that pass."""
    spark, path, seen = rows.sparkSession, scratch_dir(rows.sparkSession, label), Observation()
    context.scratch.append(path)
    rows.observe(seen, F.count(F.lit(1)).alias("rows"), *notes).write.parquet(path)
    copy = spark.read.schema(rows.schema).parquet(path)
    known = seen.get
    if "rows" not in known:  # nothing was observed: an empty source folds the plan away
        known = copy.agg(F.count(F.lit(1)).alias("rows"), *notes).head().asDict()
    return copy, known

"""Column expressions shared by sources, rules and filters."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.spec import SpecError


def quoted(name: str) -> str:
    """A column name as an identifier, so that dots and blanks in it mean nothing."""
    return "`" + name.replace("`", "``") + "`"


def present_columns(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Those of the names that the rows have, in the order given."""
    have = set(df.columns)
    return [name for name in names if name in have]


def row_hash(df: DataFrame, columns: Iterable[str]) -> Column:
    """A hash of columns by name, whatever their order; maps and variants are hashed as JSON."""

    def part(name: str) -> Column:
        kind = df.schema[name].dataType.simpleString()
        column = F.col(quoted(name))
        return F.to_json(F.struct(column)) if "map<" in kind or "variant" in kind else column

    return F.xxhash64(*[part(c) for c in sorted(columns)])


# Timestamps in JSON with all their digits.
_WHOLE_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def row_digest(df: DataFrame) -> Column:
    """A hash of a row's values and their columns' names, in any order of the columns.

    A NULL adds nothing, so a column that appears later leaves the digests of rows without a
    value as they were; a value that moves to another column changes the digest. Nested
    values are hashed as JSON.
    """

    def part(name: str, kind: T.DataType) -> Column:
        column = F.col(quoted(name))
        nested = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
        value = F.to_json(F.struct(column), _WHOLE_TIMES) if isinstance(kind, nested) else column
        return F.when(column.isNotNull(), F.xxhash64(F.lit(name), value)).otherwise(F.lit(0))

    return reduce(Column.bitwiseXOR, [part(f.name, f.dataType) for f in df.schema.fields])


def column_type(df: DataFrame, name: str) -> T.DataType:
    """Type of a column or dotted field."""
    try:
        return df.select(F.col(name)).schema[0].dataType
    except AnalysisException as err:
        raise SpecError(f"column {name!r} is not in the source: {', '.join(df.columns)}") from err


def typed_bound(df: DataFrame, name: str, bound: str) -> Column:
    """A bound written as text, as a literal of the column's own type.

    The column itself stays free of casts, which lets the comparison reach the scan. A text
    that does not fit the type is refused here, before any job runs.
    """
    kind = column_type(df, name)
    literal = F.lit(bound)
    probe = df.sparkSession.sql("SELECT 1").select(literal.try_cast(kind).alias("v"))
    if probe.head()["v"] is None:
        raise SpecError(f"bound {bound!r} does not fit {name} ({kind.simpleString()})")
    return literal.cast(kind)


def array_of_strings(df: DataFrame, name: str) -> Column:
    """A column as ``array<string>``; a plain value becomes an array of one."""
    kind = df.schema[name].dataType
    column = F.col(quoted(name))
    if isinstance(kind, T.ArrayType):
        return column.cast("array<string>")
    return F.when(column.isNotNull(), F.array(column.cast("string")))


def rebuilt_struct(df: DataFrame, name: str) -> Column:
    """A struct built anew from its fields, or NULL where the struct itself is NULL."""
    column = F.col(quoted(name))
    kind = df.schema[name].dataType
    if not isinstance(kind, T.StructType):
        return column
    fields = [column.getField(f.name).alias(f.name) for f in kind.fields]
    return F.when(column.isNotNull(), F.struct(*fields))


def json_records(df: DataFrame, body: str, path: str, name: str) -> DataFrame:
    """A row per record at a dotted path of a JSON body, its JSON text in place of the body.

    An array gives its elements and any other value gives itself. A missing path, one that
    leads through something that is not an object, or an empty array gives one row with NULL.
    The path is looked up in a projection of its own, and the outer explode brings no filter
    that would repeat it below, so each body is parsed for it once.
    """
    steps = "".join(f"['{step}']" for step in path.split(".")) if path else ""
    found = df.withColumn(body, F.get_json_object(F.col(body), "$" + steps))
    text = F.col(body)
    records = F.when(
        F.ltrim(text).startswith("["), F.from_json(text, "array<string>")
    ).otherwise(F.when(text.isNotNull(), F.array(text)))
    others = [F.col(quoted(c)) for c in df.columns if c != body]
    return found.select(*others, F.explode_outer(records).alias(name))

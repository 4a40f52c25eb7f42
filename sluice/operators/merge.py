"""Key upserts and what they need: one row per key, and a common shape.

Shapes that hold at scale:

* NULL keys match nothing, so they go around every join instead of meeting in one task.
* Where the target's keys may repeat, it is the left side of a left outer, semi or anti join.
  Adaptive execution can split a hot key on that side, which it cannot do for a full outer join.
* Where they are known to be unique, one full outer join reads and shuffles each side once.
* A batch small enough by its file size is broadcast by Spark itself, and the target is then
  not shuffled at all. No broadcast is forced here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions import quoted, row_hash
from sluice.spec import SpecError

_RANK = "__rank"
_IN = "__in_"


def latest_per_key(df: DataFrame, key: str | Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The newest row of every key; NULL is older than any value.

    Rows of equal order are told apart by a hash of the whole row, so the survivor does not
    depend on the order of the input. ``row_number() = 1`` lets Spark keep only the best row per
    key in each map task, so a hot key reaches the shuffle as one row per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    window = Window.partitionBy(*[F.col(quoted(k)) for k in keys]).orderBy(
        *[F.col(c).desc_nulls_last() for c in order_by], row_hash(df, df.columns).desc()
    )
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def dedupe_batch(df: DataFrame, key: str, mode: str, order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key in a batch. Rows without a key are all kept: they match nothing."""
    if mode == "none":
        return df
    has_key = F.col(quoted(key)).isNotNull()
    if mode == "latest":
        if not order_by:
            raise SpecError("dedupe 'latest' needs order columns")
        keyed = latest_per_key(df.filter(has_key), key, order_by)
        return keyed.unionByName(df.filter(~has_key))
    raise SpecError(f"unknown dedupe mode {mode!r}")


_WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
_FLOAT = (T.FloatType(), T.DoubleType())


def widened(table: T.DataType, batch: T.DataType, where: str) -> T.DataType:
    """The type a table column takes when a batch brings another one, or an error naming it.

    The batch's values are cast to the table's type where that holds them all. The table's type
    grows only where its files can be read as the wider one: among whole numbers, to double
    from float and from whole numbers below bigint, and by fields of structs.
    """
    if table == batch or isinstance(batch, T.NullType):
        return table
    if isinstance(table, T.NullType):
        return batch
    if isinstance(table, T.StructType) and isinstance(batch, T.StructType):
        return evolved(table, batch, where + ".")
    if isinstance(table, T.ArrayType) and isinstance(batch, T.ArrayType):
        return T.ArrayType(widened(table.elementType, batch.elementType, where + "[]"), True)
    if table in _WHOLE and batch in _WHOLE:
        return _WHOLE[max(_WHOLE.index(table), _WHOLE.index(batch))]
    if table == T.DoubleType() and batch in _WHOLE + _FLOAT:
        return table
    if batch in _FLOAT and table in _WHOLE[:3] + _FLOAT:
        return T.DoubleType()
    if table == T.FloatType() and batch in _WHOLE[:3]:
        return T.DoubleType()
    nested = (T.StructType, T.ArrayType, T.MapType, T.BinaryType)
    if isinstance(table, T.StringType) and not isinstance(batch, nested):
        return table
    raise SpecError(
        f"column {where} is {table.simpleString()} in the table "
        f"but {batch.simpleString()} in the batch"
    )


def evolved(table: T.StructType, batch: T.StructType, prefix: str = "") -> T.StructType:
    """The table's fields, widened where the batch needs it, then the batch's new fields."""
    incoming = {f.name: f for f in batch.fields}
    fields = []
    for f in table.fields:
        other = incoming.pop(f.name, None)
        kind = widened(f.dataType, other.dataType, prefix + f.name) if other else f.dataType
        fields.append(T.StructField(f.name, kind, True))
    fields += [T.StructField(f.name, f.dataType, True) for f in incoming.values()]
    return T.StructType(fields)


def empty_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows of a schema, as a plan the optimizer removes from a union."""
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).filter(F.lit(False)).select(*nulls)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows in the shape of a schema: by name, missing columns and fields NULL."""
    if df.schema == schema:
        return df
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            _shaped(F.col(quoted(f.name)), have[f.name], f.dataType).alias(f.name)
            if f.name in have
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def _shaped(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value as another type; structs by field name, at any depth."""
    if have == want:
        return column
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        inner = {f.name: f.dataType for f in have.fields}
        fields = [
            _shaped(column.getField(f.name), inner[f.name], f.dataType).alias(f.name)
            if f.name in inner
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in want.fields
        ]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(column, lambda x: _shaped(x, have.elementType, want.elementType))
    return column.cast(want)


def common_types(target: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both with their own columns, those they share in one type."""
    schema = {f.name: f for f in evolved(target.schema, batch.schema).fields}
    pick = lambda df: conform(df, T.StructType([schema[c] for c in df.columns]))
    return pick(target), pick(batch)


def append_rows(table: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of both, by name, with columns that one of them lacks NULL."""
    schema = evolved(table.schema, batch.schema)
    return conform(table, schema).unionByName(conform(batch, schema))


def upsert_rows(
    target: DataFrame, batch: DataFrame, key: str, unique: bool = False
) -> DataFrame:
    """Update the target's rows that share a key with the batch, insert the rest of the batch.

    On a match the batch's value wins even if it is NULL; columns only the target has keep
    their value; columns only the batch has are added. The batch holds a key at most once.

    ``unique`` says that the target does so too. No key is hot then, and one full outer join
    updates and inserts: either side is read and shuffled once. Where keys of the target may
    repeat, a left join that adaptive execution can split updates them, and an anti join finds
    what to insert.
    """
    _check_key(target, batch, key)
    target, batch = common_types(target, batch)
    k, incoming_key = quoted(key), quoted(_IN + key)
    known = target.filter(F.col(k).isNotNull())
    keyed = batch.filter(F.col(k).isNotNull())

    incoming = keyed.select(*[F.col(quoted(c)).alias(_IN + c) for c in keyed.columns])
    matched = F.col(incoming_key).isNotNull()
    extra = [c for c in batch.columns if c not in target.columns]
    shared = set(batch.columns) & set(target.columns)
    joined = known.join(incoming, F.col(k) == F.col(incoming_key), "full" if unique else "left")
    merged = joined.select(
        *[
            F.when(matched, F.col(quoted(_IN + c))).otherwise(F.col(quoted(c))).alias(c)
            if c in shared
            else F.col(quoted(c))
            for c in target.columns
        ],
        *[F.col(quoted(_IN + c)).alias(c) for c in extra],
    )
    if not unique:
        inserted = keyed.join(known.select(F.col(k)).distinct(), key, "left_anti")
        merged = merged.unionByName(inserted, allowMissingColumns=True)
    return merged.unionByName(
        target.filter(F.col(k).isNull()), allowMissingColumns=True
    ).unionByName(batch.filter(F.col(k).isNull()), allowMissingColumns=True)


def replace_rows(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Upsert by one anti join and a union.

    Equal to ``upsert_rows`` when the batch has every column of the target and the target
    holds a key at most once; only the batch's keys take part in the join.
    """
    _check_key(target, batch, key)
    missing = [c for c in target.columns if c not in batch.columns]
    if missing:
        raise SpecError(f"the batch lacks {', '.join(missing)}; use upsert_rows")
    target, batch = common_types(target, batch)
    return untouched_rows(target, batch, key).unionByName(batch, allowMissingColumns=True)


def untouched_rows(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Target rows whose key the batch does not hold, those without a key among them."""
    _check_key(target, batch, key)
    k = quoted(key)
    keys = batch.select(F.col(k)).filter(F.col(k).isNotNull())
    kept = target.filter(F.col(k).isNotNull()).join(keys, key, "left_anti").select(*_names(target))
    return kept.unionByName(target.filter(F.col(k).isNull()))


def drop_stale(
    batch: DataFrame, target: DataFrame, key: str, order_by: Sequence[str]
) -> DataFrame:
    """Batch rows that are newer than the target's row of the same key, or have none there.

    NULL is older than any value. Rows of equal order are told apart by a hash of the columns
    both have, so which one stays does not depend on which batch it came in. The target is first
    reduced to the batch's keys; where that shuffles it, the later steps use the same layout.
    """
    k = quoted(key)
    shared = [c for c in batch.columns if c in target.columns]
    order = lambda df: F.struct(
        *[F.col(c).alias(f"o{i}") for i, c in enumerate(order_by)],
        row_hash(df, shared).alias("hash"),
    )
    keyed = batch.filter(F.col(k).isNotNull())
    known = target.filter(F.col(k).isNotNull())
    known = known.join(keyed.select(F.col(k)), key, "left_semi")
    newest = known.groupBy(F.col(k).alias("__key")).agg(F.max(order(known)).alias("__newest"))
    fresh = (
        keyed.join(newest, F.col(k) == F.col("__key"), "left")
        .filter(F.col("__newest").isNull() | (order(keyed) > F.col("__newest")))
        .select(*_names(batch))
    )
    return fresh.unionByName(batch.filter(F.col(k).isNull()))


def _names(df: DataFrame) -> list:
    return [F.col(quoted(c)) for c in df.columns]


def _check_key(target: DataFrame, batch: DataFrame, key: str) -> None:
    for name, df in (("target", target), ("batch", batch)):
        if key not in df.columns:
            raise SpecError(f"key {key!r} is not a column of the {name}")
    check_key_type(target.schema[key].dataType, batch.schema[key].dataType, key)


def check_key_type(table: T.DataType, batch: T.DataType, key: str) -> None:
    """Keys are compared in the table's type; a batch whose keys do not fit it is refused."""
    if widened(table, batch, key) != table:
        raise SpecError(
            f"key {key!r} is {table.simpleString()} in the table "
            f"but {batch.simpleString()} in the batch"
        )

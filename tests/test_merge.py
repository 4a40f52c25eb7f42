import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from sluice.operators import merge
from sluice.spec import SpecError


def brute_upsert(target, batch, t_cols, b_cols, key):
    """MERGE in plain Python: update every match, insert the rest, NULL keys match nothing."""
    columns = t_cols + [c for c in b_cols if c not in t_cols]
    by_key = {r[key]: r for r in batch if r[key] is not None}
    out = [{**t, **by_key.get(t[key], {})} if t[key] is not None else t for t in target]
    known = {t[key] for t in target}
    out += [b for b in batch if b[key] is None or b[key] not in known]
    return sorted(
        (tuple(r.get(c) for c in columns) for r in out),
        key=lambda r: [(v is not None, str(v)) for v in r],
    )


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("small", [True, False])
def test_upsert_equals_brute_force(spark, seed, small):
    rng = random.Random(seed)
    key = lambda: rng.choice([None, *range(12)])
    target = [{"k": key(), "a": rng.randint(0, 9), "t": "old"} for _ in range(30)]  # keys repeat
    batch, seen = [], set()
    for _ in range(12):
        k = key()
        if k is None or k not in seen:
            seen.add(k)
            batch.append({"k": k, "a": rng.choice([None, 77]), "b": rng.random() < 0.5})
    t = spark.createDataFrame([tuple(r.values()) for r in target], "k int, a int, t string")
    b = spark.createDataFrame([tuple(r.values()) for r in batch], "k int, a int, b boolean")
    got = merge.upsert_rows(t, b, "k", unique=small)  # right too where keys repeat
    assert got.columns == ["k", "a", "t", "b"]
    assert rows(got) == brute_upsert(target, batch, ["k", "a", "t"], ["k", "a", "b"], "k")


def test_replace_equals_upsert_on_unique_targets(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    b = spark.createDataFrame([(2, None), (3, "c"), (None, "m")], "k int, v string")
    assert rows(merge.replace_rows(t, b, "k")) == rows(merge.upsert_rows(t, b, "k"))
    with pytest.raises(SpecError, match="lacks v"):
        merge.replace_rows(t, b.drop("v"), "k")


def test_key_must_exist_and_fit_the_tables_type(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    for schema, value in (("k string", "1"), ("k bigint", 1)):
        with pytest.raises(SpecError, match="int in the table but"):
            merge.upsert_rows(t, spark.createDataFrame([(value,)], schema), "k")
    text = spark.createDataFrame([("1", "a"), ("x", "b")], "k string, v string")
    assert rows(merge.upsert_rows(text, spark.createDataFrame([(1, "n")], "k int, v string"), "k")) == [
        ("1", "n"), ("x", "b")]
    with pytest.raises(SpecError, match="not a column"):
        merge.upsert_rows(t, t.drop("k"), "k")


def test_dedupe_keeps_the_newest_and_every_row_without_key(spark):
    df = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, "b"), (1, None, "c"), (None, 1, "d"), (None, 1, "d")], "k int, o int, v string"
    )
    out = merge.dedupe_batch(df, "k", "latest", ["o"])
    assert rows(out, "k", "v") == [(None, "d"), (None, "d"), (1, "b")]
    assert merge.dedupe_batch(df, "k", "none") is df
    with pytest.raises(SpecError):
        merge.dedupe_batch(df, "k", "latest")


def test_hot_keys_shrink_before_the_shuffle(spark, sf):
    df = merge.latest_per_key(spark.read.parquet(f"{sf}/events.parquet"), "user_id", ["ts"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_small_batches_leave_the_target_unshuffled(spark, sf):
    t = spark.read.parquet(f"{sf}/lineitem.parquet")
    b = spark.read.parquet(f"{sf}/supplier.parquet").select(t.columns[0:0] or "s_suppkey")
    b = b.withColumnRenamed("s_suppkey", "l_suppkey")
    plan = merge.untouched_rows(t, b, "l_suppkey")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_stale_rows_are_dropped(spark):
    t = spark.createDataFrame([(1, 5), (2, 5)], "k int, o int")
    b = spark.createDataFrame([(1, 4), (2, 6), (3, 1), (None, 0)], "k int, o int")
    assert rows(merge.drop_stale(b, t, "k", ["o"])) == [(None, 0), (2, 6), (3, 1)]


def test_null_order_is_oldest(spark):
    t = spark.createDataFrame([(1, 5), (2, None)], "k int, o int")
    b = spark.createDataFrame([(1, None), (2, 0), (3, None)], "k int, o int")
    assert rows(merge.drop_stale(b, t, "k", ["o"])) == [(2, 0), (3, None)]


def test_ties_do_not_depend_on_the_order_of_rows_or_batches(spark):
    schema = "k int, o int, v string, m map<string,int>"
    data = [(1, 7, v, {v: 1}) for v in "abcdefgh"]
    forms = [spark.createDataFrame(d, schema) for d in (data, data[::-1])]
    best = [rows(merge.latest_per_key(df, "k", ["o"]), "v")[0] for df in forms]
    assert best[0] == best[1]
    for row in data:  # one batch per row, against a table that holds the best or another row
        one = spark.createDataFrame([row], schema)
        if (row[2],) == best[0]:
            assert merge.drop_stale(one, forms[0].filter(F.col("v") != row[2]), "k", ["o"]).count() == 1
        else:
            assert merge.drop_stale(one, forms[0], "k", ["o"]).isEmpty()


def test_append_rows_by_name_with_wider_types(spark):
    a = spark.createDataFrame([(1, "x", (1,))], "i int, s string, n struct<p:int>")
    b = spark.createDataFrame([((2, 3), 2**40)], "n struct<p:int,q:int>, i bigint")
    out = merge.append_rows(a, b)
    assert out.schema["i"].dataType.simpleString() == "bigint"
    assert rows(out, "i", "s", "n.p", "n.q") == [(1, "x", 1, None), (2**40, None, 2, 3)]


def test_upsert_unites_nested_fields_and_types(spark):
    t = spark.createDataFrame([(1, (1,), [(1,)], 5.0), (2, (2,), None, 6.0)],
                              "k bigint, n struct<a:int>, l array<struct<x:int>>, d double")
    b = spark.createDataFrame([(2, (7, "z"), [("y", 3)], 8)],
                              "k int, n struct<a:bigint,b:string>, l array<struct<w:string,x:int>>, d bigint")
    for merged in (merge.upsert_rows(t, b, "k"), merge.replace_rows(t, b, "k")):
        assert merged.schema["n"].dataType.simpleString() == "struct<a:bigint,b:string>"
        assert rows(merged, "k", "n.a", "n.b", "l.x", "l.w", "d") == [
            (1, 1, None, [1], [None], 5.0), (2, 7, "z", [3], ["y"], 8.0)]


@pytest.mark.parametrize("table, batch, result", [
    ("int", "bigint", "bigint"), ("bigint", "int", "bigint"), ("double", "bigint", "double"),
    ("int", "double", "double"), ("float", "double", "double"), ("float", "int", "double"),
    ("string", "int", "string"), ("string", "timestamp", "string"), ("void", "int", "int"),
    ("int", "void", "int"), ("bigint", "double", None), ("int", "string", None),
    ("date", "timestamp", None), ("string", "array<string>", None), ("boolean", "int", None),
    ("decimal(10,2)", "decimal(10,2)", "decimal(10,2)"), ("decimal(10,2)", "int", None),
])
def test_widening(spark, table, batch, result):
    kind = lambda t: spark.range(1).selectExpr(f"CAST(NULL AS {t}) AS c").schema["c"].dataType
    if result is None:
        with pytest.raises(SpecError, match="column c"):
            merge.widened(kind(table), kind(batch), "c")
    else:
        assert merge.widened(kind(table), kind(batch), "c") == kind(result)


def test_types_that_cannot_meet_are_named(spark):
    a = spark.createDataFrame([(1,)], "i int")
    b = spark.createDataFrame([("x",)], "i string")
    with pytest.raises(SpecError, match="column i is int in the table but string"):
        merge.append_rows(a, b)

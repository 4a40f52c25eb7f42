import datetime as dt

import pytest
from helpers import rows

from sluice.functions import json_records
from sluice.operators import filters, rules
from sluice.spec import Rule, SpecError


def test_fill_na_fills_null_and_nan_where_the_type_fits(spark, clock):
    df = spark.createDataFrame([(1, None, None), (2, float("nan"), "x")], "id int, a double, b string")
    assert rows(rules.fill_na(df, ["a", "b", "zz"], 0)) == [(1, 0.0, None), (2, 0.0, "x")]
    assert rows(rules.fill_na(df, ["b"], "-"), "id", "b") == [(1, "-"), (2, "x")]
    assert rules.fill_na(df, [], 0) is df


def test_upper_case_turns_numbers_into_strings(spark):
    df = spark.createDataFrame([(1, "ab")], "id int, s string")
    out = rules.upper_case(df, ["id", "s", "zz"])
    assert rows(out) == [("1", "AB")]
    assert out.columns == ["id", "s"]


def test_cast_gives_null_for_values_that_do_not_fit(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "v string")
    assert rows(rules.cast_type(df, ["v"], "int")) == [(None,), (None,), (1,)]
    assert rules.cast_type(df, ["v"], "double").schema["v"].dataType.simpleString() == "double"


def test_rules_see_the_metadata_and_each_other(spark, clock):
    df = spark.createDataFrame([(1, None)], "id int, n string")
    df = rules.with_run_metadata(df, "r", "full", "csv", clock)
    chain = [
        Rule("fill_na", ("n",), "abc"),
        Rule("upper_case", ("n", "_source_name")),
        Rule("add_ingestion_timestamp"),
    ]
    out = rules.apply_rules(df, chain, clock)
    row = out.head()
    assert (row["n"], row["_source_name"], row["_ingestion_type"]) == ("ABC", "CSV", "FULL")
    assert row["_ingested_at"] == row["ingested_at"] == clock


def test_unknown_rule_is_an_error(spark, clock):
    with pytest.raises(SpecError):
        rules.apply_rule(spark.range(1), Rule("nope"), clock)


def test_ingest_date_joins_the_partitions_once(spark, clock):
    df = rules.with_run_metadata(spark.range(1), "r", "full", "csv", clock)
    out, by = rules.with_ingest_date(df, ["id"])
    assert by == ("id", "_ingest_date")
    assert out.head()["_ingest_date"] == dt.date(2025, 6, 1)
    assert rules.with_ingest_date(df, ["_ingest_date"])[1] == ("_ingest_date",)
    assert rules.with_ingest_date(spark.range(1), ["id"])[1] == ("id",)


def test_bound_is_strict_typed_and_skips_null(spark):
    df = spark.createDataFrame([(1,), (9,), (10,), (None,)], "n int")
    assert rows(filters.newer_than(df, "n", "9")) == [(10,)]
    text = spark.createDataFrame([("1",), ("9",), ("10",)], "n string")
    assert rows(filters.newer_than(text, "n", "9")) == []
    assert rows(filters.newer_than(text, "n", "1")) == [("10",), ("9",)]


def test_bad_bounds_are_refused_before_any_job(spark):
    df = spark.createDataFrame([(1,)], "n int")
    with pytest.raises(SpecError, match="does not fit"):
        filters.newer_than(df, "n", "yesterday")
    with pytest.raises(SpecError, match="not in the source"):
        filters.newer_than(df, "after", "1")


def test_bound_reaches_the_scan(spark, sf):
    for table, column, bound in [
        ("orders", "o_orderkey", "599"),
        ("events", "ts", "2024-01-15 00:00:00"),
        ("customer", "c_name", "Customer#000000090"),
    ]:
        df = filters.newer_than(spark.read.parquet(f"{sf}/{table}.parquet"), column, bound)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert f"GreaterThan({column}," in plan


def test_arrays_become_arrays_of_strings(spark):
    df = spark.sql(
        "SELECT 1 AS id, array(1, 2) AS images, 'x' AS eventLogs, array(named_struct('a', 1)) AS s, "
        "CAST(NULL AS string) AS n"
    )
    out = rules.strings_in_arrays(df, ["images", "eventLogs", "s", "n", "zz"]).head()
    assert (out["images"], out["eventLogs"], out["s"], out["n"]) == (["1", "2"], ["x"], ["{1}"], None)


def test_structs_stay_null_where_they_are_null(spark):
    df = spark.createDataFrame([(1, ("a", None)), (2, None)], "id int, vehicle struct<p:string,q:int>")
    out = rules.rebuilt_structs(df, ["vehicle", "zz"])
    assert out.schema["vehicle"].dataType == df.schema["vehicle"].dataType
    assert [r["vehicle"] is None for r in out.orderBy("id").collect()] == [False, True]


def test_flat_key(spark):
    df = spark.createDataFrame([((7,),)], "data struct<id:int>")
    out, key = rules.flat_key(df, "data.id")
    assert key == "data_id" and out.head()["data_id"] == 7
    assert rules.flat_key(df, "data") == (df, "data")
    assert rules.flat_key(df, None) == (df, None)


def test_next_bound(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "n int")
    assert rows(filters.next_bound(df, "n", "job")) == [("job", 5)]


@pytest.mark.parametrize(
    "body, path, expected",
    [
        ('{"a":{"b":[{"x":1},{"x":2}]}}', "a.b", ['{"x":1}', '{"x":2}']),
        ('[{"x":1}]', "", ['{"x":1}']),
        ('{"x":1}', "", ['{"x":1}']),
        ('{"a":{"b":{"x":1}}}', "a.b", ['{"x":1}']),
        ('{"a":[1]}', "a.b", []),
        ('{"a":1}', "zz", []),
        ('{"a":[]}', "a", []),
        ("[]", "", []),
    ],
)
def test_records_at_a_path(spark, body, path, expected):
    df = spark.createDataFrame([(body,)], "body string")
    assert [r["r"] for r in json_records(df, "body", path, "r").collect()] == (expected or [None])

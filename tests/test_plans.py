"""What the plans must look like, whatever the size of the data."""

import json
import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from sluice.catalog import QUERIES
from sluice.functions import json_records
from sluice.operators import merge, quality
from sluice.plans.job import prepare
from sluice.plans.table import Table
from sluice.sources.rest import dig
from sluice.spec import parse_spec


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_prepared_batch_is_one_scan_without_shuffle_or_python(spark, sf, clock):
    spec = parse_spec({
        "job_name": "orders", "source_type": "parquet", "ingestion_type": "incremental",
        "incremental_column": "o_orderkey", "last_ingestion_value": "599",
        "target": {"path": "unused", "primary_key": "o_orderkey", "transformations": [
            {"type": "fill_na", "columns": ["o_totalprice"], "value": 0},
            {"type": "upper_case", "columns": ["o_orderstatus"]},
            {"type": "cast_type", "columns": ["o_custkey"], "data_type": "string"},
            {"type": "add_ingestion_timestamp"}]}})
    batch, partition_by, key = prepare(spark.read.parquet(f"{sf}/orders.parquet"), spec, "r", clock)
    text = plan(batch)
    assert text.count("FileScan") == 1 and "GreaterThan(o_orderkey,599)" in text
    assert "Exchange" not in text and "Python" not in text
    assert (partition_by, key) == (("_ingest_date",), "o_orderkey")


def test_a_load_partitioned_by_its_date_is_not_shuffled(spark, path, monkeypatch):
    hints = []
    real = type(spark.range(1)).hint
    monkeypatch.setattr(type(spark.range(1)), "hint", lambda self, *a: hints.append(a) or real(self, *a))
    day = spark.range(10).select("id", (F.col("id") % 2).alias("p"), F.lit("2025-06-01").cast("date").alias("_ingest_date"))
    Table(spark, path).append(day, ["_ingest_date"])
    assert not hints
    Table(spark, path + "2").append(day, ["p", "_ingest_date"])
    assert hints == [("rebalance", "p", "_ingest_date")]


def test_matching_reads_only_the_key(spark, path):
    t = Table(spark, path)
    t.upsert(spark.range(100).selectExpr("id AS k", "'a' AS wide", "id AS v"), "k")
    near = t.read().select("k")
    assert "ReadSchema: struct<k:bigint>" in plan(near)


def test_reading_a_table_opens_no_footer_to_plan(spark, path):
    t = Table(spark, path)
    t.append(spark.range(5))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "")
    t.read().schema
    assert list(tracker.getJobIdsForGroup("plan-only")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name", ["duplicate_keys", "duplicate_rate", "count_by_type", "row_count"])
def test_counts_are_aggregated_before_the_shuffle(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "partial_count(1)" in text


def test_conforming_rows_adds_no_union(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    schema = merge.evolved(orders.schema, spark.range(1).selectExpr("1 AS extra").schema)
    assert "Union" not in plan(merge.conform(orders, schema))
    assert merge.conform(orders, orders.schema) is orders


def test_no_query_of_the_hot_path_runs_python(spark, sf):
    for name in ("merge_upsert", "dedupe_latest", "rule_chain", "enrich_metadata", "array_to_strings",
                 "reconcile_counts", "extract_records_by_path", "synth_bench_rows"):
        assert "Python" not in plan(QUERIES[name](spark, sf)), name


def random_json(rng, depth=3):
    kinds = ["int", "float", "text", "none", "bool"] + (["list", "dict"] * 2 if depth else [])
    match rng.choice(kinds):
        case "int":
            return rng.randint(-(2**62), 2**62)
        case "float":
            return rng.choice([0.5, -1e-7, 1e22, 3.141592653589793, rng.random()])
        case "text":
            return "".join(rng.choice('ab"\\\n\t é漢😀{}[],:') for _ in range(rng.randint(0, 8)))
        case "none":
            return None
        case "bool":
            return rng.random() < 0.5
        case "list":
            return [random_json(rng, depth - 1) for _ in range(rng.randint(0, 3))]
    return {rng.choice("abc"): random_json(rng, depth - 1) for _ in range(rng.randint(0, 3))}


@pytest.mark.parametrize("route", ["", "r", "a.b"])
def test_records_equal_those_found_in_python(spark, route):
    rng = random.Random(route)
    docs = []
    for i in range(200):
        records = [{"id": i, "x": random_json(rng)} for _ in range(rng.randint(0, 4))]
        node = records if rng.random() < 0.8 else {"id": i, "x": random_json(rng)}
        for step in reversed(route.split(".") if route else []):
            node = {step: node, "noise": random_json(rng)}
        docs.append(node if rng.random() < 0.9 else {"other": 1, "a": [1]})
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "i int, body string")
    found = {}
    for row in json_records(df, "body", route, "r").filter("r IS NOT NULL").collect():
        found.setdefault(row["i"], []).append(json.loads(row["r"]))
    for i, doc in enumerate(docs):
        want = dig(doc, route)
        want = [] if want is None else want if isinstance(want, list) else [want]
        assert found.get(i, []) == want, doc


def test_reconcile_scans_each_side_once(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    table = events.withColumn("_ingestion_id", F.lit("r"))
    text = plan(quality.reconcile(events, table, "r"))
    assert text.count("FileScan") == 2
    assert rows(quality.reconcile(events, table, "r"), "sc", "tc") == [(1000, 1000)]


def shuffles(df, column):
    """Exchanges that deal rows by a column, and scans below them, in the first plan."""
    text = plan(df)
    return text.count(f"Exchange hashpartitioning({column}#"), text.count("FileScan parquet"), text


@pytest.mark.parametrize("mb", [1, 38, 100])
def test_one_plan_finds_the_files_an_upsert_hits(spark, path, mb):
    """Target and batch are read once; beyond what Spark broadcasts each is shuffled once by the key."""
    t = Table(spark, path)
    t.upsert(spark.range(1000).selectExpr("id AS k", "'a' AS wide"), "k")
    batch = t._stage(spark.range(mb * 125_000, numPartitions=4).selectExpr("xxhash64(id) AS k"), ())
    base = t.snapshot()
    dealt, scans, text = shuffles(t._hits(t._rows(base.paths, base.struct), "k", batch), "k")
    assert scans == 2 and "wide" not in text.split("ReadSchema")[1].split("\n")[0]
    assert dealt == (0 if mb == 1 else 2)


@pytest.mark.parametrize("mb", [1, 38, 100])
def test_an_upsert_of_unique_keys_shuffles_the_target_once(spark, path, mb):
    spark.range(1000).selectExpr("id AS k", "id AS v").write.parquet(path + "t")
    spark.range(mb * 62_500, numPartitions=4).selectExpr("xxhash64(id) AS k", "id AS v").write.parquet(path + "b")
    t, b = (spark.read.parquet(path + x).filter("k IS NOT NULL") for x in "tb")
    merged = merge.upsert_rows(t, b, "k", unique=True)
    text = plan(merged)
    assert text.count("FullOuter") == 1 and text.count("LeftAnti") == 0
    assert text.count("Exchange hashpartitioning") == 2


def test_newer_rows_are_found_with_one_shuffle_of_each_side(spark, path):
    spark.range(1000).selectExpr("id AS k", "id AS v").write.parquet(path + "t")
    t = spark.read.parquet(path + "t")
    session = t.sparkSession
    before = session.conf.get("spark.sql.autoBroadcastJoinThreshold")
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(merge.drop_stale(t.selectExpr("k", "v + 1 AS v"), t, "k", ["v"]))
    finally:
        session.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("Exchange hashpartitioning") == 3  # the batch as rows and as keys, the target

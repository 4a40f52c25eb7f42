from helpers import rows

from sluice import synth
from sluice.operators import quality, reports
from pyspark.sql import functions as F


def test_duplicate_rate_of_an_empty_table_is_zero(spark):
    assert rows(quality.duplicate_rate(spark.createDataFrame([], "k int"), "k")) == [(0, 0, 0.0)]


def test_duplicates_count_keys_not_rows(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "k int")
    assert rows(quality.duplicate_keys(df, "k")) == [(None, 2), (1, 3)]
    assert rows(quality.duplicate_rate(df, "k")) == [(6, 2, 33.33)]


def test_verdicts():
    assert quality.judge_counts(5, 5) == (5, "SUCCESS")
    assert quality.judge_counts(5, 4) == (4, "FAILED")
    assert quality.judge_counts(1, 1) == (1, "SUCCESS")
    assert quality.judge_counts(1, 1, min_rows=2) == (1, "FAILED")
    assert quality.judge_counts(0, 0) == (0, "SUCCESS")


def test_throughput_without_a_duration_is_null(spark, clock):
    log = spark.createDataFrame(
        [(clock, "a", "SUCCESS", 10, 4.0), (clock, "b", "SUCCESS", 10, 0.0)],
        "ts timestamp, job_name string, status string, source_count bigint, duration double",
    )
    assert rows(reports.throughput(log), "job_name", "speed_rec_per_sec") == [("a", 2.5), ("b", None)]
    later = log.withColumn("ts", F.expr("ts + INTERVAL 1 DAY")).withColumn("job_name", F.lit("new"))
    assert reports.throughput(log.unionByName(later)).head()["job_name"] == "new"


def test_top_n_sorts_no_whole_table(spark, sf):
    df = reports.latest_n(spark.read.parquet(f"{sf}/events.parquet"), ["ts", "event_id"], 10)
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()


def test_sample_rows_with_nested_columns(spark):
    df = spark.createDataFrame([(1, (2,))] * 9, "a int, n struct<b:int>")
    assert rows(reports.sample_rows(df, 5, "a", "n.b")) == [(1, 2)] * 5


def test_benchmark_rows(spark):
    df = synth.benchmark_rows(spark, 1000)
    first = df.filter("id = 61").head()
    assert (first["product"], first["category"], first["timestamp"]) == (
        "Product_11", "Category_1", "2025-01-01 00:01:01")
    low, high, n = df.agg(F.min("price"), F.max("price"), F.countDistinct("price")).head()
    assert 10 <= low < 30 and 480 < high < 500 and n == 1000
    assert rows(df) == rows(synth.benchmark_rows(spark, 1000).repartition(3))
    assert rows(df, "price") != rows(synth.benchmark_rows(spark, 1000, seed=1), "price")


def test_feed_rows_stay_in_their_ranges(spark):
    ids = spark.range(20_000)  # enough for both ends of every range
    moment = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    orders = synth.feed_orders(ids, moment)
    assert {r[0] for r in orders.select("status").distinct().collect()} == set(synth.STATUSES)
    low, high = orders.agg(F.min("amount"), F.max("amount")).head()
    assert 10 <= low and high <= 1000
    products = synth.feed_products(ids, moment)
    assert tuple(products.agg(F.min("price"), F.max("price"), F.min("id"), F.max("id")).head()) == (10, 500, 1, 1000)
    assert synth.feed_users(ids).head()["email"].endswith("@example.com")


def test_draws_are_even_and_neither_ids_nor_seeds_are_alike(spark):
    from collections import Counter

    from pyspark.sql import functions as F

    ids = spark.range(-50, 40_000).unionByName(spark.range(2**40, 2**40 + 10_000))
    got = ids.select("id", *[synth.draw(s).alias(f"s{s}") for s in range(3)]).collect()
    for s in range(3):
        draws = [r[f"s{s}"] for r in got]
        assert min(draws) >= 0 and max(draws) < synth.PRIME and len(set(draws)) > 0.999 * len(draws)
        tenths = Counter(10 * d // synth.PRIME for d in draws)
        assert all(abs(n - len(draws) / 10) < 350 for n in tenths.values())
        steps = Counter(((b - a) % synth.PRIME) * 10 // synth.PRIME for a, b in zip(draws, draws[1:]))
        assert all(abs(n - len(draws) / 10) < 350 for n in steps.values())
    pairs = Counter((10 * r["s0"] // synth.PRIME, 10 * r["s1"] // synth.PRIME) for r in got)
    assert all(abs(n - len(got) / 100) < 130 for n in pairs.values()) and len(pairs) == 100
    assert spark.range(5).select(F.min(synth.draw(7)) == F.min(synth.draw(7))).head()[0]


def test_wide_keys_are_shuffled_only_where_their_hash_repeats(spark, tmp_path):
    path = str(tmp_path / "wide")
    data = spark.range(3000).selectExpr("IF(id % 500 = 0, NULL, repeat(CAST(id % 2900 AS string), 20)) AS k", "id")
    data.write.parquet(path)
    df = spark.read.parquet(path)
    got = {r.k: r.n for r in quality.duplicate_keys(df, "k").collect()}
    want = {r.k: r.n for r in df.groupBy("k").count().filter("count > 1").withColumnRenamed("count", "n").collect()}
    assert got == want and len(got) > 90 and None in got
    assert rows(quality.duplicate_rate(df, "k")) == [(3000, len(want), round(100 * len(want) / 3000, 2))]
    text = quality.duplicate_keys(df, "k")._jdf.queryExecution().executedPlan().toString()
    below = text.split("Join")[1]
    assert "hashpartitioning(__hash" in below and "hashpartitioning(k" not in below and "LeftSemi" in text
    # Rows that go to the count by value: those of repeated keys, and no others.
    counted = quality.repeated(df, "k").agg(F.sum("n")).head()[0]
    assert counted == sum(want.values())


def test_rates_of_empty_tables_and_narrow_keys(spark):
    assert rows(quality.duplicate_rate(spark.range(0).selectExpr("CAST(id AS string) AS k"), "k")) == [(0, 0, 0.0)]
    narrow = spark.range(10).selectExpr("id % 4 AS k")
    assert rows(quality.duplicate_rate(narrow, "k")) == [(10, 4, 40.0)]
    assert "LeftSemi" not in quality.duplicate_keys(narrow, "k")._jdf.queryExecution().executedPlan().toString()

"""Rows that come late at the bound of a load, ties and copies among them."""

import random
from collections import Counter

import pytest
from helpers import frame, rows

from sluice.operators import filters
from sluice.plans.job import run_job
from sluice.plans.table import Table
from sluice.spec import SpecError, parse_spec


def spec_of(tmp_path, fmt="snapshot", **target):
    return parse_spec({
        "job_name": "late", "source_type": "parquet", "ingestion_type": "incremental", "incremental_column": "t", "late_rows": True,
        "source_config": {"path": str(tmp_path / "landing")}, "target": {"path": str(tmp_path / "target"), "format": fmt, **target}})


def put(spark, tmp_path, data, schema="t int, v string, n struct<a:int,b:int>"):
    frame(spark, data, schema).write.mode("append").parquet(str(tmp_path / "landing"))


def target(spark, tmp_path, fmt):
    path = str(tmp_path / "target")
    return Table(spark, path).read() if fmt == "snapshot" else spark.read.format(fmt).load(path)


@pytest.mark.parametrize("fmt", ["snapshot", "parquet"])
@pytest.mark.parametrize("seed", range(3))
def test_every_row_arrives_once(spark, tmp_path, clock, fmt, seed):
    rng, landed = random.Random(seed), []
    for day in range(4):
        new = [(rng.choice([day, day, day + 1]), rng.choice(["a", "b", None]), rng.choice([None, {"a": 1, "b": None}, {"a": None, "b": 1}])) for _ in range(25)]
        # What lies below the bound by now is late beyond repair: a bounded load never sees it.
        bound = max((r[0] for r in landed), default=-1)
        new = [r for r in new if r[0] >= bound]
        landed += new
        put(spark, tmp_path, new)
        run_job(spark, spec_of(tmp_path, fmt), str(tmp_path / "audit"), resume=True, run_id=f"r{day}", clock=clock.replace(hour=day))
        got = Counter((r.t, r.v, str(r.n and r.n.asDict())) for r in target(spark, tmp_path, fmt).collect())
        assert got == Counter((t, v, str(n)) for t, v, n in landed)


def test_a_new_column_does_not_bring_known_rows_again(spark, tmp_path, clock):
    audit = str(tmp_path / "audit")
    put(spark, tmp_path, [(1, "a"), (1, "b")], "t int, v string")
    run_job(spark, spec_of(tmp_path), audit, resume=True, run_id="r0", clock=clock)
    landing = str(tmp_path / "landing")
    wide = spark.read.parquet(landing).selectExpr("*", "CAST(NULL AS string) AS extra").collect()
    frame(spark, [tuple(r) for r in wide] + [(1, "a", "x"), (2, "c", None)], "t int, v string, extra string").write.mode("overwrite").parquet(landing)
    run_job(spark, spec_of(tmp_path), audit, resume=True, run_id="r1", clock=clock.replace(hour=1))
    assert rows(target(spark, tmp_path, "snapshot"), "t", "v", "extra", "_ingestion_id") == [(1, "a", None, "r0"), (1, "a", "x", "r1"), (1, "b", None, "r0"), (2, "c", None, "r1")]


def test_keyed_loads_send_only_what_is_new(spark, tmp_path, clock):
    audit, spec = str(tmp_path / "audit"), spec_of(tmp_path, primary_key="v")
    put(spark, tmp_path, [(1, "a", None), (1, "b", None)])
    run_job(spark, spec, audit, resume=True, run_id="r0", clock=clock)
    put(spark, tmp_path, [(1, "c", None)])
    report = run_job(spark, spec, audit, resume=True, run_id="r1", clock=clock.replace(hour=1))
    assert (report.source_count, report.next_value) == (1, "1")
    assert rows(target(spark, tmp_path, "snapshot"), "v", "_ingestion_id") == [("a", "r0"), ("b", "r0"), ("c", "r1")]


def test_copies_beyond_those_known_come_through(spark):
    here = filters.with_digest(spark.createDataFrame([(5, "x")] * 7 + [(5, "y")] * 2 + [(6, "z"), (4, "old"), (None, "n")], "t int, v string"))
    known = filters.with_digest(spark.createDataFrame([(5, "x")] * 3 + [(5, "y")] * 4 + [(4, "z")], "t int, v string"))
    got = filters.from_bound(here, "t", "5", known)
    assert rows(got, "t", "v") == [(5, "x")] * 4 + [(6, "z")] and got.columns == here.columns


def test_copies_are_made_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(filters, "_COPIES", 4)
    here = filters.with_digest(spark.createDataFrame([(5,)] * 21, "t int"))
    for n in (0, 1, 13, 20, 21):
        known = filters.with_digest(spark.createDataFrame([(5,)] * n, "t int"))
        assert filters.from_bound(here, "t", "5", known).count() == 21 - n


def test_ties_and_copies_are_counted_before_the_shuffle(spark, tmp_path):
    spark.range(100).selectExpr("id % 2 AS t", "id % 3 AS v").write.parquet(str(tmp_path / "a"))
    df = filters.with_digest(spark.read.parquet(str(tmp_path / "a")))
    text = filters.from_bound(df, "t", "1", df)._jdf.queryExecution().executedPlan().toString()
    assert text.count("partial_count") == 2 and "EqualTo(t,1)" in text and "GreaterThan(t,1)" in text


def test_digests_tell_values_from_columns(spark):
    df = filters.with_digest(spark.createDataFrame([(1, None), (None, 1), (None, None), (1, 1)], "a int, b int"))
    assert df.select("_row_digest").distinct().count() == 4
    swapped = filters.with_digest(spark.createDataFrame([(None, 1), (1, None)], "b int, a int"))
    assert df.join(swapped, "_row_digest").count() == 2


def test_a_rule_may_not_change_the_bounded_column(tmp_path):
    with pytest.raises(SpecError, match="a rule changes it"):
        spec_of(tmp_path, transformations=[{"type": "cast_type", "columns": ["t"]}])
    with pytest.raises(SpecError, match="needs incremental_column"):
        parse_spec({"source_type": "parquet", "late_rows": True, "target": {"path": "x"}})

"""Loads without a key that are run again after a failure, and what they leave."""

import datetime as dt
import os

import pytest
from helpers import rows

from sluice.plans import job
from sluice.plans.audit import AUDIT_BUCKETS, append_audit, last_run, read_audit, report_rows
from sluice.plans.job import run_all, run_job
from sluice.plans.table import Table
from sluice.spec import parse_spec

FORMATS = ["snapshot", "parquet", "csv"]


def spec_of(tmp_path, fmt="snapshot", name="load", **more):
    return parse_spec({
        "job_name": name, "source_type": "parquet", "ingestion_type": "incremental", "incremental_column": "t",
        "source_config": {"path": str(tmp_path / "landing")},
        "target": {"path": str(tmp_path / "target"), "format": fmt, "partition_by": ["p"]}, **more})


def land(spark, tmp_path, low, high):
    spark.range(low, high).selectExpr("id", "id AS t", "id % 2 AS p").write.mode("append").parquet(str(tmp_path / "landing"))


def loaded(spark, tmp_path, fmt):
    path = str(tmp_path / "target")
    df = Table(spark, path).read() if fmt == "snapshot" else spark.read.option("header", "true").format(fmt).load(path)
    return sorted((int(i), r) for i, r in df.select("id", "_ingestion_id").collect())


def run(spark, tmp_path, clock, n, **kwargs):
    return run_job(spark, kwargs.pop("spec"), str(tmp_path / "audit"), resume=True, run_id=f"run-{n}", clock=clock + dt.timedelta(days=n), **kwargs)


@pytest.mark.parametrize("fmt", FORMATS)
def test_a_run_that_dies_after_its_write_is_replaced(spark, tmp_path, clock, fmt, monkeypatch):
    """No audit row at all: the driver was lost between write and record."""
    land(spark, tmp_path, 0, 10)
    run(spark, tmp_path, clock, 0, spec=spec_of(tmp_path, fmt))
    land(spark, tmp_path, 10, 20)
    with monkeypatch.context() as m:
        m.setattr(job, "append_audit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            run(spark, tmp_path, clock, 1, spec=spec_of(tmp_path, fmt))
    assert len(loaded(spark, tmp_path, fmt)) == 20
    land(spark, tmp_path, 20, 25)
    report = run(spark, tmp_path, clock, 2, spec=spec_of(tmp_path, fmt))
    assert (report.status, report.source_count, report.target_count) == ("SUCCESS", 15, 15)
    assert loaded(spark, tmp_path, fmt) == [(i, "run-0" if i < 10 else "run-2") for i in range(25)]


@pytest.mark.parametrize("fmt", FORMATS)
def test_good_runs_add_up_and_empty_ones_change_nothing(spark, tmp_path, clock, fmt):
    for n in range(3):
        land(spark, tmp_path, 10 * n, 10 * n + 10)
        run(spark, tmp_path, clock, 2 * n, spec=spec_of(tmp_path, fmt))
        assert run(spark, tmp_path, clock, 2 * n + 1, spec=spec_of(tmp_path, fmt)).source_count == 0
    assert loaded(spark, tmp_path, fmt) == [(i, f"run-{i // 10 * 2}") for i in range(30)]


def test_a_first_load_that_fails_is_replaced(spark, tmp_path, clock):
    land(spark, tmp_path, 0, 10)
    for n, least in enumerate([10**9, 10**9, 0]):
        run(spark, tmp_path, clock, n, spec=spec_of(tmp_path, min_rows=least))
    assert loaded(spark, tmp_path, "snapshot") == [(i, "run-2") for i in range(10)]


def test_full_loads_that_are_resumed_still_add_up(spark, tmp_path, clock):
    land(spark, tmp_path, 0, 3)
    full = spec_of(tmp_path, ingestion_type="full")
    for n, least in enumerate([0, 10**9, 0]):
        run(spark, tmp_path, clock, n, spec=spec_of(tmp_path, ingestion_type="full", min_rows=least))
    assert full.min_rows == 0
    assert loaded(spark, tmp_path, "snapshot") == [(i, r) for i in range(3) for r in ("run-0", "run-2")]


def test_runs_that_are_not_resumed_are_never_replaced(spark, tmp_path, clock):
    land(spark, tmp_path, 0, 3)
    for n in range(2):
        run_job(spark, spec_of(tmp_path, min_rows=10**9), str(tmp_path / "audit"), run_id=f"run-{n}", clock=clock)
    assert len(loaded(spark, tmp_path, "snapshot")) == 6


def test_two_jobs_of_one_table_do_not_replace_each_other(spark, tmp_path, clock):
    land(spark, tmp_path, 0, 4)
    for n, name in enumerate(["a", "b", "a", "b"]):
        run(spark, tmp_path, clock, n, spec=spec_of(tmp_path, name=name, min_rows=10**9 if n < 2 else 0))
    assert loaded(spark, tmp_path, "snapshot") == [(i, r) for i in range(4) for r in ("run-2", "run-3")]


def test_compaction_leaves_a_load_that_may_be_replaced(spark, path, clock):
    t = Table(spark, path)
    for i in range(4):
        t.append(spark.range(i, i + 1))
    t.append(spark.range(50, 60).repartition(5), share=("job", "first"))
    assert t.compact() == 1
    t.append(spark.range(70, 72), share=("job", "first"))
    assert rows(t.read()) == [(i,) for i in [0, 1, 2, 3, 70, 71]]
    t.append(spark.range(80, 81), share=("job", "second"))
    t.expire(0, clock=dt.datetime.now() + dt.timedelta(minutes=1))
    assert rows(t.read()) == [(i,) for i in [0, 1, 2, 3, 70, 71, 80]]


def test_a_target_that_cannot_be_read_fails_the_run(spark, tmp_path, clock, monkeypatch):
    land(spark, tmp_path, 0, 3)
    monkeypatch.setattr("sluice.plans.sink.SnapshotSink.read_day", lambda *a: (_ for _ in ()).throw(OSError("no disk")))
    with pytest.raises(OSError, match="no disk"):
        run(spark, tmp_path, clock, 0, spec=spec_of(tmp_path))
    assert rows(read_audit(spark, str(tmp_path / "audit")), "status", "error") == [("FAILED", "no disk")]


# -- the log itself --------------------------------------------------------------


def reports(spark, clock, *runs):
    from sluice.plans.audit import RunReport

    return report_rows(spark, [
        RunReport(i, name, "FULL", status, next_value=value, ts=clock + dt.timedelta(hours=h)) for i, name, status, value, h in runs])


def test_the_next_run_goes_on_from_the_newest_good_one(spark, path, clock):
    assert last_run(read_audit(spark, path, "a"), "a").bound is None
    append_audit(reports(spark, clock, ("1", "a", "SUCCESS", "5", 0), ("2", "a", "SUCCESS", None, 1), ("3", "a", "FAILED", "9", 2), ("4", "b", "SUCCESS", "7", 3)), path)
    found = last_run(read_audit(spark, path, "a"), "a")
    assert (found.ingestion_id, found.bound) == ("2", "5")
    assert last_run(read_audit(spark, path, "b"), "b").bound == "7"
    assert last_run(read_audit(spark, path, "none"), "none").ingestion_id is None


def test_a_run_reads_the_folder_of_its_job_alone(spark, path, clock):
    for n in range(12):
        append_audit(reports(spark, clock, (str(n), f"job {n}/ü", "SUCCESS", str(n), n)), path)
    assert len([f for f in os.listdir(path) if f.startswith("bucket=")]) > 3
    one = read_audit(spark, path, "job 3/ü")
    assert len({f.rsplit("bucket=")[1].split("/")[0] for f in one.inputFiles()}) == 1
    assert rows(one, "ingestion_id", "job_name") == [("3", "job 3/ü")]
    assert read_audit(spark, path).count() == 12 and AUDIT_BUCKETS == 32


def test_a_named_run_is_on_record_once(spark, path, clock):
    for status in ("FAILED", "SUCCESS"):
        append_audit(reports(spark, clock, ("1", "a", status, None, 0)), path, run="a-1")
    append_audit(reports(spark, clock, ("2", "a", "SUCCESS", None, 0)), path)
    assert rows(read_audit(spark, path), "ingestion_id", "status") == [("1", "SUCCESS"), ("2", "SUCCESS")]


# -- checks of plain files, and jobs side by side --------------------------------


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_the_check_of_a_load_reads_its_day_alone(spark, tmp_path, clock, fmt):
    from sluice.plans.sink import sink_for

    land(spark, tmp_path, 0, 6)
    for n in range(3):
        spec = spec_of(tmp_path, fmt, ingestion_type="full")
        run_job(spark, spec, str(tmp_path / "audit"), run_id=f"run-{n}", clock=clock + dt.timedelta(days=n))
    sink = sink_for(spark, spec)
    sink._partition_by = ("p", "_ingest_date")
    day = sink.read_day((clock + dt.timedelta(days=1)).date())
    assert rows(day) == [("run-1",)] * 6 and day.columns == ["_ingestion_id"]
    assert all("_ingest_date=2025-06-02" in f for f in day.inputFiles())
    assert sink.read_day(dt.date(1999, 1, 1)).count() == 0


def test_jobs_side_by_side_change_no_setting_of_the_caller(spark, tmp_path, clock, monkeypatch):
    import json

    seen = []
    real = job.run_job

    def noted(session, spec, *args, **kwargs):
        session.conf.set("spark.sql.shuffle.partitions", "3")
        spark_context = session.sparkContext
        seen.append((session is spark, spec.job_name, str(spark_context.getLocalProperty("spark.scheduler.pool")), sorted(map(str, spark_context.getJobTags()))))
        return real(session, spec, *args, **kwargs)

    monkeypatch.setattr(job, "run_job", noted)
    (tmp_path / "specs").mkdir()
    land(spark, tmp_path, 0, 20)
    for n in range(4):
        doc = {"job_name": f"job{n}", "source_type": "parquet", "source_config": {"path": str(tmp_path / "landing")},
               "target": {"path": str(tmp_path / f"target{n}"), "primary_key": "id"}}
        (tmp_path / "specs" / f"job{n}.json").write_text(json.dumps(doc))
    before = dict(spark.conf.getAll)
    report = run_all(spark, str(tmp_path / "specs"), str(tmp_path / "audit"), clock=clock, parallel=4)
    assert rows(report, "job_name", "status") == [(f"job{n}", "SUCCESS") for n in range(4)]
    assert dict(spark.conf.getAll) == before
    assert sorted(seen) == [(False, f"job{n}", f"sluice-job{n}", [f"sluice-job{n}"]) for n in range(4)]
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None and not spark.sparkContext.getJobTags()


def test_compaction_changes_no_setting(spark, path):
    t = Table(spark, path)
    for i in range(4):
        t.append(spark.range(i, i + 1))
    before = dict(spark.conf.getAll)
    assert t.compact() == 1 and dict(spark.conf.getAll) == before

import datetime as dt
import json
import os

import pytest
from helpers import rows

from sluice import __main__ as cli
from sluice.plans.audit import RunReport, append_audit, last_bound, read_audit, report_rows
from sluice.plans.job import run_all, run_job
from sluice.plans.sink import FileSink, SnapshotSink, sink_for
from sluice.plans.table import Table
from sluice.spec import SpecError, parse_spec


@pytest.fixture
def env(spark, tmp_path):
    class Env:
        source = str(tmp_path / "source")
        target = str(tmp_path / "target")
        audit = str(tmp_path / "audit")

        def put(self, data, schema="id int, v string", mode="overwrite"):
            spark.createDataFrame(data, schema).write.mode(mode).parquet(self.source)

        def spec(self, target=None, **more):
            return parse_spec({
                "job_name": "j", "source_type": "parquet", "source_config": {"path": self.source},
                "target": {"path": self.target, **(target or {})}, **more})

        def table(self):
            return Table(spark, self.target).read()

        def log(self):
            return read_audit(spark, self.audit)

    return Env()


def test_a_keyed_load_updates_and_reports(spark, env, clock):
    env.put([(1, "a"), (2, "b")])
    first = run_job(spark, env.spec({"primary_key": "id"}), env.audit, run_id="r1", clock=clock)
    env.put([(2, "B"), (3, "C")])
    second = run_job(spark, env.spec({"primary_key": "id"}), env.audit, run_id="r2",
                     clock=clock + dt.timedelta(days=1))
    assert first.ok and second.ok and second.source_count == second.target_count == 2
    assert rows(env.table(), "id", "v", "_ingestion_id") == [(1, "a", "r1"), (2, "B", "r2"), (3, "C", "r2")]
    assert {str(r["_ingest_date"]) for r in env.table().collect()} == {"2025-06-01", "2025-06-02"}
    assert rows(env.log(), "ingestion_id", "status", "source_count", "target_count") == [
        ("r1", "SUCCESS", 2, 2), ("r2", "SUCCESS", 2, 2)]


def test_bound_then_metadata_then_rules(spark, env, clock):
    env.put([(1, "a"), (2, "b"), (3, None), (4, "d")])
    spec = env.spec(
        {"transformations": [{"type": "fill_na", "columns": ["v", "gone"], "value": "-"},
                             {"type": "upper_case", "columns": ["v"]},
                             {"type": "add_ingestion_timestamp"}]},
        ingestion_type="incremental", incremental_column="id", last_ingestion_value="1")
    report = run_job(spark, spec, env.audit, run_id="r", clock=clock)
    assert rows(env.table(), "id", "v", "_ingestion_type", "_source_name", "ingested_at") == [
        (2, "B", "INCREMENTAL", "parquet", clock), (3, "-", "INCREMENTAL", "parquet", clock),
        (4, "D", "INCREMENTAL", "parquet", clock)]
    assert report.next_value == "4"


def test_bound_carries_over_when_asked(spark, env, clock):
    spec = env.spec(ingestion_type="incremental", incremental_column="id", last_ingestion_value="0")
    env.put([(1, "a"), (2, "b")])
    run_job(spark, spec, env.audit, resume=True, run_id="r1", clock=clock)
    env.put([(3, "c"), (4, "d")], mode="append")
    run_job(spark, spec, env.audit, resume=True, run_id="r2", clock=clock + dt.timedelta(hours=1))
    assert rows(env.table(), "id", "_ingestion_id") == [(1, "r1"), (2, "r1"), (3, "r2"), (4, "r2")]
    assert last_bound(env.log(), "j") == "4"
    assert last_bound(env.log(), "other") is None


def test_watermark_is_taken_before_rules_change_the_type(spark, env):
    env.put([(9, "a"), (10, "b"), (100, "c")])
    rule = [{"type": "cast_type", "columns": ["id"], "data_type": "string"}]
    spec = env.spec({"primary_key": "id", "transformations": rule}, ingestion_type="incremental",
                    incremental_column="id", last_ingestion_value="0")
    assert run_job(spark, spec, env.audit).next_value == "100"


@pytest.mark.parametrize("data", [[], [(1, "a")]])
def test_too_few_rows_is_a_failure(spark, env, data):
    env.put(data)
    report = run_job(spark, env.spec(min_rows=2), env.audit)
    assert (report.status, report.source_count, report.target_count) == ("FAILED", len(data), len(data))
    assert run_job(spark, env.spec(), env.audit).ok


def test_a_single_row_is_loaded_once_on_resume(spark, env):
    spec = env.spec(ingestion_type="incremental", incremental_column="id", last_ingestion_value="0")
    env.put([(5, "a")])
    reports = [run_job(spark, spec, env.audit, resume=True) for _ in range(2)]
    assert [(r.status, r.target_count) for r in reports] == [("SUCCESS", 1), ("SUCCESS", 0)]
    assert rows(env.table(), "id") == [(5,)]


def test_an_error_is_audited_and_raised(spark, env):
    env.put([(1, "a"), (1, "b")])
    with pytest.raises(Exception, match="repeats"):
        run_job(spark, env.spec({"primary_key": "id"}), env.audit, run_id="r")
    row = env.log().head()
    assert (row["status"], row["ingestion_id"]) == ("FAILED", "r") and "repeats" in row["error"]
    with pytest.raises(SpecError):
        run_job(spark, env.spec(ingestion_type="incremental", incremental_column="after",
                                last_ingestion_value="1"), env.audit)


def test_a_cut_feed_is_partial_and_holds_the_bound(spark, env, tmp_path):
    nexts = {"a": "b", "b": "c", "c": None}
    for i, (name, cursor) in enumerate(nexts.items()):
        (tmp_path / "feed" / f"after={name}").mkdir(parents=True)
        page = {"items": [{"id": i}], "next": cursor}
        (tmp_path / "feed" / f"after={name}" / "part-0.txt").write_text(json.dumps(page))

    def load(**paging):
        paging = {"strategy": "cursor", "cursor_param": "after", "cursor_path": "next", "start_cursors": ["a"], **paging}
        feed = {"url": str(tmp_path / "feed"), "transport": "files", "data_path": "items", "pagination": paging}
        spec = env.spec({"primary_key": "id"}, source_type="api", source_config=feed, ingestion_type="incremental",
                        incremental_column="id", last_ingestion_value="-1")
        return run_job(spark, spec, env.audit, resume=True)

    cut = load(max_pages=2)
    assert (cut.status, cut.target_count, cut.page_errors, cut.next_value) == ("PARTIAL", 2, 1, None)
    assert last_bound(env.log(), "j") is None
    whole = load()
    assert (whole.status, whole.target_count, whole.next_value) == ("SUCCESS", 3, "2")
    assert rows(env.table(), "id") == [(0,), (1,), (2,)]


def test_newest_row_of_a_key_wins(spark, env):
    env.put([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "id int, v string, o int")
    run_job(spark, env.spec({"primary_key": "id", "order_by": ["o"]}), env.audit)
    assert rows(env.table(), "id", "v") == [(1, "b"), (2, "c")]


def test_an_incremental_column_the_rows_lack_matters_only_with_a_bound(spark, env):
    env.put([(1, "a"), (2, "b")])
    spec = env.spec({"primary_key": "id"}, ingestion_type="incremental", incremental_column="after")
    assert run_job(spark, spec, env.audit).ok


def test_the_clock_follows_the_session_zone(spark, env):
    env.put([(1, "a"), (2, "b")])
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Pacific/Kiritimati")
        run_job(spark, env.spec(), env.audit)
        off = "abs(unix_timestamp(current_timestamp()) - unix_timestamp({})) > 600"
        assert env.table().filter(off.format("_ingested_at")).count() == 0
        assert env.log().filter(off.format("ts")).count() == 0
        assert env.table().filter("_ingest_date <> to_date(current_timestamp())").count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_overwrite_and_partitions(spark, env):
    env.put([(1, "a"), (2, "b")])
    spec = env.spec({"mode": "overwrite", "partition_by": ["v"]})
    run_job(spark, spec, env.audit)
    run_job(spark, spec, env.audit)
    assert env.table().count() == 2
    assert Table(spark, env.target).snapshot().partition_by == ("v", "_ingest_date")


def test_maintenance_follows_success_only(spark, env, monkeypatch):
    calls = []
    monkeypatch.setattr(SnapshotSink, "maintain", lambda self, clock: calls.append(1))
    env.put([(1, "a")])
    run_job(spark, env.spec(min_rows=2), env.audit)
    assert not calls
    env.put([(1, "a"), (2, "b")])
    run_job(spark, env.spec(), env.audit)
    assert calls == [1]


def test_failing_maintenance_leaves_the_load_recorded(spark, env, monkeypatch):
    def fail(self, clock):
        raise RuntimeError("another writer was first")

    monkeypatch.setattr(SnapshotSink, "maintain", fail)
    env.put([(1, "a"), (2, "b")])
    assert run_job(spark, env.spec(), env.audit).status == "SUCCESS"
    assert [r["status"] for r in env.log().collect()] == ["SUCCESS"]


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json", "orc"])
def test_plain_formats_ignore_the_key(spark, env, fmt):
    env.put([(1, "a"), (2, "b")])
    spec = env.spec({"format": fmt, "primary_key": "id"})
    assert isinstance(sink_for(spark, spec), FileSink)
    reports = [run_job(spark, spec, env.audit) for _ in range(2)]
    assert all(r.ok and r.target_count == 2 for r in reports)
    assert sink_for(spark, spec).read().count() == 4


def test_delta_falls_back_on_snapshots(spark, env):
    assert isinstance(sink_for(spark, env.spec()), SnapshotSink)


def test_key_may_be_retyped_by_a_rule_from_the_start(spark, env):
    rule = [{"type": "cast_type", "columns": ["id"], "data_type": "string"}]
    env.put([(1, "a"), (2, "b")])
    for _ in range(2):
        run_job(spark, env.spec({"primary_key": "id", "transformations": rule}), env.audit)
    assert rows(env.table(), "id", "v") == [("1", "a"), ("2", "b")]
    run_job(spark, env.spec({"primary_key": "id"}), env.audit)  # compared in the table's type
    assert rows(env.table(), "id", "v") == [("1", "a"), ("2", "b")]


def test_key_may_not_outgrow_the_table(spark, env):
    env.put([(1, "a"), (2, "b")])
    run_job(spark, env.spec({"primary_key": "id"}), env.audit)
    rule = [{"type": "cast_type", "columns": ["id"], "data_type": "string"}]
    with pytest.raises(SpecError, match="is int in the table but string"):
        run_job(spark, env.spec({"primary_key": "id", "transformations": rule}), env.audit)


def test_run_all_goes_on_after_a_failure(spark, env, tmp_path, clock):
    env.put([(1, "a"), (2, "b")])
    folder = tmp_path / "specs"
    folder.mkdir()
    good = {"job_name": "good", "source_type": "parquet", "source_config": {"path": env.source},
            "target": {"path": env.target}}
    (folder / "a.json").write_text("{not json")
    (folder / "b.json").write_text(json.dumps({**good, "job_name": "lost", "source_config": {"path": "/nowhere"}}))
    (folder / "c.json").write_text(json.dumps(good))
    (folder / "notes.txt").write_text("x")
    report = run_all(spark, str(folder), env.audit, clock=clock)
    expected = [("a", "FAILED"), ("good", "SUCCESS"), ("lost", "FAILED")]
    assert rows(report, "job_name", "status") == expected
    assert rows(env.log(), "job_name", "status") == expected


def test_jobs_of_a_folder_may_run_at_once(spark, env, tmp_path):
    env.put([(1, "a"), (2, "b")])
    folder = tmp_path / "specs"
    folder.mkdir()
    for i in range(6):
        doc = {"job_name": f"j{i}", "source_type": "parquet", "source_config": {"path": env.source},
               "target": {"path": f"{env.target}-{i}", "primary_key": "id"}}
        (folder / f"{i}.json").write_text(json.dumps(doc))
    report = run_all(spark, str(folder), env.audit, parallel=4)
    expected = [(f"j{i}", "SUCCESS", 2) for i in range(6)]
    assert rows(report, "job_name", "status", "source_count") == expected
    assert rows(env.log(), "job_name", "status", "source_count") == expected


def test_audit_rows_survive_without_all_columns(spark, env, clock):
    append_audit(report_rows(spark, [RunReport("i", "j", "FULL", "SUCCESS", 5, 5, 1.5, ts=clock)]), env.audit)
    append_audit(spark.createDataFrame([("k", "FAILED")], "job_name string, status string"), env.audit)
    assert rows(env.log(), "job_name", "status", "duration") == [("j", "SUCCESS", 1.5), ("k", "FAILED", None)]


def test_command_line(spark, env, tmp_path, monkeypatch):
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    env.put([(1, "a"), (2, "b")])
    file = tmp_path / "job.json"
    doc = {"job_name": "cli", "source_type": "parquet", "source_config": {"path": env.source},
           "target": {"path": env.target}}
    file.write_text(json.dumps(doc))
    assert cli.main(["--config", str(file), "--audit", env.audit]) == 0
    file.write_text(json.dumps({**doc, "source_type": "nope"}))
    assert cli.main(["--config", str(file), "--audit", env.audit]) == 1
    assert cli.main(["--config", str(tmp_path / "gone.json"), "--audit", env.audit]) == 1
    assert cli.main(["--config-dir", str(tmp_path), "--audit", env.audit]) == 1
    assert os.path.exists(env.target)

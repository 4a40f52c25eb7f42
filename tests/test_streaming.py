import datetime as dt

import pytest
from helpers import rows

from sluice import synth
from sluice.plans.audit import read_audit
from sluice.plans.table import Table
from sluice.spec import SpecError, parse_spec
from sluice.streaming import upsert
from sluice.streaming.upsert import stream_files, stream_job, stream_upsert


def put(spark, folder, data):
    spark.createDataFrame(data, "k int, o int, v string").coalesce(1).write.mode("append").parquet(folder)


def test_late_files_do_not_undo_newer_rows(spark, tmp_path, path):
    folder, check = str(tmp_path / "in"), str(tmp_path / "check")
    run = lambda: stream_upsert(
        stream_files(spark, "parquet", folder, "k int, o int, v string", 1), path, "k", ["o"], check
    ).awaitTermination()
    put(spark, folder, [(1, 5, "a"), (2, 1, "b"), (2, 2, "c")])
    put(spark, folder, [(1, 4, "late"), (3, 1, "d")])
    run()
    assert rows(Table(spark, path).read()) == [(1, 5, "a"), (2, 2, "c"), (3, 1, "d")]
    version = Table(spark, path).snapshot().version
    run()
    assert Table(spark, path).snapshot().version == version
    put(spark, folder, [(2, 9, "z")])
    run()
    assert rows(Table(spark, path).read()) == [(1, 5, "a"), (2, 9, "z"), (3, 1, "d")]


def test_streams_into_one_table_do_not_hide_each_other(spark, tmp_path, path):
    for i in (1, 2):
        folder = str(tmp_path / f"in{i}")
        put(spark, folder, [(i, 1, "a"), (7, i, f"from-{i}")])
        stream = stream_files(spark, "parquet", folder, "k int, o int, v string")
        stream_upsert(stream, path, "k", ["o"], str(tmp_path / f"c{i}")).awaitTermination()
    assert rows(Table(spark, path).read()) == [(1, 1, "a"), (2, 1, "a"), (7, 2, "from-2")]
    # A new checkpoint reads everything again, which changes nothing.
    before = rows(Table(spark, path).read())
    stream_upsert(stream, path, "k", ["o"], str(tmp_path / "c3")).awaitTermination()
    assert rows(Table(spark, path).read()) == before


def test_maintenance_runs_between_batches(spark, tmp_path, path, monkeypatch):
    done = []
    monkeypatch.setattr(Table, "expire", lambda self: done.append(self.snapshot().version))
    folder = str(tmp_path / "in")
    for i in range(4):
        put(spark, folder, [(i, i, "a")])
    rows_in = stream_files(spark, "parquet", folder, "k int, o int, v string", 1)
    stream_upsert(rows_in, path, "k", ["o"], str(tmp_path / "c"), maintain_every=2).awaitTermination()
    assert len(done) == 2
    assert Table(spark, path).read().count() == 4


def test_stream_equals_batch(spark, sf, tmp_path, path):
    folder = str(tmp_path / "in")
    spark.read.parquet(f"{sf}/events.parquet").repartition(5, "value").write.parquet(folder)
    schema = spark.read.parquet(folder).schema.simpleString()[7:-1].replace(":", " ")
    stream = stream_files(spark, "parquet", folder, schema, 2)
    stream_upsert(stream, path, "user_id", ["ts", "event_id"], str(tmp_path / "c")).awaitTermination()
    batch = Table(spark, path + "-batch")
    batch.upsert(spark.read.parquet(folder), "user_id", dedupe="latest", order_by=["ts", "event_id"])
    assert rows(Table(spark, path).read()) == rows(batch.read())


def test_stream_job_applies_the_spec(spark, tmp_path, path, clock):
    folder = str(tmp_path / "in")
    put(spark, folder, [(1, 1, "a"), (1, 2, "b")])
    spec = parse_spec({
        "job_name": "s", "source_type": "parquet", "source_config": {"path": folder},
        "target": {"path": path, "primary_key": "k", "order_by": ["o"],
                   "transformations": [{"type": "upper_case", "columns": ["v"]}]}})
    stream_job(spark, spec, str(tmp_path / "c"), clock=clock).awaitTermination()
    out = Table(spark, path).read()
    assert rows(out, "k", "v", "_ingestion_id", "_ingest_date") == [(1, "B", "s-0", dt.date(2025, 6, 1))]
    with pytest.raises(SpecError):
        stream_job(spark, parse_spec({"source_type": "parquet", "target": {"path": path}}), "c")
    with pytest.raises(SpecError):
        stream_files(spark, "postgres", folder)


def test_feed_ids_are_a_stream(spark):
    assert synth.stream_ids(spark).isStreaming


def audited_spec(tmp_path, path):
    return parse_spec({
        "job_name": "feed", "source_type": "parquet", "incremental_column": "o",
        "source_config": {"path": str(tmp_path / "in"), "files_per_batch": 1, "schema": "k int, o int, v string"},
        "target": {"path": path, "primary_key": "k"}})


def audit_rows(spark, tmp_path):
    columns = "ingestion_id", "status", "read_count", "source_count", "target_count", "next_value"
    return rows(read_audit(spark, str(tmp_path / "audit"), "feed"), *columns)


def test_every_micro_batch_is_on_record(spark, tmp_path, path, clock):
    folder = str(tmp_path / "in")
    put(spark, folder, [(1, 5, "a"), (2, 1, "b"), (2, 2, "c")])
    put(spark, folder, [(1, 4, "late"), (3, 1, "d")])
    put(spark, folder, [(1, 3, "later still")])
    spec = audited_spec(tmp_path, path)
    go = lambda: stream_job(spark, spec, str(tmp_path / "c"), clock=clock, audit_path=str(tmp_path / "audit")).awaitTermination()
    go()
    want = [("feed-0", "SUCCESS", 3, 2, 2, "5"), ("feed-1", "SUCCESS", 2, 1, 1, "4"), ("feed-2", "SUCCESS", 1, 0, 0, "3")]
    assert audit_rows(spark, tmp_path) == want
    go()
    assert audit_rows(spark, tmp_path) == want
    put(spark, folder, [(9, 9, "z")])
    go()
    assert audit_rows(spark, tmp_path) == [*want, ("feed-3", "SUCCESS", 1, 1, 1, "9")]


def test_a_batch_lost_between_write_and_record_is_recorded_once(spark, tmp_path, path, clock, monkeypatch):
    put(spark, str(tmp_path / "in"), [(1, 5, "a"), (2, 1, "b")])
    spec, audit = audited_spec(tmp_path, path), str(tmp_path / "audit")
    with monkeypatch.context() as m:
        m.setattr(upsert, "append_audit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception, match="lost"):
            stream_job(spark, spec, str(tmp_path / "c"), clock=clock, audit_path=audit).awaitTermination()
    version = Table(spark, path).snapshot().version
    later = clock + dt.timedelta(days=1)
    stream_job(spark, spec, str(tmp_path / "c"), clock=later, audit_path=audit).awaitTermination()
    assert Table(spark, path).snapshot().version == version
    assert audit_rows(spark, tmp_path) == [("feed-0", "SUCCESS", 2, 2, 2, "5")]


def test_a_batch_that_cannot_be_written_is_recorded_as_failed(spark, tmp_path, path, clock, monkeypatch):
    put(spark, str(tmp_path / "in"), [(1, 5, "a")])
    spec, audit = audited_spec(tmp_path, path), str(tmp_path / "audit")
    with monkeypatch.context() as m:
        m.setattr(Table, "upsert", lambda *a, **k: (_ for _ in ()).throw(OSError("no room")))
        with pytest.raises(Exception, match="no room"):
            stream_job(spark, spec, str(tmp_path / "c"), clock=clock, audit_path=audit).awaitTermination()
    assert [r[:2] for r in audit_rows(spark, tmp_path)] == [("feed-0", "FAILED")]
    stream_job(spark, spec, str(tmp_path / "c"), clock=clock, audit_path=audit).awaitTermination()
    assert audit_rows(spark, tmp_path) == [("feed-0", "SUCCESS", 1, 1, 1, "5")]

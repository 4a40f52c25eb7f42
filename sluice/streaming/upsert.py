"""A stream of changes kept as one row per key."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Sequence
from concurrent.futures import Future
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.operators.quality import judge_counts, landed_count
from sluice.operators.rules import (
    INGEST_DATE,
    apply_rules,
    flat_key,
    rebuilt_structs,
    strings_in_arrays,
    with_ingest_date,
    with_run_metadata,
)
from sluice.plans.audit import RunReport, append_audit, report_rows
from sluice.plans.table import Table, WriteResult
from sluice.runtime import Folder, clock_now
from sluice.spec import JobSpec, SpecError

STREAMED_FORMATS = ("csv", "json", "orc", "parquet", "text")


def stream_upsert(
    rows: DataFrame,
    path: str,
    key: str,
    order_by: Sequence[str],
    checkpoint: str,
    *,
    partition_by: Sequence[str] = (),
    shape: Callable[[DataFrame, int], DataFrame] | None = None,
    record: Callable[[str, int, DataFrame, WriteResult | Exception], None] | None = None,
    available_now: bool = True,
    maintain_every: int = 25,
    merge_files: int = 2,
) -> StreamingQuery:
    """Upsert every micro-batch into a table; the newest row of a key wins, however late it comes.

    A batch that Spark replays after a failure is recognised by the id of its query, which the
    checkpoint keeps, and by its number, and applied once. ``shape`` prepares a micro-batch, given
    its number, before it is written. ``record`` is told the query, the number, the batch and what
    became of it, after every write and every failed one. Partitions written to since are
    compacted, where they have ``merge_files`` small files, and old snapshots dropped after every
    ``maintain_every`` batches; 0 means never.
    """
    started: Future[str] = Future()

    def apply(batch: DataFrame, number: int) -> None:
        query = started.result()
        table = Table(batch.sparkSession, path)
        try:
            result = table.upsert(
                shape(batch, number) if shape else batch,
                key,
                partition_by,
                dedupe="latest",
                order_by=order_by,
                newest_only=True,
                stream=(query, number),
            )
        except Exception as err:
            if record:
                record(query, number, batch, err)
            raise
        if record:
            record(query, number, batch, result)
        if maintain_every and (number + 1) % maintain_every == 0:
            # A batch makes one version; compaction itself makes one more at most.
            table.compact(
                min_files=merge_files, since=max(0, result.version - 2 * maintain_every)
            )
            table.expire()

    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply)
    if available_now:
        writer = writer.trigger(availableNow=True)
    query = writer.start()
    started.set_result(query.id)
    return query


def stream_files(
    spark: SparkSession, fmt: str, path: str, schema: str | None = None, files_per_batch: int = 0
) -> DataFrame:
    """New files of a folder as a stream; the checkpoint remembers which ones were read.

    A path may also name one file, which Spark streams only as a pattern that matches it.
    """
    if fmt not in STREAMED_FORMATS:
        raise SpecError(f"{fmt!r} cannot be streamed; use one of {', '.join(STREAMED_FORMATS)}")
    kind = schema or spark.read.format(fmt).load(path).schema
    reader = spark.readStream.format(fmt).schema(kind)
    if fmt == "csv":
        reader = reader.option("header", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if Folder(spark, path).is_file():
        folder, _, name = path.rstrip("/").rpartition("/")
        path = f"{folder}/{{{name}}}"
    return reader.load(path)


def stream_job(
    spark: SparkSession,
    spec: JobSpec,
    checkpoint: str,
    *,
    clock: dt.datetime | None = None,
    audit_path: str | None = None,
) -> StreamingQuery:
    """A spec over a folder of files as a stream. The checkpoint takes the place of the bound.

    With ``audit_path`` every micro-batch leaves one audit row: the rows it read and the greatest
    value of its incremental column, seen in the write pass; the rows it sent, which are the newest
    of their keys; and the rows found in the target. A batch that is replayed replaces its row.
    """
    source, target = spec.source, spec.target
    if not target.primary_key:
        raise SpecError("a streamed job needs target.primary_key")
    path = source.options.get("path") or source.options.get("file_path")
    rows = stream_files(
        spark,
        source.type.lower(),
        path,
        source.options.get("schema"),
        int(source.options.get("files_per_batch", 0)),
    )
    rows = strings_in_arrays(rows, source.array_columns)
    rows = rebuilt_structs(rows, source.struct_columns)
    rows, key = flat_key(rows, target.primary_key)
    order_by = spec.order_columns(rows.columns, key)
    if not order_by:
        raise SpecError("a streamed job needs a column that orders the rows of a key")
    bound = spec.incremental_column or order_by[0]
    counts = [F.count(F.lit(1)).alias("rows"), F.max(F.col(bound)).cast("string").alias("bound")]
    partition_by = target.partition_by
    if INGEST_DATE not in partition_by:
        partition_by = (*partition_by, INGEST_DATE)
    now_of: dict[int, tuple[dt.datetime, Observation, float]] = {}

    def run_id(number: int) -> str:
        return f"{spec.job_name}-{number}"

    def shape(batch: DataFrame, number: int) -> DataFrame:
        now, seen = clock or clock_now(batch.sparkSession), Observation()
        now_of[number] = now, seen, time.monotonic()
        batch = batch.observe(seen, *counts)
        batch = with_run_metadata(batch, run_id(number), spec.ingestion_type, source.type, now)
        batch = apply_rules(batch, target.transformations, now)
        return with_ingest_date(batch, target.partition_by)[0]

    def record(query: str, number: int, batch: DataFrame, result: WriteResult | Exception) -> None:
        now, seen, began = now_of.pop(number, (clock, None, time.monotonic()))
        session = batch.sparkSession
        report = RunReport(
            run_id(number), spec.job_name, spec.ingestion_type.upper(), "FAILED",
            ts=now or clock_now(session), duration=round(time.monotonic() - began, 6),
        )
        if isinstance(result, Exception):
            report = replace(report, error=str(result))
        else:
            # A replayed batch was not written again, so nothing was observed: count it.
            known = {} if result.replayed or seen is None else seen.get
            if "rows" not in known:
                known = batch.agg(*counts).head().asDict()
            written = Table(session, target.path)
            day = now and not result.replayed and now.date().isoformat()
            table = written.read_partition(INGEST_DATE, day) if day else written.read()
            landed = landed_count(table, run_id(number)).head()["tc"]
            sent = landed if result.replayed else result.rows
            tc, status = judge_counts(sent, landed)
            report = replace(
                report, status=status, source_count=sent, target_count=tc,
                read_count=known["rows"], next_value=known["bound"],
            )
        append_audit(report_rows(session, [report]), audit_path, run=f"{query}-{number}")

    return stream_upsert(
        rows,
        target.path,
        key,
        order_by,
        checkpoint,
        partition_by=partition_by,
        shape=shape,
        record=record if audit_path else None,
        merge_files=target.merge_files,
    )

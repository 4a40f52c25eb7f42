"""One load from spec to audit row, and a folder of loads."""

from __future__ import annotations

import datetime as dt
import json
import logging
import re
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluice.operators.filters import incremental
from sluice.operators.quality import judge_counts, landed_count
from sluice.operators.rules import (
    apply_rules,
    flat_key,
    rebuilt_structs,
    strings_in_arrays,
    with_ingest_date,
    with_run_metadata,
)
from sluice.plans.audit import RunReport, append_audit, last_run, read_audit, report_rows
from sluice.plans.sink import sink_for
from sluice.runtime import Folder, clock_now, own_session
from sluice.sources import ReadContext, read_source
from sluice.spec import JobSpec, parse_spec

log = logging.getLogger(__name__)

_POOL = "spark.scheduler.pool"


def prepare(
    df: DataFrame,
    spec: JobSpec,
    run_id: str,
    clock: dt.datetime,
    watermark: Observation | None = None,
    known: DataFrame | None = None,
) -> tuple[DataFrame, tuple[str, ...], str | None]:
    """Source rows as the target takes them, with its partition columns and key.

    The order is fixed: shape, bound, run metadata, rules, load date. ``watermark`` notes the
    greatest value of the incremental column as the source typed it, before a rule changes it.
    ``known`` is what the target holds, where rows at the bound may have come late.
    """
    df = strings_in_arrays(df, spec.source.array_columns)
    df = rebuilt_structs(df, spec.source.struct_columns)
    df, key = flat_key(df, spec.target.primary_key)
    df = incremental(df, spec, known)
    if watermark is not None:
        df = df.observe(watermark, F.max(_bounded(df, spec)).cast("string").alias("next_value"))
    df = with_run_metadata(df, run_id, spec.ingestion_type, spec.source.type, clock)
    df = apply_rules(df, spec.target.transformations, clock)
    df, partition_by = with_ingest_date(df, spec.target.partition_by)
    return df, partition_by, key


def _bounded(df: DataFrame, spec: JobSpec) -> Column:
    """The incremental column, or NULL if the spec names none that the rows have."""
    name = spec.incremental_column
    return F.col(name) if name and name.split(".")[0] in df.columns else F.lit(None)


def run_job(
    spark: SparkSession,
    spec: JobSpec,
    audit_path: str,
    *,
    resume: bool = False,
    run_id: str | None = None,
    clock: dt.datetime | None = None,
) -> RunReport:
    """Run one load. An audit row is written in every case; an error is raised again after it.

    ``resume`` takes the bound from the job's last successful run, if there is one, instead
    of from the spec. All attempts that follow one successful run are the same load: without a
    key, a later attempt takes the place of an earlier one that failed or was PARTIAL, so its
    rows are there once. With ``late_rows`` in the spec a load reads from its bound on and
    leaves out what the target holds at it. Maintenance follows only a load whose counts agree.
    """
    run_id = run_id or str(uuid.uuid4())
    clock = clock or clock_now(spark)
    started = time.monotonic()
    context = ReadContext(run_id)
    report = RunReport(run_id, spec.job_name, spec.ingestion_type.upper(), "FAILED", ts=clock)
    try:
        share = None
        if resume:
            last = last_run(read_audit(spark, audit_path, spec.job_name), spec.job_name)
            spec = replace(spec, last_ingestion_value=last.bound or spec.last_ingestion_value)
            share = (spec.job_name, last.ingestion_id or "")
        if spec.incremental:
            context.bound = spec.incremental_column, spec.last_ingestion_value
        source = read_source(spark, spec, context)
        watermark = Observation()
        sink = sink_for(spark, spec)
        share = None if spec.target.primary_key else share
        known = sink.read_known(share) if spec.late_rows and spec.incremental else None
        batch, partition_by, key = prepare(source, spec, run_id, clock, watermark, known)
        written = sink.write(batch, partition_by, key, clock, share=share)
        tc, status = judge_counts(
            written.rows, _landed(sink, run_id, clock), spec.min_rows
        )
        # Unread pages leave the run PARTIAL: its rows are there, but the bound does not move.
        unread = context.page_errors
        report = replace(
            report,
            status="PARTIAL" if unread and status == "SUCCESS" else status,
            source_count=written.rows,
            target_count=tc,
            next_value=None if unread else watermark.get.get("next_value"),
            page_errors=unread,
            error=f"{unread} pages were not read" if unread else "",
        )
    except Exception as err:
        log.error("%s failed: %s", spec.job_name, err)
        failed = replace(report, status="FAILED", error=str(err), page_errors=context.page_errors)
        _audited(spark, failed, started, audit_path)
        raise
    finally:
        context.cleanup(spark)
    # The load and its bound are on record before maintenance, which can fail without undoing it.
    report = _audited(spark, report, started, audit_path)
    if report.status == "SUCCESS":
        try:
            sink.maintain(clock)
        except Exception as err:
            log.warning("%s: loaded, but maintenance failed: %s", spec.job_name, err)
    return report


def _landed(sink, run_id: str, clock: dt.datetime) -> int:
    """Rows of this run in the target; only the partition of the load date is looked at.

    A target that cannot be read is an error of the run, not a target without rows.
    """
    return landed_count(sink.read_day(clock.date()), run_id).head()["tc"]


def _audited(spark: SparkSession, report: RunReport, started: float, path: str) -> RunReport:
    report = replace(report, duration=round(time.monotonic() - started, 6))
    append_audit(report_rows(spark, [report]), path)
    log.info(
        "%s: %s, %d rows sent, %d landed, %.1f s",
        report.job_name,
        report.status,
        report.source_count,
        report.target_count,
        report.duration,
    )
    return report


def run_all(
    spark: SparkSession,
    folder: str,
    audit_path: str,
    *,
    resume: bool = False,
    clock: dt.datetime | None = None,
    parallel: int = 1,
) -> DataFrame:
    """Run every spec of a folder, ``parallel`` at a time; a failing one does not stop the rest.

    Each job has a session of its own, so what one sets or names no other sees, and the caller's
    settings stay as they were. Its Spark jobs carry the tag ``sluice-<file>`` and run in a pool
    of that name: under ``spark.scheduler.mode=FAIR`` a long load does not starve the others.
    """
    specs = Folder(spark, folder)

    def run(name: str) -> RunReport:
        report = RunReport(str(uuid.uuid4()), name.removesuffix(".json"), "", "FAILED", ts=clock)
        session, context = own_session(spark), spark.sparkContext
        tag = "sluice-" + re.sub(r"[^A-Za-z0-9_.-]", "_", report.job_name)
        pool = context.getLocalProperty(_POOL)
        context.addJobTag(tag)
        context.setLocalProperty(_POOL, tag)
        try:
            spec = parse_spec(json.loads(specs.read_text(name)))
            report = replace(
                report, job_name=spec.job_name, ingestion_type=spec.ingestion_type.upper()
            )
        except ValueError as err:
            report = replace(report, error=str(err))
            append_audit(report_rows(session, [report]), audit_path)
            return report
        else:
            try:
                return run_job(
                    session,
                    spec,
                    audit_path,
                    resume=resume,
                    run_id=report.ingestion_id,
                    clock=clock,
                )
            except Exception as err:
                return replace(report, error=str(err))  # run_job wrote the audit row
        finally:
            context.removeJobTag(tag)
            context.setLocalProperty(_POOL, pool)

    names = sorted(name for name, *_ in specs.listing("*.json"))
    with ThreadPoolExecutor(max(1, parallel)) as pool:
        return report_rows(spark, list(pool.map(run, names)))

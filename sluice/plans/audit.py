"""The audit log: one row per run, and the bound the next run starts from."""

from __future__ import annotations

import datetime as dt
import uuid
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.merge import conform, empty_rows
from sluice.runtime import Folder

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("ingestion_id", T.StringType()),
        T.StructField("job_name", T.StringType()),
        T.StructField("ingestion_type", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("source_count", T.LongType()),
        T.StructField("target_count", T.LongType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("error", T.StringType()),
        T.StructField("next_value", T.StringType()),
        T.StructField("page_errors", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("read_count", T.LongType()),
    ]
)

#: Folders the log is dealt to by job; a run looks for its predecessor in one of them.
AUDIT_BUCKETS = 32
_BUCKET, _RUN = "bucket", "run"


@dataclass(frozen=True)
class RunReport:
    """The outcome of one run, as it goes to the audit log."""

    ingestion_id: str
    job_name: str
    ingestion_type: str
    status: str
    source_count: int = 0
    target_count: int = 0
    duration: float = 0.0
    error: str = ""
    next_value: str | None = None
    page_errors: int = 0
    ts: dt.datetime | None = None
    #: Rows a micro-batch held before it was reduced to the newest row of each key.
    read_count: int | None = None

    @property
    def ok(self) -> bool:
        return self.status == "SUCCESS"


def report_rows(spark: SparkSession, reports: list[RunReport]) -> DataFrame:
    """Run reports as rows of the audit schema; their clock is read in the session's zone.

    They are constants of a plan, so that writing one row starts no Python worker.
    """
    structs = [
        F.struct(*[_constant(report, f).alias(f.name) for f in AUDIT_SCHEMA]) for report in reports
    ]
    if not structs:
        return empty_rows(spark, AUDIT_SCHEMA)
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def _constant(report: RunReport, column: T.StructField) -> Column:
    value = getattr(report, column.name)
    return F.lit(str(value) if column.name == "ts" and value else value).cast(column.dataType)


def append_audit(df: DataFrame, path: str, run: str | None = None) -> None:
    """Add rows to the log; columns they lack are NULL.

    Rows lie in one of ``AUDIT_BUCKETS`` folders by their job, and below it in a folder of the
    call's own. It is written by dynamic partition overwrite, whose files are staged apart from
    those of any other call, so jobs may end at the same moment; a call that names its ``run``
    replaces what an earlier call of that name wrote instead of adding to it.
    """
    spread = conform(df, AUDIT_SCHEMA).withColumns(
        {
            _BUCKET: (F.crc32(F.coalesce("job_name", F.lit("")).cast("binary")) % AUDIT_BUCKETS).cast("int"),
            _RUN: F.lit(run or uuid.uuid4().hex),
        }
    )
    writer = spread.hint("rebalance", _BUCKET).write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(_BUCKET, _RUN).parquet(path.rstrip("/"))


def read_audit(spark: SparkSession, path: str, job_name: str | None = None) -> DataFrame:
    """The log, or that of one job, read from the job's folder alone; empty before the first run."""
    path = path.rstrip("/")
    if job_name is not None:
        path += f"/{_BUCKET}={zlib.crc32(job_name.encode('utf-8')) % AUDIT_BUCKETS}"
    if not Folder(spark, path).exists():
        return empty_rows(spark, AUDIT_SCHEMA)
    rows = spark.read.schema(AUDIT_SCHEMA).option("recursiveFileLookup", "true").parquet(path)
    return rows if job_name is None else rows.filter(F.col("job_name") == job_name)


@dataclass(frozen=True)
class LastRun:
    """What the next run of a job goes on from: its newest successful run, and the bound it left."""

    ingestion_id: str | None = None
    bound: str | None = None


def last_run(audit: DataFrame, job_name: str) -> LastRun:
    """The job's newest successful run, and the newest bound that such a run left behind."""
    good = audit.filter((F.col("job_name") == job_name) & (F.col("status") == "SUCCESS"))
    # Runs of one moment are told apart by their bound, then by their id.
    moment = F.struct("ts", "next_value", "ingestion_id")
    found = good.agg(
        F.max_by("ingestion_id", moment).alias("ingestion_id"),
        F.max_by("next_value", F.when(F.col("next_value").isNotNull(), moment)).alias("bound"),
    ).head()
    return LastRun(found["ingestion_id"], found["bound"])


def last_bound(audit: DataFrame, job_name: str) -> str | None:
    """Where the job's newest successful run that saw a value ended."""
    return last_run(audit, job_name).bound

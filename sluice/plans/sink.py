"""Writes a prepared batch to the target a spec names, and reads it back for the checks."""

from __future__ import annotations

import datetime as dt
import hashlib
import importlib.util
import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions import quoted
from sluice.operators.merge import empty_rows, latest_per_key
from sluice.operators.quality import duplicate_keys
from sluice.operators.rules import INGEST_DATE
from sluice.plans.table import (
    RETENTION_HOURS,
    DuplicateKeyError,
    Table,
    WriteResult,
)
from sluice.runtime import Folder, scratch_dir
from sluice.spec import JobSpec

log = logging.getLogger(__name__)

#: Partition of plain files that holds one load; running the load again replaces it.
LOAD = "_load"
RUN_ID = T.StructType([T.StructField("_ingestion_id", T.StringType())])


def load_name(share: tuple[str, str]) -> str:
    """A folder name for a job's load: plain letters, and never a number to partition discovery."""
    return "load-" + hashlib.sha256("\n".join(share).encode("utf-8")).hexdigest()[:16]


def delta_available(spark: SparkSession) -> bool:
    """True where the Delta package is installed and the session loads its extension."""
    loaded = "delta" in (spark.conf.get("spark.sql.extensions", "") or "").lower()
    return loaded and importlib.util.find_spec("delta") is not None


class SnapshotSink:
    """Table format without extra jars; see ``plans.table``."""

    def __init__(self, spark: SparkSession, spec: JobSpec):
        self.spec = spec
        self.table = Table(spark, spec.target.path)

    def write(self, df, partition_by, key, clock, share=None) -> WriteResult:
        if key:
            order_by = self.spec.order_columns(df.columns, key)
            return self.table.upsert(
                df,
                key,
                partition_by,
                dedupe=self.spec.dedupe_mode(order_by),
                order_by=order_by,
                clock=clock,
            )
        if self.spec.target.mode == "overwrite":
            return self.table.overwrite(df, partition_by, clock=clock)
        return self.table.append(df, partition_by, clock=clock, share=share)

    def read(self) -> DataFrame:
        return self.table.read()

    def read_known(self, share: tuple[str, str] | None) -> DataFrame | None:
        """What stays in the target when a load is written; None where there is no target yet."""
        return self.table.read(without=share) if self.table.exists() else None

    def read_day(self, day: dt.date) -> DataFrame:
        return self.table.read_partition(INGEST_DATE, day.isoformat())

    def maintain(self, clock: dt.datetime) -> None:
        self.table.compact(min_files=self.spec.target.merge_files, only_newest=True, clock=clock)
        self.table.expire(RETENTION_HOURS, clock=clock)


class DeltaSink:
    """The same contract on a Delta table, whose own MERGE, OPTIMIZE and VACUUM do the work."""

    def __init__(self, spark: SparkSession, spec: JobSpec):
        self.spark = spark
        self.spec = spec
        self.path = spec.target.path

    def write(self, df, partition_by, key, clock, share=None) -> WriteResult:
        if share and not key:
            df = df.withColumn(LOAD, F.lit(load_name(share)))
        counted, seen = _counted(df)
        if not key:
            writer = _writer(counted, "delta", self.spec.target.mode, partition_by)
            if share:
                writer = writer.mode("overwrite").option("replaceWhere", f"{LOAD} = '{load_name(share)}'")
            writer.save(self.path)
            return _result(seen)
        # MERGE reads its source more than once: give it a written copy.
        copy = scratch_dir(self.spark, "batch")
        try:
            counted.write.parquet(copy)
            return self._merge(self.spark.read.parquet(copy), _result(seen), partition_by, key)
        finally:
            Folder(self.spark, copy).delete()

    def _merge(
        self, batch: DataFrame, result: WriteResult, partition_by: Sequence[str], key: str
    ) -> WriteResult:
        from delta.tables import DeltaTable

        named = F.col(quoted(key)).isNotNull()
        order_by = self.spec.order_columns(batch.columns, key)
        mode = self.spec.dedupe_mode(order_by)
        keyed = batch.filter(named)
        if mode != "none" and not duplicate_keys(keyed, key).isEmpty():
            if mode == "latest":
                single = latest_per_key(keyed, key, order_by)
            else:
                single = keyed.dropDuplicates()
            if mode == "error" and not duplicate_keys(single, key).isEmpty():
                raise DuplicateKeyError(f"{key} repeats with differing rows")
            batch = single.unionByName(batch.filter(~named))
            result = WriteResult(batch.count())
        if DeltaTable.isDeltaTable(self.spark, self.path):
            merge = DeltaTable.forPath(self.spark, self.path).alias("t")
            merge = merge.merge(batch.alias("s"), f"t.{quoted(key)} = s.{quoted(key)}")
            merge = merge.withSchemaEvolution().whenMatchedUpdateAll()
            merge.whenNotMatchedInsertAll().execute()
        else:
            _writer(batch, "delta", "overwrite", partition_by).save(self.path)
        return result

    def read(self) -> DataFrame:
        return self.spark.read.format("delta").load(self.path)

    def read_known(self, share: tuple[str, str] | None) -> DataFrame | None:
        from delta.tables import DeltaTable

        if not DeltaTable.isDeltaTable(self.spark, self.path):
            return None
        return _without_load(self.read(), share)

    def read_day(self, day: dt.date) -> DataFrame:
        return self.read().filter(F.col(INGEST_DATE) == F.lit(day))

    def maintain(self, clock: dt.datetime) -> None:
        self.spark.sql(f"OPTIMIZE delta.`{self.path}`")
        self.spark.sql(f"VACUUM delta.`{self.path}` RETAIN {RETENTION_HOURS} HOURS")


class FileSink:
    """Plain files in any format Spark writes; a key has no meaning here."""

    def __init__(self, spark: SparkSession, spec: JobSpec):
        self.spark = spark
        self.spec = spec
        self._partition_by: tuple[str, ...] = tuple(spec.target.partition_by)

    def write(self, df, partition_by, key, clock, share=None) -> WriteResult:
        """Append or overwrite. A load that may be run again has a partition of its own."""
        target = self.spec.target
        self._partition_by = tuple(partition_by)
        counted, seen = _counted(df)
        if not share or target.mode == "overwrite":
            _writer(counted, target.format, target.mode, partition_by).save(target.path)
            return _result(seen)
        self._partition_by = (LOAD, *partition_by)
        folder, own = Folder(self.spark, target.path), f"{LOAD}={load_name(share)}"
        depth = own + "/*" * (len(partition_by) + 1)
        before = [name for name, *_ in folder.listing(depth)]
        counted = counted.withColumn(LOAD, F.lit(load_name(share)))
        writer = _writer(counted, target.format, "overwrite", self._partition_by)
        writer.option("partitionOverwriteMode", "dynamic").save(target.path)
        # Partitions of the earlier attempt that this one did not write to, such as its date.
        for name in {n for n, *_ in folder.listing(depth)}.intersection(before):
            folder.delete(name)
        return _result(seen)

    def read(self) -> DataFrame:
        target = self.spec.target
        reader = self.spark.read.format(target.format).option("mergeSchema", "true")
        if target.format == "csv":
            reader = reader.option("header", "true")
        return reader.load(target.path)

    def read_known(self, share: tuple[str, str] | None) -> DataFrame | None:
        # Hidden names do not count, those of partitions such as ``_load=`` do, as in Spark's listing.
        names = [name for name, *_ in Folder(self.spark, self.spec.target.path).listing("*")]
        if not any("=" in name or name[0] not in "_." for name in names):
            return None
        return _without_load(self.read(), share)

    def read_day(self, day: dt.date) -> DataFrame:
        """Run ids of a day's rows: only the folders of that date, with a declared schema.

        CSV names its columns in each file's header and is read without inference.
        """
        target, step = self.spec.target, f"{INGEST_DATE}={day.isoformat()}"
        levels = ["*"] * len(self._partition_by)
        if INGEST_DATE not in self._partition_by:
            return self.read().filter(F.col(INGEST_DATE) == F.lit(day))
        levels[self._partition_by.index(INGEST_DATE)] = step
        pattern = "/".join(levels)
        if not Folder(self.spark, target.path).listing(pattern):
            return empty_rows(self.spark, RUN_ID)
        reader = self.spark.read.format(target.format)
        if target.format == "csv":
            return reader.option("header", "true").load(f"{target.path.rstrip('/')}/{pattern}").select("_ingestion_id")
        return reader.schema(RUN_ID).load(f"{target.path.rstrip('/')}/{pattern}").select("_ingestion_id")

    def maintain(self, clock: dt.datetime) -> None:
        """Plain files have no versions to compact or expire."""


def sink_for(spark: SparkSession, spec: JobSpec) -> SnapshotSink | DeltaSink | FileSink:
    if spec.target.format in ("delta", "snapshot"):
        if spec.target.format == "delta":
            if delta_available(spark):
                return DeltaSink(spark, spec)
            log.info("%s: no Delta in this session, writing Parquet snapshots", spec.target.path)
        return SnapshotSink(spark, spec)
    return FileSink(spark, spec)


def _without_load(rows: DataFrame, share: tuple[str, str] | None) -> DataFrame:
    """Rows but for those of one load, which the next write replaces."""
    if share is None or LOAD not in rows.columns:
        return rows
    return rows.filter(~F.col(LOAD).eqNullSafe(load_name(share)))


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _result(seen: Observation) -> WriteResult:
    return WriteResult(seen.get.get("rows", 0))


def _writer(df: DataFrame, fmt: str, mode: str, partition_by: Sequence[str]):
    writer = df.write.format(fmt).mode(mode)
    if fmt == "delta":
        writer = writer.option("mergeSchema", "true")
    if fmt == "csv":
        writer = writer.option("header", "true")
    return writer.partitionBy(*partition_by) if partition_by else writer

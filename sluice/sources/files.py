"""Files in any format Spark reads, from any file system its executors reach."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession

from sluice.plans.sink import delta_available
from sluice.plans.table import Table
from sluice.sources.registry import ReadContext, register
from sluice.sources.typed import csv_rows, json_rows
from sluice.spec import SourceSpec, SpecError

# Reader options, in lower case, that say how values are typed or records found.
READER_DECIDES = frozenset(
    "inferschema dateformat timestampformat timestampntzformat locale multiline mode samplingratio "
    "prefersdecimal primitivesasstring prefersdate columnnameofcorruptrecord inferTimestamp".lower().split()
)
SFTP_FILE_SYSTEM = "org.apache.hadoop.fs.sftp.SFTPFileSystem"


def _path(source: SourceSpec) -> str:
    path = source.options.get("path") or source.options.get("file_path")
    if not path:
        raise SpecError("source_config.path is missing")
    return path


def _read(
    spark: SparkSession,
    source: SourceSpec,
    fmt: str,
    path: str,
    context: ReadContext,
    **more: str,
) -> DataFrame:
    own = {k: str(v) for k, v in source.options.get("options", {}).items()}
    options = {**more, **own}
    schema = source.options.get("schema")
    # Options that change what a value means leave the types to Spark's own reader.
    if not schema and not {k.lower() for k in own} & READER_DECIDES:
        if fmt == "csv":
            return csv_rows(spark, path, options, context)
        if fmt == "json":
            return json_rows(spark, path, options, context)
    reader = spark.read.format(fmt).options(**options)
    if fmt == "csv":
        reader = reader.option("header", "true")
        if not schema:
            reader = reader.option("inferSchema", "true")
    return (reader.schema(schema) if schema else reader).load(path)


@register("csv", "parquet", "json", "orc", "text", "xml")
def read_files(spark: SparkSession, source: SourceSpec, context: ReadContext) -> DataFrame:
    """Files under a path. Without a ``schema`` in the spec, CSV and JSON are read and parsed once
    into a staged copy that shows their types.
    """
    return _read(spark, source, source.type.lower(), _path(source), context)


@register("table", "delta")
def read_table(spark: SparkSession, source: SourceSpec, context: ReadContext) -> DataFrame:
    """The current rows of a table that another job writes."""
    if delta_available(spark):
        return spark.read.format("delta").load(_path(source))
    return Table(spark, _path(source)).read()


def sftp_options(source: SourceSpec) -> dict[str, str]:
    """Login for Hadoop's SFTP file system, kept out of the path that plans and logs show."""
    o = source.options
    host, user = o["host"], o["username"]
    return {
        "fs.sftp.impl": SFTP_FILE_SYSTEM,
        "fs.sftp.host": host,
        "fs.sftp.host.port": str(o.get("port", 22)),
        f"fs.sftp.user.{host}": user,
        f"fs.sftp.password.{host}.{user}": str(o.get("password", "")),
    }


@register("sftp")
def read_sftp(spark: SparkSession, source: SourceSpec, context: ReadContext) -> DataFrame:
    """A CSV file with a header, read by the executors where it lies.

    Paths with a scheme, and those of the ``addFile`` method, name a file system the session
    knows already. Other paths are on the SFTP host, for which the session needs the JSch jar.
    """
    path = _path(source)
    if source.ingest_method == "addFile" or "://" in path or not source.options.get("host"):
        return _read(spark, source, "csv", path, context)
    uri = f"sftp://{source.options['host']}/{quote(path.lstrip('/'))}"
    return _read(spark, source, "csv", uri, context, **sftp_options(source))

"""Collections of nested documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.sources.registry import ReadContext, register
from sluice.spec import SourceSpec, SpecError


def mongo_options(source: SourceSpec) -> dict[str, str]:
    """Reader options of the MongoDB Spark connector."""
    names = {"connection_uri": "connection.uri", "database": "database", "collection": "collection"}
    missing = [name for name in names if not source.options.get(name)]
    if missing:
        raise SpecError(f"source_config lacks {', '.join(missing)}")
    return {theirs: str(source.options[ours]) for ours, theirs in names.items()}


@register("mongo")
def read_mongo(spark: SparkSession, source: SourceSpec, context: ReadContext) -> DataFrame:
    """A collection. Needs the MongoDB connector on the session's class path."""
    return spark.read.format("mongodb").options(**mongo_options(source)).load()

"""Which function reads which source type."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from sluice.runtime import Folder
from sluice.spec import JobSpec, SourceSpec, SpecError


@dataclass
class ReadContext:
    """What one run knows and learns while reading, and the scratch folders to drop after it."""

    run_id: str = "adhoc"
    bound: tuple[str, str] | None = None
    page_errors: int = 0
    scratch: list[str] = field(default_factory=list)

    def cleanup(self, spark: SparkSession) -> None:
        for path in self.scratch:
            Folder(spark, path).delete()
        self.scratch.clear()


Reader = Callable[[SparkSession, SourceSpec, ReadContext], DataFrame]
_READERS: dict[str, Reader] = {}


def register(*names: str) -> Callable[[Reader], Reader]:
    """Make a function the reader of these source types."""

    def keep(reader: Reader) -> Reader:
        for name in names:
            _READERS[name.lower()] = reader
        return reader

    return keep


def source_types() -> list[str]:
    return sorted(_READERS)


def read_source(
    spark: SparkSession, spec: JobSpec | SourceSpec, context: ReadContext | None = None
) -> DataFrame:
    """The rows of a source, lazily wherever its kind allows."""
    source = spec.source if isinstance(spec, JobSpec) else spec
    reader = _READERS.get(source.type.lower())
    if reader is None:
        raise SpecError(f"unknown source type {source.type!r}; known: {', '.join(source_types())}")
    return reader(spark, source, context or ReadContext())

"""Job specs: one JSON document describes one load.

A spec is parsed once into frozen dataclasses, so nothing a job does can change the
document that described it.
"""

from __future__ import annotations

import json
import os
import re
import warnings
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from pathlib import Path
from types import MappingProxyType
from typing import Any


class SpecError(ValueError):
    """The job spec cannot be run as written."""


# Rule types, load types and keys that specs carry but no job acts on.
RULE_TYPES = ("fill_na", "upper_case", "cast_type", "add_ingestion_timestamp")
LOAD_TYPES = ("full", "incremental")
IGNORED_KEYS = ("batch_size", "ingestion_status")
IGNORED_SOURCE_KEYS = ("method", "file_type")
IGNORED_TARGET_KEYS = ("schema_evolution",)
IGNORED_PAGING_KEYS = ("sleep_time",)

# Columns of REST records that are brought into one shape unless the spec says
# otherwise.
REST_TYPES = ("api", "rest")
REST_ARRAY_COLUMNS = ("images", "eventLogs")
REST_STRUCT_COLUMNS = ("vehicle",)

DEDUPE_MODES = ("latest", "error", "none")
PAGE_ERROR_MODES = ("fail", "warn")

_ENV = re.compile(r"\$\{([^}]+)\}")


@dataclass(frozen=True)
class Rule:
    """One column rule; columns the batch does not have are skipped when it is applied."""

    type: str
    columns: tuple[str, ...] = ()
    value: Any = 0
    data_type: str = "string"


@dataclass(frozen=True)
class SourceSpec:
    """Where the rows come from: a registered source type and its options."""

    type: str
    options: Mapping[str, Any] = field(default_factory=dict)
    ingest_method: str = "paramiko"
    array_columns: tuple[str, ...] = ()
    struct_columns: tuple[str, ...] = ()


@dataclass(frozen=True)
class TargetSpec:
    """Where the rows go, and how keys, partitions and rules shape them."""

    path: str
    format: str = "delta"
    mode: str = "append"
    primary_key: str | None = None
    partition_by: tuple[str, ...] = ()
    transformations: tuple[Rule, ...] = ()
    dedupe: str | None = None
    order_by: tuple[str, ...] = ()
    #: Small files a partition may gather before a run merges them.
    merge_files: int = 32


@dataclass(frozen=True)
class JobSpec:
    """A whole load: source, bound, rules and target."""

    job_name: str
    source: SourceSpec
    target: TargetSpec
    ingestion_type: str = "full"
    incremental_column: str | None = None
    last_ingestion_value: str | None = None
    late_rows: bool = False
    min_rows: int = 0
    schedule: Mapping[str, Any] = field(default_factory=dict)

    @property
    def incremental(self) -> bool:
        """True when the load is bounded: incremental, with a column and a bound."""
        return bool(
            self.ingestion_type == "incremental"
            and self.incremental_column
            and self.last_ingestion_value
        )

    def order_columns(self, columns: Iterable[str], key: str | None) -> tuple[str, ...]:
        """Columns that say which of two rows with one key is the newer.

        The incremental column stands in for ``order_by`` if the rows have it and it is not
        the key itself, which orders nothing among rows that share it.
        """
        if self.target.order_by:
            return self.target.order_by
        stand_in = self.incremental_column
        known = stand_in and stand_in != key and stand_in.split(".")[0] in set(columns)
        return (stand_in,) if known else ()

    def dedupe_mode(self, order_by: tuple[str, ...]) -> str:
        """How a keyed batch treats repeated keys: newest row if that is known, else refuse."""
        return self.target.dedupe or ("latest" if order_by else "error")


def _substitute(node: Any, env: Mapping[str, str]) -> Any:
    """Replace ``${NAME}`` in every string of a parsed document; unknown names stay as written."""
    if isinstance(node, str):
        return _ENV.sub(lambda m: env.get(m.group(1), m.group(0)), node)
    if isinstance(node, list):
        return [_substitute(item, env) for item in node]
    if isinstance(node, dict):
        return {key: _substitute(value, env) for key, value in node.items()}
    return node


def _warn_ignored(where: str, found: Mapping[str, Any], names: tuple[str, ...]) -> None:
    dead = sorted(set(found) & set(names))
    if dead:
        warnings.warn(f"{where}: {', '.join(dead)} has no effect", stacklevel=4)


def _parse_rule(doc: Mapping[str, Any]) -> Rule:
    kind = doc.get("type")
    if kind not in RULE_TYPES:
        raise SpecError(f"unknown rule type {kind!r}; known: {', '.join(RULE_TYPES)}")
    value = doc.get("value", 0)
    if kind == "fill_na" and not isinstance(value, (str, int, float, bool)):
        raise SpecError(f"fill_na needs one string, number or boolean, not {value!r}")
    return Rule(kind, tuple(doc.get("columns", ())), value, doc.get("data_type", "string"))


def _one_of(name: str, value: Any, allowed: tuple[str, ...]) -> Any:
    if value not in allowed:
        raise SpecError(f"{name} must be one of {', '.join(allowed)}, not {value!r}")
    return value


def parse_spec(doc: Mapping[str, Any], env: Mapping[str, str] | None = None) -> JobSpec:
    """Turn a parsed JSON document into a ``JobSpec``, filling ``${VAR}`` from ``env``."""
    doc = _substitute(dict(doc), os.environ if env is None else env)
    source = dict(doc.get("source_config", {}))
    target = doc.get("target", {})
    if not doc.get("source_type"):
        raise SpecError("source_type is missing")
    if not target.get("path"):
        raise SpecError("target.path is missing")

    _warn_ignored("spec", doc, IGNORED_KEYS)
    _warn_ignored("source_config", source, IGNORED_SOURCE_KEYS)
    _warn_ignored("target", target, IGNORED_TARGET_KEYS)
    _warn_ignored("pagination", source.get("pagination", {}), IGNORED_PAGING_KEYS)

    _one_of("on_page_error", source.get("on_page_error", "fail"), PAGE_ERROR_MODES)
    bound = doc.get("last_ingestion_value")
    late = _one_of("late_rows", doc.get("late_rows", False), (False, True))
    rules = tuple(_parse_rule(r) for r in target.get("transformations", ()))
    changed = {c for r in rules if r.type != "add_ingestion_timestamp" for c in r.columns}
    if late and not doc.get("incremental_column"):
        raise SpecError("late_rows needs incremental_column")
    if late and doc["incremental_column"] in changed:
        raise SpecError(f"late_rows needs {doc['incremental_column']} as the source has it; a rule changes it")
    is_rest = doc["source_type"].lower() in REST_TYPES
    return JobSpec(
        job_name=doc.get("job_name", "unknown"),
        source=SourceSpec(
            type=doc["source_type"],
            options=MappingProxyType(source),
            ingest_method=doc.get("ingest_method", "paramiko"),
            array_columns=tuple(source.get("array_columns", REST_ARRAY_COLUMNS if is_rest else ())),
            struct_columns=tuple(source.get("struct_columns", REST_STRUCT_COLUMNS if is_rest else ())),
        ),
        target=TargetSpec(
            path=target["path"],
            format=target.get("format", "delta").lower(),
            mode=_one_of("target.mode", target.get("mode", "append"), ("append", "overwrite")),
            primary_key=target.get("primary_key"),
            partition_by=tuple(target.get("partition_by", ())),
            transformations=rules,
            dedupe=target.get("dedupe") and _one_of("target.dedupe", target["dedupe"], DEDUPE_MODES),
            order_by=tuple(target.get("order_by", ())),
            merge_files=int(target.get("merge_files", 32)),
        ),
        ingestion_type=_one_of(
            "ingestion_type", doc.get("ingestion_type", "full").lower(), LOAD_TYPES
        ),
        incremental_column=doc.get("incremental_column"),
        last_ingestion_value=None if bound is None else str(bound),
        late_rows=late,
        min_rows=int(doc.get("min_rows", 0)),
        schedule=MappingProxyType(dict(doc.get("dag_params", {}))),
    )


def load_spec(path: str | Path, env: Mapping[str, str] | None = None) -> JobSpec:
    """Read one spec file. Substitution follows the parse, so quotes in values are safe."""
    with open(path, encoding="utf-8") as handle:
        return parse_spec(json.load(handle), env)

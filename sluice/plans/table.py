"""Target tables on plain Parquet: data directories, and a small file that lists the live ones.

Every write goes to new ``_commit=<id>/<partitions>`` directories that no reader sees until a
snapshot file naming them appears. A failed or killed write therefore leaves the table as it
was, and a lost executor costs only its own tasks. A snapshot names whole directories. Only
where an upsert hits few files of a directory does it name the other files one by one, so an
upsert rewrites the files that hold a matching key, and a batch of new keys is a plain append.

Where the Delta library is installed, ``plans.sink`` uses that instead.
"""

from __future__ import annotations

import datetime as dt
import json
import math
import random
import re
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions import quoted
from sluice.operators.merge import (
    check_key_type,
    conform,
    drop_stale,
    empty_rows,
    evolved,
    latest_per_key,
    untouched_rows,
    upsert_rows,
)
from sluice.operators.quality import duplicate_keys
from sluice.operators.rules import INGEST_DATE
from sluice.runtime import Folder, clock_now, own_session
from sluice.spec import SpecError

RETENTION_HOURS = 168
TARGET_FILE_BYTES = 512 * 1024 * 1024
APPEND_TRIES = 10

_SNAPSHOTS = "_snapshots"
_COMMIT = "_commit="
_PLAIN_VALUE = re.compile(r"[A-Za-z0-9_.-]+")  # written into a path as it is
_SUCCESS_MARK = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
_RANGED_KEYS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.DateType)


class DuplicateKeyError(ValueError):
    """A keyed batch holds a key more than once and nothing says which row counts."""


class ConcurrentWriteError(RuntimeError):
    """Another writer published a snapshot first; run the load again."""


@dataclass(frozen=True)
class Snapshot:
    """The state of a table at one version."""

    version: int
    committed_at: str
    operation: str
    schema: Mapping[str, Any]
    partition_by: tuple[str, ...] = ()
    paths: tuple[str, ...] = ()
    unique_key: str | None = None
    streams: Mapping[str, int] = field(default_factory=dict)
    #: Per job the load it wrote last, as ``(load, commit)``: a repeated load takes its place.
    shares: Mapping[str, Sequence[str]] = field(default_factory=dict)

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(dict(self.schema))


@dataclass(frozen=True)
class WriteResult:
    """What a write sent, how many live files it hit, and the version it made.

    ``replayed`` marks a micro-batch that had been applied before.
    """

    rows: int
    touched: int = 0
    version: int | None = None
    replayed: bool = False


@dataclass(frozen=True)
class _Staged:
    commit: str
    dirs: tuple[str, ...]
    schema: T.StructType
    rows: int
    stats: Mapping[str, Any]


class Table:
    """A Parquet table at a path: append, overwrite, upsert, compact and expire."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._folder = Folder(spark, self.path)

    # -- snapshots ---------------------------------------------------------------

    def _versions(self) -> list[int]:
        found = self._folder.listing(f"{_SNAPSHOTS}/*.json")
        return sorted(int(name.rsplit("/", 1)[1][:-5]) for name, *_ in found)

    def snapshot(self, version: int | None = None) -> Snapshot | None:
        """The given or the newest snapshot; None if there is no such version or no table."""
        versions = [v for v in self._versions() if version is None or v == version]
        return self._load(versions[-1]) if versions else None

    def _load(self, version: int) -> Snapshot:
        doc = json.loads(self._folder.read_text(f"{_SNAPSHOTS}/{version:010d}.json"))
        doc.update(partition_by=tuple(doc["partition_by"]), paths=tuple(doc["paths"]))
        return Snapshot(**doc)

    def exists(self) -> bool:
        return self.snapshot() is not None

    def _publish(
        self, base: Snapshot | None, clock: dt.datetime | None, **changes: Any
    ) -> Snapshot:
        new = replace(
            base or Snapshot(0, "", "", {}),
            version=(base.version if base else 0) + 1,
            committed_at=(clock or clock_now(self.spark)).isoformat(),
            **changes,
        )
        try:
            self._folder.write_new(f"{_SNAPSHOTS}/{new.version:010d}.json", json.dumps(asdict(new)))
        except FileExistsError as err:
            raise ConcurrentWriteError(f"{self.path}: version {new.version} exists") from err
        return new

    # -- reading -----------------------------------------------------------------

    def read(
        self, version: int | None = None, without: tuple[str, str] | None = None
    ) -> DataFrame:
        """The rows of a snapshot. Its schema is stored, so no file footer is read to plan.

        ``without`` is a share (see ``append``) whose rows are left out.
        """
        snap = self.snapshot(version)
        if snap is None:
            raise FileNotFoundError(f"no table at {self.path}")
        paths = _kept(snap, without) if without else snap.paths
        return self._rows(paths, snap.struct).select(*_columns(snap.struct))

    def read_partition(self, column: str, value: str) -> DataFrame:
        """The rows of one partition value, without a look at the directories of the others."""
        snap = self.snapshot()
        if snap is None:
            raise FileNotFoundError(f"no table at {self.path}")
        if column not in snap.partition_by or not _PLAIN_VALUE.fullmatch(value):
            return self.read().filter(F.col(quoted(column)) == F.lit(value))
        step = f"{column}={value}"
        paths = [p for p in snap.paths if step in _partition_of(p).split("/")]
        return self._rows(paths, snap.struct).select(*_columns(snap.struct))

    def _rows(self, paths: Sequence[str], schema: T.StructType) -> DataFrame:
        if not paths:
            return empty_rows(self.spark, schema)
        reader = self.spark.read.schema(schema).option("basePath", self.path)
        return reader.parquet(*[f"{self.path}/{p}" for p in paths])

    # -- writing -----------------------------------------------------------------

    def _stage(
        self,
        df: DataFrame,
        partition_by: Sequence[str],
        stats: Mapping[str, Column] | None = None,
        mixed: bool | None = None,
    ) -> _Staged:
        """Write rows to directories nobody reads yet, counting them on the way.

        Where a task would write to many partitions, the rows are first grouped by partition;
        otherwise tasks times partitions files appear. The rebalance hint leaves the sizes to
        adaptive execution: small partitions share a task, a hot one is split over many. A load
        that is partitioned by its date alone goes to one partition and is not shuffled;
        ``mixed`` overrides that guess. The counters sit right below the writer, in the stage
        whose tasks report once each.
        """
        if mixed if mixed is not None else any(c != INGEST_DATE for c in partition_by):
            df = df.hint("rebalance", *partition_by)
        commit = _COMMIT + uuid.uuid4().hex[:16]
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *_aliased(stats))
        writer = counted.write.mode("errorifexists").option(_SUCCESS_MARK, "false")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.path}/{commit}")
        found = self._folder.listing(commit + "/*" * len(partition_by))
        dirs = tuple(name for name, is_dir, *_ in found if is_dir)
        measured = seen.get
        if "rows" not in measured:  # the plan was folded away and nothing was observed
            back = self._rows(dirs, df.schema)
            measured = back.agg(F.count(F.lit(1)).alias("rows"), *_aliased(stats)).head().asDict()
        return _Staged(commit, dirs, df.schema, measured["rows"], measured)

    def _discard(self, dirs: Sequence[str]) -> None:
        for commit in sorted({d.split("/", 1)[0] for d in dirs}):
            self._folder.delete(commit)

    def append(
        self,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        *,
        clock: dt.datetime | None = None,
        share: tuple[str, str] | None = None,
    ) -> WriteResult:
        """Add rows. New columns are taken up, missing ones are NULL.

        Appends of several writers may interleave: one that comes second publishes again on
        top of the other. ``share`` is a job and a name of its load: where the job's last append
        has the same name, these rows take the place of what that one wrote, so a load that is
        run again after a failure leaves each row once.
        """
        base = self.snapshot()
        if base:
            partition_by = base.partition_by
            df = conform(df, evolved(base.struct, df.schema))
        staged = self._stage(df, partition_by)
        for left in reversed(range(APPEND_TRIES)):
            base = self.snapshot()
            if base and base.partition_by != tuple(partition_by):
                raise ConcurrentWriteError(f"{self.path}: partitioning changed during the write")
            schema = evolved(base.struct, df.schema) if base else df.schema
            kept, shares = (base.paths, dict(base.shares)) if base else ((), {})
            if share:
                kept = _kept(base, share) if base else kept
                shares[share[0]] = (share[1], staged.commit)
            try:
                new = self._publish(
                    base,
                    clock,
                    operation="append",
                    schema=schema.jsonValue(),
                    partition_by=tuple(partition_by),
                    paths=kept + staged.dirs,
                    unique_key=None,
                    shares=shares,
                )
                break
            except ConcurrentWriteError:
                if not left:
                    raise
                time.sleep(random.uniform(0, 0.5 * (APPEND_TRIES - left)))
        return WriteResult(staged.rows, version=new.version)

    def overwrite(
        self,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        *,
        clock: dt.datetime | None = None,
    ) -> WriteResult:
        """Replace all rows and the partitioning; older snapshots stay readable.

        The table keeps columns that the new rows lack, as it does on an append.
        """
        base = self.snapshot()
        if base:
            df = conform(df, evolved(base.struct, df.schema))
        staged = self._stage(df, partition_by)
        new = self._publish(
            base,
            clock,
            operation="overwrite",
            schema=df.schema.jsonValue(),
            partition_by=tuple(partition_by),
            paths=staged.dirs,
            unique_key=None,
        )
        return WriteResult(staged.rows, version=new.version)

    def upsert(
        self,
        df: DataFrame,
        key: str,
        partition_by: Sequence[str] = (),
        *,
        dedupe: str = "error",
        order_by: Sequence[str] = (),
        newest_only: bool = False,
        clock: dt.datetime | None = None,
        stream: tuple[str, int] | None = None,
    ) -> WriteResult:
        """Update rows by key, insert the others; the first load just writes.

        The source is read once: the batch is written straight to where its rows will stay,
        and every later step reads that copy. ``newest_only`` keeps the table's row where it is
        newer by ``order_by``; ``stream`` is a query and micro-batch number, and a number
        published before is not applied again.
        """
        base = self.snapshot()
        if stream and base and base.streams.get(stream[0], -1) >= stream[1]:
            return WriteResult(0, version=base.version, replayed=True)
        if key not in df.columns:
            raise SpecError(f"key {key!r} is not a column of the batch")
        schema = evolved(base.struct, df.schema) if base else df.schema
        if base:
            partition_by = base.partition_by
            self._check_key_type(base, df, key)
            df = conform(df, _typed(df.schema, schema))
        lacking = [c for c in partition_by if c not in df.columns]
        if lacking and not base:
            raise SpecError(f"the batch lacks partition columns: {', '.join(lacking)}")
        # Without its partition columns the batch cannot lie where its rows will stay.
        layout = () if lacking else partition_by

        staged = self._stage(df, layout, _key_range(df, key))
        staged = self._dedupe(staged, layout, key, dedupe, order_by)
        unique = dedupe != "none"
        streams = {**(base.streams if base else {}), **({stream[0]: stream[1]} if stream else {})}

        kept, added, hits = (), staged.dirs, 0
        if base:
            target = self._rows(base.paths, base.struct)
            if newest_only:
                near = self._near(target, key, staged).select(*_columns(base.struct))
                newer = drop_stale(self._staged_rows(staged), near, key, order_by)
                fresh = self._stage(newer, layout, _key_range(df, key))
                self._discard(staged.dirs)
                staged, added = fresh, fresh.dirs
            touched = self._touched(base, target, key, staged)
            kept, old = self._split(base, touched)
            hits = len(touched)
            if dedupe == "none" and old:
                self._refuse_ambiguous(base, old, key, staged)
            if old or lacking:
                added = self._rewrite(base, schema, old, staged, key, unique)
            unique = unique and base.unique_key == key
        new = self._publish(
            base,
            clock,
            operation="upsert",
            schema=schema.jsonValue(),
            partition_by=tuple(partition_by),
            paths=kept + added,
            unique_key=key if unique else None,
            streams=streams,
        )
        return WriteResult(staged.rows, hits, new.version)

    def _staged_rows(self, staged: _Staged) -> DataFrame:
        return self._rows(staged.dirs, staged.schema).select(*_columns(staged.schema))

    def _check_key_type(self, base: Snapshot, df: DataFrame, key: str) -> None:
        if key not in base.struct.names:
            raise SpecError(f"key {key!r} is not a column of the table")
        check_key_type(base.struct[key].dataType, df.schema[key].dataType, key)

    def _dedupe(
        self,
        staged: _Staged,
        partition_by: Sequence[str],
        key: str,
        mode: str,
        order_by: Sequence[str],
    ) -> _Staged:
        """One row per key, at the price of a key-only count unless a key does repeat.

        Mode ``error`` drops exact copies of a row and refuses rows that differ.
        """
        if mode == "none" or not staged.dirs:
            return staged
        rows = self._staged_rows(staged)
        named = F.col(quoted(key)).isNotNull()
        keyed = rows.filter(named)
        if duplicate_keys(keyed, key).isEmpty():
            return staged
        if mode == "latest":
            single = latest_per_key(keyed, key, order_by)
        else:
            single = keyed.dropDuplicates()
            if not duplicate_keys(single, key).isEmpty():
                self._discard(staged.dirs)
                raise DuplicateKeyError(
                    f"{key} repeats with differing rows; set target.order_by or target.dedupe"
                )
        kept = self._stage(
            single.unionByName(rows.filter(~named)), partition_by, _key_range(rows, key)
        )
        self._discard(staged.dirs)
        return kept

    def _refuse_ambiguous(
        self, base: Snapshot, paths: Sequence[str], key: str, staged: _Staged
    ) -> None:
        """Repeated new keys are all inserted, but one row cannot be updated by two."""
        k = F.col(quoted(key))
        keys = self._staged_rows(staged).select(k).filter(k.isNotNull())
        known = self._rows(paths, base.struct).select(k).filter(k.isNotNull()).distinct()
        if not duplicate_keys(keys.join(known, key, "left_semi"), key).isEmpty():
            self._discard(staged.dirs)
            raise DuplicateKeyError(f"several rows of the batch update one {key}")

    def _near(self, target: DataFrame, key: str, staged: _Staged) -> DataFrame:
        """Target rows within the batch's key range; statistics let Parquet skip the others.

        A load of ever-growing keys finds nothing in range and reads almost nothing.
        """
        low, high = staged.stats.get("key_low"), staged.stats.get("key_high")
        if low is None or high is None:
            return target
        kind = target.schema[key].dataType
        bounds = F.lit(low).cast(kind), F.lit(high).cast(kind)
        return target.filter(F.col(quoted(key)).between(*bounds))

    def _hits(self, target: DataFrame, key: str, staged: _Staged) -> DataFrame:
        """Numbers of the live files that hold a key of the batch; of the target only the key is read.

        One plan for every size: a file goes through the join as a number made of its path. A
        batch that Spark finds small is broadcast, otherwise either side is shuffled once.
        """
        k = quoted(key)
        near = self._near(target, key, staged).filter(F.col(k).isNotNull())
        uri = near.metadataColumn("_metadata").getField("file_path")
        number = F.xxhash64(F.substring_index(uri, f"/{_COMMIT}", -1))
        keys = self._staged_rows(staged).select(F.col(k)).filter(F.col(k).isNotNull())
        hit = near.select(F.col(k), number.alias("__file")).join(keys, key, "left_semi")
        return hit.select("__file").distinct()

    def _touched(self, base: Snapshot, target: DataFrame, key: str, staged: _Staged) -> set[str]:
        """Live files that hold a key of the batch, named by the table's own listing.

        Two files of one number would both be rewritten, which changes no row.
        """
        if not base.paths or not staged.dirs:
            return set()
        # Never more rows than the table has files.
        found = {row["__file"] for row in self._hits(target, key, staged).collect()}
        if not found:
            return set()
        files = [f for p in base.paths for f in self._files(p)]
        uris = [uri.removeprefix(_COMMIT) for uri in self._folder.encoded(files)]
        listed = self.spark.createDataFrame(pa.table({"name": files, "uri": uris}))
        numbered = listed.select("name", F.xxhash64("uri").alias("number")).collect()
        return {row["name"] for row in numbered if row["number"] in found}

    def _files(self, path: str) -> list[str]:
        """Data files of a live path, which names a directory or one file."""
        return [path] if path.endswith(".parquet") else self._folder.data_files(path)

    def _split(self, base: Snapshot, touched: set[str]) -> tuple[tuple[str, ...], tuple[str, ...]]:
        """Live paths to keep, and those to rewrite, given the files that are hit.

        A directory with few files hit is replaced by the names of its other files; one with
        most of them hit is rewritten whole, which keeps the list of paths short.
        """
        by_dir: dict[str, list[str]] = {}
        for name in sorted(touched):
            by_dir.setdefault(name.rsplit("/", 1)[0], []).append(name)
        kept, old = [], []
        for path in base.paths:
            if path in touched:
                old.append(path)
            elif path not in by_dir:
                kept.append(path)
            else:
                files = self._folder.data_files(path)
                if 2 * len(by_dir[path]) > len(files):
                    old.append(path)
                else:
                    old += by_dir[path]
                    kept += [f for f in files if f not in touched]
        return tuple(kept), tuple(old)

    def _rewrite(
        self,
        base: Snapshot,
        schema: T.StructType,
        paths: Sequence[str],
        staged: _Staged,
        key: str,
        unique: bool,
    ) -> tuple[str, ...]:
        """Write the rows of these paths anew, merged; returns what replaces paths and batch."""
        old = self._rows(paths, _typed(base.struct, schema)).select(*_columns(base.struct))
        batch = self._staged_rows(staged)
        mixed = len({_partition_of(p) for p in paths}) > 1 or None
        covers = set(base.struct.names) <= set(staged.schema.names)
        if covers and unique and base.unique_key == key:
            # The batch is in place already: only the rows it does not replace move.
            left = conform(untouched_rows(old, batch, key), schema)
            moved = self._stage(left, base.partition_by, mixed=mixed)
            return staged.dirs + moved.dirs
        known = base.unique_key == key
        merged = conform(upsert_rows(old, batch, key, unique=known), schema)
        result = self._stage(merged, base.partition_by, mixed=mixed)
        self._discard(staged.dirs)
        return result.dirs

    # -- maintenance -------------------------------------------------------------

    def compact(
        self,
        target_bytes: int = TARGET_FILE_BYTES,
        min_files: int = 2,
        only_newest: bool = False,
        since: int | None = None,
        clock: dt.datetime | None = None,
    ) -> int:
        """Merge small files, partition by partition; returns how many partitions had some.

        Directories whose files have a quarter of the wanted size on average stay as they are,
        and so do fewer than ``min_files`` small files. Shuffled rows take more room than
        Parquet, so twice the wanted size is asked of the shuffle: what comes out is then large
        enough not to be merged again. ``since`` is a version: only partitions written to
        after it are looked at, which bounds the work by what was done since; ``only_newest``
        is the version before this one. Sizes are set in a session of their own.
        """
        base = self.snapshot()
        if base is None:
            return 0
        # A job's newest load stays as it is until the next one: it may have to be replaced.
        open_loads = {commit for _, commit in base.shares.values()}
        movable = [p for p in base.paths if p.split("/", 1)[0] not in open_loads]
        groups: dict[str, list[str]] = {}
        for path in movable:
            groups.setdefault(_partition_of(path), []).append(path)
        if only_newest and base.version > 1:
            since = base.version - 1
        if since is not None:
            before = self.snapshot(since)
            known = set(before.paths) if before else set()
            fresh = {_partition_of(p) for p in base.paths if p not in known}
            groups = {p: paths for p, paths in groups.items() if p in fresh}
        loose = []
        for paths in groups.values():
            usage = {p: self._folder.usage(p) for p in paths}
            small = [p for p, (files, size) in usage.items() if size < files * target_bytes / 4]
            files, size = (sum(usage[p][i] for p in small) for i in (0, 1))
            if files >= min_files and files > math.ceil(size / target_bytes):
                loose += small
        if not loose:
            return 0

        mine = own_session(self.spark)
        mine.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(2 * target_bytes))
        there = Table(mine, self.path)
        rows = there._rows(loose, base.struct).select(*_columns(base.struct))
        staged = there._stage(rows, base.partition_by, mixed=True)
        gone = set(loose)
        self._publish(
            base,
            clock,
            operation="compact",
            paths=tuple(p for p in base.paths if p not in gone) + staged.dirs,
        )
        return len({_partition_of(p) for p in loose})

    def expire(self, hours: float = RETENTION_HOURS, clock: dt.datetime | None = None) -> int:
        """Drop snapshots older than the retention, never the newest, and what only they hold.

        Directories that no snapshot ever named, left by failed writes, go when they are as old.
        """
        now = clock or clock_now(self.spark)
        cutoff = now - dt.timedelta(hours=hours)
        snapshots = [s for v in self._versions() if (s := self._load(v))]
        if not snapshots:
            return 0
        newest = snapshots[-1]
        kept = [
            s
            for s in snapshots
            if s is newest or dt.datetime.fromisoformat(s.committed_at) >= cutoff
        ]
        live = {p for s in kept for p in s.paths}
        dead = {p for s in snapshots for p in s.paths} - live
        commits = {p.split("/", 1)[0] for p in live | dead}
        for commit, _, _, modified in self._folder.listing(_COMMIT + "*"):
            if commit not in commits and modified < (time.time() - hours * 3600) * 1000:
                self._folder.delete(commit)
        in_use = {commit for p in live for commit in _ancestors(p)}
        for path in sorted(dead):
            if path not in in_use:
                if not live.intersection(_ancestors(path)):
                    self._folder.delete(path)
            else:  # a directory some files of which are still named one by one
                for name in self._folder.data_files(path):
                    if name not in live:
                        self._folder.delete(name)
        for commit in {p.split("/", 1)[0] for p in dead} - {p.split("/", 1)[0] for p in live}:
            self._folder.delete(commit)
        for s in snapshots:
            if s not in kept:
                self._folder.delete(f"{_SNAPSHOTS}/{s.version:010d}.json")
        return len(dead)


def _kept(snap: Snapshot, share: tuple[str, str]) -> tuple[str, ...]:
    """Live paths but for those that an earlier attempt at the same load of the job wrote."""
    load, commit = snap.shares.get(share[0], ("", ""))
    return snap.paths if load != share[1] else tuple(p for p in snap.paths if p.split("/", 1)[0] != commit)


def _partition_of(path: str) -> str:
    """Partition part of a live path: neither the commit nor, if it is a file, its name."""
    return "/".join(step for step in path.split("/")[1:] if "=" in step)


def _ancestors(path: str) -> list[str]:
    """The path's parent directories within the table."""
    steps = path.split("/")
    return ["/".join(steps[:i]) for i in range(1, len(steps))]


def _typed(names: T.StructType, types: T.StructType) -> T.StructType:
    """The columns of one schema in the types of another."""
    return T.StructType([types[name] for name in names.names])


def _columns(schema: T.StructType) -> list[Column]:
    return [F.col(quoted(name)) for name in schema.names]


def _aliased(stats: Mapping[str, Column] | None) -> list[Column]:
    return [column.alias(name) for name, column in (stats or {}).items()]


def _key_range(df: DataFrame, key: str) -> dict[str, Column]:
    """Least and greatest key, for key types that Parquet statistics order the same way."""
    if not isinstance(df.schema[key].dataType, _RANGED_KEYS):
        return {}
    k = F.col(quoted(key))
    return {"key_low": F.min(k), "key_high": F.max(k)}

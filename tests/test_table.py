import datetime as dt
import os
import random
import time

import pytest
from helpers import frame, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.plans.table import ConcurrentWriteError, DuplicateKeyError, Table
from sluice.runtime import own_session
from sluice.spec import SpecError


def make(spark, data, schema="k int, v string, p string"):
    return frame(spark, data, schema)


def test_append_takes_up_new_columns(spark, path):
    t = Table(spark, path)
    assert not t.exists()
    t.append(make(spark, [(1, "a", "x")]), ["p"])
    t.append(make(spark, [(2, "y", 5)], "k int, p string, extra int"))
    assert rows(t.read(), "k", "v", "p", "extra") == [(1, "a", "x", None), (2, None, "y", 5)]


def test_columns_may_widen(spark, path):
    t = Table(spark, path)
    t.append(make(spark, [(1, 1, 1.5)], "k int, n int, f float"))
    t.append(make(spark, [(2, 2**40, 2.5)], "k int, n bigint, f double"))
    t.append(make(spark, [(3, 7, 3.5)], "k int, n int, f float"))
    assert rows(t.read()) == [(1, 1, 1.5), (2, 2**40, 2.5), (3, 7, 3.5)]


def test_nested_fields_may_be_added(spark, path):
    t = Table(spark, path)
    t.append(make(spark, [(1, (1,))], "k int, n struct<a:int>"))
    t.append(make(spark, [(2, (2, "z"))], "k int, n struct<a:int,b:string>"))
    assert rows(t.read(), "k", "n.a", "n.b") == [(1, 1, None), (2, 2, "z")]


def test_upsert_may_widen_and_nest(spark, path):
    t = Table(spark, path)
    t.upsert(make(spark, [(1, 1, (1,)), (2, 2, (2,))], "k int, i int, n struct<a:int>"), "k")
    wide = "k int, i bigint, n struct<a:bigint,b:string>"
    t.upsert(make(spark, [(2, 2**40, (3, "z"))], wide), "k")
    t.upsert(make(spark, [(1, 7)], "k int, i int"), "k")
    assert rows(t.read(), "k", "i", "n.a", "n.b") == [(1, 7, 1, None), (2, 2**40, 3, "z")]


def test_overwrite_keeps_old_columns_and_the_old_snapshot(spark, path):
    t = Table(spark, path)
    t.append(make(spark, [(1, "a", "x")]))
    t.overwrite(make(spark, [(9, 5)], "k int, z int"), ["k"])
    assert rows(t.read(), "k", "v", "p", "z") == [(9, None, None, 5)]
    assert t.snapshot().partition_by == ("k",)
    assert rows(t.read(version=1)) == [(1, "a", "x")]


def test_upsert_rewrites_only_touched_partitions(spark, path):
    t = Table(spark, path)
    t.upsert(make(spark, [(1, "a", "x"), (2, "b", "y"), (3, "c", "y"), (4, "d", "z")]), "k", ["p"])
    before = set(t.snapshot().paths)
    result = t.upsert(make(spark, [(2, "B", "new"), (5, "e", "z")]), "k")
    assert result.touched == 1
    assert rows(t.read()) == [(1, "a", "x"), (2, "B", "new"), (3, "c", "y"), (4, "d", "z"), (5, "e", "z")]
    gone = before - set(t.snapshot().paths)
    assert [d.split("/")[1] for d in gone] == ["p=y"]


def many_files(spark, n=6):
    """Rows 0..99 in n files, each with its own range of keys."""
    return spark.range(0, 100, 1, n).selectExpr("id AS k", "'old' AS v", "id % 2 AS p")


def test_upsert_rewrites_only_the_files_that_hold_a_key(spark, path):
    t = Table(spark, path)
    t.upsert(many_files(spark), "k")
    whole = t.snapshot().paths
    assert len(whole) == 1 and len(t._folder.data_files(whole[0])) == 6
    assert t.upsert(spark.sql("SELECT 5L AS k, 'new' AS v, 1L AS p"), "k").touched == 1
    kept = [p for p in t.snapshot().paths if p.endswith(".parquet")]
    assert len(kept) == 5 and all(p.startswith(whole[0]) for p in kept)
    want = [(i, "new" if i == 5 else "old", i % 2) for i in range(100)]
    assert sorted(map(tuple, t.read().collect())) == want
    # Files named one by one can be hit, compacted and expired like directories.
    assert t.upsert(spark.sql("SELECT 50L AS k, 'new' AS v, 0L AS p"), "k").touched == 1
    want[50] = (50, "new", 0)
    assert sorted(map(tuple, t.read().collect())) == want
    before = len(os.listdir(f"{path}/{whole[0]}"))
    t.expire(0, clock=dt.datetime.now() + dt.timedelta(minutes=1))
    assert len(os.listdir(f"{path}/{whole[0]}")) < before
    assert sorted(map(tuple, t.read().collect())) == want
    assert t.compact() == 1
    t.expire(0, clock=dt.datetime.now() + dt.timedelta(minutes=1))
    assert not os.path.exists(f"{path}/{whole[0]}")
    assert sorted(map(tuple, t.read().collect())) == want


@pytest.mark.parametrize("seed", range(4))
def test_many_upserts_equal_a_dict(spark, path, seed, monkeypatch):
    rng = random.Random(seed)
    if seed % 2:  # no side of a join is small enough to be broadcast
        spark = own_session(spark)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    t, want = Table(spark, path), {}
    for step in range(6):
        batch = {rng.randrange(60): (f"s{step}", rng.choice("xyz")) for _ in range(rng.choice([3, 25]))}
        df = make(spark, [(k, v, p) for k, (v, p) in batch.items()]).repartition(3, "k")
        t.upsert(df, "k", ["p"])
        want.update(batch)
        if rng.random() < 0.4:
            t.compact()
        if rng.random() < 0.4:
            t.expire(0, clock=dt.datetime.now() + dt.timedelta(minutes=1))
        assert sorted(map(tuple, t.read().collect())) == sorted((k, v, p) for k, (v, p) in want.items())


def test_upsert_can_empty_a_partition(spark, path):
    t = Table(spark, path)
    t.upsert(make(spark, [(1, "a", "x"), (2, "b", "y")]), "k", ["p"])
    t.upsert(make(spark, [(1, "a2", "y")]), "k")
    assert rows(t.read()) == [(1, "a2", "y"), (2, "b", "y")]
    assert not any(d.endswith("p=x") for d in t.snapshot().paths)


def test_new_keys_are_a_plain_append(spark, path):
    t = Table(spark, path)
    t.upsert(make(spark, [(1, "a", "x")]), "k", ["p"])
    old = t.snapshot().paths
    assert t.upsert(make(spark, [(2, "b", "x")]), "k").touched == 0
    assert set(old) < set(t.snapshot().paths)


def test_odd_partition_values(spark, path):
    odd = ["a b", "a/b", "a=b", "50%", "ü:*?", "x'y", "01", "1", "2024-01-01", "{x}[y]"]
    t = Table(spark, path)
    t.upsert(make(spark, [(i, "old", p) for i, p in enumerate(odd)] + [(99, "n", None)]), "k", ["p"])
    result = t.upsert(make(spark, [(i, "new", p) for i, p in enumerate(odd)] + [(99, "m", None)]), "k")
    assert result.touched == len(odd) + 1
    assert rows(t.read()) == sorted(
        [(i, "new", p) for i, p in enumerate(odd)] + [(99, "m", None)],
        key=lambda r: [(v is not None, str(v)) for v in r],
    )


def test_files_do_not_multiply_by_tasks_and_partitions(spark, path):
    t = Table(spark, path)
    rows_in = spark.range(0, 1000, 1, 20).selectExpr("id AS k", "id % 5 AS p")
    assert t.append(rows_in, ["p"]).rows == 1000
    assert sum(t._folder.usage(p)[0] for p in t.snapshot().paths) == 5


@pytest.mark.parametrize("kind, values", [
    ("date", ["2024-02-29", "1999-12-31"]),
    ("timestamp", ["2024-02-29 01:02:03.5", "1999-12-31 00:00:00"]),
    ("timestamp_ntz", ["2024-02-29 01:02:03.5", "1999-12-31 00:00:00"]),
    ("decimal(10,2)", ["1.50", "-3.00"]),
    ("double", ["0.1", "1e300"]),
    ("boolean", ["true", "false"]),
])
def test_partition_values_keep_their_type(spark, path, kind, values):
    t = Table(spark, path)
    df = spark.createDataFrame(list(enumerate([*values, None])), "k int, raw string")
    df = df.withColumn("p", F.col("raw").cast(kind))
    for _ in range(2):
        t.upsert(df, "k", ["p"])
    assert t.read().schema["p"].dataType == df.schema["p"].dataType
    assert rows(t.read(), "k", "p") == rows(df, "k", "p")


def test_one_partition_is_read_without_the_others(spark, path):
    t = Table(spark, path)
    t.append(make(spark, [(1, "a", "x"), (2, "b", "y"), (3, "c", "x=y")]), ["p"])
    t.append(make(spark, [(4, "d", "x")]))
    assert rows(t.read_partition("p", "x")) == [(1, "a", "x"), (4, "d", "x")]
    assert rows(t.read_partition("v", "b")) == [(2, "b", "y")]
    assert rows(t.read_partition("p", "z")) == []
    assert rows(t.read_partition("p", "x=y")) == [(3, "c", "x=y")]
    files = t.read_partition("p", "x").inputFiles()
    assert len(files) == 2 and all("p=x/" in f for f in files)


def test_odd_table_paths(spark, tmp_path):
    t = Table(spark, f"file:{tmp_path}/a b/50% ü/t/")
    for value in ("old", "new"):
        t.upsert(make(spark, [(1, value, "x"), (2, value, "y z")]), "k", ["p"])
    assert rows(t.read()) == [(1, "new", "x"), (2, "new", "y z")]
    relative = Table(spark, os.path.relpath(f"{tmp_path}/rel"))
    for value in ("old", "new"):
        relative.upsert(make(spark, [(1, value, "x")]), "k", ["p"])
    assert rows(relative.read()) == [(1, "new", "x")]


@pytest.mark.parametrize("small", [1 << 26, -1])
def test_a_key_may_have_any_name(spark, path, small):
    spark = own_session(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(small))
    for i, key in enumerate(["file_path", "a.b", "rows", "back`tick", "_metadata"]):
        t = Table(spark, f"{path}{i}")
        for value in ("old", "new"):
            df = spark.createDataFrame([(1, value), (2, value)], T.StructType(
                [T.StructField(key, T.LongType()), T.StructField("v", T.StringType())]))
            t.upsert(df, key)
        assert sorted(map(tuple, t.read().collect())) == [(1, "new"), (2, "new")]


def test_maintenance_survives_missing_versions(spark, path):
    t = Table(spark, path)
    for i in range(3):
        t.append(make(spark, [(i, "a", "x")]))
    t.expire(0, clock=dt.datetime.now() + dt.timedelta(minutes=1))
    assert t.snapshot(2) is None
    assert t.compact(only_newest=True) == 1
    assert t.read().count() == 3
    with pytest.raises(FileNotFoundError):
        t.read(version=1)


def test_rows_without_key_are_always_inserted(spark, path):
    t = Table(spark, path)
    for _ in range(2):
        t.upsert(make(spark, [(None, "n", "x"), (1, "a", "x")]), "k", ["p"])
    assert rows(t.read()) == [(None, "n", "x"), (None, "n", "x"), (1, "a", "x")]


def test_upsert_keeps_columns_the_batch_lacks(spark, path):
    t = Table(spark, path)
    t.upsert(make(spark, [(1, "a", "x"), (2, "b", "x")]), "k")
    t.upsert(make(spark, [(2, "X", 5), (3, "Y", 6)], "k int, p string, extra int"), "k")
    assert rows(t.read()) == [(1, "a", "x", None), (2, "b", "X", 5), (3, None, "Y", 6)]


def test_a_batch_may_lack_the_partition_column(spark, path):
    t = Table(spark, path)
    t.upsert(make(spark, [(1, "a", "x"), (2, "b", "y")]), "k", ["p"])
    t.upsert(make(spark, [(2, "B")], "k int, v string"), "k")
    t.upsert(make(spark, [(9, "N")], "k int, v string"), "k")
    assert rows(t.read()) == [(1, "a", "x"), (2, "B", "y"), (9, "N", None)]


def test_repeated_keys(spark, path):
    t = Table(spark, path)
    twice = make(spark, [(1, "a", "x"), (1, "b", "x")])
    with pytest.raises(DuplicateKeyError):
        t.upsert(twice, "k")
    assert not t.exists()
    assert not [f for f in os.listdir(path) if f.startswith("_commit")]
    assert t.upsert(twice, "k", dedupe="latest", order_by=["v"]).rows == 1
    assert rows(t.read()) == [(1, "b", "x")]


def test_exact_copies_are_one_row(spark, path):
    t = Table(spark, path)
    copies = make(spark, [(1, "a", "x"), (1, "a", "x"), (None, "n", "x"), (None, "n", "x")])
    assert t.upsert(copies, "k").rows == 3
    assert rows(t.read()) == [(None, "n", "x"), (None, "n", "x"), (1, "a", "x")]


def test_undeduplicated_first_load_updates_every_copy(spark, path):
    t = Table(spark, path)
    t.upsert(make(spark, [(1, "a", "x"), (1, "b", "x"), (2, "c", "x")]), "k", dedupe="none")
    t.upsert(make(spark, [(1, "N", "x")]), "k")
    assert rows(t.read()) == [(1, "N", "x"), (1, "N", "x"), (2, "c", "x")]


def test_without_dedupe_new_keys_may_repeat_but_updates_may_not(spark, path):
    t = Table(spark, path)
    t.upsert(make(spark, [(1, "a", "x")]), "k")
    t.upsert(make(spark, [(1, "b", "x"), (2, "c", "x"), (2, "d", "x")]), "k", dedupe="none")
    assert rows(t.read()) == [(1, "b", "x"), (2, "c", "x"), (2, "d", "x")]
    with pytest.raises(DuplicateKeyError, match="several rows"):
        t.upsert(make(spark, [(1, "y", "x"), (1, "z", "x")]), "k", dedupe="none")
    assert rows(t.read()) == [(1, "b", "x"), (2, "c", "x"), (2, "d", "x")]


def test_newest_only_ignores_late_rows(spark, path):
    t = Table(spark, path)
    schema = "k int, o int, v string"
    t.upsert(make(spark, [(1, 5, "a"), (2, 5, "b")], schema), "k")
    late = make(spark, [(1, 4, "late"), (2, 6, "new"), (3, 1, "ins")], schema)
    t.upsert(late, "k", dedupe="latest", order_by=["o"], newest_only=True)
    assert rows(t.read()) == [(1, 5, "a"), (2, 6, "new"), (3, 1, "ins")]


def test_a_replayed_micro_batch_is_applied_once(spark, path):
    t = Table(spark, path)
    batch = make(spark, [(None, "n", "x")])
    for _ in range(3):
        t.upsert(batch, "k", stream=("q", 7))
    t.upsert(batch, "k", stream=("q", 8))
    assert t.read().count() == 2


def test_key_type_and_partition_columns_are_checked(spark, path):
    t = Table(spark, path)
    with pytest.raises(SpecError, match="partition columns: zz"):
        t.upsert(make(spark, [(1, "a", "x")]), "k", ["zz"])
    t.upsert(make(spark, [(1, "a", "x")]), "k")
    with pytest.raises(SpecError, match="int in the table but string"):
        t.upsert(make(spark, [("1", "a", "x")], "k string, v string, p string"), "k")


def test_a_failed_write_leaves_the_table_alone(spark, path):
    t = Table(spark, path)
    t.upsert(make(spark, [(1, "a", "x")]), "k")
    bad = make(spark, [(1, "b", "x")]).withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        t.upsert(bad, "k")
    assert rows(t.read()) == [(1, "a", "x")]
    assert t.snapshot().version == 1


def test_the_second_of_two_writers_is_refused(spark, path):
    t = Table(spark, path)
    t.append(make(spark, [(1, "a", "x")]))
    base = t.snapshot()
    t.append(make(spark, [(2, "b", "x")]))
    with pytest.raises(ConcurrentWriteError):
        t._publish(base, None, operation="append")
    assert t.read().count() == 2
    hidden = [f for f in os.listdir(f"{path}/_snapshots") if not f.endswith(".crc")]
    assert sorted(hidden) == ["0000000001.json", "0000000002.json"]


def test_an_append_that_comes_second_publishes_on_top(spark, path, monkeypatch):
    t = Table(spark, path)
    t.append(make(spark, [(1, "a", "x")]))
    publish, raced = Table._publish, []

    def lose_twice(self, base, clock, **changes):
        if len(raced) < 2:
            raced.append(1)
            other = make(spark, [(1 + len(raced), "o", 5)], "k int, v string, extra int")
            monkeypatch.setattr(Table, "_publish", publish)
            Table(spark, path).append(other)
            monkeypatch.setattr(Table, "_publish", lose_twice)
        return publish(self, base, clock, **changes)

    monkeypatch.setattr(Table, "_publish", lose_twice)
    monkeypatch.setattr("sluice.plans.table.time.sleep", lambda seconds: None)
    t.append(make(spark, [(9, "i", "z")]))
    assert rows(t.read(), "k", "p", "extra") == [
        (1, "x", None), (2, None, 5), (3, None, 5), (9, "z", None)]
    assert t.snapshot().version == 4


def test_a_writer_that_died_before_publishing_is_ignored(spark, path):
    t = Table(spark, path)
    t.append(make(spark, [(1, "a", "x")]))
    with open(f"{path}/_snapshots/.draft", "w") as half:
        half.write('{"version": 2, "pa')
    t.append(make(spark, [(2, "b", "x")]))
    assert t.snapshot().version == 2 and t.read().count() == 2


def test_compaction_changes_files_not_rows(spark, path):
    t = Table(spark, path)
    for i in range(4):
        t.append(make(spark, [(i, "a", p) for p in "xy"]), ["p"])
    before = rows(t.read())
    assert t.compact() == 2
    assert len(t.snapshot().paths) == 2
    assert rows(t.read()) == before
    assert t.compact() == 0


def test_compaction_of_the_newest_write_leaves_other_partitions(spark, path):
    t = Table(spark, path)
    for _ in range(3):
        t.append(make(spark, [(1, "a", "x")]), ["p"])
    for _ in range(3):
        t.append(make(spark, [(2, "b", "y")]))
    assert t.compact(only_newest=True) == 1
    assert sorted(d.split("/")[1] for d in t.snapshot().paths) == ["p=x"] * 3 + ["p=y"]


def test_merged_files_are_not_merged_again(spark, path):
    t = Table(spark, path)
    pad = F.sha2(F.col("id").cast("string"), 256).alias("pad")
    for i in range(4):
        t.append(spark.range(i * 50_000, (i + 1) * 50_000, 1, 16).select("id", pad))
    target = 3 << 20
    assert t.compact(target_bytes=target) == 1
    sizes = [t._folder.usage(p) for p in t.snapshot().paths]
    assert sum(n for n, _ in sizes) > 2  # several files, as the rows need
    version = t.snapshot().version
    assert t.compact(target_bytes=target) == 0 and t.snapshot().version == version
    assert t.read().count() == 200_000


def test_expiry_drops_what_only_old_snapshots_hold(spark, path):
    t = Table(spark, path)
    day = lambda n: dt.datetime(2025, 6, 1) + dt.timedelta(days=n)
    t.overwrite(make(spark, [(1, "a", "x")]), clock=day(0))
    t.overwrite(make(spark, [(2, "b", "x")]), clock=day(8))
    t.append(make(spark, [(3, "c", "x")]), clock=day(9))
    assert t.expire(clock=day(10)) == 1
    assert rows(t.read()) == [(2, "b", "x"), (3, "c", "x")]
    assert rows(t.read(version=2)) == [(2, "b", "x")]
    assert t.snapshot(3).version == 3
    assert len([f for f in os.listdir(path) if f.startswith("_commit")]) == 2


def test_expiry_never_drops_the_newest_and_clears_abandoned_writes(spark, path):
    t = Table(spark, path)
    t.append(make(spark, [(1, "a", "x")]), clock=dt.datetime(2020, 1, 1))
    make(spark, [(5, "z", "x")]).write.parquet(f"{path}/_commit=abandoned")
    make(spark, [(6, "z", "x")]).write.parquet(f"{path}/_commit=inflight")
    old = time.time() - 8 * 24 * 3600
    os.utime(f"{path}/_commit=abandoned", (old, old))
    t.expire()
    assert os.path.exists(f"{path}/_commit=inflight")
    assert rows(t.read()) == [(1, "a", "x")]
    assert not os.path.exists(f"{path}/_commit=abandoned")


def test_growing_keys_prune_the_target_scan(spark, path):
    t = Table(spark, path)
    t.upsert(spark.range(1000).withColumnRenamed("id", "k"), "k")
    staged = t._stage(spark.range(2000, 2010).withColumnRenamed("id", "k"), (), {
        "key_low": F.min("k"), "key_high": F.max("k")})
    near = t._near(t.read(), "k", staged)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,2000)" in plan

"""CSV and JSON without a declared schema: one read, the types of Spark's own inference."""

import json
import random
import shutil

import pytest
from helpers import rows

from sluice.sources import ReadContext, read_source
from sluice.sources.typed import joined_kind, variant_conflicts, variant_struct
from sluice.spec import SourceSpec

CELLS = {
    "int": ["1", "-5", "+7", "007", "2147483647"], "bigint": ["2147483648", "-9999999999"],
    "double": ["1.5", "-2e3", ".5", "3.", "NaN"], "date": ["2024-01-31", "1999-12-01"],
    "timestamp": ["2024-01-31 10:00:00", "2024-02-29T23:59:59.123456"], "boolean": ["true", "FALSE"], "string": ["x", "2024-13-45", "1d", "0x1F", "1,5"],
}


def csv_file(tmp_path, columns, n=40, parts=3):
    folder = tmp_path / "csv"
    folder.mkdir()
    cell = lambda v: "" if v is None else '"' + v.replace('"', '""') + '"' if "," in v else v
    for part in range(parts):
        lines = [",".join(columns)] + [",".join(cell(columns[c][i % len(columns[c])]) for c in columns) for i in range(part, n, parts)]
        (folder / f"{part}.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


@pytest.mark.parametrize("seed", range(6))
def test_csv_types_and_values_equal_sparks_inference(spark, tmp_path, seed):
    rng = random.Random(seed)
    columns = {}
    for i, kinds in enumerate([[k] for k in CELLS] + [rng.sample(sorted(CELLS), 2) for _ in range(6)]):
        cells = [rng.choice(CELLS[rng.choice(kinds)]) for _ in range(30)]
        columns[f"c{i}"] = [None if rng.random() < 0.2 else v for v in cells]
    columns["id"] = [str(i) for i in range(30)]
    path = csv_file(tmp_path, columns)
    got = read_source(spark, SourceSpec("csv", {"path": path}))
    want = spark.read.option("header", "true").option("inferSchema", "true").csv(path)
    assert got.dtypes == want.dtypes
    shown = lambda df: rows(df.selectExpr(*[f"CAST({c} AS STRING) AS {c}" for c in df.columns]))
    assert shown(got) == shown(want)


def test_odd_csv(spark, tmp_path):
    path = csv_file(tmp_path, {"a b": ["1"], "c.d": [None], "e`f": ["99999999999999999999"]}, n=3, parts=1)
    got = read_source(spark, SourceSpec("csv", {"path": path}))
    assert got.dtypes == [("a b", "int"), ("c.d", "string"), ("e`f", "decimal(38,0)")]
    assert len(got.collect()) == 3
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "a.csv").write_text("x,y\n")
    empty = read_source(spark, SourceSpec("csv", {"path": str(tmp_path / "none")}))
    assert empty.columns == ["x", "y"] and empty.collect() == []


@pytest.mark.parametrize("bits, kind", [(0, "string"), (None, "string"), (0b1, "int"), (0b11, "bigint"), (0b1001, "double"), (0b110000, "timestamp"), (0b10000, "date"), (0b10001, "string"), (0b1000000, "boolean"), (0b1000001, "string"), (0b10000001, "string")])
def test_kinds_join_upwards(bits, kind):
    assert joined_kind(bits) == kind


def json_source(spark, tmp_path, lines, name="json"):
    folder = tmp_path / name
    folder.mkdir()
    (folder / "a.json").write_text("\n".join(lines[::2]) + "\n")
    (folder / "b.json").write_text("\n".join(lines[1::2]) + "\n")
    return str(folder)


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_the_source_is_read_once(spark, tmp_path, fmt):
    if fmt == "csv":
        path = csv_file(tmp_path, {"a": ["1", "2"]}, n=10)
    else:
        path = json_source(spark, tmp_path, ['{"a": 1}'] * 10)
    context = ReadContext()
    got = read_source(spark, SourceSpec(fmt, {"path": path}), context)
    shutil.rmtree(path)
    assert len(got.collect()) == 10 and len(context.scratch) == 1
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    context.cleanup(spark)


@pytest.mark.parametrize("seed", range(4))
def test_json_equals_sparks_reader(spark, tmp_path, seed):
    rng = random.Random(seed)
    record = lambda i: {"id": i, "n": {"x": rng.choice([1, 2.5, None]), "y": [rng.randint(0, 9) for _ in range(rng.randint(0, 3))]}, "s": rng.choice(["a", "é\"", None]), "t": "2024-01-01", "b": rng.random() < 0.5, **({"late": i} if i % 3 == 0 else {}), "list": [{"k": i}]}
    objects = [record(i) for i in range(40)]
    lines = [json.dumps(objects[i]) for i in range(10)] + [json.dumps(objects[i : i + 5]) for i in range(10, 40, 5)] + ["", "[]"]
    path = json_source(spark, tmp_path, lines)
    got, want = read_source(spark, SourceSpec("json", {"path": path})), spark.read.json(path)
    assert got.dtypes == want.dtypes
    assert rows(got.selectExpr("to_json(struct(*)) AS j")) == rows(want.selectExpr("to_json(struct(*)) AS j"))


def test_fields_without_one_type_are_strings(spark, tmp_path):
    path = json_source(spark, tmp_path, ['{"id": 1, "v": 5}', '{"id": 2, "v": "five"}', '{"id": 3, "v": {"a": [1]}}', '{"id": 4, "v": null, "w": null}'])
    got = read_source(spark, SourceSpec("json", {"path": path}))
    assert got.dtypes == [("id", "bigint"), ("v", "string"), ("w", "string")]
    assert rows(got) == [(1, "5", None), (2, "five", None), (3, '{"a":[1]}', None), (4, None, None)]


def test_lines_that_are_no_records_are_shown(spark, tmp_path):
    path = json_source(spark, tmp_path, ['{"id": 1}', "{broken", '[{"id": 2}, 7]', "5"])
    got = read_source(spark, SourceSpec("json", {"path": path}))
    assert got.columns == ["id", "_corrupt_record"]
    assert rows(got) == [(None, "5"), (None, "7"), (None, "{broken"), (1, None), (2, None)]
    none = json_source(spark, tmp_path, ["[]", ""], "none")
    assert read_source(spark, SourceSpec("json", {"path": none})).collect() == []


def test_names_that_look_like_types():
    kind = "OBJECT<DECIMAL: DECIMAL(3,1), VOID: VOID, `a VARIANT: b`: VARIANT, o: OBJECT<`x<y`: ARRAY<VARIANT>, e: OBJECT<>>, z: ARRAY<OBJECT<q: FLOAT>>>"
    assert variant_struct(kind).simpleString() == "struct<DECIMAL:double,VOID:string,a VARIANT: b:string,o:struct<x<y:array<string>,e:string>,z:array<struct<q:double>>>"
    assert variant_conflicts(kind) == ["a VARIANT: b"]
    assert variant_struct("VOID").fields == [] and variant_conflicts("VOID") == []

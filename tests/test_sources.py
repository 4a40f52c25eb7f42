from unittest.mock import MagicMock

import pytest
from helpers import rows

from sluice.plans.table import Table
from sluice.sources import ReadContext, read_source, register, source_types
from sluice.sources.documents import mongo_options
from sluice.sources.files import sftp_options
from sluice.sources.jdbc import jdbc_options
from sluice.spec import SourceSpec, SpecError


def test_registry_ignores_case_and_names_what_it_knows(spark):
    register("Pairs")(lambda spark, source, context: spark.range(source.options["n"]))
    assert read_source(spark, SourceSpec("PAIRS", {"n": 3})).count() == 3
    with pytest.raises(SpecError, match="unknown source type 'nope'"):
        read_source(spark, SourceSpec("nope"))
    assert {"api", "mongo", "postgres", "sftp", "csv", "json", "parquet", "table"} <= set(source_types())


def test_jdbc_options_pass_only_what_is_given():
    base = {"url": "jdbc:postgresql://h/db", "dbtable": "public.users", "user": "u", "password": "p"}
    assert jdbc_options(base) == {**base, "driver": "org.postgresql.Driver"}
    ranged = {**base, "partition_column": "id", "lower_bound": "0", "upper_bound": 1000000, "num_partitions": "4"}
    assert jdbc_options(ranged) | {} == {
        **base,
        "driver": "org.postgresql.Driver",
        "partitionColumn": "id",
        "lowerBound": "0",
        "upperBound": "1000000",
        "numPartitions": "4",
    }


def test_jdbc_options_that_cannot_work():
    base = {"url": "u", "dbtable": "t"}
    for lame in ({"partition_column": "id"}, {"num_partitions": 4}, {"lower_bound": 1},
                 {"lower_bound": 1, "upper_bound": 2},
                 {"partition_column": "id", "num_partitions": 4, "upper_bound": 2}):
        with pytest.raises(SpecError, match="as well"):
            jdbc_options({**base, **lame})
    with pytest.raises(SpecError, match="dbtable is missing"):
        jdbc_options({"url": "u"})


def test_mongo_options():
    options = {"connection_uri": "mongodb://h", "database": "d", "collection": "c"}
    assert mongo_options(SourceSpec("mongo", options)) == {
        "connection.uri": "mongodb://h", "database": "d", "collection": "c"}
    with pytest.raises(SpecError, match="collection"):
        mongo_options(SourceSpec("mongo", {"connection_uri": "x", "database": "d"}))


def test_sftp_login_stays_out_of_the_path():
    options = sftp_options(SourceSpec("sftp", {"host": "h", "username": "u", "password": "p"}))
    assert options["fs.sftp.host.port"] == "22"
    assert options["fs.sftp.password.h.u"] == "p"


def test_csv_types_are_inferred_or_declared(spark, tmp_path):
    file = tmp_path / "d.csv"
    file.write_text("id,price,ts\n1,2.5,2025-01-01 00:00:00\n2,,\n")
    for source in (SourceSpec("csv", {"path": str(file)}),
                   SourceSpec("sftp", {"file_path": str(file)}, ingest_method="addFile")):
        types = {f.name: f.dataType.simpleString() for f in read_source(spark, source).schema}
        assert types == {"id": "int", "price": "double", "ts": "timestamp"}
    declared = SourceSpec("csv", {"path": str(file), "schema": "id string, price float, ts string"})
    assert rows(read_source(spark, declared), "id", "price") == [("1", 2.5), ("2", None)]


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "xml"])
def test_file_formats(spark, tmp_path, fmt):
    path = str(tmp_path / "data")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string")
    options = {"rowTag": "r"} if fmt == "xml" else {}
    df.write.format(fmt).options(**options).save(path)
    source = SourceSpec(fmt, {"path": path, "options": options})
    assert rows(read_source(spark, source), "id", "v") == [(1, "a"), (2, "b")]


def test_json_arrays_give_a_row_per_element(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id":1},{"id":2,"x":1}]\n[]\n{"id":"3"}\n')
    df = read_source(spark, SourceSpec("json", {"path": str(tmp_path)}))
    assert rows(df, "id", "x") == [("1", None), ("2", 1), ("3", None)]


def test_a_table_is_a_source(spark, path):
    Table(spark, path).append(spark.range(3))
    assert read_source(spark, SourceSpec("table", {"path": path})).count() == 3
    with pytest.raises(SpecError):
        read_source(spark, SourceSpec("table"))


@pytest.mark.parametrize(
    "kind, fmt, options",
    [
        ("postgres", "jdbc", {"url": "u", "dbtable": "t"}),
        ("mongo", "mongodb", {"connection_uri": "m", "database": "d", "collection": "c"}),
    ],
)
def test_database_reads_go_through_their_format(kind, fmt, options):
    session = MagicMock()
    read_source(session, SourceSpec(kind, options))
    session.read.format.assert_called_once_with(fmt)
    given = session.read.format.return_value.options.call_args.kwargs
    assert "u" in given.values() or "m" in given.values()


def test_sftp_reads_the_host_through_the_file_system():
    session = MagicMock()
    options = {"host": "h", "username": "u", "password": "secret", "file_path": "up load/a.csv", "schema": "a int"}
    read_source(session, SourceSpec("sftp", options))
    reader = session.read.format.return_value.options.return_value.option.return_value
    loaded = [call.args[0] for call in reader.schema.return_value.load.call_args_list]
    assert loaded == ["sftp://h/up%20load/a.csv"]
    given = session.read.format.return_value.options.call_args.kwargs
    assert given["fs.sftp.password.h.u"] == "secret" and "secret" not in loaded[0]


@pytest.mark.parametrize(
    "ends, bound, expected",
    [
        ((5, 900), None, ("5", "900")),
        ((5, 900), ("id", "600"), ("600", "900")),
        ((5, 900), ("id", "2"), ("5", "900")),
        ((5, 900), ("id", "2000"), ("900", "900")),
        ((5, 900), ("other", "600"), ("5", "900")),
        ((None, None), ("id", "600"), None),
    ],
)
def test_range_ends_are_asked_of_the_table(ends, bound, expected):
    session = MagicMock()
    session.read.format.return_value.options.return_value.load.return_value.head.return_value = ends
    options = {"url": "u", "dbtable": "(SELECT * FROM t) x", "partition_column": "id", "num_partitions": 4}
    read_source(session, SourceSpec("jdbc", options), ReadContext(bound=bound))
    asked, read = [call.kwargs for call in session.read.format.return_value.options.call_args_list]
    assert asked["dbtable"] == "(SELECT MIN(id) AS low, MAX(id) AS high FROM (SELECT * FROM t) x) ends"
    assert "partitionColumn" not in asked
    if expected is None:
        assert "partitionColumn" not in read and "numPartitions" not in read
    else:
        assert (read["lowerBound"], read["upperBound"], read["numPartitions"]) == (*expected, "4")

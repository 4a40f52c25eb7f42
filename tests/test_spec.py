import json

import pytest

from sluice.spec import SpecError, load_spec, parse_spec


def doc(**changes):
    base = {
        "job_name": "users",
        "source_type": "postgres",
        "source_config": {"url": "jdbc:x", "password": "${DB_PASSWORD}"},
        "target": {"path": "/t"},
    }
    return {**base, **changes}


def test_defaults():
    spec = parse_spec({"source_type": "csv", "target": {"path": "/t"}})
    assert spec.job_name == "unknown"
    assert spec.ingestion_type == "full"
    assert spec.target.format == "delta"
    assert spec.target.mode == "append"
    assert not spec.incremental
    assert spec.dedupe_mode(spec.order_columns(["a"], "a")) == "error"


def test_environment_fills_strings_and_leaves_unknown_names():
    spec = parse_spec(doc(job_name="a-${X}-${NOPE}"), env={"DB_PASSWORD": 'p"w', "X": "1"})
    assert spec.source.options["password"] == 'p"w'
    assert spec.job_name == "a-1-${NOPE}"


def test_load_spec_survives_quotes_in_values(tmp_path):
    file = tmp_path / "job.json"
    file.write_text(json.dumps(doc()))
    assert load_spec(file, env={"DB_PASSWORD": 'a"b\\c'}).source.options["password"] == 'a"b\\c'


def test_zero_is_a_bound_but_none_is_not():
    spec = parse_spec(doc(ingestion_type="INCREMENTAL", incremental_column="id", last_ingestion_value="0"))
    assert spec.incremental
    assert not parse_spec(doc(ingestion_type="incremental", incremental_column="id")).incremental
    assert not parse_spec(doc(incremental_column="id", last_ingestion_value="5")).incremental


def test_order_columns():
    spec = parse_spec(doc(incremental_column="at.day"))
    assert spec.order_columns(["id", "at"], "id") == ("at.day",)
    assert spec.dedupe_mode(("at.day",)) == "latest"
    assert spec.order_columns(["id"], "id") == ()  # the rows do not have it
    assert parse_spec(doc(incremental_column="id")).order_columns(["id"], "id") == ()
    given = parse_spec(doc(target={"path": "/t", "order_by": ["v"], "dedupe": "none"}))
    assert given.order_columns([], "id") == ("v",) and given.dedupe_mode(("v",)) == "none"


def test_dead_keys_only_warn():
    with pytest.warns(UserWarning, match="batch_size"):
        parse_spec(doc(batch_size=5))


@pytest.mark.parametrize(
    "changes",
    [
        {"source_type": ""},
        {"target": {}},
        {"ingestion_type": "sometimes"},
        {"target": {"path": "/t", "mode": "upsert"}},
        {"target": {"path": "/t", "dedupe": "maybe"}},
        {"target": {"path": "/t", "transformations": [{"type": "lower_case"}]}},
        {"target": {"path": "/t", "transformations": [{"type": "fill_na", "value": {"a": 1}}]}},
        {"source_config": {"on_page_error": "ignore"}},
    ],
)
def test_unusable_specs_are_refused(changes):
    with pytest.raises(SpecError):
        parse_spec(doc(**changes))


def test_a_spec_cannot_be_changed():
    spec = parse_spec(doc(target={"path": "/t", "partition_by": ["a"]}))
    assert spec.target.partition_by == ("a",)
    with pytest.raises(TypeError):
        spec.source.options["url"] = "other"


def test_rest_sources_shape_their_known_columns():
    assert parse_spec(doc(source_type="api")).source.array_columns == ("images", "eventLogs")
    assert parse_spec(doc(source_type="api")).source.struct_columns == ("vehicle",)
    assert parse_spec(doc()).source.array_columns == ()

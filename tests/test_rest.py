import json
import warnings

import pytest
from helpers import rows

from sluice.sources import ReadContext, read_source, rest
from sluice.spec import SourceSpec, SpecError


class Script:
    """Answers prepared requests and notes what was asked."""

    def __init__(self, answers):
        self.answers = answers
        self.asked = []

    def __call__(self, request):
        return self

    def get(self, params, varying):
        self.asked.append(dict(params))
        answer = self.answers(params)
        if isinstance(answer, Exception):
            raise answer
        return answer if isinstance(answer, str) else json.dumps(answer)


def run(monkeypatch, options, answers):
    script = Script(answers)
    monkeypatch.setitem(rest.TRANSPORTS, "http", script)
    reader = rest.PagedRestReader(rest.request_of(SourceSpec("api", {"url": "u", **options}), env={}))
    pages = [row for part in reader.partitions() for row in reader.read(part)]
    return pages, script.asked


def test_numbered_pages_go_on_after_an_empty_one(monkeypatch):
    options = {"params": {"q": 1}, "pagination": {"strategy": "page", "page_param": "p", "start_page": 3, "max_pages": 3}}
    pages, asked = run(monkeypatch, options, lambda p: [] if p["p"] == 4 else [p["p"]])
    assert asked == [{"q": 1, "p": 3}, {"q": 1, "p": 4}, {"q": 1, "p": 5}]
    assert [(n, json.loads(body)) for _, n, body, _ in pages] == [(3, [3]), (5, [5])]


def test_page_errors_fail_or_are_reported(monkeypatch):
    options = {"pagination": {"strategy": "page", "max_pages": 2}}
    broken = lambda p: OSError("down") if p["page"] == 2 else [1]
    with pytest.raises(RuntimeError, match="page 2: down"):
        run(monkeypatch, options, broken)
    pages, _ = run(monkeypatch, {**options, "on_page_error": "warn"}, broken)
    assert [(n, error) for _, n, _, error in pages] == [(1, None), (2, "OSError: down")]
    pages, _ = run(monkeypatch, {**options, "on_page_error": "warn"}, lambda p: "<html>")
    assert all(error for *_, error in pages)


def test_pages_are_spread_over_tasks():
    paging = {"strategy": "page", "max_pages": 10, "num_partitions": 3}
    reader = rest.PagedRestReader(rest.request_of(SourceSpec("api", {"url": "u", "pagination": paging}), env={}))
    ranges = [p.pages for p in reader.partitions()]
    assert len(ranges) == 3 and [n for r in ranges for n in r] == list(range(1, 11))


def test_cursor_follows_until_it_ends(monkeypatch):
    feed = {None: ("b", [1]), "b": ("c", [2]), "c": (None, [3])}
    options = {"data_path": "d.i", "pagination": {"strategy": "cursor", "cursor_param": "after", "cursor_path": "d.next", "max_pages": 9}}
    answer = lambda p: {"d": {"i": feed[p.get("after")][1], "next": feed[p.get("after")][0]}}
    pages, asked = run(monkeypatch, options, answer)
    assert asked == [{}, {"after": "b"}, {"after": "c"}]
    assert len(pages) == 3
    del options["pagination"]["max_pages"]
    assert len(run(monkeypatch, options, answer)[0]) == 3
    options["pagination"]["max_pages"] = 2
    cut = run(monkeypatch, options, answer)[0]
    assert [(n, error) for _, n, _, error in cut] == [(0, None), (1, None), (2, "max_pages: the feed goes on at c")]


def test_numbered_pages_without_a_limit_end_with_the_feed(monkeypatch):
    options = {"pagination": {"strategy": "page", "num_partitions": 2}}
    pages, asked = run(monkeypatch, options, lambda p: [p["page"]] if p["page"] <= 5 else [])
    assert sorted(n for _, n, *_ in pages) == [1, 2, 3, 4, 5]
    assert sorted(p["page"] for p in asked) == [1, 2, 3, 4, 5, 6, 7]


def test_cursor_stops_without_records_and_raises_on_errors(monkeypatch):
    options = {"data_path": "i", "pagination": {"strategy": "cursor", "cursor_param": "c", "cursor_path": "n", "max_pages": 9, }}
    pages, asked = run(monkeypatch, options, lambda p: {"i": [] if p else [1], "n": "x"})
    assert len(pages) == 1 and len(asked) == 2
    with pytest.raises(OSError):
        run(monkeypatch, options, lambda p: OSError("down"))


def test_object_cursor_becomes_parameters(monkeypatch):
    options = {"data_path": "i", "pagination": {"strategy": "cursor", "cursor_param": "continue", "cursor_path": "continue", "max_pages": 2}}
    step = {"sroffset": 50, "continue": "-||"}
    _, asked = run(monkeypatch, options, lambda p: {"i": [1], "continue": step})
    assert asked == [{}, step]


def test_every_chain_is_followed(monkeypatch):
    options = {"data_path": "i", "pagination": {"strategy": "cursor", "cursor_param": "c", "cursor_path": "n", "max_pages": 5, "start_cursors": ["a0", "b0"]}}
    nexts = {"a0": "a1", "a1": None, "b0": None}
    pages, asked = run(monkeypatch, options, lambda p: {"i": [1], "n": nexts[p["c"]]})
    assert [(c, n) for c, n, *_ in pages] == [(0, 0), (0, 1), (1, 0)]


def test_single_is_one_request(monkeypatch):
    pages, asked = run(monkeypatch, {"pagination": {"max_pages": 5}}, lambda p: {"x": 1})
    assert len(pages) == len(asked) == 1


@pytest.mark.parametrize(
    "auth, header",
    [
        ({"type": "bearer", "token": "s"}, {"Authorization": "Bearer s"}),
        ({"type": "Token", "token": "s"}, {"Authorization": "token s"}),
        ({"type": "apikey", "token_env_var": "KEY"}, {"X-API-Key": "from-env"}),
        ({"type": "bearer"}, {}),
        ({"type": "basic", "token": "s"}, {}),
    ],
)
def test_login_headers(auth, header):
    request = rest.request_of(SourceSpec("api", {"url": "u", "headers": {"A": "b"}, "auth": auth}), env={"KEY": "from-env"})
    assert request["headers"] == {"A": "b", **header}


def test_unusable_requests_are_refused():
    for options in ({}, {"url": "u", "pagination": {"strategy": "all"}}, {"url": "u", "pagination": {"strategy": "cursor"}}):
        with pytest.raises(SpecError):
            rest.request_of(SourceSpec("api", options))


def test_http_session_retries_both_schemes():
    pages = rest.HttpPages({"url": "u", "headers": {"A": "b"}, "verify_ssl": False})
    for url in ("http://x", "https://x"):
        retry = pages._session.get_adapter(url).max_retries
        assert retry.total == 5 and 429 in retry.status_forcelist
    assert pages._session.headers["A"] == "b" and pages._session.verify is False


def test_http_get_passes_parameters_and_timeout(monkeypatch):
    class Answer:
        text = "[1]"

        def raise_for_status(self):
            pass

    asked = {}
    pages = rest.HttpPages({"url": "http://x", "headers": {}, "verify_ssl": True})
    monkeypatch.setattr(pages._session, "get", lambda url, **kw: asked.update(kw, url=url) or Answer())
    assert pages.get({"a": 1}, None) == "[1]"
    assert asked == {"url": "http://x", "params": {"a": 1}, "timeout": 60}


def store(tmp_path, name, value, doc):
    folder = tmp_path / f"{name}={value}" if name else tmp_path
    folder.mkdir(exist_ok=True)
    (folder / "part-0.txt").write_text(json.dumps(doc))


def test_read_rest_unites_schemas_and_types(spark, tmp_path):
    store(tmp_path, "page", 1, {"r": [{"id": 1, "a": "x"}, {"id": 2, "n": {"p": 1}}]})
    store(tmp_path, "page", 2, {"r": {"id": "three", "b": 1.5}})
    options = {"url": str(tmp_path), "transport": "files", "data_path": "r", "pagination": {"strategy": "page", "max_pages": 2}}
    df = read_source(spark, SourceSpec("api", options))
    assert df.schema["id"].dataType.simpleString() == "string"
    assert rows(df, "id", "a", "b", "n.p") == [("1", "x", None, None), ("2", None, None, 1), ("three", None, 1.5, None)]


def test_read_rest_counts_page_errors_and_cleans_up(spark, tmp_path):
    store(tmp_path, "page", 1, [{"id": 1}])
    for page in (2, 3):
        (tmp_path / f"page={page}").mkdir()
        (tmp_path / f"page={page}" / "part-0.txt").write_text("<html>")
    options = {"url": str(tmp_path), "transport": "files", "on_page_error": "warn", "pagination": {"strategy": "page", "max_pages": 3}}
    context = ReadContext()
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        assert read_source(spark, SourceSpec("api", options), context).count() == 1
    assert context.page_errors == 2 and any("2 pages" in str(w.message) for w in caught)
    folder = context.scratch[0]
    context.cleanup(spark)
    import os

    assert not os.path.exists(folder)


def test_an_empty_feed_is_an_error(spark, tmp_path):
    store(tmp_path, "", "", {"r": []})
    with pytest.raises(ValueError, match="no records"):
        read_source(spark, SourceSpec("api", {"url": str(tmp_path), "transport": "files", "data_path": "r"}))


def test_a_declared_schema_is_used(spark, tmp_path):
    store(tmp_path, "", "", {"id": 1, "x": 2})
    options = {"url": str(tmp_path), "transport": "files", "schema": "id string"}
    assert rows(read_source(spark, SourceSpec("rest", options))) == [("1",)]

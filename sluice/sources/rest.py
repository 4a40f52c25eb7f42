"""REST feeds. Executors request the pages; the answers are written once and read as JSON.

Requests go out in the tasks of a Python data source: a range of numbered pages per task, as
many tasks as the cluster runs at once unless the spec says otherwise, or one task per chain
for cursors, whose pages only the chain itself can name. What they
answer is written to scratch before anything else looks at it, so that schema inference, the
write and the checks never request a page a second time.
"""

from __future__ import annotations

import itertools
import json
import os
import warnings
from collections.abc import Iterable, Iterator, Mapping
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from sluice.functions import json_records
from sluice.runtime import scratch_dir
from sluice.sources.registry import ReadContext, register
from sluice.spec import SourceSpec, SpecError

FORMAT = "paged_rest"

# Request limits and the header each kind of login sets.
TIMEOUT_SECONDS = 60
RETRIES = 5
RETRY_BACKOFF = 1
RETRY_STATUS = (429, 500, 502, 503, 504)
AUTH_HEADERS = {
    "bearer": ("Authorization", "Bearer {}"),
    "token": ("Authorization", "token {}"),
    "apikey": ("X-API-Key", "{}"),
}
STRATEGIES = ("single", "page", "cursor")


def dig(node: Any, path: str) -> Any:
    """The value at a dotted path of a JSON value; None where the path leaves the objects."""
    for step in path.split(".") if path else ():
        if not isinstance(node, dict):
            return None
        node = node.get(step)
    return node


class HttpPages:
    """Requests pages over HTTP, with retries on the statuses that pass."""

    def __init__(self, request: Mapping[str, Any]):
        import requests
        from requests.adapters import HTTPAdapter
        from urllib3.util.retry import Retry

        self._url = request["url"]
        self._session = requests.Session()
        self._session.headers.update(request["headers"])
        self._session.verify = request["verify_ssl"]
        retry = Retry(total=RETRIES, backoff_factor=RETRY_BACKOFF, status_forcelist=RETRY_STATUS)
        for scheme in ("https://", "http://"):
            self._session.mount(scheme, HTTPAdapter(max_retries=retry))

    def get(self, params: Mapping[str, Any], varying: tuple[str, Any] | None) -> str:
        answer = self._session.get(self._url, params=params, timeout=TIMEOUT_SECONDS)
        answer.raise_for_status()
        return answer.text


class StoredPages:
    """Pages kept as files: the page or cursor parameter names a folder ``name=value``."""

    def __init__(self, request: Mapping[str, Any]):
        from pyarrow import fs

        url = request["url"].replace("s3a://", "s3://", 1)
        if "://" not in url and not url.startswith("file:"):
            url = "file://" + url
        if url.startswith("file:/") and not url.startswith("file://"):
            url = "file://" + url[len("file:") :]
        self._fs, self._root = fs.FileSystem.from_uri(url)

    def get(self, params: Mapping[str, Any], varying: tuple[str, Any] | None) -> str:
        from pyarrow import fs

        folder = self._root + (f"/{varying[0]}={varying[1]}" if varying else "")
        found = self._fs.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        names = sorted(
            f.path for f in found if f.is_file and not f.base_name.startswith(("_", "."))
        )
        parts = []
        for name in names:
            with self._fs.open_input_stream(name) as stream:
                parts.append(stream.read().decode("utf-8"))
        return "".join(parts) if parts else "null"  # past the end of the feed


TRANSPORTS = {"http": HttpPages, "files": StoredPages}


class PageRange(InputPartition):
    """Numbered pages that one task requests."""

    def __init__(self, pages: range):
        self.pages = pages


class PageStride(InputPartition):
    """Every ``step``-th page from ``first`` on, up to the first without records."""

    def __init__(self, first: int, step: int):
        self.pages = itertools.count(first, step)


class CursorChain(InputPartition):
    """One chain of pages, from its first cursor (None: the feed's own start)."""

    def __init__(self, chain: int, cursor: Any):
        self.chain = chain
        self.cursor = cursor


class PagedRestReader(DataSourceReader):
    """Turns a request description into pages: ``chain, page, body, error``."""

    def __init__(self, request: Mapping[str, Any]):
        self.request = request

    def partitions(self) -> list[InputPartition]:
        r = self.request
        if r["strategy"] == "page":
            first, count = r["start_page"], r["max_pages"]
            if count is None:
                tasks = r["num_partitions"] or 1
                return [PageStride(first + i, tasks) for i in range(tasks)]
            tasks = min(count, r["num_partitions"] or count)
            cuts = [first + count * i // tasks for i in range(tasks + 1)] if tasks else []
            return [PageRange(range(a, b)) for a, b in zip(cuts, cuts[1:])]
        return [CursorChain(i, c) for i, c in enumerate(r["start_cursors"] or [None])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        pages = TRANSPORTS[self.request["transport"]](self.request)
        if isinstance(partition, CursorChain):
            return self._chained(pages, partition)
        return self._numbered(pages, partition.pages, isinstance(partition, PageStride))

    def _numbered(self, pages: Any, numbers: Iterable[int], to_end: bool) -> Iterator[tuple]:
        """Pages of a task; without a limit, up to one that has no records or cannot be read."""
        r = self.request
        for number in numbers:
            try:
                step = (r["page_param"], number)
                body = pages.get({**r["params"], step[0]: number}, step)
                found = dig(json.loads(body), r["data_path"])
            except Exception as err:
                if r["on_page_error"] == "fail":
                    raise RuntimeError(f"page {number}: {err}") from err
                yield 0, number, None, f"{type(err).__name__}: {err}"
                if to_end:
                    return
                continue
            if found:
                yield 0, number, body, None
            elif to_end:
                return

    def _chained(self, pages: Any, part: CursorChain) -> Iterator[tuple]:
        """Pages of a chain to its end; where ``max_pages`` cuts it, the next one counts as unread."""
        r = self.request
        cursor = part.cursor
        for number in itertools.count():
            if number == r["max_pages"]:
                yield part.chain, number, None, f"max_pages: the feed goes on at {cursor}"
                return
            step = {}
            if cursor:
                step = cursor if isinstance(cursor, dict) else {r["cursor_param"]: cursor}
            varying = next(iter(step.items()), None)
            body = pages.get({**r["params"], **step}, varying)
            answer = json.loads(body)
            if not dig(answer, r["data_path"]):
                return
            yield part.chain, number, body, None
            paged = r["strategy"] == "cursor" and r["cursor_path"]
            cursor = dig(answer, r["cursor_path"]) if paged else None
            if not cursor:
                return


class PagedRest(DataSource):
    """Spark data source of REST pages; its one option is the request as JSON."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "chain int, page int, body string, error string"

    def reader(self, schema: Any) -> PagedRestReader:
        return PagedRestReader(json.loads(self.options["request"]))


def request_of(source: SourceSpec, env: Mapping[str, str] | None = None) -> dict[str, Any]:
    """The spec's request with every default filled in and the login turned into its header."""
    o = source.options
    env = os.environ if env is None else env
    paging = o.get("pagination", {})
    strategy = paging.get("strategy", "single").lower()
    if strategy not in STRATEGIES:
        raise SpecError(f"pagination.strategy must be one of {', '.join(STRATEGIES)}")
    if not o.get("url"):
        raise SpecError("source_config.url is missing")
    if strategy == "cursor" and not paging.get("cursor_param"):
        raise SpecError("pagination.cursor_param is missing")

    headers = dict(o.get("headers", {}))
    auth = o.get("auth", {})
    secret = env.get(auth.get("token_env_var", ""), auth.get("token"))
    login = AUTH_HEADERS.get(auth.get("type", "").lower())
    if secret and login:
        headers[login[0]] = login[1].format(secret)
    return {
        "url": o["url"],
        "transport": o.get("transport", "http"),
        "params": dict(o.get("params", {})),
        "headers": headers,
        "verify_ssl": bool(o.get("verify_ssl", True)),
        "data_path": o.get("data_path", ""),
        "on_page_error": o.get("on_page_error", "fail"),
        "strategy": strategy,
        "page_param": paging.get("page_param", "page"),
        "start_page": int(paging.get("start_page", 1)),
        "max_pages": int(paging["max_pages"]) if "max_pages" in paging else None,
        "num_partitions": int(paging.get("num_partitions", 0)),
        "cursor_param": paging.get("cursor_param"),
        "cursor_path": paging.get("cursor_path", ""),
        "start_cursors": list(paging.get("start_cursors", ())),
    }


def fetch_pages(spark: SparkSession, request: Mapping[str, Any]) -> DataFrame:
    """The pages as rows. Every action on the result requests them again."""
    import sys

    # Executors get the classes themselves and need no copy of this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(PagedRest)
    return spark.read.format(FORMAT).option("request", json.dumps(request)).load()


@register("api", "rest")
def read_rest(spark: SparkSession, source: SourceSpec, context: ReadContext) -> DataFrame:
    """The records of a feed, one row each, with the schema inferred over all pages or given."""
    request = request_of(source)
    request["num_partitions"] = request["num_partitions"] or spark.sparkContext.defaultParallelism
    folder = scratch_dir(spark, "records")
    context.scratch.append(folder)
    seen = Observation()
    pages = fetch_pages(spark, request).select("error", "body")
    records = json_records(pages, "body", request["data_path"], "value").observe(
        seen, F.count("error").alias("errors"), F.count("value").alias("rows")
    )
    records.select("value").filter("value IS NOT NULL").write.text(folder)
    context.page_errors += seen.get.get("errors", 0)
    if seen.get.get("errors"):
        warnings.warn(f"{seen.get['errors']} pages could not be read", stacklevel=2)
    if not seen.get.get("rows"):
        raise ValueError("the source returned no records")
    reader = spark.read
    if source.options.get("schema"):
        reader = reader.schema(source.options["schema"])
    return reader.json(folder)

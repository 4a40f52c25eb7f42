"""One query per operator, each over whole tables of a test folder."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import synth
from sluice.catalog import feeds
from sluice.functions import json_records
from sluice.operators import filters, merge, quality, reports, rules
from sluice.plans.audit import append_audit, read_audit
from sluice.plans.job import run_all, run_job
from sluice.plans.table import Table
from sluice.runtime import Folder, scratch_dir
from sluice.sources import read_source, register
from sluice.spec import Rule, SourceSpec, parse_spec
from sluice.streaming import upsert as streaming

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CLOCK = dt.datetime(2025, 6, 1)
RUN = "run-1"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_source(spark, SourceSpec("parquet", {"path": f"{sf}/{name}.parquet"}))


def spec_of(sf: str, table: str, path: str, target: dict | None = None, **more) -> dict:
    """A job document that reads one of the test tables."""
    return {
        "job_name": table,
        "source_type": "parquet",
        "source_config": {"path": f"{sf}/{table}.parquet"},
        "target": {"path": path, **(target or {})},
        **more,
    }


def ntz(*names: str) -> list:
    return [F.col(n).cast("timestamp_ntz").alias(n) for n in names]


# -- sources ---------------------------------------------------------------------


@query
def scan_parquet(spark, sf):
    return load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")


@query
def scan_csv_inferred(spark, sf):
    path = scratch_dir(spark, "csv")
    load(spark, sf, "customer").write.option("header", "true").csv(path)
    rows = read_source(spark, SourceSpec("sftp", {"file_path": path}, ingest_method="addFile"))
    return rules.cast_type(rows, ["c_custkey"], "bigint")


@query
def scan_csv_declared(spark, sf):
    path = scratch_dir(spark, "csv")
    orders = load(spark, sf, "orders")
    orders.write.option("header", "true").csv(path)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in orders.schema)
    return read_source(spark, SourceSpec("csv", {"path": path, "schema": schema}))


@query
def csv_bounded_by_timestamp(spark, sf):
    """A load from CSV without declared types, bounded by a timestamp that its text shows."""
    path, target = scratch_dir(spark, "csv"), scratch_dir(spark, "table")
    whole = {"header": "true", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    load(spark, sf, "events").write.options(**whole).csv(path)
    spec = parse_spec({
        "job_name": "events", "source_type": "csv", "source_config": {"path": path},
        "ingestion_type": "incremental", "incremental_column": "ts",
        "last_ingestion_value": "2024-01-15 00:00:00",
        "target": {"path": target, "primary_key": "event_id"},
    })
    run_job(spark, spec, scratch_dir(spark, "audit"), run_id=RUN, clock=CLOCK)
    return Table(spark, target).read().select(
        F.col("event_id").cast("bigint").alias("event_id"), *ntz("ts"), "event_type", "value", "_ingestion_id"
    )


@query
def scan_json_pages(spark, sf):
    """Pages of many records each, their types taken from the records themselves in one read."""
    path = scratch_dir(spark, "json")
    chat = load(spark, sf, "conversations")
    page = F.to_json(F.collect_list(F.struct(*chat.columns)))
    chat.groupBy("conv_id").agg(page.alias("value")).select("value").write.text(path)
    return read_source(spark, SourceSpec("json", {"path": path})).select(*chat.columns)


@query
def scan_nested_documents(spark, sf):
    path = scratch_dir(spark, "documents")
    load(spark, sf, "lineitem").select(
        F.struct(F.col("l_orderkey").alias("id")).alias("order"),
        F.array(F.struct(F.col("l_quantity").alias("qty"))).alias("lines"),
    ).write.json(path)
    docs = read_source(spark, SourceSpec("json", {"path": path}))
    lines = docs.select(F.col("order.id").alias("order_id"), F.inline("lines"))
    return lines.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("qty").cast("bigint")).alias("qty")
    )


@query
def rest_page_scan(spark, sf):
    chat = load(spark, sf, "conversations")
    url, _ = feeds.numbered_pages(chat, F.struct(*chat.columns), 100)
    feed = {
        "url": url,
        "transport": "files",
        "data_path": "result.data",
        "pagination": {"strategy": "page", "page_param": "page"},
    }
    return read_source(spark, SourceSpec("api", feed)).select(*chat.columns)


@query
def rest_cursor_scan(spark, sf):
    pages = load(spark, sf, "pages").select("page_id", "url", "html")
    url, starts, _ = feeds.chained_pages(pages, F.struct(*pages.columns), 50)
    feed = {
        "url": url,
        "transport": "files",
        "data_path": "items",
        "pagination": {"strategy": "cursor", "cursor_param": "cursor", "cursor_path": "paging.next",
                       "start_cursors": starts},
    }
    return read_source(spark, SourceSpec("api", feed)).select(*pages.columns)


@query
def extract_records_by_path(spark, sf):
    body = F.concat(F.lit('{"result":{"data":['), F.col("props"), F.lit("]}}"))
    bodies = load(spark, sf, "events").select("event_id", body.alias("body"))
    records = json_records(bodies, "body", "result.data", "record")
    return records.select("event_id", F.from_json("record", "k bigint").getField("k").alias("k"))


@query
def extension_source(spark, sf):
    @register("price_list")
    def read_price_list(session, source, context):
        return session.read.parquet(source.options["path"]).select("p_partkey", "p_retailprice")

    return read_source(spark, SourceSpec("Price_List", {"path": f"{sf}/part.parquet"}))


# -- bounds ----------------------------------------------------------------------


@query
def incremental_numeric(spark, sf):
    return filters.newer_than(load(spark, sf, "orders"), "o_orderkey", "599").select(
        "o_orderkey", "o_custkey"
    )


@query
def incremental_timestamp(spark, sf):
    return filters.newer_than(load(spark, sf, "events"), "ts", "2024-01-15 00:00:00").select(
        "event_id", "ts"
    )


@query
def incremental_string(spark, sf):
    return filters.newer_than(load(spark, sf, "customer"), "c_name", "Customer#000000090").select(
        "c_custkey", "c_name"
    )


@query
def full_load(spark, sf):
    spec = parse_spec(spec_of(sf, "events", "unused", ingestion_type="incremental",
                              incremental_column="ts"))
    return filters.incremental(read_source(spark, spec), spec).select("event_id", "user_id")


@query
def next_watermark(spark, sf):
    newer = filters.newer_than(load(spark, sf, "events"), "ts", "2024-01-15 00:00:00")
    return filters.next_bound(newer, "ts", "events")


# -- metadata and rules ----------------------------------------------------------


@query
def enrich_metadata(spark, sf):
    rows = load(spark, sf, "orders").select("o_orderkey")
    rows = rules.with_run_metadata(rows, RUN, "full", "parquet", CLOCK)
    return rows.withColumns({"_ingested_at": F.col("_ingested_at").cast("timestamp_ntz")})


def labelled(spark, sf):
    """Documents with their labels, which only some of them have."""
    return load(spark, sf, "documents").select("doc_id").join(load(spark, sf, "labels"), "doc_id", "left")


@query
def fill_na_numeric(spark, sf):
    return rules.fill_na(labelled(spark, sf), ["quality", "toxic", "absent"], 0)


@query
def fill_na_string(spark, sf):
    named = labelled(spark, sf).select(
        "doc_id", F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor").alias("label")
    )
    return rules.fill_na(named, ["label"], "unknown")


@query
def upper_case(spark, sf):
    return rules.upper_case(load(spark, sf, "events"), ["event_type", "absent"]).select(
        "event_id", "event_type"
    )


@query
def cast_type(spark, sf):
    rows = load(spark, sf, "events").select("event_id", "user_id", "value")
    return rules.cast_type(rules.cast_type(rows, ["user_id"], "string"), ["value"], "int")


@query
def try_cast_nulls(spark, sf):
    rows = load(spark, sf, "customer").select(
        "c_custkey", "c_name", F.substring_index("c_name", "#", -1).alias("c_number")
    )
    return rules.cast_type(rows, ["c_name", "c_number"], "bigint")


@query
def add_ingestion_timestamp(spark, sf):
    rows = rules.add_ingestion_timestamp(load(spark, sf, "orders").select("o_orderkey"), CLOCK)
    return rows.select("o_orderkey", *ntz("ingested_at"))


@query
def rule_chain(spark, sf):
    chain = [
        Rule("upper_case", ("p_name", "p_type", "category")),
        Rule("cast_type", ("p_size",), data_type="double"),
        Rule("fill_na", ("p_size",), 0.0),
    ]
    rows = load(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_size")
    return rules.apply_rules(rows, chain, CLOCK)


@query
def ingest_date_partition(spark, sf):
    rows = load(spark, sf, "events").withColumnRenamed("ts", "_ingested_at")
    rows, by = rules.with_ingest_date(rows, ())
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def nested_events(spark, sf):
    props = F.from_json("props", "k bigint")
    data = F.struct(F.col("event_id").alias("id"), props.getField("k").alias("k"))
    return load(spark, sf, "events").select(data.alias("data"), "event_type", "user_id")


@query
def flatten_nested_key(spark, sf):
    rows, key = rules.flat_key(nested_events(spark, sf), "data.id")
    return rows.select(key, F.col("data.k").alias("k"))


@query
def array_to_strings(spark, sf):
    words = F.transform(F.split("text", " "), F.length)
    rows = load(spark, sf, "documents").select("doc_id", words.alias("images"))
    rows = rules.strings_in_arrays(rows, ["images", "absent"])
    return rows.select("doc_id", F.array_join("images", ",").alias("images"))


@query
def struct_null_normalise(spark, sf):
    both = F.when(F.col("quality").isNotNull(), F.struct("quality", "toxic"))
    rows = labelled(spark, sf).select("doc_id", both.alias("vehicle"))
    rows = rules.rebuilt_structs(rows, ["vehicle"])
    return rows.select("doc_id", "vehicle.quality", F.col("vehicle").isNull().alias("missing"))


@query
def project_nested(spark, sf):
    return rules.project(
        nested_events(spark, sf), {"event_id": "data.id", "kind": "event_type", "author": "user_id"}
    )


# -- writes ----------------------------------------------------------------------

ORDER_COLUMNS = ["o_orderkey", "o_orderstatus", "o_totalprice"]


@query
def append_write(spark, sf):
    orders = load(spark, sf, "orders").select(*ORDER_COLUMNS)
    table = Table(spark, scratch_dir(spark, "table"))
    table.append(orders, ["o_orderstatus"])
    table.append(orders.filter("o_orderstatus = 'F'"))
    return table.read()


@query
def append_plain_files(spark, sf):
    target = scratch_dir(spark, "files")
    spec = parse_spec(spec_of(sf, "customer", target, target={
        "format": "parquet", "primary_key": "c_custkey", "partition_by": ["c_mktsegment"]}))
    for _ in range(2):
        run_job(spark, spec, scratch_dir(spark, "audit"), run_id=RUN, clock=CLOCK)
    return spark.read.parquet(target).select("c_custkey", "c_mktsegment", "_ingestion_id")


@query
def overwrite_write(spark, sf):
    orders = load(spark, sf, "orders").select(*ORDER_COLUMNS)
    table = Table(spark, scratch_dir(spark, "table"))
    table.append(orders.filter("o_orderstatus = 'F'"))
    table.overwrite(orders)
    return table.read()


@query
def schema_merge_append(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    table = Table(spark, scratch_dir(spark, "table"))
    table.append(orders.filter("o_orderdate < '1998-01-01'").drop("o_orderpriority"))
    table.append(orders.filter("o_orderdate >= '1998-01-01'"))
    return table.read()


@query
def union_by_name(spark, sf):
    customers = load(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"), "c_mktsegment"
    )
    suppliers = load(spark, sf, "supplier").select(
        F.col("s_acctbal").alias("acctbal"), F.col("s_name").alias("name"), "s_nationkey"
    )
    return merge.append_rows(customers, suppliers)


def old_orders(spark, sf):
    """What an earlier load left: orders up to 1998."""
    return load(spark, sf, "orders").filter("o_orderdate < '1999-01-01'")


def new_orders(spark, sf):
    """What the source holds now: orders from 1997 on, changed since."""
    return load(spark, sf, "orders").filter("o_orderdate >= '1997-01-01'").withColumns(
        {"o_orderstatus": F.lit("U"), "o_totalprice": F.col("o_totalprice") + 1}
    )


@query
def merge_upsert(spark, sf):
    return merge.upsert_rows(
        old_orders(spark, sf).select(*ORDER_COLUMNS),
        new_orders(spark, sf).select(*ORDER_COLUMNS),
        "o_orderkey",
        unique=True,
    )


@query
def merge_repeated_keys(spark, sf):
    """A target whose keys repeat: every line of an order takes the order's new status."""
    lines = load(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", F.col("l_linestatus").alias("o_orderstatus")
    )
    return merge.upsert_rows(lines, new_orders(spark, sf).select("o_orderkey", "o_orderstatus"), "o_orderkey")


@query
def merge_by_anti_union(spark, sf):
    return merge.replace_rows(
        old_orders(spark, sf).select(*ORDER_COLUMNS),
        new_orders(spark, sf).select(*ORDER_COLUMNS),
        "o_orderkey",
    )


@query
def merge_schema_evolution(spark, sf):
    status = F.when(F.col("o_orderpriority") == "5-LOW", None).otherwise(F.lit("U"))
    batch = new_orders(spark, sf).select(
        "o_orderkey", status.alias("o_orderstatus"), F.col("o_orderpriority").alias("extra")
    )
    return merge.upsert_rows(
        old_orders(spark, sf).select(*ORDER_COLUMNS), batch, "o_orderkey", unique=True
    )


@query
def merge_null_key(spark, sf):
    labels = load(spark, sf, "labels").select(F.col("doc_id").alias("k"))
    docs = load(spark, sf, "documents").select("doc_id", "lang")
    rows = docs.join(labels, F.col("doc_id") == F.col("k"), "left").select("k", "doc_id", "lang")
    return merge.upsert_rows(
        rows.select("k", F.concat(F.lit("old-"), "lang").alias("v")),
        rows.select("k", F.concat(F.lit("new-"), "lang").alias("v")),
        "k",
    )


@query
def merge_first_load(spark, sf):
    table = Table(spark, scratch_dir(spark, "table"))
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    table.upsert(lines, "l_orderkey", ["l_returnflag"], dedupe="none")
    return table.read()


@query
def upsert_partitioned_table(spark, sf):
    year = F.year("o_orderdate").alias("y")
    table = Table(spark, scratch_dir(spark, "table"))
    table.upsert(old_orders(spark, sf).select(*ORDER_COLUMNS, year), "o_orderkey", ["y"])
    table.upsert(new_orders(spark, sf).select(*ORDER_COLUMNS, year), "o_orderkey")
    return table.read()


@query
def upsert_evolving_table(spark, sf):
    table = Table(spark, scratch_dir(spark, "table"))
    table.upsert(old_orders(spark, sf).select(*ORDER_COLUMNS), "o_orderkey")
    table.upsert(
        new_orders(spark, sf).select("o_orderkey", "o_orderstatus", "o_orderpriority"), "o_orderkey"
    )
    return table.read()


@query
def dedupe_latest(spark, sf):
    latest = merge.dedupe_batch(load(spark, sf, "events"), "user_id", "latest", ["ts", "event_id"])
    return latest.select("user_id", "event_id", "event_type")


# -- quality and reports ---------------------------------------------------------


@query
def row_count(spark, sf):
    return load(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("total"))


@query
def reconcile_counts(spark, sf):
    events = load(spark, sf, "events")
    landed = events.withColumn("_ingestion_id", F.lit(RUN))
    partly = events.withColumn(
        "_ingestion_id", F.when(F.col("event_type") == "error", "run-0").otherwise(RUN)
    )
    newest = events.agg(F.max("ts").alias("ts"))
    cases = {
        "match": (events, landed),
        "short": (events, partly),
        "single_row": (newest, newest.withColumn("_ingestion_id", F.lit(RUN))),
        "no_target": (events, None),
    }
    rows = [
        quality.reconcile(source, table, RUN).withColumn("scenario", F.lit(name))
        for name, (source, table) in cases.items()
    ]
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    return out


@query
def duplicate_keys(spark, sf):
    return quality.duplicate_keys(load(spark, sf, "lineitem"), "l_orderkey")


@query
def duplicate_rate(spark, sf):
    return quality.duplicate_rate(load(spark, sf, "lineitem"), "l_orderkey")


@query
def duplicate_texts(spark, sf):
    """A wide key: whole texts that occur more than once, by number of occurrences and length."""
    found = quality.duplicate_keys(load(spark, sf, "documents"), "text")
    return found.select(F.length("text").cast("bigint").alias("n_chars"), "n").groupBy("n_chars", "n").agg(
        F.count(F.lit(1)).alias("texts")
    )


@query
def duplicate_text_rate(spark, sf):
    return quality.duplicate_rate(load(spark, sf, "documents"), "text")


@query
def count_by_type(spark, sf):
    return quality.count_by(load(spark, sf, "events"), "event_type")


def event_log(spark, sf):
    """Events read as audit rows: the id stands for the row count, the value for the duration."""
    kind = F.when(F.col("event_type").isin("view", "click"), "FULL").otherwise("INCREMENTAL")
    return load(spark, sf, "events").select(
        F.col("ts"),
        F.concat(F.lit("user-"), "user_id").alias("job_name"),
        kind.alias("ingestion_type"),
        F.lit("SUCCESS").alias("status"),
        F.col("event_id").alias("source_count"),
        F.col("value").alias("duration"),
    )


@query
def audit_append(spark, sf):
    path = scratch_dir(spark, "audit")
    rows = event_log(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    append_audit(rows.filter("ingestion_type = 'FULL'"), path)
    append_audit(rows.filter("ingestion_type = 'INCREMENTAL'"), path)
    return read_audit(spark, path).select(
        "job_name", "ingestion_type", "source_count", "target_count", *ntz("ts")
    )


@query
def audit_throughput(spark, sf):
    return reports.throughput(event_log(spark, sf))


@query
def compare_load_types(spark, sf):
    return reports.compare_load_types(event_log(spark, sf))


@query
def scenario_timings(spark, sf):
    return reports.scenario_timings(event_log(spark, sf))


@query
def latest_n(spark, sf):
    return reports.latest_n(load(spark, sf, "events").select("event_id", "ts"), ["ts", "event_id"], 10)


@query
def describe_schema(spark, sf):
    return reports.describe(load(spark, sf, "lineitem")).select("pos", "name", "type", "total_records")


# -- maintenance -----------------------------------------------------------------


@query
def compact_table(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    table = Table(spark, scratch_dir(spark, "table"))
    for priority in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"):
        table.append(orders.filter(F.col("o_orderpriority") == priority), ["o_orderstatus"])
    table.compact()
    return table.read()


@query
def expire_snapshots(spark, sf):
    orders = load(spark, sf, "orders").select(*ORDER_COLUMNS)
    table = Table(spark, scratch_dir(spark, "table"))
    table.overwrite(orders.filter("o_orderstatus = 'F'"), clock=CLOCK)
    table.overwrite(orders, clock=CLOCK + dt.timedelta(days=8))
    table.append(orders.filter("o_orderstatus = 'F'"), clock=CLOCK + dt.timedelta(days=9))
    table.expire(clock=CLOCK + dt.timedelta(days=10))
    return table.read()


# -- streaming and made-up rows --------------------------------------------------


@query
def stream_upsert(spark, sf):
    """Files in no order of time, one per micro-batch: late rows do not undo newer ones."""
    target, checkpoint, landing = (scratch_dir(spark, n) for n in ("table", "stream", "landing"))
    load(spark, sf, "events").repartition(3, "event_id").write.parquet(landing)
    rows = streaming.stream_files(spark, "parquet", landing, files_per_batch=1)
    streaming.stream_upsert(
        rows, target, "user_id", ["ts", "event_id"], checkpoint
    ).awaitTermination()
    return Table(spark, target).read().select("user_id", "event_id", "event_type")


@query
def stream_reconciled(spark, sf):
    """A streamed job's audit rows: what each micro-batch read, sent and landed, and its last bound."""
    target, checkpoint, landing, audit = (
        scratch_dir(spark, n) for n in ("table", "stream", "landing", "audit")
    )
    events = load(spark, sf, "events")
    for share in ("ts < '2024-01-10'", "ts >= '2024-01-10' AND ts < '2024-01-20'", "ts >= '2024-01-20'"):
        events.filter(share).coalesce(1).write.mode("append").parquet(landing)
    spec = parse_spec({
        "job_name": "events", "source_type": "parquet", "incremental_column": "ts",
        "source_config": {"path": landing, "files_per_batch": 1},
        "target": {"path": target, "primary_key": "user_id", "order_by": ["ts", "event_id"]},
    })
    streaming.stream_job(spark, spec, checkpoint, clock=CLOCK, audit_path=audit).awaitTermination()
    return read_audit(spark, audit, "events").select(
        "ingestion_id", "ingestion_type", "status", "read_count", "source_count", "target_count",
        F.col("next_value").cast("timestamp_ntz").alias("next_value"),
    )


@query
def synth_bench_rows(spark, sf):
    ids = load(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))
    return synth.benchmark_columns(ids)


def feed_ids(spark, sf):
    return load(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), "o_orderdate")


@query
def synth_orders(spark, sf):
    return synth.feed_orders(feed_ids(spark, sf), F.col("o_orderdate"))


@query
def synth_users(spark, sf):
    return synth.feed_users(feed_ids(spark, sf))


@query
def synth_products(spark, sf):
    return synth.feed_products(feed_ids(spark, sf), F.col("o_orderdate"))


# -- whole jobs ------------------------------------------------------------------


@query
def job_end_to_end(spark, sf):
    """Two bounded loads into one keyed table: rows are kept, updated and inserted."""
    target, audit = scratch_dir(spark, "table"), scratch_dir(spark, "audit")
    bounds = {"run-0": ("o_orderdate", "1997-01-01 00:00:00"), "run-1": ("o_totalprice", "250000")}
    for run_id, (column, bound) in bounds.items():
        spec = spec_of(sf, "orders", target, ingestion_type="incremental",
                       incremental_column=column, last_ingestion_value=bound,
                       target={"primary_key": "o_orderkey", "transformations": [
                           {"type": "upper_case", "columns": ["o_orderpriority"]},
                           {"type": "cast_type", "columns": ["o_custkey"], "data_type": "string"},
                           {"type": "add_ingestion_timestamp"}]})
        run_job(spark, parse_spec(spec), audit, run_id=run_id, clock=CLOCK)
    return Table(spark, target).read().select(
        "o_orderkey", "o_custkey", "o_orderpriority", "_ingestion_id", "_ingestion_type",
        "_ingest_date", *ntz("ingested_at"),
    )


@query
def job_resumes_at_watermark(spark, sf):
    """The second run starts where the audit log says the first one ended."""
    landing, target, audit = (scratch_dir(spark, n) for n in ("landing", "table", "audit"))
    events = load(spark, sf, "events")
    spec = parse_spec({
        "job_name": "events", "source_type": "parquet", "ingestion_type": "incremental",
        "incremental_column": "ts", "source_config": {"path": landing},
        "target": {"path": target},
    })
    events.filter("ts < '2024-01-20'").write.parquet(landing)
    run_job(spark, spec, audit, resume=True, run_id="run-0", clock=CLOCK)
    events.filter("ts >= '2024-01-20'").write.mode("append").parquet(landing)
    run_job(spark, spec, audit, resume=True, run_id="run-1", clock=CLOCK + dt.timedelta(hours=1))
    return Table(spark, target).read().select("event_id", "_ingestion_id")


@query
def job_replays_without_key(spark, sf):
    """Three resumed runs of a load without a key, the second failing after its write, a day apart.

    The third is the same load as the second and takes its place, on a table and on plain files.
    """
    events = load(spark, sf, "events")
    shares = "ts < '2024-01-10'", "ts >= '2024-01-10' AND ts < '2024-01-20'", "ts >= '2024-01-20'"
    out = None
    for fmt in ("snapshot", "parquet"):
        landing, target, audit = (scratch_dir(spark, n) for n in ("landing", "table", "audit"))
        doc = {
            "job_name": "events", "source_type": "parquet", "ingestion_type": "incremental",
            "incremental_column": "ts", "source_config": {"path": landing},
            "target": {"path": target, "format": fmt, "partition_by": ["event_type"]},
        }
        for n, share in enumerate(shares):
            events.filter(share).write.mode("append").parquet(landing)
            # More rows asked for than there are: the run fails when its rows have landed.
            wanted = {"min_rows": 10**12} if n == 1 else {}
            run_job(spark, parse_spec(doc | wanted), audit, resume=True, run_id=f"run-{n}",
                    clock=CLOCK + dt.timedelta(days=n))
        rows = Table(spark, target).read() if fmt == "snapshot" else spark.read.parquet(target)
        rows = rows.select(F.lit(fmt).alias("format"), "event_id", "_ingestion_id", "_ingest_date")
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def job_takes_late_rows(spark, sf):
    """Loads bounded by a day, with many rows at each bound, some of them late, some twice.

    The second run fails after its write and is run again; every row of the landing folder arrives
    once, on a table and on plain files.
    """
    events = load(spark, sf, "events").select(
        "event_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), "event_type", "ts"
    )
    twice = events.unionByName(events.filter("event_type = 'error'"))
    shares = "ts < '2024-01-10 12:00:00'", "ts >= '2024-01-10 12:00:00' AND ts < '2024-01-20 12:00:00'", "ts >= '2024-01-20 12:00:00'"
    out = None
    for fmt in ("snapshot", "parquet"):
        landing, target, audit = (scratch_dir(spark, n) for n in ("landing", "table", "audit"))
        doc = {
            "job_name": "events", "source_type": "parquet", "ingestion_type": "incremental",
            "incremental_column": "day", "late_rows": True, "source_config": {"path": landing},
            "target": {"path": target, "format": fmt},
        }
        for n, share in enumerate(shares):
            twice.filter(share).write.mode("append").parquet(landing)
            wanted = {"min_rows": 10**12} if n == 1 else {}
            run_job(spark, parse_spec(doc | wanted), audit, resume=True, run_id=f"run-{n}",
                    clock=CLOCK + dt.timedelta(days=n))
        rows = Table(spark, target).read() if fmt == "snapshot" else spark.read.parquet(target)
        rows = rows.select(F.lit(fmt).alias("format"), "event_id", "day", "_ingestion_id")
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def job_from_rest(spark, sf):
    """A feed of nested records: arrays and structs normalised, the key taken from inside."""
    record = F.struct(
        F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("title")).alias("data"),
        F.array(F.struct(F.col("user_id").alias("user"))).alias("eventLogs"),
        F.when(F.col("event_type") != "error", F.struct(F.col("event_type").alias("plate"))).alias("vehicle"),
    )
    url, _ = feeds.numbered_pages(load(spark, sf, "events"), record, 500)
    target = scratch_dir(spark, "table")
    spec = parse_spec({
        "job_name": "feed", "source_type": "api",
        "source_config": {
            "url": url, "transport": "files", "data_path": "result.data",
            "pagination": {"strategy": "page"}},
        "target": {"path": target, "primary_key": "data.id"},
    })
    run_job(spark, spec, scratch_dir(spark, "audit"), run_id=RUN, clock=CLOCK)
    return Table(spark, target).read().select(
        "data_id", "data.title", F.col("eventLogs")[0].alias("log"), F.col("vehicle.plate").alias("plate"),
        "_source_name",
    )


@query
def run_all_report(spark, sf):
    """Every spec of a folder, one audit row each."""
    specs = Folder(spark, scratch_dir(spark, "specs"))
    tables = {"customer": "c_custkey", "orders": "o_orderkey", "events": "event_id", "lineitem": None}
    for name, key in tables.items():
        target = scratch_dir(spark, name)
        doc = spec_of(sf, name, target, target={"primary_key": key} if key else {})
        specs.write_new(f"{name}.json", json.dumps(doc))
    audit = scratch_dir(spark, "audit")
    run_all(spark, specs.path, audit, clock=CLOCK)
    return read_audit(spark, audit).select("job_name", "source_count", "target_count", "status")

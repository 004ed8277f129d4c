"""Registered queries: each operator over the given tables, with the SQL that must give the same rows.

The tables have no telematics, so they are packed into pages, runs, units and rosters first; timestamps are compared as
whole microseconds.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadlake import catalog, pipelines
from roadlake.functions import scalars as S
from roadlake.operators import aggregates, audit, decode, filters, rosters, sets, typing
from roadlake.plans import bisection, drive, requests, windows
from roadlake.schema import parse
from roadlake.sources import current, scans, versions, writers
from roadlake.staging import compiled, shared_dir, staged
from roadlake.streaming import feed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
START, END = datetime(2024, 1, 8), datetime(2024, 1, 15)


def query(sql: str | None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its times without zone are taken as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    compiled(spark)
    found = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return found.select(*[F.col(n).cast("timestamp").alias(n) if t == "timestamp_ntz" else F.col(n) for n, t in found.dtypes])


def us(name: str, alias: str | None = None) -> Column:
    return F.unix_micros(F.col(name)).alias(alias or f"{name}_us")


def iso(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def packed(rows: DataFrame, key: Column, record: Column, wrap: Callable[[Column], Column], sent: Column | None = None, limit: int = 100) -> DataFrame:
    """Rows as landed pages: those of one key are one page, which holds a bounded number of records."""
    groups = rows.groupBy(key.alias("page_seq")).agg(F.collect_list(record).alias("items"), *([F.first(sent).alias("sent_params")] if sent is not None else []))
    sent_params = F.col("sent_params") if sent is not None else F.lit(None).cast("map<string,string>")
    return groups.select(F.lit("p").alias("provider"), F.lit("e").alias("endpoint"), F.lit("c").alias("chain_id"), F.col("page_seq").cast("int").alias("page_seq"), sent_params.alias("sent_params"), F.lit(limit).alias("results_limit"), F.to_json(wrap(F.col("items"))).alias("body"))


EVENT = parse("events", "eventId BIGINT !\nts TIMESTAMP !\nuser.id BIGINT ! as user_id\neventType STRING !\nvalue DOUBLE -")


def event_record() -> Column:
    return F.struct(F.col("event_id").alias("eventId"), iso("ts").alias("ts"), F.struct(F.col("user_id").cast("string").alias("id")).alias("user"), F.concat(F.lit("  "), F.col("event_type"), F.lit(" ")).alias("eventType"), F.col("value"))


def event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "events"), F.floor(F.col("event_id") / 100), event_record(), lambda x: F.struct(x.alias("data")))


@query("SELECT event_id, epoch_us(ts) AS ts_us, user_id, event_type, value FROM events")
def decode_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-level list, flattening, coercion of quoted numbers, stripping."""
    rows = typing.valid(typing.typed(decode.records(event_pages(spark, sf_dir), decode.Decode(("data",))), EVENT))
    return rows.select("event_id", us("ts"), "user_id", "event_type", "value")


@query("SELECT o_orderkey AS order_key, o_custkey AS cust_key, o_orderstatus AS status, o_totalprice AS total, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS priority FROM orders")
def decode_wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wrapped list; empty text becomes null; snake_case keys are taken beside camelCase ones."""
    orders = table(spark, sf_dir, "orders")
    record = F.struct(F.struct(F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("custKey"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total"), F.when(F.col("o_orderstatus") == "F", "  ").otherwise(F.col("o_orderpriority")).alias("priority"), F.lit("x").alias("unknown")).alias("order"))
    pages = packed(orders, F.floor(F.col("o_orderkey") / 100), record, lambda x: F.struct(x.alias("orders")))
    schema = parse("orders", "orderKey BIGINT !\ncustKey BIGINT !\nstatus STRING !\ntotal DOUBLE !\npriority STRING -")
    return typing.valid(typing.typed(decode.records(pages, decode.Decode(("orders",), item="order")), schema))


@query("SELECT user_id, epoch_us(date_trunc('day', ts)) AS window_start_us, epoch_us(date_trunc('day', ts) + INTERVAL 1 DAY) AS window_end_us, count(*) AS n FROM events GROUP BY ALL")
def decode_report_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report of daily rollups, each row stamped with the window that was asked for, over what the record itself says."""
    daily = table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    sent = F.create_map(F.lit("start_date"), F.col("day").cast("string"), F.lit("end_date"), F.date_add("day", 1).cast("string"))
    record = F.struct("user_id", "n", F.lit("1999-01-01").alias("windowStartDate"))
    pages = packed(daily, F.datediff("day", F.lit("2020-01-01")) * 64 + F.col("user_id") % 64, record, lambda x: F.struct(F.struct(x.alias("reports")).alias("data")), sent)
    schema = parse("daily", "user_id BIGINT !\nwindowStartDate TIMESTAMP ! datelabel as window_start\nwindowEndDate TIMESTAMP ! datelabel as window_end\nn BIGINT !")
    how = decode.Decode(("data", "reports"), stamps=(("windowStartDate", "start_date"), ("windowEndDate", "end_date")))
    return typing.valid(typing.typed(decode.records(pages, how), schema)).select("user_id", us("window_start"), us("window_end"), "n")


@query("SELECT CAST(user_id AS VARCHAR) AS vehicle_id, 'U' || user_id AS vehicle_name, epoch_us(ts) AS time_us, event_type AS value FROM events")
def series_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A series per user, with the user's identity carried onto each reading; users without readings give no row."""
    events = table(spark, sf_dir, "events")
    chunk = events.groupBy("user_id", F.floor(F.col("event_id") / 5000).alias("part")).agg(F.collect_list(F.struct(iso("ts").alias("time"), F.col("event_type").alias("value"))).alias("engineStates"))
    idle = events.select("user_id").distinct().select("user_id", F.lit(-1).alias("part"), F.array().cast("array<struct<time:string,value:string>>").alias("engineStates"))
    record = F.struct(F.col("user_id").cast("string").alias("id"), F.concat(F.lit("U"), F.col("user_id")).alias("name"), "engineStates")
    pages = packed(chunk.unionByName(idle), F.pmod(F.xxhash64("user_id", "part"), F.lit(1 << 20)), record, lambda x: F.struct(x.alias("data")))
    spec = catalog.CATALOG["samsara.engine_states"]
    return typing.valid(typing.typed(decode.records(pages, spec.decode), spec.schema)).select("vehicle_id", "vehicle_name", us("time"), "value")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def flatten_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.try_parse_json("props")
    return table(spark, sf_dir, "events").select("event_id", S.whole_number(S.get(props, "k")).alias("k"))


@query("SELECT CASE WHEN event_id % 1000 = 0 THEN 'data: missing' ELSE 'data: array expected, found STRING' END AS fault, CAST(count(*) AS BIGINT) AS n FROM events WHERE event_id % 500 = 0 GROUP BY 1")
def envelope_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed envelopes, named by their shape."""
    events = table(spark, sf_dir, "events")
    body = F.when(F.col("event_id") % 1000 == 0, '{"other":[]}').when(F.col("event_id") % 500 == 0, '{"data":"x"}').otherwise('{"data":[{"a":1}]}')
    pages = events.select(F.lit("p").alias("provider"), F.lit("e").alias("endpoint"), F.lit("c").alias("chain_id"), F.col("event_id").alias("page_seq"), body.alias("body"))
    return decode.bad_pages(pages, decode.Decode(("data",))).groupBy("fault").agg(F.count("*").alias("n"))


@query("""SELECT CAST(event_id AS BIGINT) AS event_id, CASE WHEN event_id % 3 = 0 THEN 'ts: no TIMESTAMP' WHEN event_id % 5 = 0 THEN 'eventType: missing' WHEN event_id % 7 = 0 THEN 'value: no BIGINT' END AS error
FROM events WHERE event_id % 3 = 0 OR event_id % 5 = 0 OR event_id % 7 = 0""")
def validation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that are refused: a time without offset, a missing key, a number that would lose its fraction."""
    n = F.col("event_id")
    plain = (n % 3 != 0) & (n % 5 == 0)
    body = F.to_json(F.struct(F.array(F.struct(n.alias("eventId"), F.when(n % 3 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).otherwise(iso("ts")).alias("ts"), F.when(~plain, F.col("event_type")).alias("eventType"), F.when((n % 3 != 0) & (n % 5 != 0) & (n % 7 == 0), 2.5).otherwise(3.0).alias("value"))).alias("data")))
    pages = table(spark, sf_dir, "events").select(F.lit("p").alias("provider"), F.lit("e").alias("endpoint"), F.lit("c").alias("chain_id"), n.alias("page_seq"), F.lit(None).cast("map<string,string>").alias("sent_params"), body.alias("body"))
    schema = parse("strict", "eventId BIGINT !\nts TIMESTAMP !\neventType STRING !\nvalue BIGINT !")
    return typing.quarantined(typing.typed(decode.records(pages, decode.Decode(("data",))), schema)).select("event_id", F.explode("errors").alias("error"))


#: Pages of a hundred events, ten to a chain; every thirteenth page has not landed. {0}: faults; {1}: more pages.
WALK = """WITH p AS (SELECT event_id // 1000 AS chain, CAST((event_id % 1000) // 100 AS INTEGER) AS page_seq, count(*) AS n FROM events GROUP BY ALL),
t AS (SELECT chain, max(page_seq) AS top, sum(n) AS total FROM p GROUP BY 1),
l AS (SELECT chain, page_seq, n, top, total FROM p JOIN t USING (chain) WHERE (chain * 10 + page_seq) % 13 <> 5{1}),
w AS (SELECT CAST(chain AS VARCHAR) AS chain_id, page_seq, top, total, lag(page_seq) OVER c AS before, lead(page_seq) OVER c IS NULL AS last, sum(n) OVER c AS upto FROM l WINDOW c AS (PARTITION BY chain ORDER BY page_seq))
SELECT chain_id, page_seq, fault FROM (SELECT *, CASE {0} END AS fault FROM w) WHERE fault IS NOT NULL"""


def walk_pages(spark: SparkSession, sf_dir: str, body: Callable[[], Column], param: str, sent: Column, limit: Column | None = None, ends: bool = False) -> DataFrame:
    """All events as chains of pages that hold them as records, without those that have not landed. ``body``, ``sent`` and
    ``limit`` are made of items, no (of the page), n (its events), top (the last page's no), total (events of the chain) and
    before_id (of the last event of the page before). ``ends``: with an empty page after the last one."""
    n = F.col("event_id")
    events = table(spark, sf_dir, "events").select(F.floor(n / 1000).alias("chain"), F.floor(n % 1000 / 100).cast("int").alias("no"), n, "value")
    stats = events.groupBy("chain", "no").agg(F.count("*").alias("n"), F.max("event_id").alias("last_id"))
    chain = Window.partitionBy("chain")
    stats = stats.select("chain", "no", "n", F.max("no").over(chain).alias("top"), F.sum("n").over(chain).alias("total"), F.lag("last_id").over(chain.orderBy("no")).alias("before_id"), "last_id")
    items = events.groupBy("chain", "no").agg(F.array_sort(F.collect_list(F.struct(F.lpad(n.cast("string"), 12, "0").alias("id"), "value"))).alias("items"))
    pages = items.join(stats, ["chain", "no"]).where((F.col("chain") * 10 + F.col("no")) % 13 != 5)
    if ends:
        after = stats.where("no = top").select("chain", (F.col("no") + 1).alias("no"), F.lit(0).alias("n"), "top", "total", F.col("last_id").alias("before_id"), F.lit(None).cast("long").alias("last_id"))
        pages = pages.unionByName(after.withColumn("items", F.array().cast(pages.schema["items"].dataType)))
    limits = F.lit(100) if limit is None else limit
    return pages.select(F.lit("p").alias("provider"), F.lit("e").alias("endpoint"), F.col("chain").cast("string").alias("chain_id"), F.col("no").alias("page_seq"), F.create_map(F.lit(param), sent).alias("sent_params"), limits.cast("int").alias("results_limit"), F.to_json(body()).alias("body"))


@query(WALK.format("WHEN page_seq + 1 <> coalesce(before + 1, 0) + 1 THEN 'page missing before this one' WHEN last AND (page_seq + 1) * 100 < total THEN 'walk ends before the total' WHEN NOT last AND (page_seq + 1) * 100 >= total THEN 'page after the end' WHEN last AND upto <> total THEN 'records do not add up to the total'", ""))
def walk_audit_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = lambda: F.struct(F.col("items").alias("data"), F.struct((F.col("no") + 1).alias("page_no"), F.lit(100).alias("per_page"), "total").alias("pagination"))
    return audit.offset_walk(walk_pages(spark, sf_dir, body, "page_no", (F.col("no") + 1).cast("string")), "data").select("chain_id", "page_seq", "fault")


@query(WALK.format("WHEN page_seq > 0 AND before IS NULL OR before <> page_seq - 1 THEN 'request does not continue the page before' WHEN last AND page_seq < top THEN 'walk ends before the last page'", ""))
def walk_audit_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = F.col("no") < F.col("top")
    body = lambda: F.struct(F.col("items").alias("data"), F.struct(F.when(more, F.concat(F.lit("c"), "no")).otherwise("").alias("endCursor"), more.alias("hasNextPage")).alias("pagination"))
    return audit.cursor_walk(walk_pages(spark, sf_dir, body, "after", F.when(F.col("no") > 0, F.concat(F.lit("c"), F.col("no") - 1)))).select("chain_id", "page_seq", "fault")


@query(WALK.format("WHEN before IS NOT NULL AND before <> page_seq - 1 THEN 'request does not continue the page before' WHEN last AND page_seq < top THEN 'walk ends on a full page'", ""))
def walk_audit_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = lambda: F.struct(F.struct(F.col("items").alias("data"), F.concat(F.lit("v"), "no").alias("toVersion")).alias("result"))
    limit = F.col("n") + (F.col("no") == F.col("top")).cast("int")
    return audit.feed_walk(walk_pages(spark, sf_dir, body, "fromVersion", F.when(F.col("no") > 0, F.concat(F.lit("v"), F.col("no") - 1)), limit)).select("chain_id", "page_seq", "fault")


@query(WALK.format("WHEN page_seq > 0 AND before IS NULL OR before <> page_seq - 1 THEN 'request does not continue the page before' WHEN last AND page_seq <= top THEN 'walk ends before an empty page'", " UNION ALL SELECT chain, top + 1, 0, top, total FROM t"))
def walk_audit_seek(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = walk_pages(spark, sf_dir, lambda: F.struct(F.col("items").alias("result")), "offset", F.lpad(F.col("before_id").cast("string"), 12, "0"), ends=True)
    return audit.seek_walk(pages).select("chain_id", "page_seq", "fault")


@query("SELECT n_name AS endpoint, CAST(coalesce(e, 0) AS BIGINT) AS expected, CAST(coalesce(h, 0) AS BIGINT) AS harvested FROM nation JOIN (SELECT c_nationkey AS k, count(*) AS e, count(*) FILTER (c_acctbal > -900) AS h FROM customer GROUP BY 1) ON k = n_nationkey WHERE e <> h")
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider-reported counts against harvested ones."""
    customer = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).withColumn("provider", F.lit("p")).withColumnRenamed("n_name", "endpoint")
    expected = customer.groupBy("provider", "endpoint").agg(F.count("*").alias("expected_count"))
    return audit.incomplete(customer.where("c_acctbal > -900"), expected).select("endpoint", "expected", "harvested")


@query("SELECT event_id, epoch_us(ts) AS ts_us FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'")
def window_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    # compared in the stored type, so that it reaches the scan
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    kept = filters.in_window(F.col("ts"), F.lit(START).cast("timestamp_ntz"), F.lit(END).cast("timestamp_ntz"))
    return raw.where(kept).select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"))


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1995-01-01' AND CAST(o_orderdate AS DATE) < DATE '1995-02-01'")
def ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with shipments that overlap a window, kept where the order itself lies in it."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    start, end = F.lit("1995-01-01").cast("date"), F.lit("1995-02-01").cast("date")
    overlapping = orders.where((F.col("day") < end) & (F.date_add("day", 200) >= start))
    return filters.owned(overlapping, "day", start, end).select("o_orderkey", F.col("day").cast("string").alias("day"))


@query("SELECT CAST(count(*) FILTER (o_orderkey % 3 = 0) AS BIGINT) AS fetchable, CAST(count(*) FILTER (o_orderkey % 3 = 1) AS BIGINT) AS nulls, CAST(count(*) FILTER (o_orderkey % 3 = 2) AS BIGINT) AS empties FROM orders")
def fetchable_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return filters.member_report(table(spark, sf_dir, "orders").select(F.when(k % 3 == 0, k.cast("string")).when(k % 3 == 2, "").alias("member")), "member")


@query("SELECT event_id, user_id, event_type, value FROM events")
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return sets.distinct_rows(sets.concat([rows, rows.where("event_id % 3 = 0"), rows.where("event_id % 9 = 0")]))


@query("SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, count(*) AS n, epoch_us(max(ts)) AS top_us FROM events GROUP BY 1")
def split_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.with_date(table(spark, sf_dir, "events"), "ts").groupBy(F.col("date").cast("string").alias("date")).agg(F.count("*").alias("n"), F.unix_micros(F.max("ts")).alias("top_us"))


@query("SELECT event_id, unnest(generate_series(date_trunc('day', ts), date_trunc('day', ts + (event_id % 4) * INTERVAL 1 DAY + INTERVAL 1 SECOND - INTERVAL 1 MICROSECOND), INTERVAL 1 DAY))::DATE::VARCHAR AS date FROM events")
def covered_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = F.col("ts") + F.make_dt_interval((F.col("event_id") % 4).cast("int"), F.lit(0), F.lit(0), F.lit(1).cast("decimal(18,6)"))
    return table(spark, sf_dir, "events").select("event_id", F.explode(sets.covered_dates(F.col("ts"), end)).alias("date")).select("event_id", F.col("date").cast("string").alias("date"))


SWEPT = ("click", "error", "login", "logout", "purchase", "refund", "signup", "view")


@query(f"WITH c AS (SELECT event_type, user_id, bool_or(event_id % 50 = 7) AS cut FROM events WHERE event_type <> 'click' OR event_id % 2 = 0 GROUP BY ALL) SELECT value FROM (VALUES {', '.join(f'({x!r})' for x in SWEPT)}) v(value) WHERE value NOT IN (SELECT event_type FROM c WHERE NOT cut OR event_type = 'view') OR value = 'error'")
def sweep_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the values that a sweep declares, those without a finished chain. A chain is a type's events of a user: the walks of
    errors were all cut short, others where one of their events says so."""
    n, kind = F.col("event_id"), F.col("event_type")
    events = table(spark, sf_dir, "events").where((kind != "click") | (n % 2 == 0))
    chains = events.groupBy("event_type", "user_id").agg(F.bool_or(n % 50 == 7).alias("cut"))
    finished = (~F.col("cut") | (kind == "view")) & (kind != "error")
    return sets.unswept(chains.select(F.create_map(F.lit("kind"), kind).alias("sent_params"), finished.alias("finished")), "kind", SWEPT)


@query("SELECT epoch_us(max(ts)) AS observed_max_us FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'")
def latest_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = filters.owned(table(spark, sf_dir, "events"), "ts", START, END)
    return aggregates.latest_event_time(rows, "ts").select(us("observed_max"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run per event: its user is the endpoint, its type decides how it went."""
    n = F.col("event_id")
    status = F.when(n % 5 == 0, "failed").when(n % 11 == 0, "running").otherwise("succeeded")
    start = F.date_trunc("day", "ts")
    return table(spark, sf_dir, "events").select(n.cast("string").alias("run_id"), F.lit("p").alias("provider"), F.col("user_id").cast("string").alias("endpoint"), status.alias("status"), F.when(n % 2 == 0, "watermark").otherwise("snapshot").alias("mode"), F.when(n % 2 == 0, start).alias("window_start"), F.when(n % 2 == 0, start + F.expr("interval 1 day")).alias("window_end"), F.lit(None).cast("string").alias("from_version"), F.lit(None).cast("string").alias("to_version"), n.alias("row_count"), F.col("ts").alias("started_at"), (F.col("ts") + F.expr("interval 5 minutes")).alias("ended_at"), F.when(n % 10 == 0, "x").alias("error_detail"))


@query("SELECT CAST(user_id AS VARCHAR) AS endpoint, epoch_us(max(date_trunc('day', ts)) + INTERVAL 1 DAY) AS frontier_us FROM events WHERE event_id % 5 <> 0 AND event_id % 11 <> 0 AND event_id % 2 = 0 GROUP BY 1")
def frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.frontier(runs(spark, sf_dir)).select("endpoint", us("frontier"))


@query("SELECT CAST(user_id AS VARCHAR) AS endpoint, epoch_us(max(ts) + INTERVAL 5 MINUTE) AS last_success_us FROM events WHERE event_id % 5 <> 0 AND event_id % 11 <> 0 GROUP BY 1")
def last_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.last_success(runs(spark, sf_dir)).select("endpoint", us("last_success"))


@query("SELECT reason, count(*) AS n FROM (SELECT CASE WHEN event_id % 5 <> 0 AND event_id % 11 = 0 THEN 'a running run has no end' WHEN event_id % 5 = 0 AND event_id % 10 <> 0 THEN 'a failed run says why' END AS reason FROM events) WHERE reason IS NOT NULL GROUP BY 1")
def run_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.run_faults(runs(spark, sf_dir)).groupBy("reason").agg(F.count("*").alias("n"))


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A unit per user and day; one in 37 is not done."""
    daily = table(spark, sf_dir, "events").groupBy("user_id", F.date_trunc("day", "ts").alias("chunk_start")).agg(F.max("ts").alias("top"))
    n = F.pmod(F.col("user_id") * 31 + F.dayofyear("chunk_start"), F.lit(37))
    return daily.select(F.lit("p").alias("provider"), F.col("user_id").cast("string").alias("endpoint"), F.lit(None).cast("string").alias("partition_key"), "chunk_start", (F.col("chunk_start") + F.expr("interval 1 day")).alias("chunk_end"), F.when(n == 0, "failed").when(n == 1, "pending").when(n == 2, "claimed").otherwise("done").alias("status"), F.when(n != 3, F.col("top")).alias("observed_max"))


UNITS = """WITH d AS (SELECT user_id, date_trunc('day', ts) AS s, max(ts) AS top FROM events GROUP BY 1, 2),
u AS (SELECT CAST(user_id AS VARCHAR) AS endpoint, s, CASE (user_id * 31 + dayofyear(s)) % 37 WHEN 0 THEN 'failed' WHEN 1 THEN 'pending' WHEN 2 THEN 'claimed' ELSE 'done' END AS status,
  CASE WHEN (user_id * 31 + dayofyear(s)) % 37 <> 3 THEN top END AS top FROM d) """


@query(UNITS + "SELECT endpoint, epoch_us(max(u.top)) AS observed_max_us FROM u LEFT JOIN (SELECT endpoint, min(s) AS stop FROM u WHERE status <> 'done' GROUP BY 1) f USING (endpoint) WHERE status = 'done' AND (stop IS NULL OR s < stop) GROUP BY 1 HAVING max(u.top) IS NOT NULL")
def done_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.done_prefix(units(spark, sf_dir)).select("endpoint", us("observed_max"))


@query(UNITS + "SELECT endpoint, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'claimed') AS claimed, count(*) FILTER (status = 'done') AS done, count(*) FILTER (status = 'failed') AS failed FROM u GROUP BY 1")
def unit_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.unit_progress(units(spark, sf_dir)).select("endpoint", "pending", "claimed", "done", "failed")


@query("""WITH e AS (SELECT user_id, date_trunc('day', ts) AS s, event_id, CASE event_id % 4 WHEN 0 THEN 'claimed' WHEN 1 THEN 'done' WHEN 2 THEN 'failed' ELSE 'reset' END AS status FROM events)
SELECT CAST(user_id AS VARCHAR) AS endpoint, epoch_us(s) AS chunk_start_us, CASE WHEN arg_max(status, event_id) = 'reset' THEN 'pending' ELSE arg_max(status, event_id) END AS status, count(*) FILTER (status = 'claimed') AS attempts FROM e GROUP BY user_id, s""")
def unit_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, day = F.col("event_id"), F.date_trunc("day", "ts")
    log = table(spark, sf_dir, "events").select(F.lit("p").alias("provider"), F.col("user_id").cast("string").alias("endpoint"), F.lit("k").alias("partition_key"), day.alias("chunk_start"), (day + F.expr("interval 1 day")).alias("chunk_end"), n.alias("seq"), F.element_at(F.array(F.lit("claimed"), F.lit("done"), F.lit("failed"), F.lit("reset")), (n % 4 + 1).cast("int")).alias("status"), F.col("ts").alias("observed_max"))
    return aggregates.unit_state(log).select("endpoint", us("chunk_start"), "status", "attempts")


@query("SELECT user_id, CAST(count(*) AS BIGINT) AS rows_written, CAST(sum(event_id % 3) AS BIGINT) AS duplicates_dropped, epoch_us(max(ts)) AS observed_max_us, CAST(count(DISTINCT CAST(ts AS DATE)) FILTER (event_id % 7 = 0) AS INTEGER) AS deleted FROM events GROUP BY 1")
def outcome_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    outcomes = table(spark, sf_dir, "events").select("user_id", F.lit(1).alias("rows_written"), (n % 3).alias("duplicates_dropped"), F.lit(1).alias("files_written"), F.when(n % 7 == 0, F.array(F.to_date("ts").cast("string"))).otherwise(F.array().cast("array<string>")).alias("deleted_partitions"), F.col("ts").alias("observed_max"))
    return aggregates.merged_outcomes(outcomes, ["user_id"]).select("user_id", "rows_written", "duplicates_dropped", us("observed_max"), F.size("deleted_partitions").alias("deleted"))


ENDPOINTS = """WITH e AS (SELECT user_id, max(ts) FILTER (user_id % 3 = 0) AS watermark, max(date_trunc('day', ts)) FILTER (user_id % 3 = 1) AS frontier FROM events GROUP BY 1),
r AS (SELECT user_id, date_trunc('day', coalesce(watermark - (user_id % 4) * INTERVAL 1 DAY, frontier, TIMESTAMP '2023-12-25 07:00:00')) AS a, date_trunc('day', TIMESTAMP '2024-01-31 05:00:00' - (user_id % 3) * INTERVAL 1 DAY) AS b FROM e) """


def endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("user_id")
    grouped = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max(F.when(u % 3 == 0, F.col("ts"))).alias("watermark"), F.max(F.when(u % 3 == 1, F.date_trunc("day", "ts"))).alias("frontier"))
    return grouped.select(F.lit("p").alias("provider"), u.alias("endpoint"), "watermark", "frontier", F.lit(datetime(2023, 12, 25, 7)).cast("timestamp").alias("default_start"), (u % 4).cast("int").alias("lookback_days"), (u % 3).cast("int").alias("cutoff_days"), windows.unit_days(F.when(u % 5 == 0, 1), F.lit(7)).alias("unit_days"))


NOW = datetime(2024, 1, 31, 5)


@query(ENDPOINTS + "SELECT user_id AS endpoint, epoch_us(a) AS window_start_us, epoch_us(b) AS window_end_us FROM r WHERE a < b")
def resume_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.windows(endpoints(spark, sf_dir), NOW).select("endpoint", us("window_start"), us("window_end"))


@query(ENDPOINTS + "SELECT user_id AS endpoint, epoch_us(s) AS chunk_start_us, epoch_us(least(s + CASE WHEN user_id % 5 = 0 THEN INTERVAL 1 DAY ELSE INTERVAL 7 DAY END, b)) AS chunk_end_us FROM (SELECT *, unnest(generate_series(a, b - INTERVAL 1 MICROSECOND, CASE WHEN user_id % 5 = 0 THEN INTERVAL 1 DAY ELSE INTERVAL 7 DAY END)) AS s FROM r WHERE a < b)")
def tile_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.tiles(windows.windows(endpoints(spark, sf_dir), NOW)).select("endpoint", us("chunk_start"), us("chunk_end"))


@query(UNITS + "SELECT endpoint, epoch_us(s + INTERVAL 14 DAY) AS chunk_start_us FROM u EXCEPT SELECT endpoint, epoch_us(s) FROM u")
def enqueue_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = units(spark, sf_dir)
    shifted = known.withColumn("chunk_start", F.col("chunk_start") + F.expr("interval 14 days")).withColumn("chunk_end", F.col("chunk_end") + F.expr("interval 14 days"))
    return windows.to_enqueue(shifted, known).select("endpoint", us("chunk_start"))


@query(UNITS + "SELECT endpoint, epoch_us(s) AS chunk_start_us FROM u WHERE status = 'done' AND s >= TIMESTAMP '2024-01-08' AND s + INTERVAL 1 DAY <= TIMESTAMP '2024-01-15'")
def release_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = units(spark, sf_dir)
    spans = known.select("provider", "endpoint").distinct().withColumn("window_start", F.lit(START).cast("timestamp")).withColumn("window_end", F.lit(END).cast("timestamp"))
    return windows.to_release(known, spans).select("endpoint", us("chunk_start"))


@query("SELECT CAST(user_id AS VARCHAR) AS endpoint, epoch_us(greatest(max(ts) FILTER (event_id % 2 = 0), max(ts) FILTER (event_id % 2 = 1 AND user_id % 4 = 0))) AS watermark_us FROM events GROUP BY 1 HAVING watermark_us IS NOT NULL")
def watermark_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.lit("p").alias("provider"), F.col("user_id").cast("string").alias("endpoint"), "event_id", "user_id", "ts")
    stored = rows.where("event_id % 2 = 1 and user_id % 4 = 0").groupBy("provider", "endpoint").agg(F.max("ts").alias("watermark"))
    return windows.advanced(stored, rows.where("event_id % 2 = 0").withColumnRenamed("ts", "observed_max")).select("endpoint", us("watermark"))


@query("SELECT CAST(user_id AS VARCHAR) AS endpoint, 'v' || arg_max(event_id, ts) AS to_version FROM events GROUP BY 1")
def feed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "events").select(F.lit("p").alias("provider"), F.col("user_id").cast("string").alias("endpoint"), F.col("ts").alias("fetched_at"), F.col("event_id").alias("page_seq"), F.concat(F.lit("v"), "event_id").alias("to_version"))
    return windows.feed_tokens(pages).select("endpoint", "to_version")


@query("SELECT CAST(user_id AS VARCHAR) AS endpoint, CASE WHEN user_id % 4 = 3 THEN 'a snapshot keeps no cursor' WHEN user_id % 4 = 1 THEN 'cursor of another kind' ELSE 'watermark in the future' END AS reason FROM (SELECT user_id, max(ts) AS t FROM events GROUP BY 1) WHERE user_id % 4 IN (1, 3) OR user_id % 4 = 0 AND t > TIMESTAMP '2024-01-30 12:00:00'")
def broken_cursors(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").alias("t"))
    u = F.col("user_id")
    mode = F.when(u % 4 == 2, "feed").when(u % 4 == 3, "snapshot").otherwise("watermark")
    named = latest.select(F.lit("p").alias("provider"), u.cast("string").alias("endpoint"), mode.alias("mode"), F.when(u % 4 == 0, "watermark").otherwise("token").alias("kind"), F.date_format("t", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("value"))
    return filters.broken_cursors(named.drop("mode"), named, F.lit(datetime(2024, 1, 30, 12)).cast("timestamp")).select("endpoint", "reason")


ROSTER = """WITH s AS (SELECT c_custkey AS member, c_custkey % 4 AS n FROM customer WHERE c_custkey % 5 <> 0), l AS (SELECT DISTINCT o_custkey AS member FROM orders),
b AS (SELECT coalesce(s.member, l.member) AS member, n, l.member IS NOT NULL AS here FROM s FULL JOIN l ON s.member = l.member) """


def roster_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Customers as the stored roster of each, those who ordered as the new listing."""
    stored = table(spark, sf_dir, "customer").where("c_custkey % 5 <> 0").select(F.lit("p").alias("provider"), F.lit("vehicle_ids").alias("name"), F.col("c_custkey").cast("string").alias("member"), (F.col("c_custkey") % 4).cast("int").alias("absence_count"))
    listed = aggregates.members(table(spark, sf_dir, "orders"), "o_custkey").select(F.lit("p").alias("provider"), F.lit("vehicle_ids").alias("name"), "member")
    return stored, listed, spark.createDataFrame([("p", "vehicle_ids", 3)], "provider string, name string, evict_after int")


@query(ROSTER + "SELECT CAST(member AS VARCHAR) AS member, CASE WHEN here AND (n IS NULL OR n > 0) THEN 'zero' WHEN here THEN 'keep' WHEN n + 1 > 3 THEN 'evict' ELSE 'increment' END AS action, CAST(CASE WHEN here THEN 0 ELSE n + 1 END AS INTEGER) AS absence_count FROM b")
def roster_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rosters.reconcile(*roster_tables(spark, sf_dir)).select("member", "action", "absence_count")


@query(ROSTER + "SELECT CAST(member AS VARCHAR) AS member, CAST(CASE WHEN here THEN 0 ELSE n + 1 END AS INTEGER) AS absence_count FROM b WHERE here OR n + 1 <= 3")
def roster_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, listed, policies = roster_tables(spark, sf_dir)
    return rosters.applied(stored, rosters.reconcile(stored, listed, policies)).select("member", "absence_count")


@query("WITH m AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS member FROM orders), r AS (SELECT member, CAST((row_number() OVER (ORDER BY member) - 1) // 50 AS INTEGER) AS batch FROM m) SELECT batch, string_agg(member, ',' ORDER BY member) AS members FROM r GROUP BY 1")
def roster_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rosters.batches(roster_tables(spark, sf_dir)[1], 50).select("batch", "members")


@query("SELECT CAST(user_id AS VARCHAR) AS name, CASE WHEN count(*) FILTER (event_id % 5 <> 0 AND event_id % 11 <> 0) = 0 THEN 'never listed' WHEN user_id % 2 = 1 THEN 'empty' ELSE 'too old' END AS reason FROM events GROUP BY user_id HAVING count(*) FILTER (event_id % 5 <> 0 AND event_id % 11 <> 0) = 0 OR user_id % 2 = 1 OR max(ts) FILTER (event_id % 5 <> 0 AND event_id % 11 <> 0) + INTERVAL 5 MINUTE < TIMESTAMP '2024-01-30 05:00:00'")
def roster_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "events").select("user_id").distinct()
    policies = names.select(F.lit("p").alias("provider"), F.col("user_id").cast("string").alias("name"), F.col("user_id").cast("string").alias("feeder"), F.lit(1).alias("max_age_days"))
    stored = names.where("user_id % 2 = 0").select(F.lit("p").alias("provider"), F.col("user_id").cast("string").alias("name"), F.lit("m").alias("member"))
    return rosters.due(policies, aggregates.last_success(runs(spark, sf_dir)), stored, NOW).select("name", "reason")


@query("SELECT CAST(c_custkey AS VARCHAR) AS member, s * 86400000 AS start_ms FROM (SELECT c_custkey FROM customer), (SELECT unnest(generate_series(0, 6)) AS s)")
def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request for each member and unit window."""
    spans = spark.createDataFrame([("p", "trips", datetime(1970, 1, 1), datetime(1970, 1, 8), 1)], "provider string, endpoint string, window_start timestamp, window_end timestamp, unit_days int")
    roster = table(spark, sf_dir, "customer").select(F.lit("p").alias("provider"), F.col("c_custkey").cast("string").alias("member"))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    planned = requests.plan(rosters.fan_out(roster, windows.tiles(spans.withColumn("window_start", F.timestamp_seconds(F.lit(0))).withColumn("window_end", F.timestamp_seconds(F.lit(7 * 86_400))))), "epoch_millis", "vehicleId")
    return planned.select(F.col("params")["vehicleId"].alias("member"), F.col("params")["startMs"].cast("long").alias("start_ms"))


@query("SELECT event_id, strftime(date_trunc('day', ts) - INTERVAL 1 DAY, '%Y-%m-%d') AS start_date, strftime(date_trunc('day', ts) + INTERVAL 1 DAY, '%Y-%m-%d') AS end_date, strftime(date_trunc('day', ts), '%Y-%m-%dT%H:%M:%SZ') AS start_time, strftime(date_trunc('day', ts) + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%SZ') AS end_time FROM events")
def request_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_trunc("day", "ts")
    spans = table(spark, sf_dir, "events").select("event_id", day.alias("chunk_start"), (day + F.expr("interval 1 day")).alias("chunk_end"))
    rows = spans.withColumn("labels", requests.parameters("date_labels", F.col("chunk_start"), F.col("chunk_end"), 1)).withColumn("times", requests.parameters("rfc3339", F.col("chunk_start"), F.col("chunk_end")))
    return rows.select("event_id", F.col("labels")["start_date"].alias("start_date"), F.col("labels")["end_date"].alias("end_date"), F.col("times")["startTime"].alias("start_time"), F.col("times")["endTime"].alias("end_time"))


@query("""SELECT event_id, '{"method":"Get","params":{"typeName":"Trip","search":{"fromDate":"' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || '","toDate":"' || strftime(ts + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%SZ') || '"},"resultsLimit":5000,"sort":{"sortBy":"id","sortDirection":"asc","offset":null}}}' AS body FROM events""")
def request_rpc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", requests.rpc_body("get_window_sorted", "Trip", 5000, F.col("ts"), F.col("ts") + F.expr("interval 1 day")).alias("body"))


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("event_id") % 977).cast("decimal(18,6)"))
    return table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("active_from"), (F.col("ts") + seconds).alias("active_to"))


@query("""WITH RECURSIVE e AS (SELECT epoch_us(ts) AS s, epoch_us(ts) + (event_id % 977) * 1000000 AS t FROM events),
w AS (SELECT CAST(1704067200 AS BIGINT) AS a, CAST(1706745600 AS BIGINT) AS b, (SELECT count(*) FROM e WHERE s < 1706745600000000 AND t >= 1704067200000000) AS n
  UNION ALL SELECT h.a, h.b, (SELECT count(*) FROM e WHERE e.s < h.b * 1000000 AND e.t >= h.a * 1000000)
  FROM (SELECT unnest([{'a': a, 'b': (a + b) // 2}, {'a': (a + b) // 2, 'b': b}]) AS h FROM w WHERE n >= 500))
SELECT a * 1000000 AS window_start_us, b * 1000000 AS window_end_us, n FROM w WHERE n < 500""")
def capped_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves of halving January until under 500 events overlap each, a minute at least."""
    return bisection.capped_windows(spans(spark, sf_dir), datetime.fromisoformat("2024-01-01T00:00:00+00:00"), datetime.fromisoformat("2024-02-01T00:00:00+00:00"), 500, 60).select(us("window_start"), us("window_end"), "n")


@query("SELECT event_id, CAST(1 AS BIGINT) AS leaves FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01'")
def capped_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event has exactly one owning leaf, also where a minute holds more events than a request returns."""
    rows = spans(spark, sf_dir)
    leaves = bisection.capped_windows(rows, datetime.fromisoformat("2024-01-01T00:00:00+00:00"), datetime.fromisoformat("2024-02-01T00:00:00+00:00"), 500, 60, dense="keep")
    return bisection.owned_by_leaf(rows, leaves).groupBy("event_id").agg(F.count("*").alias("leaves"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN CAST(l_quantity AS INTEGER) % 30 < 24 THEN ((l_linenumber * 24 + CAST(l_quantity AS INTEGER) % 30) * 3600 + (l_partkey % 60) * 60 + l_suppkey % 60) * 1000000 + (l_orderkey % 10) * 100000 END AS micros FROM lineitem")
def timespan_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    text = F.concat(F.col("l_linenumber"), F.lit("."), two(F.col("l_quantity").cast("int") % 30), F.lit(":"), two(F.col("l_partkey") % 60), F.lit(":"), two(F.col("l_suppkey") % 60), F.lit("."), F.col("l_orderkey") % 10)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", S.interval_to_micros(S.timespan(text)).alias("micros"))


@query("SELECT event_id, epoch_us(ts) // 1000000 * 1000000 AS whole_us, epoch_us(ts) AS exact_us, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS label, epoch_us(ts) // 1000 AS millis, epoch_us(date_trunc('day', ts)) AS midnight_us, CAST(CAST(ts AS DATE) AS VARCHAR) AS date FROM events")
def iso_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times as text and back; an offset other than UTC; epoch milliseconds; date labels."""
    rows = table(spark, sf_dir, "events").select("event_id", "ts", S.to_iso(F.col("ts")).alias("label"))
    east = F.concat(F.date_format(F.col("ts") + F.expr("interval 150 minutes"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+02:30"))
    return rows.select("event_id", F.unix_micros(S.iso_timestamp(F.col("label"))).alias("whole_us"), F.unix_micros(S.iso_timestamp(east)).alias("exact_us"), "label", F.unix_millis(S.epoch_millis(S.to_epoch_millis(F.col("ts")))).alias("millis"), F.unix_micros(S.date_label(S.utc_date(F.col("ts")).cast("string"))).alias("midnight_us"), S.utc_date(F.col("ts")).cast("string").alias("date"))


@query("SELECT event_id, CASE WHEN event_id % 3 < 2 THEN 'u' || user_id END AS user, CASE WHEN event_id % 4 < 3 THEN 'u' || user_id || ',' || event_type END AS ids FROM events")
def ref_lift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References that are bare text or objects; id lists, refused where an element is neither."""
    n, name = F.col("event_id"), F.concat(F.lit("u"), "user_id")
    quoted = F.concat(F.lit('"'), name, F.lit('"'))
    ref = F.when(n % 3 == 0, quoted).when(n % 3 == 1, F.concat(F.lit('{"id":'), quoted, F.lit(',"isDriver":true}'))).otherwise(F.lit('{"other":1}'))
    second = F.when(n % 4 == 3, F.lit('{"id":"x","more":1}')).when(n % 4 == 2, F.concat(F.lit('"'), "event_type", F.lit('"'))).otherwise(F.concat(F.lit('{"id":"'), "event_type", F.lit('"}')))
    ids = S.id_list(F.parse_json(F.concat(F.lit("["), quoted, F.lit(","), second, F.lit("]"))))
    return table(spark, sf_dir, "events").select("event_id", S.text_of(S.reference_id(F.parse_json(ref))).alias("user"), F.when(ids.isNotNull(), F.array_join(ids, ",")).alias("ids"))


@query("SELECT event_id, CASE event_id % 6 WHEN 0 THEN event_id WHEN 1 THEN event_id WHEN 2 THEN event_id WHEN 3 THEN 1 END AS whole, CASE event_id % 6 WHEN 0 THEN event_id WHEN 1 THEN event_id WHEN 2 THEN event_id WHEN 3 THEN 1 WHEN 4 THEN event_id + 0.5 END::DOUBLE AS number, CASE event_id % 6 WHEN 3 THEN 1 WHEN 5 THEN 1 END AS flag FROM events")
def lax_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers in quotes, whole floats, booleans as numbers; fractions are refused for whole numbers."""
    n = F.col("event_id").cast("string")
    k = F.col("event_id") % 6
    raw = F.parse_json(F.when(k == 0, n).when(k == 1, F.concat(F.lit('" '), n, F.lit('"'))).when(k == 2, F.concat(n, F.lit(".0"))).when(k == 3, F.lit("true")).when(k == 4, F.concat(n, F.lit(".5"))).otherwise(F.lit('"Yes"')))
    flag = F.when(k.isin(3, 5), S.boolean(raw))
    return table(spark, sf_dir, "events").select("event_id", S.whole_number(raw).alias("whole"), S.number(raw).alias("number"), flag.cast("int").alias("flag"))


@query("SELECT user_id, arg_max(event_id, ts) AS event_id, arg_max(value, ts) AS value FROM events GROUP BY 1")
def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "value", F.lpad(F.hex(F.unix_micros("ts")), 16, "0").alias("version"))
    return aggregates.latest_version(rows, "user_id").select("user_id", "event_id", "value")


@query("SELECT user_id AS id, arg_max(event_id, ts) AS event_id, true AS few FROM events WHERE ts < TIMESTAMP '2024-01-20' OR user_id % 50 = 0 GROUP BY 1")
def current_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current row of each user, from two lots, of which the second has one user in fifty: few buckets are rewritten.
    Versions are hexadecimal numbers of any width."""
    rows, path = table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), "event_id", F.hex(F.unix_micros("ts")).alias("version"), "ts"), fresh_path(spark, "current")
    early, few = F.col("ts") < F.lit(datetime(2024, 1, 20)), F.col("id") % 50 == 0
    current.update(rows.where(early).drop("ts"), path, buckets=32, order="hex")
    second = rows.where(~early & few).drop("ts")
    touched = current.update(second, path, buckets=32, order="hex")
    changed = [x.key for x in versions.version(spark, path)[1] if x not in versions.version(spark, path, 1)[1]]
    small = len(touched) <= second.select("id").distinct().count() and sorted(map(int, changed)) == touched
    return current.read(spark, path, second.schema).select("id", "event_id", F.lit(small).alias("few"))


@query("""SELECT user_id, CAST(count(*) AS BIGINT) AS n, 'rollups of 1 days can''t be summed over 7 days, 0:00:00; window_start has no grain; a rollup of another window overlaps' AS refused
FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11' GROUP BY 1""")
def rollup_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rollups of all events, summed over a day of their own, and refused over a week, without a grain, and beside
    rollups of two days."""
    day = F.date_trunc("day", "ts")
    plain = table(spark, sf_dir, "events").groupBy("user_id", "event_type", day.alias("window_start")).agg(F.count("*").alias("n")).withColumn("window_end", F.col("window_start") + F.expr("interval 1 day"))
    path = fresh_path(spark, "rollups")
    aggregates.grained(plain, 1).write.parquet(path)
    daily = spark.read.parquet(path)  # with its grain
    wide = daily.unionByName(daily.limit(1).withColumn("window_start", F.lit(datetime(2024, 1, 9))).withColumn("window_end", F.lit(datetime(2024, 1, 11))))
    own, refused = (datetime(2024, 1, 10), datetime(2024, 1, 11)), []
    for rows, window in ((daily, (START, END)), (plain, own), (aggregates.grained(wide, 1), own)):
        try:
            aggregates.rollup(rows, ["user_id"], ["n"], window).collect()
        except Exception as error:
            refused.append(re.search(r"rollups of 1 days can't be summed over [^\n]*|window_start has no grain|a rollup of another window overlaps", str(error))[0])
    return aggregates.rollup(daily, ["user_id"], ["n"], own).select("user_id", "n", F.lit("; ".join(refused)).alias("refused"))


@query("SELECT DISTINCT user_id FROM events")
def active_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.one_per_id(table(spark, sf_dir, "events"), "user_id").select("user_id")


@query("SELECT CAST(o_custkey AS VARCHAR) AS member FROM orders GROUP BY 1")
def roster_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.members(table(spark, sf_dir, "orders"), "o_custkey")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, count(*) AS n, CAST(sum(CASE WHEN ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15' THEN 2 ELSE 1 END) AS BIGINT) AS versions FROM events WHERE CAST(ts AS DATE) <> DATE '2024-01-10' AND NOT (ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15' AND event_id % 2 = 0) GROUP BY 1")
def replace_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window refetched: its dates are replaced, the one that came back empty is deleted, history stays."""
    rows = table(spark, sf_dir, "events").select("event_id", "ts", F.lit(1).alias("version"))
    path, first, last = fresh_path(spark, "window"), datetime(2024, 1, 1), datetime(2024, 2, 1)
    writers.replace_window(filters.owned(rows, "ts", first, last), path, "ts", first, last)
    again = filters.owned(rows, "ts", START, END).where("event_id % 2 = 1 and to_date(ts) <> date '2024-01-10'").withColumn("version", F.lit(2))
    writers.replace_window(again.unionAll(again.where("event_id % 5 = 0")), path, "ts", START, END)
    return spark.read.parquet(path).groupBy(F.col("date").cast("string").alias("date")).agg(F.count("*").alias("n"), F.sum("version").alias("versions"))


@query("SELECT event_id, value FROM events WHERE event_id % 2 = 0")
def replace_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, path = table(spark, sf_dir, "events").select("event_id", "value"), fresh_path(spark, "snapshot")
    writers.replace_snapshot(rows, path)
    kept = rows.where("event_id % 2 = 0")
    writers.replace_snapshot(kept.unionAll(kept.where("event_id % 3 = 0")), path)
    return spark.read.parquet(path)


@query("SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15' THEN 2 ELSE 1 END AS version FROM events WHERE NOT (ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15' AND event_id % 2 = 0)")
def replace_single_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, path = table(spark, sf_dir, "events").select("event_id", "ts", F.lit(1).alias("version")), fresh_path(spark, "single")
    writers.replace_single_window(rows, path, "ts", datetime(2024, 1, 1), datetime(2024, 2, 1))
    writers.replace_single_window(filters.owned(rows, "ts", START, END).where("event_id % 2 = 1").withColumn("version", F.lit(2)), path, "ts", START, END)
    return spark.read.parquet(path).select("event_id", "version")


@query("SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date FROM events UNION ALL SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) FROM events WHERE event_id % 4 = 0")
def feed_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appends keep what is there, duplicates included."""
    rows, path = table(spark, sf_dir, "events").select("event_id", "ts"), fresh_path(spark, "feed")
    writers.append(rows, path, "ts")
    writers.append(rows.where("event_id % 4 = 0"), path, "ts")
    return spark.read.parquet(path).select("event_id", F.col("date").cast("string").alias("date"))


FEED_PAGES = 500


def log_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as landed pages of a feed, each of which asks from the version that the page before ends with."""
    spec = catalog.CATALOG["geotab.log_records"]
    record = F.struct(F.concat(F.lit("i"), "event_id").alias("id"), iso("ts").alias("dateTime"), F.struct(F.col("user_id").cast("string").alias("id")).alias("device"), F.col("value").alias("latitude"), F.col("value").alias("longitude"), F.lit(1.0).alias("speed"))
    page = F.floor(F.col("event_id") / FEED_PAGES)
    sent = F.create_map(F.lit("fromVersion"), F.when(page > 0, F.concat(F.lit("v"), page.cast("string"))))
    pages = packed(table(spark, sf_dir, "events"), page, record, lambda x: F.struct(F.struct(x.alias("data"), F.concat(F.lit("v"), (F.col("page_seq") + 1).cast("string")).alias("toVersion")).alias("result")), sent, FEED_PAGES)
    return pages.withColumn("provider", F.lit(spec.provider)).withColumn("endpoint", F.lit(spec.name)).withColumn("fetched_at", F.timestamp_seconds("page_seq"))


@query("SELECT 'i' || event_id AS id, epoch_us(ts) AS date_time_us, CAST(CAST(ts AS DATE) AS VARCHAR) AS date FROM events")
def feed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of a feed landed in two lots, streamed in two runs and a third that finds nothing new."""
    spec, landed, root = catalog.CATALOG["geotab.log_records"], fresh_path(spark, "landed"), fresh_path(spark, "stored")
    pages = log_pages(spark, sf_dir)
    for lot in (F.col("page_seq") < 1, F.col("page_seq") >= 1, None):
        if lot is not None:
            pages.where(lot).write.mode("append").json(landed)
        feed.start(spark, landed, root, spec).awaitTermination()
    return spark.read.parquet(f"{root}/{spec.provider}/{spec.name}").select("id", us("date_time"), F.col("date").cast("string").alias("date"))


def moved_in(spark: SparkSession, source: str, target: str) -> None:
    """The one data file of ``source`` takes the name and place of that of ``target``, or a place of its own there."""
    data = lambda folder: [x.getPath() for x in scans.file_system(spark, folder)[0].listStatus(scans.file_system(spark, folder)[1]) if x.getPath().getName().startswith("part-")]
    system, [new], old = scans.file_system(spark, source)[0], data(source), data(target)[0]
    system.delete(old, False)
    system.rename(new, old)


@query(f"SELECT 'i' || event_id AS id, event_id < {FEED_PAGES} AS before, fault FROM events, (VALUES ('asked from version gap, the page before ends with v1'), ('result: missing')) v(fault)")
def feed_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds that break on their second page, by a gap between versions or an error in a page's place: the stream stops before
    that batch, names the fault, and goes on once the page is mended. ``before``: rows that were stored when it stopped."""
    spec, pages, out = catalog.CATALOG["geotab.log_records"], log_pages(spark, sf_dir), []
    second, rest = pages.where("page_seq = 1").coalesce(1), pages.where("page_seq > 1")  # one page is one file; the rest is as many as it takes
    broken = {"sent_params": F.create_map(F.lit("fromVersion"), F.lit("gap")), "body": F.lit('{"error":{"message":"no"}}')}
    for column, value in broken.items():
        landed, root = fresh_path(spark, "landed"), fresh_path(spark, "stored")
        stored = f"{root}/{spec.provider}/{spec.name}"
        pages.where("page_seq < 1").write.json(f"{landed}/lot=1")
        feed.start(spark, f"{landed}/*", root, spec).awaitTermination()
        second.withColumn(column, value).write.json(f"{landed}/lot=2")
        rest.write.json(f"{landed}/lot=3")
        try:
            feed.start(spark, f"{landed}/*", root, spec).awaitTermination()
            fault = None
        except Exception as error:
            fault = re.search(r"FeedError: \S+ c/1: ([^;\n]*)", str(error))[1]
        before = spark.read.parquet(stored).select("id", F.lit(True).alias("before"))
        before = spark.createDataFrame(before.toArrow(), before.schema) if before.isEmpty() else staged(before)
        second.write.json(f"{landed}-mended")
        moved_in(spark, f"{landed}-mended", f"{landed}/lot=2")
        feed.start(spark, f"{landed}/*", root, spec).awaitTermination()
        rows = spark.read.parquet(stored).join(before, "id", "left")
        out.append(rows.select("id", F.coalesce("before", F.lit(False)).alias("before"), F.lit(fault).alias("fault")))
    return sets.concat(out)


@query(f"SELECT CAST(CASE WHEN event_id < {FEED_PAGES} THEN 0 ELSE 1 END AS BIGINT) AS batch, CAST(count(*) AS BIGINT) AS n, CAST(count(*) AS BIGINT) AS stored FROM events GROUP BY 1")
def feed_observer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an observer sees of a feed that lands in two lots, beside what is stored under each batch's number."""
    spec, landed, root, seen = catalog.CATALOG["geotab.log_records"], fresh_path(spark, "landed"), fresh_path(spark, "stored"), []
    pages = log_pages(spark, sf_dir)
    for lot in (F.col("page_seq") < 1, F.col("page_seq") >= 1):
        pages.where(lot).write.mode("append").json(landed)
        feed.start(spark, landed, root, spec, observer=lambda batch, number: seen.append((number, batch.count()))).awaitTermination()
    stored = spark.read.parquet(f"{root}/{spec.provider}/{spec.name}").groupBy(F.col("batch").cast("long").alias("batch")).agg(F.count("*").alias("stored"))
    return spark.createDataFrame(seen, "batch long, n long").join(stored, "batch", "left")


def vehicle_pages(spark: SparkSession, sf_dir: str, kept: Column) -> DataFrame:
    """Customers as landed pages of a listing of vehicles."""
    fixed = {"notes": "n", "harshAccelerationSettingType": "off", "vehicleRegulationMode": "regulated", "createdAtTime": "2024-01-01T00:00:00Z", "updatedAtTime": "2024-01-01T00:00:00Z"}
    record = F.struct(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), *[F.lit(v).alias(k) for k, v in fixed.items()])
    last = F.struct(F.lit("").alias("endCursor"), F.lit(False).alias("hasNextPage")).alias("pagination")
    pages = packed(table(spark, sf_dir, "customer").where(kept), F.floor(F.col("c_custkey") / 100), record, lambda x: F.struct(x.alias("data"), last))
    named = F.concat(F.lit("c"), F.col("page_seq").cast("string"))
    return pages.withColumn("provider", F.lit("samsara")).withColumn("endpoint", F.lit("vehicles")).withColumn("chain_id", named)


@query("SELECT CAST(c_custkey AS VARCHAR) AS member, CAST(CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END AS INTEGER) AS absence_count FROM customer")
def feeder_tap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing stored twice, the second time without a seventh of its members: the roster that it feeds counts them absent."""
    root = fresh_path(spark, "roster")
    for name, kept in (("all", F.lit(True)), ("most", F.col("c_custkey") % 7 != 0)):
        vehicle_pages(spark, sf_dir, kept).write.parquet(f"{root}/landed-{name}")
        pipelines.ingest(spark, f"{root}/landed-{name}", root, "samsara.vehicles")
    return drive.control(spark, root, "rosters", rosters.ROSTER).select("member", "absence_count")


@query("SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, 'page refused: data: missing (samsara/vehicles/c/-1)' AS refused FROM customer")
def snapshot_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing among whose pages an error has landed fails and names it; without that page it gives all rows."""
    pages = vehicle_pages(spark, sf_dir, F.lit(True)).withColumn("chain_id", F.lit("c"))
    bad = pages.limit(1).withColumn("page_seq", F.lit(-1)).withColumn("body", F.lit('{"message":"try later"}'))
    landed = fresh_path(spark, "landed")
    pages.write.parquet(f"{landed}/good")
    pages.unionByName(bad).write.parquet(f"{landed}/mixed")
    try:
        pipelines.read_snapshot(spark, f"{landed}/mixed", "samsara.vehicles").count()
        said = None
    except Exception as error:
        said = re.search(r"page refused: [^\n]*?\)", str(error))[0]
    return pipelines.read_snapshot(spark, f"{landed}/good", "samsara.vehicles").select("id", "name", F.lit(said).alias("refused"))


@query("""SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15' THEN 2 ELSE 1 END AS version, 'versions 1 to 12, at most 1 files a date, conflict' AS said
FROM events WHERE NOT (ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15' AND event_id % 2 = 0)""")
def versioned_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events appended in ten small lots, packed, and a week replaced under a reader of the version before; a writer that
    began before that and has a lower fence is refused."""
    rows, path = sets.with_date(table(spark, sf_dir, "events").select("event_id", "ts", F.lit(1).alias("version")), "ts"), fresh_path(spark, "versions")
    for k in range(10):
        versions.append(rows.where(F.col("event_id") % 10 == k), path)
    versions.compact(spark, path, rows.schema, most_files=1)
    base, reader = versions.version(spark, path), scans.dataset(spark, path, rows.schema)
    files = max(sum(x.files for x in base[1] if x.key == day) for day in {x.key for x in base[1]})
    again = filters.owned(rows, "ts", START, END).where("event_id % 2 = 1").withColumn("version", F.lit(2))
    writers.replace_spans(again.drop("date"), path, "ts", [(START, END)], fence=2)
    try:
        versions.replace(again.withColumn("version", F.lit(9)), path, writers.covered(START, END), 1, base)
        said = "stored"
    except versions.Conflict:
        said = "conflict"
    kept = reader.count() == rows.count()
    said = f"versions {versions.numbers(spark, path)[0]} to {versions.numbers(spark, path)[-1]}, at most {files} files a date, {said}" if kept else "the reader lost rows"
    return scans.dataset(spark, path, rows.schema).select("event_id", "version", F.lit(said).alias("said"))


@query("SELECT CAST(user_id AS VARCHAR) AS endpoint, CAST(arg_max(event_id, ts) AS VARCHAR) AS run_id FROM events GROUP BY 1")
def last_run_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest run of each endpoint, as a JSON document."""
    return writers.last_runs(runs(spark, sf_dir)).select("endpoint", F.get_json_object("document", "$.run_id").alias("run_id"))


@query("""WITH w AS (SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15')
SELECT CAST(count(*) AS BIGINT) AS rows_written, CAST(count(*) FILTER (event_id % 5 = 0) AS BIGINT) AS duplicates_dropped, epoch_us(max(ts)) AS observed_max_us, CAST(count(DISTINCT CAST(ts AS DATE)) AS BIGINT) AS dates FROM w""")
def write_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a write says of itself, observed while it ran, beside the dates that it stored."""
    rows, path = filters.owned(table(spark, sf_dir, "events").select("event_id", "ts"), "ts", START, END), fresh_path(spark, "report")
    report = writers.replace_window(rows.unionAll(rows.where("event_id % 5 = 0")), path, "ts", START, END)
    dates = scans.partitioned(spark, path, rows.schema).agg(F.count_distinct("date").alias("dates"))
    said = [F.lit(report.rows_written).cast("long").alias("rows_written"), F.lit(report.duplicates_dropped).cast("long").alias("duplicates_dropped"), F.unix_micros(F.lit(report.observed_max).cast("timestamp")).alias("observed_max_us")]
    return dates.select(*said, "dates")


@query("SELECT * FROM (VALUES ('a row outside the window'), ('a row without event time'), ('a listing without members'), ('a walk cut short')) v(refused), (SELECT CAST(count(*) AS BIGINT) AS stored FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15')")
def refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes and listings that are refused whole, and the rows that are stored after them: those from before."""
    events, path = table(spark, sf_dir, "events").select("event_id", "ts"), fresh_path(spark, "refused")
    writers.replace_window(filters.owned(events, "ts", START, END), path, "ts", START, END)
    members = events.select(F.lit("p").alias("provider"), F.lit("n").alias("name"), F.lit("").alias("member"))
    page = walk_pages(spark, sf_dir, lambda: F.struct(F.col("items").alias("data"), F.struct(F.lit("c").alias("endCursor"), F.lit(True).alias("hasNextPage")).alias("pagination")), "after", F.lit(None).cast("string"))
    tried = {
        "a row outside the window": (writers.OutOfWindow, lambda: writers.replace_window(events, path, "ts", START, END)),
        "a row without event time": (Exception, lambda: writers.append(events.withColumn("ts", F.when(F.col("event_id") % 2 == 0, F.col("ts"))), path, "ts")),
        "a listing without members": (rosters.EmptyListing, lambda: rosters.require_listed(members)),
        "a walk cut short": (audit.WalkError, lambda: audit.require_none(audit.cursor_walk(page))),
    }
    refused = []
    for name, (kind, act) in tried.items():
        try:
            act()
        except kind:
            refused.append(name)
    stored = scans.dataset(spark, path, events.schema).agg(F.count("*").alias("stored"))
    return stored.select(F.explode(F.array(*map(F.lit, refused))).alias("refused"), "stored")


def engine_pages(events: DataFrame, windows_: list[tuple[int, int]], tag: str, fetched: datetime | None = None) -> DataFrame:
    """Events of January as landed pages of engine states, by the windows (first day, day after) that asked for them, fetched
    when the window was over, or at another time."""
    out = []
    for first, after in windows_:
        start, end = datetime(2024, 1, first), datetime(2024, 1, after)
        chunk = filters.owned(events, "ts", start, end).groupBy("user_id", F.floor(F.col("event_id") / 5000).alias("part")).agg(F.collect_list(F.struct(iso("ts").alias("time"), F.col("event_type").alias("value"))).alias("engineStates"))
        record = F.struct(F.col("user_id").cast("string").alias("id"), F.concat(F.lit("U"), F.col("user_id")).alias("name"), "engineStates")
        # a walk of numbered pages of one part's events, each of which names the next one's cursor; only their numbers meet in a task
        groups = chunk.groupBy("part").agg(F.collect_list(record).alias("items"))
        walk = Window.orderBy("part")
        numbers = filters.owned(events, "ts", start, end).select(F.floor(F.col("event_id") / 5000).alias("part")).distinct()
        numbers = numbers.select("part", (F.row_number().over(walk) - 1).alias("page_seq"), F.lead("part").over(walk).isNotNull().alias("more"))
        groups = groups.join(numbers, "part").select("page_seq", "more", "items")
        cursor = lambda n: F.concat(F.lit("c"), n.cast("string"))
        page = F.struct(F.when(F.col("more"), cursor(F.col("page_seq"))).otherwise("").alias("endCursor"), F.col("more").alias("hasNextPage")).alias("pagination")
        sent = F.create_map(F.lit("startTime"), F.lit(f"{start:%Y-%m-%dT%H:%M:%SZ}"), F.lit("endTime"), F.lit(f"{end:%Y-%m-%dT%H:%M:%SZ}"), F.lit("after"), F.when(F.col("page_seq") > 0, cursor(F.col("page_seq") - 1)))
        out.append(groups.select(F.lit("samsara").alias("provider"), F.lit("engine_states").alias("endpoint"), F.lit(f"{tag}-{first}").alias("chain_id"), "page_seq", sent.alias("sent_params"), F.lit(None).cast("string").alias("sent_body"), F.lit(512).alias("results_limit"), F.to_json(F.struct(F.col("items").alias("data"), page)).alias("body"), F.lit(fetched or end).cast("timestamp").alias("fetched_at")))
    return sets.concat(out)


@query("""WITH e AS (SELECT DISTINCT user_id, ts, CASE WHEN ts >= TIMESTAMP '2024-01-12' AND event_id % 5 = 0 THEN 'changed' ELSE event_type END AS value FROM events
  WHERE CASE WHEN ts < TIMESTAMP '2024-01-12' THEN event_id % 10 <> 3 WHEN ts < TIMESTAMP '2024-01-26' THEN event_id % 7 <> 0 ELSE event_id % 7 <> 0 AND event_id % 2 = 0 END AND ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-29')
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, value, count(*) AS n, (SELECT epoch_us(max(ts)) FROM (SELECT ts FROM events WHERE event_id % 7 <> 0 AND ts < TIMESTAMP '2024-01-29')) AS watermark_us FROM e GROUP BY 1, 2""")
def sync_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three syncs of a windowed dataset. The second begins two days before the watermark of the first; its pages withdraw some
    rows of these days and change others. The third finds the last three days released and fetched once more, with half of
    their rows withdrawn. What is stored of a day is what was fetched for it last, and nothing older."""
    events, root = table(spark, sf_dir, "events"), fresh_path(spark, "sync")
    policy = drive.Policy(datetime(2024, 1, 1), lookback_days=2, unit_days=7)
    landed, spec = f"{root}/landed", catalog.CATALOG["samsara.engine_states"]
    engine_pages(events.where("event_id % 10 <> 3"), [(1, 8), (8, 15)], "first").write.parquet(landed)
    pipelines.run_sync(spark, landed, root, [spec.key], now=datetime(2024, 1, 15, 5), policy=policy)
    later = events.where("event_id % 7 <> 0").withColumn("event_type", F.when(F.col("event_id") % 5 == 0, "changed").otherwise(F.col("event_type")))
    engine_pages(later, [(12, 19), (19, 26), (26, 29)], "second").write.mode("append").parquet(landed)
    pipelines.run_sync(spark, landed, root, [spec.key], now=datetime(2024, 1, 29, 5), policy=policy)
    engine_pages(later.where("event_id % 2 = 0"), [(26, 29)], "third", datetime(2024, 1, 29, 6)).write.mode("append").parquet(landed)
    done = pipelines.run_sync(spark, landed, root, [spec.key], now=datetime(2024, 1, 29, 7), policy=policy)
    rows = scans.partitioned(spark, f"{root}/{spec.provider}/{spec.name}", spec.schema.struct)
    by_date = rows.groupBy(F.col("date").cast("string").alias("date"), "value").agg(F.count("*").alias("n"))
    return by_date.withColumn("watermark_us", F.unix_micros(F.lit(done[spec.key].watermark).cast("timestamp")))


@query("""SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, count(*) AS n, '2024-01-10 data: missing, 2024-01-12 record refused: time: no TIMESTAMP' AS failed, '2024-01-13' AS waiting
FROM (SELECT DISTINCT user_id, ts, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15') WHERE dayofmonth(ts) NOT IN (10, 12, 13) GROUP BY 1""")
def sync_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A week of daily units, of which one has an error in place of its page, one a record that is refused, and one a walk that
    has not ended: the others are stored in one write, and the two that are at fault are named."""
    events, root = table(spark, sf_dir, "events"), fresh_path(spark, "faults")
    policy, landed, spec = drive.Policy(datetime(2024, 1, 8), unit_days=1), f"{root}/landed", catalog.CATALOG["samsara.engine_states"]
    pages = engine_pages(events, [(d, d + 1) for d in range(8, 15)], "x")
    day, first = F.dayofmonth("fetched_at") - 1, F.col("page_seq") == 0
    body = F.when(day == 10, '{"message":"try later"}').when((day == 12) & first, F.regexp_replace("body", '"time":"[^"]*"', '"time":"noon"')).when(day == 13, F.regexp_replace("body", r'"endCursor":"","hasNextPage":false', '"endCursor":"c","hasNextPage":true')).otherwise(F.col("body"))
    pages.withColumn("body", body).write.parquet(landed)
    now = datetime(2024, 1, 15, 5)
    try:
        pipelines.sync_windows(spark, landed, root, spec.key, now, policy)
        failed = []
    except pipelines.SyncError as error:
        failed = re.findall(r"engine_states (\S+) 00:00:00 to \S+ \S+ (data: missing|record refused: time: no TIMESTAMP)", str(error))
    left = drive.unit_states(spark, root, spec, now).where("status = 'pending'").agg(F.concat_ws(", ", F.array_sort(F.collect_list(F.date_format("chunk_start", "yyyy-MM-dd"))))).first()[0]
    rows = scans.partitioned(spark, f"{root}/{spec.provider}/{spec.name}", spec.schema.struct)
    said = ", ".join(" ".join(x) for x in failed).replace(":,", ",")
    return rows.groupBy(F.col("date").cast("string").alias("date")).agg(F.count("*").alias("n")).select("date", "n", F.lit(said).alias("failed"), F.lit(left).alias("waiting"))


@query("""WITH e AS (SELECT user_id, date_trunc('day', ts) AS s, event_id AS seq, ts, CASE event_id % 5 WHEN 0 THEN 'claimed' WHEN 1 THEN 'done' WHEN 2 THEN 'failed' WHEN 3 THEN 'claimed' ELSE 'released' END AS status,
  CASE event_id % 5 WHEN 4 THEN NULL WHEN 0 THEN event_id WHEN 3 THEN event_id ELSE (event_id * 7919) % 100000 END AS fence FROM events),
v AS (SELECT *, (SELECT min(c.seq) FROM e c WHERE c.status = 'claimed' AND c.user_id = e.user_id AND c.s = e.s AND c.fence > e.fence) < seq AS refused FROM e),
l AS (SELECT user_id, s, arg_max(status, seq) AS last, arg_max(ts, seq) AS noted, arg_max(seq, seq) FILTER (status = 'done') AS done FROM v WHERE NOT coalesce(refused, false) GROUP BY ALL)
SELECT CAST(user_id AS VARCHAR) AS endpoint, epoch_us(s) AS chunk_start_us, CASE WHEN last = 'released' OR last = 'claimed' AND noted + INTERVAL 2 DAY <= TIMESTAMP '2024-01-20' THEN 'pending' ELSE last END AS status, last = 'claimed' AND noted + INTERVAL 2 DAY <= TIMESTAMP '2024-01-20' AS expired, done AS stored_by FROM l""")
def unit_leases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of runs that claim units, report on them or crash: claims expire, and reports of runs whose unit a newer one has
    claimed in the meantime count for nothing."""
    n, day = F.col("event_id"), F.date_trunc("day", "ts")
    status = F.element_at(F.array(*map(F.lit, ("claimed", "done", "failed", "claimed", "released"))), (n % 5 + 1).cast("int"))
    fence = F.when(n % 5 == 4, F.lit(None)).when((n % 5).isin(0, 3), n).otherwise(n * 7919 % 100000)
    log = table(spark, sf_dir, "events").select(F.lit("p").alias("provider"), F.col("user_id").cast("string").alias("endpoint"), F.lit(None).cast("string").alias("partition_key"), day.alias("chunk_start"), (day + F.expr("interval 1 day")).alias("chunk_end"), n.alias("seq"), status.alias("status"), F.timestamp_micros(n).alias("observed_max"), fence.alias("fence"), (F.col("ts") + F.expr("interval 2 days")).alias("expires_at"), F.col("ts").alias("generation"))
    state = aggregates.leased_state(log, F.lit(datetime(2024, 1, 20)).cast("timestamp"))
    return state.select("endpoint", us("chunk_start"), "status", "expired", F.unix_micros("observed_max").alias("stored_by"))


HALVED = 100


@query(f"""WITH RECURSIVE t AS (SELECT epoch_us(ts) // 1000000 AS s FROM events),
w AS (SELECT CAST(1704067200 AS BIGINT) AS a, CAST(1706745600 AS BIGINT) AS b, 0 AS depth
  UNION ALL SELECT h.a, h.b, depth + 1 FROM (SELECT unnest([{{'a': a, 'b': (a + b) // 2}}, {{'a': (a + b) // 2, 'b': b}}]) AS h, depth FROM w
    WHERE depth < 4 AND (depth = 0 OR a // 3600 % 5 <> 2) AND (SELECT count(*) FROM t WHERE s >= w.a AND s < w.b) >= {HALVED}))
SELECT a * 1000000 AS window_start_us, b * 1000000 AS window_end_us FROM w WHERE NOT (depth < 4 AND (depth = 0 OR a // 3600 % 5 <> 2))""")
def halving_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What to fetch next of January from a provider that caps its pages: some windows of four levels of halving have landed,
    those with as many events as the cap came back full."""
    spec = replace(catalog.CATALOG["geotab.exception_events"], page_limit=HALVED)
    month = datetime(2024, 1, 1), datetime(2024, 2, 1)
    unit = spark.createDataFrame([(spec.provider, spec.name, None, *month, None)], f"{', '.join(drive.UNITS.split(', ')[:5])}, generation timestamp")
    level = unit.select(F.unix_seconds("chunk_start").alias("a"), F.unix_seconds("chunk_end").alias("b"), F.lit(0).alias("depth"))
    asked = [level]
    for _ in range(3):
        middle = F.floor((F.col("a") + F.col("b")) / 2).cast("long")
        level = level.select(F.explode(F.array(F.struct(F.col("a").alias("a"), middle.alias("b")), F.struct(middle.alias("a"), F.col("b").alias("b")))).alias("w"), (F.col("depth") + 1).alias("depth")).select("w.a", "w.b", "depth")
        asked.append(level)
    asked = sets.concat(asked).where("depth = 0 or floor(a / 3600) % 5 <> 2")
    # events by window: a second meets the windows of each level that it lies in
    seconds = table(spark, sf_dir, "events").groupBy(F.unix_seconds("ts").alias("s")).agg(F.count("*").alias("k"))
    counts = asked.join(seconds, (F.col("s") >= F.col("a")) & (F.col("s") < F.col("b")), "left").groupBy("a", "b", "depth").agg(F.coalesce(F.sum("k"), F.lit(0)).alias("n"))
    n = F.least(F.col("n"), F.lit(HALVED)).cast("int")
    body = F.concat(F.lit('{"result":['), F.array_join(F.array_repeat(F.lit('{"id":"x"}'), n), ","), F.lit("]}"))
    sent = requests.rpc_body("get_window", "ExceptionEvent", HALVED, F.timestamp_seconds("a"), F.timestamp_seconds("b"))
    pages = counts.select(F.lit(spec.provider).alias("provider"), F.lit(spec.name).alias("endpoint"), F.concat_ws("-", "a", "b").alias("chain_id"), F.lit(0).alias("page_seq"), F.create_map().cast("map<string,string>").alias("sent_params"), sent.alias("sent_body"), F.lit(HALVED).alias("results_limit"), body.alias("body"), F.timestamp_seconds("depth").alias("fetched_at"))
    return drive.frontier(pages, spec, unit).select(us("window_start"), us("window_end"))


@query("""WITH p AS (SELECT s_suppkey, CASE WHEN s_suppkey % 6 = 0 THEN NULL WHEN s_suppkey % 6 < 3 THEN 'never listed' WHEN s_suppkey % 6 = 3 THEN 'empty' ELSE 'too old' END AS reason, s_suppkey % 4 = 1 AS failed, s_suppkey % 3 = 1 AS keep FROM supplier)
SELECT CAST(ps AS VARCHAR) AS endpoint, reason IS NULL OR NOT failed OR reason = 'too old' AND keep AS ready, CASE WHEN reason IS NULL THEN 'fresh' WHEN NOT failed THEN 'listed anew' WHEN reason = 'too old' AND keep THEN 'the feeder failed, the old members stay' ELSE 'the feeder failed, and the roster is ' || reason END AS why
FROM (SELECT c_custkey AS ps, c_custkey % (SELECT max(s_suppkey) FROM supplier) + 1 AS k FROM customer) JOIN p ON k = s_suppkey""")
def roster_readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as datasets laid out over rosters that suppliers feed: which can go on after the due feeders were run."""
    k = F.col("s_suppkey")
    supplier = table(spark, sf_dir, "supplier").select(F.lit("p").alias("provider"), k.cast("string").alias("name"), k.cast("string").alias("feeder"), k, F.when(k % 6 == 0, None).when(k % 6 < 3, "never listed").when(k % 6 == 3, "empty").otherwise("too old").alias("reason"))
    last = supplier.agg(F.max("s_suppkey").alias("last"))
    consumers = table(spark, sf_dir, "customer").join(F.broadcast(last)).select(F.lit("p").alias("provider"), F.col("c_custkey").cast("string").alias("endpoint"), (F.col("c_custkey") % F.col("last") + 1).cast("string").alias("name"))
    policies = supplier.select("provider", "name", (k % 3 == 1).alias("keep_stale"))
    found = rosters.readiness(consumers, supplier.where("reason is not null").select("provider", "name", "feeder", "reason"), supplier.where(k % 4 == 1).select("provider", "feeder"), policies)
    return found.select("endpoint", "ready", "why")


@query("SELECT value, count(*) AS n FROM (SELECT event_type AS value FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11') GROUP BY 1")
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages, series unnest, typing, one UTC day, exact dedup, window replace, read back, count by value."""
    start, end, path = datetime(2024, 1, 10), datetime(2024, 1, 11), fresh_path(spark, "engine_states")
    events = table(spark, sf_dir, "events")
    chunk = events.groupBy("user_id", F.floor(F.col("event_id") / 5000).alias("part")).agg(F.collect_list(F.struct(iso("ts").alias("time"), F.col("event_type").alias("value"))).alias("engineStates"))
    record = F.struct(F.col("user_id").cast("string").alias("id"), F.concat(F.lit("U"), F.col("user_id")).alias("name"), "engineStates")
    pages = packed(chunk, F.pmod(F.xxhash64("user_id", "part"), F.lit(1 << 20)), record, lambda x: F.struct(x.alias("data")))
    spec = catalog.CATALOG["samsara.engine_states"]
    rows = filters.owned(typing.valid(typing.typed(decode.records(pages, spec.decode), spec.schema)), spec.event_time, start, end)
    writers.write_dataset(rows, spec, path, (start, end), dedup=False)
    return spark.read.parquet(f"{path}/{spec.provider}/{spec.name}").groupBy("value").agg(F.count("*").alias("n"))

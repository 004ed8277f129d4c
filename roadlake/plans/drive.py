"""Incremental work on windowed datasets: which units there are, which requests fetch them, and which have landed.

State is two append-only tables, a log of what happened to units and the watermarks reached; each is folded when it is
read. Requests are matched to landed pages by the parameters that were planned, whatever paging a fetcher added.

A request may be fetched again and again; each walk over its pages is a generation. A unit takes the newest whole
generation of each of its requests, of those begun after the pages of its last store were fetched: a unit that was
released waits for new pages and then holds only those.

Units are claimed under leases. Each run takes a number of its own, the fence, by creating a file that nobody else can
create; a claim names the fence and when it expires. A unit whose run died is taken up after that, and what a run reports
after a newer one took its unit over is refused.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.catalog import EndpointSpec
from roadlake.functions.scalars import text_of
from roadlake.operators import aggregates, audit, decode, filters, rosters
from roadlake.plans import bisection, requests, windows
from roadlake.sources import scans, writers
from roadlake.staging import local, staged

UNITS = "provider string, endpoint string, partition_key string, chunk_start timestamp, chunk_end timestamp, seq long, status string, observed_max timestamp, fence long, expires_at timestamp, generation timestamp, detail string"
MARKS = "provider string, endpoint string, watermark timestamp, reached_at timestamp"


@dataclass(frozen=True)
class Policy:
    """How a windowed dataset is kept current: where a cold start begins, how many days before the watermark are fetched
    again for late rows, how many days before now are left for later, how wide a unit is, and how long a claim holds."""

    default_start: datetime
    lookback_days: int = 0
    cutoff_days: int = 0
    unit_days: int = 7
    lease: timedelta = timedelta(hours=1)


def control(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    return scans.dataset(spark, f"{root}/_control/{name}", spark.createDataFrame([], schema).schema)


def of(rows: DataFrame, spec: EndpointSpec) -> DataFrame:
    return rows.where((F.col("provider") == spec.provider) & (F.col("endpoint") == spec.name))


def unit_states(spark: SparkSession, root: str, spec: EndpointSpec, now: datetime) -> DataFrame:
    return aggregates.leased_state(of(control(spark, root, "units", UNITS), spec), now)


def note(units: DataFrame, root: str, status: str, fence: int | None = None, expires_at: datetime | None = None) -> None:
    """Adds to the log what happened to units (windows.UNIT, and observed_max, generation and detail if they are known)."""
    known = lambda c, kind: F.col(c) if c in units.columns else F.lit(None).cast(kind)
    rows = units.select(*windows.UNIT, F.lit(time.time_ns()).alias("seq"), F.lit(status).alias("status"), known("observed_max", "timestamp").alias("observed_max"), F.lit(fence).cast("long").alias("fence"), F.lit(expires_at).cast("timestamp").alias("expires_at"), known("generation", "timestamp").alias("generation"), known("detail", "string").alias("detail"))
    rows.coalesce(1).write.mode("append").parquet(f"{root}/_control/units")


def take_fence(spark: SparkSession, root: str, spec: EndpointSpec) -> int:
    """A number higher than any run of the dataset has taken: whoever creates its file owns it."""
    system, place = scans.file_system(spark, f"{root}/_control/fences/{spec.provider}/{spec.name}")
    system.mkdirs(place)
    fence = max([int(x.getPath().getName()) for x in system.listStatus(place)], default=0) + 1
    while True:
        try:
            system.create(place.suffix(f"/{fence}"), False).close()
            return fence
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in str(error):
                raise
            fence += 1


class LeaseLost(RuntimeError):
    """A newer run took over units that this one was storing."""


def claim(spark: SparkSession, root: str, spec: EndpointSpec, units: DataFrame, fence: int, now: datetime, policy: Policy) -> DataFrame:
    """Claims ``units``; returns those that no run of a higher fence has claimed as well."""
    note(units, root, "claimed", fence, now + policy.lease)
    return local(units.join(held(spark, root, spec, fence, now), ["chunk_start", "chunk_end"], "left_semi"))


def held(spark: SparkSession, root: str, spec: EndpointSpec, fence: int, now: datetime) -> DataFrame:
    return unit_states(spark, root, spec, now).where((F.col("status") == "claimed") & (F.col("fence") == fence)).select(*windows.UNIT)


def require_held(spark: SparkSession, root: str, spec: EndpointSpec, units: DataFrame, fence: int, now: datetime) -> None:
    """Raises unless every one of ``units`` is still this run's: a late writer stops here, before it replaces anything."""
    if lost := units.join(held(spark, root, spec, fence, now), ["chunk_start", "chunk_end"], "left_anti").take(1):
        raise LeaseLost(f"{spec.key} {lost[0]['chunk_start']}: claimed by a newer run, or expired")


class BrokenCursor(ValueError):
    """State that can't be resumed from."""


def leftovers(spark: SparkSession, root: str, spec: EndpointSpec, now: datetime) -> DataFrame:
    """windows.UNIT, generation: units of earlier plans that are still to be stored: pending ones, those that failed, and those
    whose claim has expired, which is noted. ``generation``: pages up to then are in what is stored of the unit."""
    state = local(unit_states(spark, root, spec, now))
    if not (orphans := state.where("expired")).isEmpty():
        note(orphans.select(*windows.UNIT), root, "reset")
    return local(state.where(F.col("status").isin("pending", "failed")).select(*windows.UNIT, "generation"))


def plan(spark: SparkSession, root: str, spec: EndpointSpec, now: datetime, policy: Policy) -> DataFrame:
    """windows.UNIT, generation: the units to store, after the window that is due has been cut into units and recorded: new
    ones are enqueued, and done ones wholly inside the window are released for what came late. While an earlier unit is not
    done, the watermark stands still; then those after it are as new as they can be and stay done."""
    if spec.mode != "watermark":
        raise ValueError(f"{spec.key} has no windows")
    marks, state = of(control(spark, root, "watermarks", MARKS), spec), local(unit_states(spark, root, spec, now))
    cursors = marks.groupBy("provider", "endpoint").agg(F.max("watermark").alias("watermark"))
    named = spark.createDataFrame([(spec.provider, spec.name, spec.mode)], "provider string, endpoint string, mode string")
    kinds = cursors.select("provider", "endpoint", F.lit("watermark").alias("kind"), F.col("watermark").cast("string").alias("value"))
    if broken := filters.broken_cursors(kinds, named, F.lit(now).cast("timestamp")).take(1):
        raise BrokenCursor(f"{spec.key}: {broken[0]['reason']}: {broken[0]['value']}")
    runs = aggregates.frontier(of(control(spark, root, "runs", writers.RUNS), spec))
    row = (spec.provider, spec.name, policy.default_start, policy.lookback_days, policy.cutoff_days, spec.fixed_unit_days or policy.unit_days)
    one = spark.createDataFrame([row], "provider string, endpoint string, default_start timestamp, lookback_days int, cutoff_days int, unit_days int")
    span = local(windows.windows(one.join(cursors, windows.KEY, "left").join(runs, windows.KEY, "left"), now))
    fresh = local(windows.to_enqueue(windows.tiles(span).withColumn("partition_key", F.lit(None).cast("string")), state))
    stop = state.where("status <> 'done'").agg(F.min("chunk_start").alias("stop")).first()["stop"]
    again = windows.to_release(state if stop is None else state.where(F.col("chunk_start") < F.lit(stop)), span)
    for units, status in ((local(again), "released"), (fresh, "enqueued")):
        if not units.isEmpty():
            note(units, root, status)
    return leftovers(spark, root, spec, now)


def members_of(spark: SparkSession, root: str, spec: EndpointSpec) -> DataFrame:
    """member: the values that a dataset's requests are laid out over; one null where there is one request a unit."""
    if spec.shape == "sweep":
        return spark.createDataFrame([(x,) for x in spec.sweep[1]], "member string")
    if spec.roster is None:
        return spark.createDataFrame([(None,)], "member string")
    listed = control(spark, root, "rosters", rosters.ROSTER).where((F.col("provider") == spec.provider) & (F.col("name") == spec.roster[0]))
    return rosters.batches(listed, spec.batch_size).select(F.col("members").alias("member")) if spec.shape == "roster_batches" else listed.select("member")


def planned_requests(spark: SparkSession, root: str, spec: EndpointSpec, units: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """windows.UNIT, params (map), body (JSON-RPC or null): a row per request that an external fetcher sends for ``units``.
    Where windows are halved, those that are still to be fetched after the ``pages`` that have landed."""
    if spec.shape == "bisected" and pages is not None:
        found = frontier(pages, spec, units)
        body = requests.rpc_body(spec.request, requests.type_name(spec.name), spec.page_limit, F.col("window_start"), F.col("window_end"))
        return found.select(*windows.UNIT, F.create_map().cast("map<string,string>").alias("params"), body.alias("body"))
    each = units.select(*windows.UNIT).join(members_of(spark, root, spec).withColumn("provider", F.lit(spec.provider)), "provider")
    param = spec.roster[1] if spec.roster else spec.sweep[0] if spec.sweep else None
    if spec.provider == "geotab":
        body = requests.rpc_body(spec.request, requests.type_name(spec.name), spec.page_limit, F.col("chunk_start"), F.col("chunk_end"))
        return each.select(*windows.UNIT, F.create_map().cast("map<string,string>").alias("params"), body.alias("body"))
    return requests.plan(each, spec.request, param, pad_days=spec.pad_days).select(*windows.UNIT, "params", F.lit(None).cast("string").alias("body"))


def feed_request(spark: SparkSession, pages: DataFrame, spec: EndpointSpec, seed: datetime) -> DataFrame:
    """provider, endpoint, body: the next request of a feed, from the last version that landed, or without one from the seed."""
    version = text_of(F.try_variant_get("envelope", "$.result.toVersion", "variant"))
    tokens = windows.feed_tokens(decode.parsed(of(pages, spec)).select("provider", "endpoint", "fetched_at", "page_seq", version.alias("to_version")).where("to_version is not null"))
    one = spark.createDataFrame([(spec.provider, spec.name, seed)], "provider string, endpoint string, seed timestamp").join(tokens, windows.KEY, "left")
    return one.select(*windows.KEY, requests.rpc_body("get_feed", requests.type_name(spec.name), spec.page_limit, F.col("seed"), version=F.col("to_version")).alias("body"))


def request_key(spec: EndpointSpec, params: Column, body: Column) -> Column:
    """What names a request, also one that was sent with paging added."""
    if spec.provider == "geotab":
        return F.concat_ws("|", *[F.get_json_object(body, f"$.params.search.{x}") for x in ("fromDate", "toDate")])
    names = [*([spec.roster[1]] if spec.roster else []), *([spec.sweep[0]] if spec.sweep else []), *requests.WINDOW_PARAMS[spec.request]]
    return F.concat_ws("|", *[F.coalesce(params[x], F.lit("")) for x in names])


def named_pages(pages: DataFrame, spec: EndpointSpec) -> DataFrame:
    return pages.withColumn("key", request_key(spec, F.col("sent_params"), F.col("sent_body")))


#: Walks that have these faults alone may still be going on.
UNENDED = ["walk ends before the last page", "walk ends before the total", "walk ends on a full page", "walk ends before an empty page"]


class NoMembers(ValueError):
    """A roster without members has no requests."""


def generations(spark: SparkSession, root: str, spec: EndpointSpec, pages: DataFrame, pending: DataFrame) -> DataFrame:
    """windows.UNIT, key, chain_id, landed_at, fault: every request of the units with the walks that answer it, begun after
    the unit's generation; a row without chain where there is none, and fault null where the walk is whole.

    Which walks those are is found without bodies. Bodies of these are parsed once, into a narrow staged table, which all
    units are audited on together."""
    if spec.shape == "bisected":
        return whole_windows(pages, spec, pending)
    wanted = planned_requests(spark, root, spec, pending).select(*windows.UNIT, request_key(spec, F.col("params"), F.col("body")).alias("key"))
    wanted = staged(wanted.join(pending.select("chunk_start", "chunk_end", "generation"), ["chunk_start", "chunk_end"]))
    if spec.roster and wanted.isEmpty() and not pending.isEmpty():
        raise NoMembers(f"{spec.key}: roster {spec.roster[0]} has no members")
    walks = named_pages(pages, spec).groupBy("key", "chain_id").agg(F.min("fetched_at").alias("begun"), F.max("fetched_at").alias("landed_at"))
    fresh = F.col("generation").isNull() | (F.col("begun") > F.col("generation"))
    found = staged(wanted.join(walks, "key").where(fresh).select(*windows.UNIT, "key", "chain_id", "landed_at"))
    faults = faults_of(named_pages(pages, spec).join(found.select("key", "chain_id"), ["key", "chain_id"], "left_semi"), spec)
    told = found.join(faults, ["key", "chain_id"], "left")
    return wanted.drop("generation").join(told.select("chunk_start", "chunk_end", "key", "chain_id", "landed_at", "fault"), ["chunk_start", "chunk_end", "key"], "left")


def faults_of(pages: DataFrame, spec: EndpointSpec) -> DataFrame:
    """key, chain_id, fault: the walks at fault, with one of their faults; one that only has not ended comes last."""
    columns, walk = audit.WALKS[spec.audit] if spec.audit else (lambda _: {}, None)
    own = {"n": audit.size(".".join(spec.decode.path)), "key": F.col("key"), "fault_of_page": decode.faults(spec.decode)} | columns(".".join(spec.decode.path))
    # requests may share a chain's name
    rows = staged(audit.narrow(pages, own).withColumn("chain_id", F.struct("key", "chain_id")))
    found = rows.where("fault_of_page is not null").select("chain_id", F.col("fault_of_page").alias("fault"))
    if walk:
        found = found.unionByName(walk(rows).select("chain_id", "fault"))
    worst = F.min_by("fault", F.struct(F.col("fault").isin(*UNENDED), "fault"))
    return found.groupBy("chain_id").agg(worst.alias("fault")).select("chain_id.key", "chain_id.chain_id", "fault")


def best(found: DataFrame) -> DataFrame:
    """windows.UNIT, key, chain_id, landed_at, fault, state: of each request its newest whole walk, or none: then state says
    whether to wait for one or what is wrong with the newest that there is."""
    whole = F.col("chain_id").isNotNull() & F.col("fault").isNull()
    newest = F.max_by(F.struct("chain_id", "landed_at"), F.when(whole, F.struct(F.coalesce("landed_at", F.timestamp_seconds(F.lit(0))), "chain_id")))
    last_fault = F.max_by("fault", F.when(F.col("fault").isNotNull(), F.struct(~F.col("fault").isin(*UNENDED), "landed_at")))
    one = found.groupBy(*windows.UNIT, "key").agg(newest.alias("w"), last_fault.alias("fault"))
    state = F.when(F.col("w").isNotNull(), "whole").when(F.col("fault").isNotNull() & ~F.col("fault").isin(*UNENDED), "failed").otherwise("waiting")
    return one.select(*windows.UNIT, "key", "w.chain_id", "w.landed_at", "fault", state.alias("state"))


def verdicts(requests_: DataFrame) -> DataFrame:
    """windows.UNIT, verdict, generation, detail: ready if all requests of a unit have a whole walk, failed if one is at
    fault, else waiting. ``generation``: when the newest of its pages was fetched."""
    failed, waiting = F.count_if(F.col("state") == "failed"), F.count_if(F.col("state") == "waiting")
    verdict = F.when(failed > 0, "failed").when(waiting > 0, "waiting").otherwise("ready")
    detail = F.when(failed > 0, F.min(F.when(F.col("state") == "failed", F.concat_ws(": ", "fault", "key")))).when(waiting > 0, F.concat(waiting.cast("string"), F.lit(" requests have not landed whole")))
    return requests_.groupBy(*windows.UNIT).agg(verdict.alias("verdict"), F.max("landed_at").alias("generation"), detail.alias("detail"))


def of_units(pages: DataFrame, spec: EndpointSpec, chosen: DataFrame) -> DataFrame:
    """The pages of the walks ``chosen`` (key, chain_id, chunk_start, chunk_end), with the unit they are for as unit_start and unit_end."""
    units = chosen.select("key", "chain_id", F.col("chunk_start").alias("unit_start"), F.col("chunk_end").alias("unit_end"))
    return named_pages(pages, spec).join(units, ["key", "chain_id"]).select(*pages.columns, "unit_start", "unit_end")


def window_pages(pages: DataFrame, spec: EndpointSpec, pending: DataFrame) -> DataFrame:
    """windows.UNIT, a, b (seconds), key, chain_id, landed_at, full, fault: the newest page of each window inside a unit, of
    those fetched after the unit's generation (staged). Only their bodies are parsed."""
    sent = [F.unix_seconds(F.get_json_object("sent_body", f"$.params.search.{x}").try_cast("timestamp")).alias(c) for x, c in (("fromDate", "a"), ("toDate", "b"))]
    named = named_pages(pages, spec).select(*sent, "key", "chain_id", "fetched_at", "body").withColumn("day", F.to_date(F.timestamp_seconds("a")))
    days = F.explode(F.sequence(F.to_date("chunk_start"), F.to_date(F.col("chunk_end") - F.expr("interval 1 microsecond")))).alias("day")
    inside = (F.col("a") >= F.unix_seconds("chunk_start")) & (F.col("b") <= F.unix_seconds("chunk_end"))
    fresh = F.col("generation").isNull() | (F.col("fetched_at") > F.col("generation"))
    met = named.join(pending.select(*windows.UNIT, "generation", days), "day").where(inside & fresh)
    full = F.coalesce(audit.size(".".join(spec.decode.path)), F.lit(0)) >= spec.page_limit
    told = staged(decode.parsed(met).select(*windows.UNIT, "a", "b", "key", "chain_id", "fetched_at", full.alias("full"), decode.faults(spec.decode).alias("fault")))
    last = F.max_by(F.struct("key", "chain_id", F.col("fetched_at").alias("landed_at"), "full", "fault"), F.struct("fetched_at", "chain_id"))
    return staged(told.groupBy(*windows.UNIT, "a", "b").agg(last.alias("p")).select(*windows.UNIT, "a", "b", "p.*"))


def reached_windows(pages: DataFrame, spec: EndpointSpec, pending: DataFrame) -> DataFrame:
    """windows.UNIT, a, b, key, chain_id, landed_at, full, fault: every window that halving has come to, from the unit itself down.
    One that has no page, or whose page is older than that of a window it lies in, has none (chain_id null)."""
    landed = window_pages(pages, spec, pending)
    unit = [F.unix_seconds("chunk_start"), F.unix_seconds("chunk_end")]
    # the way down from the unit to a landed window; every window on it but the last has to be full, and none older than the one above
    way = landed.select(*windows.UNIT, "a", "b", F.posexplode(bisection.way_down(*unit, F.col("a"), F.col("b"))).alias("depth", "w"))
    above = landed.select(*windows.UNIT, F.struct("a", "b").alias("w"), F.col("landed_at").alias("at"), F.col("full").alias("was_full"))
    key = ["provider", "endpoint", "chunk_start", "chunk_end"]
    steps = way.join(above.drop("partition_key"), [*key, "w"], "left").groupBy(*key, "a", "b").agg(F.array_sort(F.collect_list(F.struct("depth", "at", "was_full"))).alias("steps"))
    rising = F.forall(F.zip_with(F.slice("steps", 1, F.size("steps") - 1), F.slice("steps", 2, F.size("steps") - 1), lambda x, y: x["was_full"] & (x["at"] <= y["at"])), lambda ok: F.coalesce(ok, F.lit(False)))
    current = landed.join(steps.where(F.coalesce((F.size("steps") == 1) | rising, F.lit(False))).select(*key, "a", "b"), [*key, "a", "b"], "left_semi")
    current = staged(current)
    middle = F.floor((F.col("a") + F.col("b")) / 2).cast("long")
    halves = F.explode(F.array(F.struct(F.col("a").alias("a"), middle.alias("b")), F.struct(middle.alias("a"), F.col("b").alias("b")))).alias("w")
    reached = pending.select(*windows.UNIT, F.struct(unit[0].alias("a"), unit[1].alias("b")).alias("w")).unionByName(current.where("full and fault is null").where(F.col("b") - F.col("a") > bisection.FLOOR_SECONDS).select(*windows.UNIT, halves))
    return reached.select(*windows.UNIT, "w.a", "w.b").join(current.drop("partition_key"), [*key, "a", "b"], "left")


def frontier(pages: DataFrame, spec: EndpointSpec, pending: DataFrame) -> DataFrame:
    """windows.UNIT, window_start, window_end: the windows to fetch next of a dataset whose windows are halved until none is
    full: units of which nothing has landed, and halves, at the whole second in the middle, of windows that came back full.
    A full window as narrow as the floor raises TooDense."""
    open_ = staged(reached_windows(pages, spec, pending))
    narrow = open_.where("full").agg(F.min(F.col("b") - F.col("a")).alias("width")).first()["width"]
    if narrow is not None and narrow <= bisection.FLOOR_SECONDS:
        raise bisection.TooDense(f"{spec.key}: a window of {narrow} seconds still came back full")
    return open_.where("chain_id is null or fault is not null").select(*windows.UNIT, F.timestamp_seconds("a").alias("window_start"), F.timestamp_seconds("b").alias("window_end"))


def whole_windows(pages: DataFrame, spec: EndpointSpec, pending: DataFrame) -> DataFrame:
    """generations() where windows are halved: the requests of a unit are the windows that halving has come to and that are
    not full; together they cover it."""
    found = staged(reached_windows(pages, spec, pending))
    label = lambda c: F.date_format(F.timestamp_seconds(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    dense = F.coalesce(F.col("full") & (F.col("b") - F.col("a") <= bisection.FLOOR_SECONDS), F.lit(False))
    found = found.withColumn("fault", F.when(dense, "a window of the least width came back full").otherwise(F.col("fault"))).where("not coalesce(full, false) or fault is not null")
    return found.select(*windows.UNIT, F.coalesce("key", F.concat_ws("|", label("a"), label("b"))).alias("key"), "chain_id", "landed_at", "fault")


def reached(spark: SparkSession, root: str, spec: EndpointSpec) -> datetime | None:
    """The watermark."""
    return of(control(spark, root, "watermarks", MARKS), spec).agg(F.max("watermark")).first()[0]


def advance(spark: SparkSession, root: str, spec: EndpointSpec, now: datetime) -> datetime | None:
    """Moves the watermark to the latest event time of the units done before the first that is not; returns it."""
    before = reached(spark, root, spec)
    found = aggregates.done_prefix(unit_states(spark, root, spec, now)).first()
    if found and (before is None or found["observed_max"] > before):
        writers.append_rows(spark, [{"provider": spec.provider, "endpoint": spec.name, "watermark": found["observed_max"], "reached_at": datetime.now(UTC)}], MARKS, f"{root}/_control/watermarks")
        return found["observed_max"]
    return before

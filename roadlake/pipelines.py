"""From landed pages to stored datasets: one dataset in each of its three ways, or many, feeders first."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.catalog import CATALOG, ROSTERS, EndpointSpec, RosterPolicy
from roadlake.operators import audit, decode, rosters, typing
from roadlake.operators.aggregates import grained, last_success, members
from roadlake.operators.filters import in_window, owned
from roadlake.operators.sets import unswept
from roadlake.plans import drive
from roadlake.sources import scans, writers
from roadlake.staging import local, staged
from roadlake.streaming import feed



def typed_rows(pages: DataFrame, spec: EndpointSpec, strict: bool = True) -> DataFrame:
    """Valid rows of a dataset's pages; lazy. ``strict``: a malformed page, or a record with errors, fails the job that meets it."""
    return typing.valid(typing.typed(decode.records(pages, spec.decode, strict), spec.schema), strict)


def read_snapshot(spark: SparkSession, landed: str, endpoint: str, form: str = "parquet") -> DataFrame:
    """A snapshot dataset as a typed DataFrame, without storing anything; no pages give no rows of its columns. A page that
    is no page of the dataset, such as an error in its place, fails the job, as an empty result would look like an empty fleet."""
    spec = CATALOG[endpoint]
    if spec.mode != "snapshot":
        raise ValueError(f"{endpoint} is no snapshot; it needs a window or a stream")
    return typed_rows(scans.pages(spark, landed, spec.provider, spec.name, form), spec)


def stored(spark: SparkSession, root: str, endpoint: str) -> DataFrame:
    """A stored dataset with its column date, if it has one; rollups have their grain (aggregates.rollup)."""
    spec = CATALOG[endpoint]
    read = scans.dataset if spec.layout == "single" else scans.partitioned
    rows = read(spark, f"{root}/{spec.provider}/{spec.name}", spec.schema.struct)
    return grained(rows, spec.fixed_unit_days) if spec.fixed_unit_days else rows


def processed(pages: DataFrame, spec: EndpointSpec, window: tuple[datetime, datetime] | None = None) -> DataFrame:
    """Decoded, typed and, for a window, owned rows."""
    rows = typed_rows(pages, spec)
    return owned(rows, spec.event_time, *window) if window else rows


def require_complete(pages: DataFrame, spec: EndpointSpec, expected: int | None = None) -> None:
    """Refuses malformed envelopes, walks with holes, pages at a silent cap, unfinished sweeps and wrong counts, before
    anything is written. Bodies are parsed once for all of it, into a narrow staged table."""
    records = ".".join(spec.decode.path)
    columns, faults = audit.WALKS[spec.audit] if spec.audit else (lambda _: {}, None)
    own = {"n": audit.size(records)} | columns(records) | {"fault_of_page": decode.faults(spec.decode)}
    if spec.sweep:
        own["swept"] = F.col("sent_params")[spec.sweep[0]]
    rows = staged(audit.narrow(pages, own))
    decode.require_no_faults(rows.where("fault_of_page is not null").withColumnRenamed("fault_of_page", "fault"))
    if faults:
        audit.require_none(faults(rows))
    if spec.shape == "bisected":
        audit.require_none(audit.overflowing(rows, spec.page_limit))
    if spec.sweep:  # the audit has found every chain finished
        audit.require_none(unswept(rows.select(F.create_map(F.lit(spec.sweep[0]), "swept").alias("sent_params"), F.lit(True).alias("finished")), *spec.sweep))
    if spec.count_check and expected is not None:
        harvested = rows.groupBy("provider", "endpoint").agg(F.sum("n").alias("harvested"))
        wanted = pages.sparkSession.createDataFrame([(spec.provider, spec.name, expected)], "provider string, endpoint string, expected_count long")
        audit.require_none(audit.miscounted(harvested, wanted))


def ingest(spark: SparkSession, landed: str, root: str, endpoint: str, window: tuple[datetime, datetime] | None = None, expected: int | None = None, form: str = "parquet", dedup: bool = True, pages: DataFrame | None = None) -> writers.WriteReport | None:
    """Stores one dataset: a snapshot whole, a windowed one by its dates, a feed as a stream of what has landed since.
    ``pages``: of a windowed dataset, those to store instead of all that have landed.

    The run is recorded as running, the data is written, and the run is recorded as ended, so a crash in between leaves a
    trace, repeats work and loses none. A run that fails is recorded as failed and raises.
    """
    spec, began = CATALOG[endpoint], datetime.now(UTC)
    run = {"run_id": uuid.uuid4().hex, "provider": spec.provider, "endpoint": spec.name, "mode": spec.mode, "started_at": began}
    run |= {"window_start": window[0], "window_end": window[1]} if window else {}
    writers.append_rows(spark, [run | {"status": "running"}], writers.RUNS, f"{root}/_control/runs")
    report = None
    try:
        if spec.mode == "feed":
            feed.start(spark, landed, root, spec, form).awaitTermination()
        else:
            own = scans.pages(spark, landed, spec.provider, spec.name, form) if pages is None else pages
            require_complete(own, spec, expected)
            report = writers.write_dataset(processed(own, spec, window), spec, root, window, dedup)
            for policy in ROSTERS:
                if (policy.provider, policy.feeder) == (spec.provider, spec.name):
                    refresh_roster(spark, root, policy)
        run |= {"status": "succeeded", "row_count": report.rows_written if report else 0, "report": str(report) if report else None}
        return report
    except Exception as error:
        run |= {"status": "failed", "error_detail": f"{type(error).__name__}: {str(error)[:500]}"}
        raise
    finally:
        writers.append_rows(spark, [run | {"ended_at": datetime.now(UTC)}], writers.RUNS, f"{root}/_control/runs")


def refresh_roster(spark: SparkSession, root: str, policy: RosterPolicy) -> None:
    """Reconciles the roster that a stored feeder dataset lists, as its policy says. The roster is written as a new version
    that takes the old one's place."""
    path, feeder = f"{root}/_control/rosters", CATALOG[f"{policy.provider}.{policy.feeder}"]
    stored = scans.dataset(spark, path, spark.createDataFrame([], rosters.ROSTER).schema)
    rows = scans.dataset(spark, f"{root}/{feeder.provider}/{feeder.name}", feeder.schema.struct)
    listed = members(rows, policy.column).select(F.lit(policy.provider).alias("provider"), F.lit(policy.name).alias("name"), "member")
    rosters.require_listed(listed)
    policies = spark.createDataFrame([(policy.provider, policy.name, policy.evict_after)], "provider string, name string, evict_after int")
    new = writers.fresh(path)
    rosters.applied(stored, rosters.reconcile(stored, listed, policies)).write.parquet(new)
    writers.swap(spark, new, path)


def due_rosters(spark: SparkSession, root: str, now: datetime) -> DataFrame:
    """provider, name, feeder, reason: the rosters whose feeder has to be listed anew before requests are laid out over them."""
    policies = spark.createDataFrame([(x.provider, x.name, x.feeder, x.max_age_days) for x in ROSTERS], "provider string, name string, feeder string, max_age_days int")
    stored = drive.control(spark, root, "rosters", rosters.ROSTER)
    return rosters.due(policies, last_success(drive.control(spark, root, "runs", writers.RUNS)), stored, now)


@dataclass
class Synced:
    """What a sync of a windowed dataset did: the windows stored, with the report of the one write that stored them, the units
    that wait for pages, with the reason, and the watermark after it."""

    stored: list[tuple[datetime, datetime, writers.WriteReport]]
    waiting: list[tuple[datetime, datetime, str]]
    watermark: datetime | None


SIDE = ["chunk_start", "chunk_end"]


def unit_rows(pages: DataFrame, spec: EndpointSpec, chosen: DataFrame) -> DataFrame:
    """unit_start, unit_end, the dataset's columns and errors: the rows of chosen walks, those that their unit owns and those
    with errors (staged)."""
    records = decode.records(drive.of_units(pages, spec, chosen), spec.decode)
    rows = typing.typed(records, spec.schema, ["unit_start", "unit_end"])
    return staged(rows.where((F.size("errors") > 0) | in_window(F.col(spec.event_time), F.col("unit_start"), F.col("unit_end"))))


def joined(units: DataFrame) -> list[tuple[datetime, datetime]]:
    """The windows of ``units``, those that follow one another as one. Units of one dataset: at most a row a day."""
    spans: list[tuple[datetime, datetime]] = []
    for start, end in units.select(*SIDE).orderBy(*SIDE).collect():
        spans[-1:] = [(spans[-1][0], end)] if spans and spans[-1][1] == start else [*spans[-1:], (start, end)]
    return spans


def sync_windows(spark: SparkSession, landed: str, root: str, endpoint: str, now: datetime, policy: drive.Policy, form: str = "parquet") -> Synced:
    """Brings a windowed dataset up to date: units that earlier plans have left over come first and move the watermark; then
    the window that is due is planned from there, and its units are stored as far as their pages have landed. Failed units
    stay to be done, hold the watermark, and are raised at the end."""
    spec, began = CATALOG[endpoint], datetime.now(UTC)
    clock = lambda: now + (datetime.now(UTC) - began)
    pages, fence = scans.pages(spark, landed, spec.provider, spec.name, form), drive.take_fence(spark, root, spec)
    done, failed = Synced([], [], drive.reached(spark, root, spec)), {}
    old = drive.leftovers(spark, root, spec, now)
    for pending in (lambda: old, lambda: drive.plan(spark, root, spec, now, policy).join(old.select(*SIDE), SIDE, "left_anti")):
        if not (units := local(pending())).isEmpty():
            stored, waiting, wrong = store_units(spark, root, spec, pages, units, fence, clock, policy)
            done.stored += stored
            done.waiting += waiting
            failed |= wrong
            done.watermark = drive.advance(spark, root, spec, clock())
    done.waiting.sort()
    if failed:
        raise SyncError("; ".join(f"{endpoint} {a} to {b}: {detail[:200]}" for (a, b), detail in sorted(failed.items())))
    return done


def store_units(spark: SparkSession, root: str, spec: EndpointSpec, pages: DataFrame, pending: DataFrame, fence: int, clock: Callable[[], datetime], policy: drive.Policy) -> tuple[list, list, dict]:
    """(windows stored, units that wait, what is wrong with failed ones) of ``pending``.

    The landed pages of all units are audited in one pass, which gives each unit a verdict of its own: ready, waiting for
    pages, or failed. Ready ones are claimed and their rows typed; a unit with a refused record fails by itself. The dates of
    all good units are stored in one write, if this run still holds their leases, and each is marked done with what it held.
    """
    walks = staged(drive.best(drive.generations(spark, root, spec, pages, pending)))
    units = local(drive.verdicts(walks))
    waiting = [tuple(r) for r in units.where("verdict = 'waiting'").select(*SIDE, "detail").collect()]
    failed = {(r["chunk_start"], r["chunk_end"]): r["detail"] for r in units.where("verdict = 'failed'").collect()}
    run = {"run_id": uuid.uuid4().hex, "provider": spec.provider, "endpoint": spec.name, "mode": spec.mode, "started_at": datetime.now(UTC)}
    log = lambda spans, **more: writers.append_rows(spark, [run | {"window_start": a, "window_end": b} | more for a, b in spans], writers.RUNS, f"{root}/_control/runs")
    spans, report = [], None
    if failed:
        drive.note(units.where("verdict = 'failed'"), root, "failed")
    ready = units.where("verdict = 'ready'")
    if not ready.isEmpty() and not (ready := drive.claim(spark, root, spec, ready, fence, clock(), policy)).isEmpty():
        rows = unit_rows(pages, spec, walks.join(ready.select(*SIDE), SIDE, "left_semi")).withColumnsRenamed({"unit_start": "chunk_start", "unit_end": "chunk_end"})
        broken = local(rows.where(F.size("errors") > 0).groupBy(*SIDE).agg(F.min(F.concat(F.lit("record refused: "), F.concat_ws("; ", "errors"))).alias("detail")))
        if wrong := {(r["chunk_start"], r["chunk_end"]): r["detail"] for r in broken.collect()}:
            failed |= wrong
            drive.note(ready.drop("detail").join(broken, SIDE), root, "failed", fence)
        good = local(ready.join(broken, SIDE, "left_anti"))
        spans = joined(good)
    if failed:
        log(failed, status="failed", ended_at=datetime.now(UTC), error_detail="; ".join(sorted(set(failed.values())))[:500])
    if spans:
        log(spans, status="running")
        try:
            drive.require_held(spark, root, spec, good, fence, clock())
            kept = rows.where(F.size("errors") == 0).join(good.select(*SIDE), SIDE, "left_semi").drop(*SIDE, "errors")
            sizes = {r["date"]: r["n"] for r in kept.groupBy(F.to_date(spec.event_time).alias("date")).agg(F.count("*").alias("n")).collect()}  # a row a date
            report = writers.write_spans(kept, spec, root, spans, fence=fence, sizes=sizes)
        except Exception as error:
            log(spans, status="failed", ended_at=datetime.now(UTC), error_detail=f"{type(error).__name__}: {str(error)[:500]}")
            if not isinstance(error, drive.LeaseLost):
                drive.note(good, root, "failed", fence)
            raise
        tops = rows.where(F.size("errors") == 0).groupBy(*SIDE).agg(F.max(spec.event_time).alias("observed_max"))
        drive.note(good.join(tops, SIDE, "left"), root, "done", fence)
        log(spans, status="succeeded", ended_at=datetime.now(UTC), row_count=report.rows_written, report=str(report))
    return [(a, b, report) for a, b in spans], waiting, failed


class SyncError(RuntimeError):
    """Datasets that failed; the others are stored."""


def run_sync(spark: SparkSession, landed: str, root: str, endpoints: Iterable[str], windows: dict[str, tuple[datetime, datetime]] | None = None, form: str = "parquet", now: datetime | None = None, policy: drive.Policy | None = None) -> dict[str, writers.WriteReport | Synced | None]:
    """Stores many datasets in the order in which they need each other: what lists a roster comes before what is laid out over
    it, and is listed anew, once, if the roster is due, whether it was asked for or not. A dataset whose roster is due and
    could not be listed goes on with the members known so far, or is held back, as the roster's policy says.

    Windowed datasets take the window given for them, or with ``policy`` are brought up to ``now`` (sync_windows). A failure
    does not stop the others; all are raised together."""
    names, now, done, failed = set(endpoints), now or datetime.now(UTC), {}, {}

    def store(name: str) -> None:
        try:
            if policy and CATALOG[name].mode == "watermark" and name not in (windows or {}):
                done[name] = sync_windows(spark, landed, root, name, now, policy, form)
            else:
                done[name] = ingest(spark, landed, root, name, (windows or {}).get(name), form=form)
        except Exception as error:
            failed[name] = error

    planned = [CATALOG[x] for x in sorted(names) if CATALOG[x].roster and policy and x not in (windows or {})]
    consumers = spark.createDataFrame([(x.provider, x.name, x.roster[0]) for x in planned], "provider string, endpoint string, name string")
    due = local(due_rosters(spark, root, now).join(consumers.select("provider", "name").distinct(), ["provider", "name"], "left_semi")) if planned else None
    feeders = {f"{r['provider']}.{r['feeder']}" for r in due.collect()} if planned else set()
    for name in sorted({x for x in names if CATALOG[x].feeds} | feeders):
        store(name)
    held = {}
    if planned:
        wrong = spark.createDataFrame([tuple(x.split(".")) for x in feeders if x in failed], "provider string, feeder string")
        keep = spark.createDataFrame([(x.provider, x.name, x.keep_stale) for x in ROSTERS], "provider string, name string, keep_stale boolean")
        held = {f"{r['provider']}.{r['endpoint']}": r["why"] for r in rosters.readiness(consumers, due, wrong, keep).where("not ready").collect()}
    for name in sorted(x for x in names if not CATALOG[x].feeds):
        if name in held:
            failed[name] = HeldBack(held[name])
        else:
            store(name)
    writers.project_metadata(spark.read.parquet(f"{root}/_control/runs"), root)
    if failed:
        raise SyncError("; ".join(f"{k}: {type(e).__name__}: {str(e)[:200]}" for k, e in sorted(failed.items())))
    return done


class HeldBack(RuntimeError):
    """A dataset that was not begun, as what it needs is not there."""

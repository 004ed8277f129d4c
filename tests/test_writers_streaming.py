import json
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from roadlake import catalog, pipelines
from roadlake.operators import audit, rosters
from roadlake.plans import bisection, drive, windows
from roadlake.sources import scans, writers
from roadlake.staging import staged
from roadlake.streaming import feed

JAN = [datetime(2026, 1, d) for d in range(1, 12)]


def events(spark, *days, version=1):
    rows = [(k, datetime(2026, 1, d, 5), version) for k, d in enumerate(days)]
    return spark.createDataFrame(rows, "id long, ts timestamp, version int")


def stored(spark, path):
    return sorted((r["date"].day, r["version"]) for r in spark.read.parquet(path).collect())


def test_window_replace_prunes_and_keeps_history(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    writers.replace_window(events(spark, 1, 2, 3, 4), path, "ts", JAN[0], JAN[4])
    report = writers.replace_window(events(spark, 2, 2, version=2), path, "ts", JAN[1], JAN[3])
    assert stored(spark, path) == [(1, 1), (2, 2), (2, 2), (4, 1)]
    assert (report.rows_written, report.deleted_partitions, report.files_written) == (2, ["2026-01-03"], 1)
    again = writers.replace_window(events(spark, 2, 2, version=2), path, "ts", JAN[1], JAN[3])
    assert stored(spark, path) == [(1, 1), (2, 2), (2, 2), (4, 1)] and again.deleted_partitions == []


def test_window_replace_without_rows_clears_the_window_only(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    writers.replace_window(events(spark, 1, 2, 3), path, "ts", JAN[0], JAN[3])
    report = writers.replace_window(events(spark).limit(0), path, "ts", JAN[1], JAN[2])
    assert stored(spark, path) == [(1, 1), (3, 1)] and report.deleted_partitions == ["2026-01-02"]


def test_row_outside_the_window_leaves_everything_as_it_was(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    writers.replace_window(events(spark, 1, 2), path, "ts", JAN[0], JAN[2])
    with pytest.raises(writers.OutOfWindow):
        writers.replace_window(events(spark, 2, 9, version=2), path, "ts", JAN[1], JAN[2])
    assert stored(spark, path) == [(1, 1), (2, 1)]


def test_exact_duplicates_are_counted(spark, tmp_path):
    rows = events(spark, 1)
    report = writers.replace_window(rows.unionAll(rows), f"file://{tmp_path}/t", "ts", JAN[0], JAN[1])
    assert (report.rows_written, report.duplicates_dropped, report.observed_max) == (1, 1, datetime(2026, 1, 1, 5))
    kept = writers.replace_window(rows.unionAll(rows), f"file://{tmp_path}/u", "ts", JAN[0], JAN[1], dedup=False)
    assert kept.rows_written == 2


def test_failed_snapshot_keeps_the_old_one(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    writers.replace_snapshot(events(spark, 1, 2), path)
    bad = events(spark, 3).withColumn("id", F.raise_error(F.lit("bad record")).cast("long"))
    with pytest.raises(Exception, match="bad record"):
        writers.replace_snapshot(bad, path)
    assert spark.read.parquet(path).count() == 2
    writers.replace_snapshot(events(spark, 3), path)
    assert spark.read.parquet(path).count() == 1


def test_append_refuses_null_event_times_whole(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    assert writers.append(events(spark, 1, 2), path, "ts").files_written == 2
    with pytest.raises(Exception, match="no event time"):
        writers.append(events(spark, 1).unionAll(spark.createDataFrame([(9, None, 1)], "id long, ts timestamp, version int")), path, "ts")
    assert spark.read.parquet(path).count() == 2
    writers.append(events(spark, 1, 2), path, "ts")
    assert spark.read.parquet(path).count() == 4


def test_single_table_window_replace(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    writers.replace_single_window(events(spark, 1, 2, 3), path, "ts", JAN[0], JAN[3])
    writers.replace_single_window(events(spark, 2, version=2), path, "ts", JAN[1], JAN[3])
    assert sorted((r["ts"].day, r["version"]) for r in spark.read.parquet(path).collect()) == [(1, 1), (2, 2)]


def test_a_date_with_a_third_of_the_rows_is_split(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    rows = spark.range(60_000).select("id", F.when(F.col("id") % 3 == 0, F.lit(JAN[0])).otherwise(F.timestamp_seconds(F.lit(1767225600) + F.col("id") % 10 * 86_400)).alias("ts"), F.uuid().alias("x"))
    changed = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k", "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10k"}
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        writers.replace_window(rows.repartition(16), path, "ts", JAN[0], JAN[10])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = {d: len(list((tmp_path / "t" / f"date=2026-01-{d:02d}").glob("*.parquet"))) for d in range(1, 11)}
    assert files[1] > 2, files
    assert spark.read.parquet(path).count() == 60_000
    report = writers.append(rows.limit(100).coalesce(1), path, "ts")
    assert report.rows_written == 100 and report.files_written == 10


def test_a_crash_between_the_renames_of_a_swap_loses_nothing(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    schema = events(spark).schema
    writers.replace_snapshot(events(spark, 1, 2), path)
    (tmp_path / "t").rename(tmp_path / "t-old")
    assert scans.dataset(spark, path, schema).count() == 2
    writers.replace_snapshot(events(spark, 3), path)
    assert scans.dataset(spark, path, schema).count() == 1 and not (tmp_path / "t-old").exists()


def test_partitioned_scan_reads_only_the_dates_asked_for(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    writers.replace_window(events(spark, 1, 2, 3, 4), path, "ts", JAN[0], JAN[4])
    found = scans.partitioned(spark, path, events(spark).schema).where(F.col("date") == F.lit("2026-01-02").cast("date"))
    assert [r["ts"].day for r in found.collect()] == [2]
    assert "PartitionFilters: [isnotnull(date" in found._jdf.queryExecution().toString()


def engine_pages(spark, landed, windows, days, version, fetched=None, more=False, body=None):
    """A page per window that asks for its own days, and holds a reading for each of ``days``."""
    rows = []
    for start, end in windows:
        readings = [{"time": f"2026-01-{d:02d}T12:00:00Z", "value": f"{version}"} for d in days if start <= d < end]
        told = {"data": [{"id": "7", "name": "n", "externalIds": {}, "engineStates": readings}], "pagination": {"endCursor": "x" if more else "", "hasNextPage": more}}
        sent = {"startTime": f"2026-01-{start:02d}T00:00:00Z", "endTime": f"2026-01-{end:02d}T00:00:00Z", "limit": "512"}
        rows.append(("samsara", "engine_states", f"{start}-{end}-{version}", 0, sent, None, 512, body or json.dumps(told), fetched or datetime(2026, 1, end, tzinfo=UTC)))
    spark.createDataFrame(rows, scans.PAGE).write.mode("append").parquet(landed)


SYNCED = "samsara.engine_states"


def synced(spark, tmp_path, day, **policy):
    policy = drive.Policy(datetime(2026, 1, 1), **{"unit_days": 2} | policy)
    return pipelines.sync_windows(spark, f"file://{tmp_path}/landed", f"file://{tmp_path}/root", SYNCED, datetime(2026, 1, day, 5), policy)


def readings(spark, tmp_path):
    stored = scans.dataset(spark, f"file://{tmp_path}/root/samsara/engine_states", catalog.CATALOG[SYNCED].schema.struct)
    return sorted((r["time"].day, r["value"]) for r in stored.collect())


def days_of(spans):
    return [(x[0].day, x[1].day) for x in spans]


def test_sync_resumes_from_the_done_prefix(spark, tmp_path):
    landed, root = f"file://{tmp_path}/landed", f"file://{tmp_path}/root"
    got, sync = lambda: readings(spark, tmp_path), lambda day: synced(spark, tmp_path, day, lookback_days=1)
    engine_pages(spark, landed, [(1, 3), (5, 7)], [1, 2, 5, 6], "a")
    first = sync(7)
    assert days_of(first.stored) == [(1, 3), (5, 7)] and days_of(first.waiting) == [(3, 5)]
    # the unit that has not landed holds the watermark
    assert first.watermark == datetime(2026, 1, 2, 12) and got() == [(1, "a"), (2, "a"), (5, "a"), (6, "a")]
    # a walk that has not ended is waited for
    engine_pages(spark, landed, [(3, 5)], [3], "cut", more=True)
    second = sync(7)
    # the lookback has released the first unit, which waits for new pages and keeps its rows
    assert second.stored == [] and days_of(second.waiting) == [(1, 3), (3, 5)] and len(got()) == 4
    engine_pages(spark, landed, [(1, 3), (3, 5)], [1, 2, 3, 4], "b", datetime(2026, 1, 7, 6, tzinfo=UTC))
    third = sync(7)
    # what was left over moves the watermark, from which the next window is planned
    assert third.watermark == datetime(2026, 1, 6, 12) and days_of(third.stored) == [(1, 5)] and days_of(third.waiting) == [(5, 7)]
    assert got() == [(1, "b"), (2, "b"), (3, "b"), (4, "b"), (5, "a"), (6, "a")]
    # a refetch replaces: day 5 was withdrawn, day 6 changed, and late rows of the lookback day come with the next window
    fourth = sync(9)
    assert fourth.stored == [] and days_of(fourth.waiting) == [(5, 7), (7, 9)]
    engine_pages(spark, landed, [(5, 7), (7, 9)], [6, 7, 8], "c", datetime(2026, 1, 9, 6, tzinfo=UTC))
    fifth = sync(9)
    assert fifth.watermark == datetime(2026, 1, 8, 12)
    assert got() == [(1, "b"), (2, "b"), (3, "b"), (4, "b"), (6, "c"), (7, "c"), (8, "c")]
    runs = spark.read.parquet(f"{root}/_control/runs").groupBy("status").count().collect()
    assert {r["status"]: r["count"] for r in runs} == {"running": 4, "succeeded": 4}


def test_a_unit_at_fault_fails_by_itself(spark, tmp_path):
    landed = f"file://{tmp_path}/landed"
    engine_pages(spark, landed, [(d, d + 1) for d in range(1, 9) if d not in (3, 6)], range(1, 9), "a")
    engine_pages(spark, landed, [(3, 4)], [], "bad", body='{"error": "try later"}')
    wrong = {"data": [{"id": "7", "name": "n", "externalIds": {}, "engineStates": [{"time": "noon", "value": "x"}]}], "pagination": {"endCursor": "", "hasNextPage": False}}
    engine_pages(spark, landed, [(6, 7)], [], "wrong", body=json.dumps(wrong))
    with pytest.raises(pipelines.SyncError, match="2026-01-03.*data: missing.*2026-01-06.*record refused: time"):
        synced(spark, tmp_path, 9, unit_days=1)
    assert [d for d, _ in readings(spark, tmp_path)] == [1, 2, 4, 5, 7, 8]
    # the units at fault are mended by newer pages
    engine_pages(spark, landed, [(3, 4), (6, 7)], [3, 6], "b", datetime(2026, 1, 9, 6, tzinfo=UTC))
    assert synced(spark, tmp_path, 9, unit_days=1).watermark == datetime(2026, 1, 8, 12)
    assert [d for d, v in readings(spark, tmp_path) if v == "b"] == [3, 6]


def test_a_claim_of_a_dead_run_expires_and_its_late_report_is_refused(spark, tmp_path):
    landed, root, spec = f"file://{tmp_path}/landed", f"file://{tmp_path}/root", catalog.CATALOG[SYNCED]
    policy = drive.Policy(datetime(2026, 1, 1), unit_days=2, lease=timedelta(hours=2))
    now = datetime(2026, 1, 5, 5)
    dead = drive.take_fence(spark, root, spec)
    units = drive.plan(spark, root, spec, now, policy)
    assert drive.claim(spark, root, spec, units, dead, now, policy).count() == 2
    engine_pages(spark, landed, [(1, 3), (3, 5)], [1, 2, 3, 4], "a")
    # while the lease holds nobody else takes the units
    early = pipelines.sync_windows(spark, landed, root, SYNCED, now + timedelta(hours=1), policy)
    assert early.stored == [] and early.watermark is None
    late = pipelines.sync_windows(spark, landed, root, SYNCED, now + timedelta(hours=3), policy)
    assert days_of(late.stored) == [(1, 5)] and late.watermark == datetime(2026, 1, 4, 12)
    units = staged(drive.unit_states(spark, root, spec, now).where("status = 'done'").select(*windows.UNIT))
    with pytest.raises(drive.LeaseLost):
        drive.require_held(spark, root, spec, units, dead, now)
    drive.note(units, root, "failed", dead)
    assert drive.unit_states(spark, root, spec, now).where("status = 'done'").count() == units.count() == 2
    assert drive.take_fence(spark, root, spec) > dead


def test_requests_and_rosters_of_a_plan(spark, tmp_path):
    root, spec = f"file://{tmp_path}/root", catalog.CATALOG["samsara.trips"]
    members = [("samsara", "vehicle_ids", x, 0) for x in ("1", "2")]
    spark.createDataFrame(members, rosters.ROSTER).write.parquet(f"{root}/_control/rosters")
    pending = drive.plan(spark, root, spec, datetime(2026, 1, 3), drive.Policy(datetime(2026, 1, 1), unit_days=1))
    asked = drive.planned_requests(spark, root, spec, pending)
    start = 1767225600000
    assert sorted((r["params"]["vehicleId"], int(r["params"]["startMs"]) - start) for r in asked.collect()) == [(m, d * 86_400_000) for m in "12" for d in (0, 1)]
    pages = spark.createDataFrame([("samsara", "trips", "c", 0, {"vehicleId": m, "startMs": str(start), "endMs": str(start + 86_400_000)}, None, 0, '{"trips": []}', None) for m in "12"], scans.PAGE)
    for landed, want in ((pages, [1]), (pages.where("sent_params['vehicleId'] = '1'"), [])):
        units = drive.verdicts(drive.best(drive.generations(spark, root, spec, landed, pending)))
        assert [r["chunk_start"].day for r in units.where("verdict = 'ready'").collect()] == want and units.count() == 2
    with pytest.raises(drive.NoMembers):
        drive.generations(spark, f"{root}-none", spec, pages, pending)
    due = {(r["provider"], r["reason"]) for r in pipelines.due_rosters(spark, root, datetime(2026, 1, 3)).collect()}
    assert due == {("samsara", "never listed"), ("motive", "never listed")}
    feed_spec = catalog.CATALOG["geotab.log_records"]
    page = lambda version: spark.createDataFrame([("geotab", "log_records", "c", 0, {}, None, 1, json.dumps({"result": {"data": [], "toVersion": version}}), datetime.now(UTC))], scans.PAGE)
    bodies = [drive.feed_request(spark, x, feed_spec, datetime(2026, 1, 1)).first()["body"] for x in (page("v7").limit(0), page("v7"))]
    assert '"fromDate":"2026-01-01T00:00:00Z"' in bodies[0] and '"fromVersion":"v7"' in bodies[1] and '"typeName":"LogRecord"' in bodies[1]


def test_windows_at_the_cap_are_halved_until_they_cover_the_unit(spark, tmp_path):
    spec = catalog.CATALOG["geotab.exception_events"]
    units = spark.createDataFrame([("geotab", "exception_events", None, JAN[0], JAN[1], None)], "provider string, endpoint string, partition_key string, chunk_start timestamp, chunk_end timestamp, generation timestamp")

    def page(start, end, n, hour=0, body=None):
        sent = json.dumps({"params": {"search": {"fromDate": f"2026-01-{start}Z", "toDate": f"2026-01-{end}Z"}}})
        return ("geotab", "exception_events", f"{start}-{hour}", 0, {}, sent, 5000, body or json.dumps({"result": [{"id": str(k)} for k in range(n)]}), datetime(2026, 1, 3, hour, tzinfo=UTC))

    frame = lambda *rows: spark.createDataFrame(rows, scans.PAGE)
    hours = lambda rows: sorted((r["window_start"].strftime("%dT%H:%M"), r["window_end"].strftime("%dT%H:%M")) for r in rows.collect())
    next_ = lambda *rows: hours(drive.frontier(frame(*rows), spec, units))
    full, first, last = page("01T00:00:00", "02T00:00:00", 5000), page("01T00:00:00", "01T12:00:00", 4000, 1), page("01T12:00:00", "02T00:00:00", 4999, 1)
    with pytest.raises(audit.WalkError, match="as full as the cap"):
        pipelines.require_complete(frame(full), spec)
    assert next_(page("05T00:00:00", "06T00:00:00", 1)) == [("01T00:00", "02T00:00")]
    assert next_(full) == [("01T00:00", "01T12:00"), ("01T12:00", "02T00:00")]
    assert next_(full, first) == [("01T12:00", "02T00:00")] and next_(full, first, last) == []
    assert next_(full, first, page("01T12:00:00", "02T00:00:00", 5000, 1)) == [("01T12:00", "01T18:00"), ("01T18:00", "02T00:00")]
    # halves without the full window above them, and windows that halving does not come to, count for nothing
    assert next_(first, page("01T01:00:00", "01T02:00:00", 5, 1)) == [("01T00:00", "02T00:00")]
    # a refetch of the whole window makes the halves before it old
    assert next_(full, first, last, page("01T00:00:00", "02T00:00:00", 5000, 2)) == [("01T00:00", "01T12:00"), ("01T12:00", "02T00:00")]
    assert next_(full, first, last, page("01T00:00:00", "02T00:00:00", 7, 2)) == []
    assert next_(full, first, page("01T12:00:00", "02T00:00:00", 0, 1, '{"error": {}}')) == [("01T12:00", "02T00:00")]
    narrow = [full, *[page(f"01T{a}", f"01T{b}", 5000, 1) for a, b in NARROW]]
    with pytest.raises(bisection.TooDense):
        drive.frontier(frame(*narrow), spec, units)
    bodies = [r["body"] for r in drive.planned_requests(spark, "", spec, units, frame(full, first)).collect()]
    assert len(bodies) == 1 and '"fromDate":"2026-01-01T12:00:00Z","toDate":"2026-01-02T00:00:00Z"' in bodies[0]
    # what covers the unit is stored: the parts that are not full, each once
    for pages, want in (((full,), "waiting"), ((full, first), "waiting"), ((full, first, last), "ready"), (narrow, "failed")):
        found = drive.best(drive.generations(spark, "", spec, frame(*pages), units))
        assert [r["verdict"] for r in drive.verdicts(found).collect()] == [want]
    chosen = drive.best(drive.generations(spark, "", spec, frame(full, first, last), units))
    assert sorted(r["chain_id"] for r in drive.of_units(frame(full, first, last), spec, chosen).collect()) == ["01T00:00:00-1", "01T12:00:00-1"]
    later = units.withColumn("generation", F.lit(datetime(2026, 1, 3, 1)))
    assert hours(drive.frontier(frame(full, first, last), spec, later)) == [("01T00:00", "02T00:00")]


#: Down to less than a minute, from midnight on.
NARROW = [("00:00:00", b) for b in ("12:00:00", "06:00:00", "03:00:00", "01:30:00", "00:45:00", "00:22:30", "00:11:15", "00:05:37", "00:02:48", "00:01:24", "00:00:42")]


def test_absent_dataset_is_empty(spark, tmp_path):
    spec = catalog.CATALOG["samsara.trips"]
    assert scans.dataset(spark, f"file://{tmp_path}/none", spec.schema.struct).count() == 0


LOGS = "geotab.log_records"


def log_page(spark, folder, *records, seq=0, chain="c", sent=None, version=None, limit=50_000, body=None):
    told = {"result": {"data": [{"id": i, "dateTime": t, "device": {"id": "d"}, "latitude": 1, "longitude": 2, "speed": 3} for i, t in records], "toVersion": version or f"v{seq + 1}"}}
    params = {"params": {"fromVersion": sent or f"v{seq}"}} if sent or seq else {"params": {"search": {}}}
    rows = [("geotab", "log_records", chain, seq, {}, json.dumps(params), limit, body or json.dumps(told), datetime(2026, 1, 1, seq, tzinfo=UTC))]
    spark.createDataFrame(rows, scans.PAGE).coalesce(1).write.mode("append").json(folder)


def test_feed_stream_resumes_and_reruns_add_nothing(spark, tmp_path):
    landed, root, spec = f"file://{tmp_path}/landed", f"file://{tmp_path}/root", catalog.CATALOG[LOGS]
    log_page(spark, landed, ("a", "2026-01-01T00:00:00Z"), ("b", "2026-01-02T00:00:00Z"))
    for more in (False, False, True):
        if more:
            log_page(spark, landed, ("late", "2020-01-01T00:00:00Z"), seq=1)
        feed.start(spark, landed, root, spec).awaitTermination()
    got = spark.read.parquet(f"{root}/geotab/log_records")
    assert sorted(r["id"] for r in got.collect()) == ["a", "b", "late"]
    assert feed.last_page(spark, root, spec) == "v2"


def test_feed_observer_sees_batches_and_bad_records_stop_the_stream(spark, tmp_path):
    landed, root, spec, seen = f"file://{tmp_path}/landed", f"file://{tmp_path}/root", catalog.CATALOG[LOGS], []
    log_page(spark, landed, ("a", "2026-01-01T00:00:00Z"))
    feed.start(spark, landed, root, spec, observer=lambda batch, n: seen.append((n, batch.count()))).awaitTermination()
    assert seen == [(0, 1)] and spark.read.parquet(f"{root}/geotab/log_records").count() == 1
    log_page(spark, landed, ("b", "yesterday"), seq=1)
    with pytest.raises(Exception, match="record refused"):
        feed.start(spark, landed, root, spec).awaitTermination()
    assert spark.read.parquet(f"{root}/geotab/log_records").count() == 1


@pytest.mark.parametrize("page, fault", [
    ({"body": '{"error": {"message": "no"}}'}, "c/1: result: missing"),
    ({"body": "<html>"}, "c/1: body: not JSON"),
    ({"sent": "v8"}, "c/1: asked from version v8, the page before ends with v1"),
    ({"version": "v1", "limit": 1}, "c/1: feed stalled"),
    ({"version": ""}, "c/1: asked from|c/1: result.toVersion|c/2"),
])
def test_a_broken_feed_stops_before_its_batch_and_goes_on_once_mended(spark, tmp_path, page, fault):
    landed, root, spec = f"file://{tmp_path}/landed", f"file://{tmp_path}/root", catalog.CATALOG[LOGS]
    log_page(spark, landed, ("a", "2026-01-01T00:00:00Z"))
    pipelines.ingest(spark, landed, root, LOGS, form="json")
    if page.get("version") == "":
        page = {"body": json.dumps({"result": {"data": []}})}
    log_page(spark, f"{landed}-bad", ("b", "2026-01-01T00:00:00Z"), seq=1, **page)
    bad = [x for x in (tmp_path / "landed-bad").glob("*.json")]
    target = tmp_path / "landed" / bad[0].name
    bad[0].rename(target)
    with pytest.raises(Exception, match=fault):
        pipelines.ingest(spark, landed, root, LOGS, form="json")
    assert spark.read.parquet(f"{root}/geotab/log_records").count() == 1 and feed.last_page(spark, root, spec) == "v1"
    assert [r["status"] for r in spark.read.parquet(f"{root}/_control/runs").where("ended_at is not null").orderBy("ended_at").collect()] == ["succeeded", "failed"]
    # the page is mended in its place
    log_page(spark, f"{landed}-good", ("b", "2026-01-01T00:00:00Z"), seq=1)
    (tmp_path / "landed" / f".{bad[0].name}.crc").unlink(missing_ok=True)
    next((tmp_path / "landed-good").glob("*.json")).rename(target)
    log_page(spark, landed, ("c", "2026-01-03T00:00:00Z"), seq=2)
    pipelines.ingest(spark, landed, root, LOGS, form="json")
    assert sorted(r["id"] for r in spark.read.parquet(f"{root}/geotab/log_records").collect()) == ["a", "b", "c"]


def test_snapshot_of_an_error_page_fails(spark, tmp_path):
    rows = [("samsara", "vehicles", "c", 0, {}, None, 512, body, datetime.now(UTC)) for body in ('{"data": []}', '{"message": "no"}')]
    spark.createDataFrame(rows[:1], scans.PAGE).write.parquet(f"file://{tmp_path}/empty")
    assert pipelines.read_snapshot(spark, f"file://{tmp_path}/empty", "samsara.vehicles").count() == 0
    spark.createDataFrame(rows[1:], scans.PAGE).write.parquet(f"file://{tmp_path}/error")
    with pytest.raises(Exception, match="page refused: data: missing .samsara/vehicles/c/0"):
        pipelines.read_snapshot(spark, f"file://{tmp_path}/error", "samsara.vehicles").collect()


def test_sync_stores_feeders_first_and_collects_failures(spark, tmp_path):
    landed, root = f"file://{tmp_path}/landed", f"file://{tmp_path}/root"
    vehicle = {"id": "7", "name": "n", "notes": "x", "harshAccelerationSettingType": "h", "vehicleRegulationMode": "r", "createdAtTime": "2026-01-01T00:00:00Z", "updatedAtTime": "2026-01-01T00:00:00Z"}
    state = {"id": "7", "name": "n", "externalIds": {}, "engineStates": [{"time": "2026-01-01T12:00:00Z", "value": "On"}, {"time": "2026-01-05T12:00:00Z", "value": "Off"}]}
    last = {"endCursor": "", "hasNextPage": False}
    bodies = {"vehicles": {"data": [vehicle], "pagination": last}, "engine_states": {"data": [state], "pagination": last}, "addresses": {"data": [], "pagination": {"endCursor": "x", "hasNextPage": True}}}
    rows = [("samsara", k, "c", 0, {}, None, 512, json.dumps(b), datetime.now(UTC)) for k, b in bodies.items()]
    spark.createDataFrame(rows, scans.PAGE).write.parquet(landed)
    names = [f"samsara.{x}" for x in bodies]
    with pytest.raises(pipelines.SyncError, match="samsara.addresses: WalkError"):
        pipelines.run_sync(spark, landed, root, names, {"samsara.engine_states": (JAN[0], JAN[1])})
    assert spark.read.parquet(f"{root}/samsara/engine_states").count() == 1
    assert [(r["member"], r["absence_count"]) for r in spark.read.parquet(f"{root}/_control/rosters").collect()] == [("7", 0)]
    rows = spark.read.parquet(f"{root}/_control/runs").collect()
    assert sorted(r["endpoint"] for r in rows if r["status"] == "running") == ["addresses", "engine_states", "vehicles"]
    runs = {r["endpoint"]: r["status"] for r in rows if r["status"] != "running"}
    assert runs == {"vehicles": "succeeded", "engine_states": "succeeded", "addresses": "failed"}
    assert pipelines.read_snapshot(spark, landed, "samsara.vehicles").count() == 1
    with pytest.raises(ValueError, match="no snapshot"):
        pipelines.read_snapshot(spark, landed, "samsara.engine_states")


def test_a_due_roster_is_listed_anew_before_its_consumers(spark, tmp_path):
    landed, root, policy = f"file://{tmp_path}/landed", f"file://{tmp_path}/root", drive.Policy(datetime(2026, 1, 1), unit_days=2)
    vehicle = {"id": "7", "name": "n", "notes": "x", "harshAccelerationSettingType": "h", "vehicleRegulationMode": "r", "createdAtTime": "2026-01-01T00:00:00Z", "updatedAtTime": "2026-01-01T00:00:00Z"}
    last = {"endCursor": "", "hasNextPage": False}
    page = lambda chain, **body: ("samsara", "vehicles", chain, 0, {}, None, 512, json.dumps({"pagination": last} | body), datetime.now(UTC))
    sync = lambda where: pipelines.run_sync(spark, f"{landed}/{where}", root, ["samsara.trips"], now=datetime.now(UTC), policy=policy)
    spark.createDataFrame([page("a", error=1)], scans.PAGE).write.parquet(f"{landed}/bad")
    with pytest.raises(pipelines.SyncError, match="samsara.trips: HeldBack: the feeder failed, and the roster is never listed; samsara.vehicles: EnvelopeError"):
        sync("bad")
    assert not (tmp_path / "root/_control/units").exists()
    spark.createDataFrame([page("a", data=[vehicle])], scans.PAGE).write.parquet(f"{landed}/good")
    done = sync("good")
    assert set(done) == {"samsara.vehicles", "samsara.trips"} and done["samsara.trips"].stored == [] and done["samsara.trips"].waiting
    # it is fresh now, so the feeder is left alone
    assert set(sync("good")) == {"samsara.trips"}

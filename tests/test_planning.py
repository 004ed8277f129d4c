from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from roadlake import catalog
from roadlake.operators import aggregates, audit, rosters
from roadlake.plans import bisection, requests, windows

D = lambda d, h=0: datetime(2026, 1, d, h)


def test_resume_precedence_and_caught_up(spark):
    rows = [("p", "a", D(10, 5), D(3), D(1), 2, 1), ("p", "b", None, D(3), D(1), 2, 1), ("p", "c", None, None, D(1, 7), 2, 1), ("p", "d", None, D(20), D(1), 0, 1)]
    ends = spark.createDataFrame(rows, "provider string, endpoint string, watermark timestamp, frontier timestamp, default_start timestamp, lookback_days int, cutoff_days int")
    got = {r["endpoint"]: (r["window_start"], r["window_end"]) for r in windows.windows(ends, D(12, 9)).collect()}
    assert got == {"a": (D(8), D(11)), "b": (D(3), D(11)), "c": (D(1), D(11))}
    assert [r["endpoint"] for r in windows.caught_up(ends, D(12, 9)).collect()] == ["d"]


def test_tiles_are_contiguous_and_refuse_other_hours(spark):
    span = spark.createDataFrame([("p", "a", D(1), D(11), 4)], "provider string, endpoint string, window_start timestamp, window_end timestamp, unit_days int")
    got = [(r["chunk_start"].day, r["chunk_end"].day) for r in windows.tiles(span).orderBy("chunk_start").collect()]
    assert got == [(1, 5), (5, 9), (9, 11)]
    with pytest.raises(Exception, match="midnight"):
        windows.tiles(span.withColumn("window_start", F.col("window_start") + F.expr("interval 1 hour"))).collect()


def test_enqueue_compares_null_keys(spark):
    schema = "provider string, endpoint string, partition_key string, chunk_start timestamp, chunk_end timestamp"
    known = spark.createDataFrame([("p", "a", None, D(1), D(2)), ("p", "a", "k", D(1), D(2))], schema)
    planned = known.unionAll(spark.createDataFrame([("p", "a", None, D(2), D(3))], schema))
    assert windows.to_enqueue(planned, known).count() == 1


def test_done_prefix_is_blind_to_gaps(spark):
    rows = [("p", "a", D(1), "done", D(1, 5)), ("p", "a", D(3), "done", D(3, 5)), ("p", "a", D(4), "failed", None), ("p", "a", D(5), "done", D(5, 5)), ("p", "b", D(1), "pending", None)]
    units = spark.createDataFrame(rows, "provider string, endpoint string, chunk_start timestamp, status string, observed_max timestamp")
    assert [(r["endpoint"], r["observed_max"]) for r in aggregates.done_prefix(units).collect()] == [("a", D(3, 5))]


def test_watermark_moves_forward_only(spark):
    stored = spark.createDataFrame([("p", "a", D(5)), ("p", "b", D(5))], "provider string, endpoint string, watermark timestamp")
    seen = spark.createDataFrame([("p", "a", D(3)), ("p", "b", D(7)), ("p", "c", D(1)), ("p", "d", None)], "provider string, endpoint string, observed_max timestamp")
    assert {r["endpoint"]: r["watermark"] for r in windows.advanced(stored, seen).collect()} == {"a": D(5), "b": D(7), "c": D(1)}


def test_roster_hysteresis(spark):
    schema = "provider string, name string, member string, absence_count int"
    stored = spark.createDataFrame([("p", "r", "stays", 0), ("p", "r", "back", 2), ("p", "r", "away", 1), ("p", "r", "gone", 3), ("p", "other", "x", 1)], schema)
    listed = spark.createDataFrame([("p", "r", m) for m in ("stays", "back", "new", "", None)], "provider string, name string, member string")
    policies = spark.createDataFrame([("p", "r", 3)], "provider string, name string, evict_after int")
    delta = rosters.reconcile(stored, listed, policies)
    assert {r["member"]: (r["action"], r["absence_count"]) for r in delta.collect()} == {"stays": ("keep", 0), "back": ("zero", 0), "new": ("zero", 0), "away": ("increment", 2), "gone": ("evict", 4)}
    assert {r["member"]: r["absence_count"] for r in rosters.applied(stored, delta).collect()} == {"stays": 0, "back": 0, "new": 0, "away": 2, "x": 1}
    never = rosters.reconcile(stored, listed, policies.withColumn("evict_after", F.lit(None).cast("int")))
    assert never.where("action = 'evict'").count() == 0
    with pytest.raises(rosters.EmptyListing):
        rosters.require_listed(listed.where("member = ''"))


def test_batches_refuse_commas(spark):
    members = spark.createDataFrame([("p", "r", m) for m in ("c", "a", "b")], "provider string, name string, member string")
    assert {r["batch"]: r["members"] for r in rosters.batches(members, 2).collect()} == {0: "a,b", 1: "c"}
    with pytest.raises(Exception, match="comma"):
        rosters.batches(members.withColumn("member", F.lit("a,b")), 2).collect()


def brute(events, start, end, limit, floor):
    hits = sum(a < end and (b is None or b >= start) for a, b in events)
    if hits < limit:
        return [(start, end, hits)]
    if end - start <= floor:
        raise bisection.TooDense
    middle = (start + end) // 2
    return brute(events, start, middle, limit, floor) + brute(events, middle, end, limit, floor)


def test_capped_windows_match_brute_force(spark):
    base = int(datetime(2026, 1, 1, tzinfo=UTC).timestamp())
    events = [(base + k * 97 % 5000, None if k % 50 == 0 else base + k * 97 % 5000 + k % 60) for k in range(400)]
    rows = spark.createDataFrame(events, "a long, b long").select(F.timestamp_seconds("a").alias("active_from"), F.timestamp_seconds("b").alias("active_to"))
    begin, finish = datetime.fromtimestamp(base, UTC), datetime.fromtimestamp(base + 5000, UTC)
    got = bisection.capped_windows(rows, begin, finish, 60, 10)
    found = sorted((int(r["a"]), int(r["b"]), r["n"]) for r in got.select(F.unix_seconds("window_start").alias("a"), F.unix_seconds("window_end").alias("b"), "n").collect())
    assert found == sorted(brute(events, base, base + 5000, 60, 10))
    assert bisection.owned_by_leaf(rows, got).count() == 400
    with pytest.raises(bisection.TooDense):
        bisection.capped_windows(rows, begin, finish, 5, 600)


def test_dense_windows_are_leaves_if_they_are_kept(spark):
    base = int(datetime(2026, 1, 1, 0, 50, tzinfo=UTC).timestamp())
    seconds = [base + 900] * 30 + [base + k * 10 for k in range(300)]
    rows = spark.createDataFrame([(s,) for s in seconds], "a long").select(F.timestamp_seconds("a").alias("active_from"), F.timestamp_seconds("a").alias("active_to"))
    begin, finish = datetime.fromtimestamp(base, UTC), datetime.fromtimestamp(base + 5000, UTC)
    got = bisection.capped_windows(rows, begin, finish, 20, 60, dense="keep")
    leaves = sorted((r["window_start"].timestamp(), r["window_end"].timestamp(), r["n"]) for r in got.collect())
    assert leaves[0][0] == base and leaves[-1][1] == base + 5000 and all(a[1] == b[0] for a, b in zip(leaves, leaves[1:]))
    assert [b - a <= 60 for a, b, n in leaves if n >= 20] == [True]
    assert bisection.owned_by_leaf(rows, got).count() == 330


def test_request_parameters(spark):
    row = spark.range(1).select(F.lit(D(1)).cast("timestamp").alias("a"), F.lit(D(3)).cast("timestamp").alias("b"), F.lit("v1").alias("v"))
    one = lambda c: row.select(c.alias("x")).first()["x"]
    a, b = F.col("a"), F.col("b")
    assert one(requests.parameters("date_labels", a, b)) == {"start_date": "2026-01-01", "end_date": "2026-01-02"}
    assert one(requests.parameters("date_labels", a, b, 1)) == {"start_date": "2025-12-31", "end_date": "2026-01-03"}
    assert one(requests.parameters("epoch_millis", a, b)) == {"startMs": "1767225600000", "endMs": "1767398400000"}
    assert one(requests.rpc_body("get_feed", "LogRecord", 9, a)) == '{"method":"GetFeed","params":{"typeName":"LogRecord","search":{"fromDate":"2026-01-01T00:00:00Z"},"resultsLimit":9}}'
    assert one(requests.rpc_body("get_feed", "LogRecord", 9, None, None, F.col("v"))) == '{"method":"GetFeed","params":{"typeName":"LogRecord","fromVersion":"v1","resultsLimit":9}}'
    assert one(requests.rpc_body("get_sorted", "User", 9)) == '{"method":"Get","params":{"typeName":"User","resultsLimit":9,"sort":{"sortBy":"id","sortDirection":"asc","offset":null}}}'


def test_stalled_feed(spark):
    rows = [("p", "e", "c", k, {"fromVersion": v} if v else {}, 1, '{"result":{"data":[{}],"toVersion":"v1"}}') for k, v in enumerate([None, "v1"])]
    pages = spark.createDataFrame(rows, "provider string, endpoint string, chain_id string, page_seq int, sent_params map<string,string>, results_limit int, body string")
    assert [r["fault"] for r in audit.feed_walk(pages).collect()] == ["feed stalled: a full page did not move the version"]


def test_catalog_rules():
    with pytest.raises(ValueError, match="event time"):
        catalog.EndpointSpec("geotab", "audits", "feed", catalog.FEED, "nope")
    with pytest.raises(ValueError, match="roster exactly"):
        catalog.EndpointSpec("samsara", "trips", "watermark", catalog.FEED, "start_time", shape="roster")
    assert catalog.Endpoints.samsara.trips is catalog.CATALOG["samsara.trips"]
    assert len(catalog.available("feed")) == 14

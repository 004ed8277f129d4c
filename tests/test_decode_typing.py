import json

import pytest
from pyspark.sql import functions as F

from roadlake import catalog, queries, schema
from roadlake.functions import scalars as S
from roadlake.operators import decode, typing
from roadlake.sources.scans import PAGE

PAGES = "provider string, endpoint string, chain_id string, page_seq int, sent_params map<string,string>, body string"


def pages(spark, *bodies, sent=None, spec=None):
    provider, endpoint = (spec.provider, spec.name) if spec else ("p", "e")
    return spark.createDataFrame([(provider, endpoint, "c", k, sent or {}, b if isinstance(b, str) else json.dumps(b)) for k, b in enumerate(bodies)], PAGES)


def rows(spark, key, *bodies, sent=None):
    spec = catalog.CATALOG[key]
    return typing.typed(decode.records(pages(spark, *bodies, sent=sent, spec=spec), spec.decode), spec.schema)


def test_all_schemas_load_and_name_their_columns_once():
    assert len(catalog.SPECS) == 38
    assert sum(len(x.schema.fields) for x in catalog.SPECS) == 803
    assert {x.mode for x in catalog.SPECS} == set(catalog.MODES)
    assert sum(f.enum is not None for x in catalog.SPECS for f in x.schema.fields) == 4


def test_schema_refuses_duplicates_and_unknown_types():
    with pytest.raises(TypeError, match="twice"):
        schema.parse("x", "a STRING -\nb STRING - as a")
    with pytest.raises(TypeError, match="no supported leaf"):
        schema.parse("x", "a MAP<STRING,STRING> -")


def test_snake_case():
    names = {"dateTime": "date_time", "isHOSAllowed": "is_hos_allowed", "isUIAllowed": "is_ui_allowed", "samsara.vin": "samsara_vin", "id": "id"}
    assert {k: schema.snake(k) for k in names} == names


def test_series_rows_take_identity_and_empty_series_give_none(spark):
    body = {"data": [{"id": "1", "name": " T ", "externalIds": {"samsara.serial": "S"}, "engineStates": [{"time": "2026-01-01T12:00:03.062Z", "value": "On"}, {"time": "2026-01-01T14:00:03+02:00", "value": "  "}]}, {"id": "2", "name": "U"}, {"id": "3", "name": "V", "engineStates": []}]}
    got = rows(spark, "samsara.engine_states", body).collect()
    assert [(r["vehicle_id"], r["vehicle_name"], r["vehicle_serial"], r["vehicle_vin"], r["value"]) for r in got] == [("1", "T", "S", None, "On"), ("1", "T", "S", None, None)]
    assert all(r["errors"] == [] for r in got)


def test_stamp_wins_over_the_record(spark):
    got = rows(spark, "samsara.trips", {"trips": [{"vehicleId": "1", "startMs": 1767225600123}]}, sent={"vehicleId": "77"}).first()
    assert got["vehicle_id"] == "77" and got["start_time"].microsecond == 123000


def test_epoch_millis_refuse_text_fractions_and_booleans(spark):
    for bad in ("1767225600123", 1.5, True):
        got = rows(spark, "samsara.trips", {"trips": [{"startMs": bad}]}).first()
        assert got["start_time"] is None and "startMs: no TIMESTAMP epochms" in got["errors"]


def test_references_may_be_bare_and_id_lists_are_exact(spark):
    body = {"result": {"data": [{"id": "a", "dateTime": "2026-01-01T00:00:00Z", "driver": "UnknownDriverId", "version": "1", "annotations": ["x", {"id": "y"}]}, {"id": "b", "dateTime": "2026-01-01T00:00:00", "driver": {"id": "d"}, "version": "1", "annotations": [{"id": "y", "z": 1}]}], "toVersion": "1"}}
    one, two = rows(spark, "geotab.duty_status_logs", body).collect()
    assert (one["driver__id"], one["annotations"], one["errors"]) == ("UnknownDriverId", ["x", "y"], [])
    assert two["driver__id"] == "d" and two["date_time"] is None and len(two["errors"]) == 2


def test_required_in_an_optional_block(spark):
    base = {"id": "a", "dateTime": "2026-01-01T00:00:00Z", "driver": "d", "version": "1"}
    body = {"result": {"data": [base, base | {"location": {"location": {"x": 1}}}]}}
    absent, half = rows(spark, "geotab.duty_status_logs", body).collect()
    assert absent["errors"] == [] and half["errors"] == ["location.location.y: missing"]


def test_enum_and_quoted_numbers_and_empty_int(spark):
    got = rows(spark, "motive.vehicles", {"vehicles": [{"vehicle": {"id": "7", "company_id": 7.0, "number": "n", "status": "gone", "ifta": "yes", "group_ids": [1, "2"]}}]}).first()
    assert got["vehicle_id"] == 7 and got["company_id"] == 7 and got["ifta"] is True and got["group_ids"] == [1, 2]
    assert "status: not in the closed set" in got["errors"]


def test_field_names_are_taken_beside_wire_names(spark):
    got = rows(spark, "geotab.audits", {"result": {"data": [{"date_time": "2026-01-01T00:00:00Z", "user_name": "u", "id": "1", "version": "2"}]}}).first()
    assert got["user_name"] == "u" and got["date_time"] is not None and got["errors"] == []


def test_strict_rows_fail_and_lenient_rows_split(spark):
    typed = rows(spark, "geotab.audits", {"result": {"data": [{"id": "1"}, {"id": "2", "version": "2", "dateTime": "2026-01-01T00:00:00Z"}]}})
    assert [r["id"] for r in typing.valid(typed, strict=False).collect()] == ["2"]
    assert {(r["error"], r["n"]) for r in typing.error_counts(typed).collect()} == {("dateTime: missing", 1), ("version: missing", 1)}
    with pytest.raises(Exception, match="record refused: dateTime: missing; version: missing"):
        typing.valid(typed).collect()


def test_structure_faults_name_shapes(spark):
    how = decode.Decode(("orders",), item="order")
    bad = decode.bad_pages(pages(spark, "{", "[]", {"a": 1}, {"orders": {}}, {"orders": [1]}, {"orders": [{"x": 1}]}, {"orders": [{"order": {"a": 1}}]}), how)
    faults = {r["page_seq"]: r["fault"] for r in bad.collect()}
    assert sorted(faults) == [0, 1, 2, 3, 4, 5]
    assert faults[0] == "body: not JSON" and faults[2] == "orders: missing" and faults[3] == "orders: array expected, found OBJECT"
    with pytest.raises(decode.EnvelopeError, match="not JSON"):
        decode.require_good_pages(pages(spark, "{"), how)


def test_no_pages_give_typed_zero_rows(spark):
    spec = catalog.CATALOG["geotab.devices"]
    got = typing.valid(typing.typed(decode.records(spark.createDataFrame([], PAGE), spec.decode), spec.schema))
    assert got.schema.fieldNames() == spec.schema.struct.fieldNames() and got.count() == 0
    assert [f.dataType for f in got.schema] == [f.dataType for f in spec.schema.struct]


def test_pages_of_engine_states_stay_small(spark):
    events = spark.range(60_000).select(F.col("id").alias("event_id"), F.lit("2024-01-02").cast("timestamp").alias("ts"), (F.col("id") % 7).alias("user_id"), F.lit("on").alias("event_type"))
    pages = queries.engine_pages(events, [(1, 8)], "t").select("page_seq", F.regexp_count("body", F.lit('"time"')).alias("n"), F.get_json_object("body", "$.pagination.hasNextPage").alias("more"))
    assert sorted(map(tuple, pages.collect())) == [(k, 5_000, "true" if k < 11 else "false") for k in range(12)]


def test_lax_booleans_and_members_of_other_spellings(spark):
    words = ["oN", "TRUE", "Y", "off", "False", "nO", "\x00yes", "onn", "ﬀ"]
    rows = spark.createDataFrame([(w,) for w in words], "w string").select(S.boolean(F.parse_json(F.to_json(F.struct("w"))).cast("variant")).alias("none"), S.boolean(F.try_variant_get(F.parse_json(F.to_json(F.struct("w"))), "$.w", "variant")).alias("b"))
    assert [r["b"] for r in rows.collect()] == [True, True, True, False, False, False, None, None, None]
    own = schema.parse("x.y", "ID STRING - as one\ndeviceId STRING - as two\ndriver.licenseNo STRING -")
    made = spark.createDataFrame([('{"ID":"a","device_id":"b","driver":{"license_no":"c"}}',), ('{"id":"a","driver":null}',)], "j string")
    records = made.select(F.parse_json("j").alias("record"), F.lit(None).cast("map<string,string>").alias("stamped"), F.lit(None).cast("map<string,variant>").alias("identity"))
    assert [tuple(r) for r in typing.valid(typing.typed(records, own)).collect()] == [("a", "b", "c"), ("a", None, None)]

import pytest
from pyspark.sql import functions as F

from roadlake.functions import scalars as S


def apply(spark, fn, values, kind="string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"x {kind}").select(fn(F.col("x"))).collect()]


def test_timespans(spark):
    good = {"00:05:01": 301_000_000, "00:03:42.3630000": 222_363_000, "4.16:41:16": 405_676_000_000, "00:00:00.1234567": 123_456, "00:00:00.5": 500_000}
    assert apply(spark, S.timespan_micros, good) == list(good.values())
    assert apply(spark, lambda x: S.interval_to_micros(S.timespan(x)), good) == list(good.values())
    assert set(apply(spark, S.timespan_micros, ["-00:00:01", "", "24:00:00", "00:60:00", "0:00:00", "00:00:00.", "00:00:00.12345678", "x"])) == {None}


def test_date_labels_and_iso(spark):
    assert [x is not None for x in apply(spark, S.date_label, ["2026-07-19", "20260719", "2026-W29-1", "2026-07-19T00:00:00Z", "2026-02-30"])] == [True, False, False, False, False]
    got = apply(spark, lambda x: F.unix_micros(S.iso_timestamp(x)), ["2026-01-01T00:00:00Z", "2026-01-01T02:00:00.5+02:00", "2026-01-01T00:00:00"])
    assert got == [1767225600000000, 1767225600500000, None]


def test_to_iso_drops_what_is_below_a_second(spark):
    assert apply(spark, lambda x: S.to_iso(x.cast("timestamp")), ["2026-01-01 00:00:01.999"]) == ["2026-01-01T00:00:01Z"]


@pytest.mark.parametrize(
    ("fn", "cases"),
    [
        (S.whole_number, {"3": 3, "3.0": 3, '"2022"': 2022, '" 7 "': 7, '"7.0"': 7, "true": 1, "3.5": None, '"abc"': None, '""': None, "null": None, "[]": None}),
        (S.number, {"3": 3.0, "2.5": 2.5, '"2.5"': 2.5, "false": 0.0, '"x"': None, "{}": None, "1e3": 1000.0}),
        (S.boolean, {"true": True, "1": True, "0": False, '"Yes"': True, '"off"': False, "2": None, '"maybe"': None}),
        (lambda v: S.coerced(v, "STRING"), {'" a "': "a", "3": None, "true": None, '" b "': "b"}),
    ],
)
def test_lax_coercion(spark, fn, cases):
    assert apply(spark, lambda x: fn(F.parse_json(x)), cases) == list(cases.values())

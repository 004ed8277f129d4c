"""The 38 datasets: how each is decoded, typed, planned and written."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from roadlake import schema
from roadlake.operators.decode import Decode

MODES = ("snapshot", "watermark", "feed")
SHAPES = ("single", "roster", "roster_batches", "sweep", "bisected")


@dataclass(frozen=True)
class RosterPolicy:
    """How a roster is kept: the feeder dataset and column that list its members, when a listing is too old, after how many
    listings in a row without a member that one goes (null: never), and whether members of a listing that is too old are
    good enough while no new one can be had."""

    provider: str
    name: str
    feeder: str
    column: str
    max_age_days: int = 1
    evict_after: int | None = 3
    keep_stale: bool = True


@dataclass(frozen=True)
class EndpointSpec:
    """One dataset. ``shape``: how its requests are laid out; ``roster``: (name, request parameter) for roster shapes;
    ``sweep``: (parameter, values); ``layout``: "single" or "date" partitions; ``fixed_unit_days``: the grain of a rollup;
    ``pad_days``: whole days that the request is wider than the window; ``audit``: the walk's pagination rule."""

    provider: str
    name: str
    mode: str
    decode: Decode
    event_time: str | None = None
    page_limit: int | None = None
    shape: str = "single"
    layout: str = "date"
    audit: str | None = None
    roster: tuple[str, str] | None = None
    batch_size: int | None = None
    sweep: tuple[str, tuple[str, ...]] | None = None
    fixed_unit_days: int | None = None
    pad_days: int = 0
    count_check: bool = False
    feeds: tuple[str, str] | None = None
    request: str | None = None

    def __post_init__(self) -> None:
        columns = self.schema.struct.fieldNames()
        rules = [
            (self.mode in MODES, "unknown mode"),
            (self.shape in SHAPES, "unknown request shape"),
            ((self.mode == "snapshot") == (self.event_time is None), "event time exactly for windowed and feed datasets"),
            (self.event_time is None or self.event_time in columns, "event time is no column"),
            (self.mode != "snapshot" or self.layout == "single", "a snapshot is one file set"),
            (self.mode != "feed" or (self.layout == "date" and self.shape == "single"), "a feed is one chain, appended by date"),
            ((self.roster is None) != (self.shape in ("roster", "roster_batches")), "roster exactly for roster shapes"),
            ((self.shape == "roster_batches") == (self.batch_size is not None), "batch size exactly for batches"),
            ((self.shape == "sweep") == (self.sweep is not None), "sweep values exactly for sweeps"),
            (self.sweep is None or self.audit is not None, "a sweep needs an audit, which says that its chains are finished"),
            (self.fixed_unit_days is None or self.mode == "watermark", "fixed units are for windowed datasets"),
            (self.shape != "bisected" or (self.mode == "watermark" and self.page_limit), "capped windows need a window and a cap"),
            (not self.count_check or self.mode == "snapshot", "a count check is for snapshots"),
            (self.feeds is None or self.mode == "snapshot", "only a snapshot lists a roster"),
        ]
        if broken := [text for fine, text in rules if not fine]:
            raise ValueError(f"{self.key}: {'; '.join(broken)}")

    @property
    def key(self) -> str:
        return f"{self.provider}.{self.name}"

    @property
    def schema(self) -> schema.Schema:
        return schema.load(self.key)


FEED, SEEK = Decode(("result", "data")), Decode(("result",))
VEHICLE = (("vehicleId", ("id",)), ("vehicleName", ("name",)), ("vehicleSerial", ("externalIds", "samsara.serial")), ("vehicleVin", ("externalIds", "samsara.vin")))


def feed(name: str, event_time: str = "date_time", limit: int = 50_000) -> EndpointSpec:
    return EndpointSpec("geotab", name, "feed", FEED, event_time, limit, audit="feed", request="get_feed")


def wrapped(plural: str, one: str, mode: str, event_time: str | None = None, **more) -> EndpointSpec:
    stamps = (("windowStartDate", "start_date"), ("windowEndDate", "end_date")) if more.get("fixed_unit_days") else ()
    layout = "single" if mode == "snapshot" else "date"
    return EndpointSpec("motive", plural, mode, Decode((plural,), item=one, stamps=stamps), event_time, **({"page_limit": 100, "audit": "offset", "layout": layout, "request": None if mode == "snapshot" else "date_labels"} | more))


def listed(name: str, mode: str, event_time: str | None = None, limit: int = 512, **more) -> EndpointSpec:
    return EndpointSpec("samsara", name, mode, more.pop("decode", Decode(("data",))), event_time, limit, audit="cursor", layout="single" if mode == "snapshot" else "date", request=more.pop("request", None if mode == "snapshot" else "rfc3339"), **more)


def report(name: str, key: str) -> EndpointSpec:
    decode = Decode(("data", key), stamps=(("windowStartDate", "startDate"), ("windowEndDate", "endDate")))
    return listed(name, "watermark", "window_start", 100, decode=decode, fixed_unit_days=1, request="rfc3339_dates")


def stats(name: str, series: str) -> EndpointSpec:
    return listed(name, "watermark", "time", decode=Decode(("data",), series=series, identity=VEHICLE))


SPECS = (
    *[feed(x) for x in ("annotation_logs", "audits", "driver_changes", "duty_status_logs", "dvir_logs", "fault_data", "fuel_and_energy_used", "log_records", "shipment_logs", "status_data")],
    feed("fill_ups", limit=10_000),
    feed("fuel_tax_details", "enter_time"),
    feed("media_files", "from_date"),
    feed("text_messages", "sent"),
    *[EndpointSpec("geotab", x, "snapshot", SEEK, page_limit=5000, layout="single", audit="seek", count_check=True, request="get_sorted") for x in ("devices", "users")],
    EndpointSpec("geotab", "exception_events", "watermark", SEEK, "active_from", 5000, "bisected", request="get_window"),
    EndpointSpec("geotab", "trips", "watermark", SEEK, "stop", 5000, audit="seek", request="get_window_sorted"),
    wrapped("driver_idle_rollups", "driver_idle_rollup", "watermark", "window_start", fixed_unit_days=1),
    wrapped("vehicle_utilizations", "vehicle_utilization", "watermark", "window_start", fixed_unit_days=1),
    wrapped("driving_periods", "driving_period", "watermark", "start_time"),
    wrapped("idle_events", "idle_event", "watermark", "start_time", pad_days=1),
    wrapped("vehicle_locations", "vehicle_location", "watermark", "located_at", page_limit=None, audit=None, shape="roster", roster=("vehicle_ids", "vehicle_id")),
    wrapped("groups", "group", "snapshot"),
    wrapped("users", "user", "snapshot"),
    wrapped("vehicles", "vehicle", "snapshot", feeds=("vehicle_ids", "vehicle_id")),
    listed("addresses", "snapshot"),
    listed("drivers", "snapshot", shape="sweep", sweep=("driverActivationStatus", ("active", "deactivated"))),
    listed("vehicles", "snapshot", feeds=("vehicle_ids", "id")),
    listed("asset_locations", "watermark", "happened_at_time", shape="roster_batches", roster=("vehicle_ids", "ids"), batch_size=50),
    listed("driver_vehicle_assignments", "watermark", "start_time", 50),
    listed("idling_events", "watermark", "start_time", 200),
    report("driver_fuel_energy_reports", "driverReports"),
    report("vehicle_fuel_energy_reports", "vehicleReports"),
    stats("engine_states", "engineStates"),
    stats("gps_readings", "gps"),
    stats("odometer_readings", "obdOdometerMeters"),
    EndpointSpec("samsara", "trips", "watermark", Decode(("trips",), stamps=(("vehicleId", "vehicleId"),)), "start_time", shape="roster", roster=("vehicle_ids", "vehicleId"), request="epoch_millis"),
)
CATALOG = {x.key: x for x in SPECS}
ROSTERS = tuple(RosterPolicy(x.provider, x.feeds[0], x.name, x.feeds[1]) for x in SPECS if x.feeds)


class Endpoints:
    """Typed names: Endpoints.samsara.trips is the spec."""


for _provider in ("geotab", "motive", "samsara"):
    setattr(Endpoints, _provider, type(_provider, (), {x.name: x for x in SPECS if x.provider == _provider}))


def available(mode: str | None = None) -> list[str]:
    return sorted(k for k, x in CATALOG.items() if mode in (None, x.mode))


def catalog_df(spark: SparkSession) -> DataFrame:
    """A row per dataset."""
    rows = [(x.provider, x.name, x.mode, x.event_time, ".".join(x.decode.path), x.page_limit, x.shape, x.layout, x.fixed_unit_days, len(x.schema.fields)) for x in SPECS]
    return spark.createDataFrame(rows, "provider string, endpoint string, mode string, event_time string, records_path string, page_limit int, shape string, layout string, fixed_unit_days int, columns int")

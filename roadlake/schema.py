"""Declared dataset schemas: one text file per dataset, read into typed fields and a flat StructType."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache
from pathlib import Path

from pyspark.sql import types as T

SCHEMAS = Path(__file__).parent / "schemas"
TYPES = {"BIGINT": T.LongType(), "DOUBLE": T.DoubleType(), "STRING": T.StringType(), "BOOLEAN": T.BooleanType(), "DATE": T.DateType(), "TIMESTAMP": T.TimestampType(), "INTERVAL": T.DayTimeIntervalType()}
LIFTS = ("timespan", "epochms", "datelabel", "idlist", "emptyint")

#: Closed value sets of the wire (fixed values).
ENUMS = {
    "motive.vehicles:status": ("active", "inactive", "deactivated"),
    "motive.vehicles:availability_details__availability_status": ("in_service", "out_of_service"),
    "motive.vehicle_locations:location_type": ("breadcrumb", "vehicle_stopped", "vehicle_moving", "ignition_on", "ignition_off", "engine_start", "engine_stop", "gps_moving", "gps_stopped"),
    "samsara.drivers:driver_activation_status": ("active", "deactivated"),
}


def snake(name: str) -> str:
    """camelCase, with runs of capitals as one word, and dotted names to snake_case."""
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name.replace(".", "_")).lower()


@dataclass(frozen=True)
class Field:
    """A column: where its value lies in a record, its type, and when it must be there.

    ``path``: keys from the record down. ``reference``: the position of a key whose value may be a bare string instead of
    an object with an id. ``required``: "!" always, "(!)" if the block around it is present, "-" never.
    """

    path: tuple[str, ...]
    kind: str
    required: str
    name: str
    lift: str | None = None
    reference: int | None = None
    enum: tuple[str, ...] | None = None

    @property
    def array(self) -> bool:
        return self.kind.startswith("ARRAY<")

    @property
    def scalar(self) -> str:
        return self.kind[6:-1] if self.array else self.kind

    @property
    def spark(self) -> T.DataType:
        one = TYPES[self.scalar]
        return T.ArrayType(one) if self.array else one


@dataclass(frozen=True)
class Schema:
    dataset: str
    fields: tuple[Field, ...]

    def __post_init__(self) -> None:
        names = [f.name for f in self.fields]
        if twice := sorted({x for x in names if names.count(x) > 1}):
            raise TypeError(f"{self.dataset}: columns named twice: {', '.join(twice)}")
        for f in self.fields:
            if f.scalar not in TYPES or f.required not in ("!", "(!)", "-") or (f.lift and f.lift not in LIFTS):
                raise TypeError(f"{self.dataset}.{f.name}: no supported leaf: {f.kind} {f.required} {f.lift or ''}")

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.spark) for f in self.fields])


def parse(dataset: str, text: str) -> Schema:
    """Lines of ``path TYPE required [lift] [as name]``; a path is keys joined by dots, a key with a dot in quotes, a
    reference marked by ``~``. The name is the snake_case of the keys joined by two underscores if none is given."""
    fields = []
    for line in text.splitlines():
        if not (words := line.split()) or words[0].startswith("#"):
            continue
        keys = [a or b for a, b in re.findall(r'"([^"]+)"|([^."]+)', words[0])]
        marks = [k for k, x in enumerate(keys) if x.endswith("~")]
        path = tuple(x.rstrip("~") for x in keys)
        rest = words[3:]
        name = rest[rest.index("as") + 1] if "as" in rest else "__".join(map(snake, path))
        lift = next((x for x in rest if x in LIFTS), None)
        fields.append(Field(path, words[1], words[2], name, lift, marks[0] if marks else None, ENUMS.get(f"{dataset}:{name}")))
    return Schema(dataset, tuple(fields))


@cache
def load(dataset: str) -> Schema:
    """The schema of a dataset, named provider.dataset."""
    return parse(dataset, (SCHEMAS / f"{dataset}.txt").read_text())

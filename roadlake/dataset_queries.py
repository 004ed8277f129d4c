"""A query per dataset: all events, written as records of the dataset's wire form and landed as pages, are decoded and typed;
the SQL says what each column must hold then. Values follow from the event and the column's place by rule."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.catalog import SPECS, EndpointSpec
from roadlake.functions import scalars as S
from roadlake.operators import decode, typing
from roadlake.schema import Field
from roadlake.staging import compiled


def quoted(text: Column, pad: str = "") -> Column:
    return F.concat(F.lit(f'"{pad}'), text, F.lit(f'{pad}"'))


#: The second element of an array of each type.
LAST = {"STRING": "7", "BIGINT": "7", "DOUBLE": "7.5", "BOOLEAN": "false"}


def wire(f: Field, i: int) -> Column:
    """A column's wire text (JSON) for an event."""
    e, n = F.col("event_id"), F.pmod(F.col("event_id") * 7 + i, F.lit(1000)).cast("string")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    if f.enum:
        return quoted(F.element_at(F.array(*map(F.lit, f.enum)), (e % len(f.enum) + 1).cast("int")))
    if f.lift == "idlist":
        return F.concat(F.lit('["a'), e, F.lit(f'",{{"id":"b{i}"}}]'))
    if f.array:
        first = {"STRING": quoted(F.concat(F.lit(" s"), n)), "BIGINT": n, "DOUBLE": F.concat(n, F.lit(".5")), "BOOLEAN": F.lit("true")}[f.scalar]
        return F.concat(F.lit("["), first, F.lit(f',"{LAST[f.scalar]}"]'))
    if f.lift == "emptyint":
        return F.when(e % 3 == 0, '""').otherwise(quoted(n))
    if f.lift == "epochms":
        return (F.unix_millis("ts") + i).cast("string")
    if f.lift == "timespan":
        return quoted(F.concat((e % 3).cast("string"), F.lit("."), two(e % 24), F.lit(":"), two(e % 60), F.lit(":"), two((e + i) % 60), F.lit(".5")))
    if f.scalar == "DATE" or f.lift == "datelabel":
        return quoted(F.date_format("ts", "yyyy-MM-dd"))
    if f.scalar == "TIMESTAMP":
        return quoted(F.concat(F.date_format(F.col("ts") + F.make_dt_interval(mins=F.lit(i)), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")))
    if f.scalar == "BIGINT":
        return quoted(n) if i % 3 == 0 else n
    if f.scalar == "DOUBLE":
        return ((e % 997) / 4 + i).cast("double").cast("string")
    if f.scalar == "BOOLEAN":
        return F.when((e + i) % 2 == 0, '"yes"' if i % 3 == 0 else "true").otherwise('"no"' if i % 3 == 0 else "false")
    return quoted(F.concat(F.lit(f"v{i}-"), e % 50), "  " if i % 2 else "")


def value(f: Field, i: int) -> str:
    """A column's typed value for an event, in SQL; times and durations in microseconds, arrays joined by commas."""
    n = f"(event_id * 7 + {i}) % 1000"
    if f.enum:
        return f"([{', '.join(map(repr, f.enum))}])[event_id % {len(f.enum)} + 1]"
    if f.lift == "idlist":
        return f"'a' || event_id || ',b{i}'"
    if f.array:
        first = {"STRING": f"'s' || {n}", "BIGINT": n, "DOUBLE": f"{n} || '.5'", "BOOLEAN": "'true'"}[f.scalar]
        return f"{first} || ',{LAST[f.scalar]}'"
    if f.lift == "timespan":
        return f"((((event_id % 3) * 24 + event_id % 24) * 60 + event_id % 60) * 60 + (event_id + {i}) % 60) * 1000000 + 500000"
    if f.scalar == "DATE":
        return "CAST(CAST(ts AS DATE) AS VARCHAR)"
    if f.scalar == "TIMESTAMP":
        return {"epochms": f"(epoch_us(ts) // 1000 + {i}) * 1000", "datelabel": "epoch_us(date_trunc('day', ts))"}.get(f.lift, f"epoch_us(ts) + {i * 60_000_000}")
    if f.scalar == "BIGINT":
        return f"CASE WHEN event_id % 3 <> 0 THEN {n} END" if f.lift == "emptyint" else n
    if f.scalar == "DOUBLE":
        return f"CAST((event_id % 997) / 4.0 + {i} AS DOUBLE)"
    return f"(event_id + {i}) % 2 = 0" if f.scalar == "BOOLEAN" else f"'v{i}-' || event_id % 50"


def own_fields(spec: EndpointSpec) -> list[tuple[int, Field]]:
    """The fields that a record itself has; others come from the request or the vehicle around it."""
    given = {k for k, _ in spec.decode.stamps} | {k for k, _ in spec.decode.identity}
    return [(i, f) for i, f in enumerate(spec.schema.fields) if f.path[0] not in given]


def needed(spec: EndpointSpec) -> set[str]:
    """The keys of records that are always there."""
    return {f.path[0] for f in spec.schema.fields if f.required == "!"}


def blank(f: Field) -> bool:
    return f.kind == "STRING" and not f.enum


def record_of(spec: EndpointSpec) -> Column:
    """The JSON text of an event's record. Optional values are null or, as text, blank for some events, blocks that no
    required column is in are absent for others, and references with nothing but an id are bare for every second one."""
    tree, e, always = {}, F.col("event_id"), needed(spec)
    for i, f in own_fields(spec):
        text = wire(f, i)
        if f.required == "-" and f.lift != "emptyint":
            text = F.when((e + i) % 4 == 2, '" "').otherwise(text) if blank(f) else text
            text = F.when((e + i) % 4 == 1, "null").otherwise(text)
        at = tree
        for key in f.path[:-1]:
            at = at.setdefault(key, {})
        at[f.path[-1]] = text
    references = {f.path[0] for f in spec.schema.fields if f.reference == 0 and len(f.path) == 2}

    def text_of(node: dict) -> Column:
        parts = []
        for key, below in node.items():
            text = text_of(below) if isinstance(below, dict) else below
            if isinstance(below, dict) and node is tree:
                if key in references and list(below) == ["id"]:
                    text = F.when(e % 2 == 0, below["id"]).otherwise(text)
                if key not in always:
                    text = F.when(e % 5 == 0, "null").otherwise(text)
            parts += [F.lit(("," if parts else "") + json.dumps(key) + ":"), text]
        return F.concat(F.lit("{"), *parts, F.lit("}"))

    return text_of(tree)


#: What pages_of writes around readings, and what it stamps on records, in SQL.
GIVEN = {"vehicleId": "'u' || user_id % 8", "vehicleName": "'Nu' || user_id % 8", "vehicleSerial": "'S'", "vehicleVin": "'V'", "windowStartDate": "epoch_us(date_trunc('day', ts))", "windowEndDate": "epoch_us(date_trunc('day', ts) + INTERVAL 1 DAY)"}


def dataset_sql(spec: EndpointSpec) -> str:
    values, always = {f.name: GIVEN[f.path[0]] for f in spec.schema.fields if f.path[0] in GIVEN}, needed(spec)
    for i, f in own_fields(spec):
        text = value(f, i)
        if f.required == "-" and f.lift != "emptyint":
            text = f"CASE WHEN (event_id + {i}) % 4 NOT IN ({'1, 2' if blank(f) else '1'}) THEN {text} END"
        if len(f.path) > 1 and f.path[0] not in always:
            text = f"CASE WHEN event_id % 5 <> 0 THEN {text} END"
        values[f.name] = text
    return f"SELECT {', '.join(f'{values[f.name]} AS {chr(34)}{f.name}{chr(34)}' for f in spec.schema.fields)} FROM events"


def pages_of(events: DataFrame, spec: EndpointSpec) -> DataFrame:
    """All events as landed pages of a dataset: of a day and a user's group where a request says so, of up to 200 records."""
    record, how, group = record_of(spec), spec.decode, F.concat(F.lit("u"), F.col("user_id") % 8)
    rows = events.select(F.floor(F.col("event_id") / 200).alias("page"), F.to_date("ts").alias("day"), group.alias("group"), record.alias("record"))
    keys = ["page", *(["day"] if spec.fixed_unit_days else []), *(["group"] if how.series or spec.shape == "roster" else [])]
    items = F.concat_ws(",", F.collect_list("record")) if not how.item else F.concat_ws(",", F.collect_list(F.concat(F.lit(f'{{"{how.item}":'), F.col("record"), F.lit("}"))))
    found = rows.groupBy(*keys).agg(items.alias("items"))
    body, sent = F.concat(F.lit("["), F.col("items"), F.lit("]")), F.create_map().cast("map<string,string>")
    if how.series:
        vehicle = F.concat(F.lit('{"id":"'), F.col("group"), F.lit('","name":" N'), F.col("group"), F.lit('","externalIds":{"samsara.serial":"S","samsara.vin":"V"},"' + how.series + '":'), body, F.lit("}"))
        body = F.concat(F.lit("["), vehicle, F.lit(',{"id":"idle","name":"no readings"}]'))
    elif spec.fixed_unit_days:
        end = "" if spec.request == "date_labels" else "T00:00:00Z"
        sent = F.create_map(*[x for k, (_, param) in enumerate(how.stamps) for x in (F.lit(param), F.concat(F.date_add("day", k).cast("string"), F.lit(end)))])
    elif spec.shape == "roster":
        sent = F.create_map(F.lit(spec.roster[1]), F.col("group"))
    for key in reversed(how.path):
        body = F.concat(F.lit(f'{{"{key}":'), body, F.lit("}"))
    return found.select(F.lit(spec.provider).alias("provider"), F.lit(spec.name).alias("endpoint"), F.lit("c").alias("chain_id"), F.col("page").cast("int").alias("page_seq"), sent.alias("sent_params"), body.alias("body"))


def shown(f: Field) -> Column:
    c = F.col(f.name)
    if f.array:
        return F.when(c.isNotNull(), F.concat_ws(",", c.cast("array<string>"))).alias(f.name)
    kinds: dict[str, Callable[[Column], Column]] = {"TIMESTAMP": F.unix_micros, "INTERVAL": S.interval_to_micros, "DATE": lambda x: x.cast("string")}
    return kinds.get(f.scalar, lambda x: x)(c).alias(f.name)


def dataset_query(spec: EndpointSpec) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        compiled(spark)
        events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
        rows = typing.valid(typing.typed(decode.records(pages_of(events, spec), spec.decode), spec.schema))
        return rows.select(*[shown(f) for f in spec.schema.fields])

    return run


QUERIES = {f"dataset_{x.provider}_{x.name}": dataset_query(x) for x in SPECS}
SQL = {f"dataset_{x.provider}_{x.name}": dataset_sql(x) for x in SPECS}

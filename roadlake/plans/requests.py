"""Requests for an external fetcher: windows rendered as each provider's parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.functions.scalars import to_epoch_millis, to_iso


#: The parameters that hold a window, by how requests are written.
WINDOW_PARAMS = {"date_labels": ("start_date", "end_date"), "rfc3339": ("startTime", "endTime"), "rfc3339_dates": ("startDate", "endDate"), "epoch_millis": ("startMs", "endMs")}


def type_name(dataset: str) -> str:
    """The entity that a JSON-RPC dataset lists: its name in the singular, in capitals without underscores."""
    words = dataset.removesuffix("s").split("_")
    return "".join(x.upper() if x == "dvir" else x.capitalize() for x in words)


def parameters(request: str, start: Column, end: Column, pad_days: int = 0) -> Column:
    """A window as query parameters (map): inclusive date labels, widened by whole days; RFC 3339 times; or epoch milliseconds."""
    if request not in WINDOW_PARAMS:
        raise ValueError(f"no query parameters for {request}")
    if request == "date_labels":
        last = F.to_date(end - F.expr("interval 1 microsecond"))
        values = F.date_sub(F.to_date(start), pad_days).cast("string"), F.date_add(last, pad_days).cast("string")
    elif request == "epoch_millis":
        values = to_epoch_millis(start).cast("string"), to_epoch_millis(end).cast("string")
    else:
        values = to_iso(start), to_iso(end)
    return F.create_map(*[x for name, value in zip(WINDOW_PARAMS[request], values) for x in (F.lit(name), value)])


def rpc_body(request: str, type_name: str, limit: int, start: Column | None = None, end: Column | None = None, version: Column | None = None) -> Column:
    """A JSON-RPC body: a sorted walk, a window, a sorted window, or a feed from a version or, without one, a start date.
    A first sorted page has an explicit null offset."""
    quoted = lambda x: F.to_json(F.array(x))
    text = lambda x: F.substring(quoted(x), 2, 1_000_000).substr(F.lit(1), F.length(quoted(x)) - 2)
    parts: list[Column] = [F.lit(f'{{"method":"{"GetFeed" if request == "get_feed" else "Get"}","params":{{"typeName":"{type_name}"')]
    if request == "get_feed":
        from_version = F.when(version.isNotNull(), F.concat(F.lit(',"fromVersion":'), text(version))) if version is not None else F.lit(None).cast("string")
        seed = F.concat(F.lit(',"search":{"fromDate":'), text(to_iso(start)), F.lit("}")) if start is not None else F.lit("")
        parts.append(F.coalesce(from_version, seed))
    elif start is not None:
        parts += [F.lit(',"search":{"fromDate":'), text(to_iso(start)), F.lit(',"toDate":'), text(to_iso(end)), F.lit("}")]
    parts.append(F.lit(f',"resultsLimit":{limit}'))
    if request.endswith("sorted"):
        parts.append(F.lit(',"sort":{"sortBy":"id","sortDirection":"asc","offset":null}'))
    return F.concat(*parts, F.lit("}}"))


def plan(units: DataFrame, request: str, member_param: str | None = None, limit_param: str | None = None, limit: int | None = None, pad_days: int = 0) -> DataFrame:
    """``units`` (chunk_start, chunk_end, and member for roster shapes) with ``params``, the map an external fetcher sends."""
    maps = [parameters(request, F.col("chunk_start"), F.col("chunk_end"), pad_days)]
    if member_param:
        maps.insert(0, F.create_map(F.lit(member_param), F.col("member")))
    if limit_param:
        maps.append(F.create_map(F.lit(limit_param), F.lit(str(limit))))
    return units.withColumn("params", F.map_concat(*maps))

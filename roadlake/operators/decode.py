"""Envelopes to records: a row per record, as a variant, with the page it came from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.functions.scalars import get, is_object, kind

PAGE_COLUMNS = ["provider", "endpoint", "chain_id", "page_seq"]


@dataclass(frozen=True)
class Decode:
    """How an endpoint's envelope holds its records.

    ``path``: keys down to the list of records. ``item``: the key that wraps each record. ``series``: the key of a list
    inside each record whose elements are the rows, with ``identity`` (column, keys) carried onto them. ``stamps``: (record
    key, sent parameter) written onto each record, over what the record has there.
    """

    path: tuple[str, ...]
    item: str | None = None
    series: str | None = None
    identity: tuple[tuple[str, tuple[str, ...]], ...] = ()
    stamps: tuple[tuple[str, str], ...] = ()


def once(value: Column) -> Column:
    """A generator of one row: what is made from ``value`` later refers to its result. A plain column would be made again
    in every filter that the optimizer moves below its projection."""
    return F.explode(F.array(value))


def parsed(pages: DataFrame) -> DataFrame:
    """``pages`` with their body as a variant, parsed once; null where it is no JSON. Parsed pages stay as they are."""
    if "envelope" in pages.columns:
        return pages
    return pages.select("*", once(F.try_parse_json("body")).alias("envelope"))


def elements(decode: Decode) -> Column:
    """The envelope's list of records, as variants, or as structs of the variant under ``item``; null where there is none, and
    an element null that is no object under a declared item."""
    one = f"struct<`{decode.item}`:variant>" if decode.item else "variant"
    return F.try_variant_get("envelope", "$." + ".".join(decode.path), f"array<{one}>")


def faults(decode: Decode, items: Column | None = None) -> Column:
    """What is wrong with an envelope's structure, or null: it names shapes, never values. ``items``: elements(), where it is
    a column already. A block is only copied out of the envelope, to name its kind, where it doesn't fit."""
    top, items = F.col("envelope"), elements(decode) if items is None else items
    out = F.when(top.isNull(), F.lit("body: not JSON")).when(~is_object(top), F.concat(F.lit("body: object expected, found "), kind(top)))
    for k in range(1, len(decode.path) + 1):
        at, keys = get(top, *decode.path[:k]), ".".join(decode.path[:k])
        want, fits = ("ARRAY", items.isNotNull()) if k == len(decode.path) else ("OBJECT", F.try_variant_get(top, f"$.{keys}", "struct<>").isNotNull())
        out = out.when(~fits & at.isNull(), F.lit(f"{keys}: missing")).when(~fits, F.concat(F.lit(f"{keys}: {want.lower()} expected, found "), kind(at)))
    out = out.when(F.exists(items, lambda x: x.isNull() if decode.item else ~is_object(x)), F.lit(f"{'.'.join(decode.path)}: an element is no object"))
    if decode.item:
        out = out.when(F.exists(items, lambda x: ~F.coalesce(is_object(x[decode.item]), F.lit(False))), F.lit(f"{'.'.join(decode.path)}: an element has no object under {decode.item}"))
    return out


def bad_pages(pages: DataFrame, decode: Decode) -> DataFrame:
    """The pages whose envelope is malformed, with the fault."""
    return parsed(pages).withColumn("fault", faults(decode)).where("fault is not null").drop("envelope", "body")


class EnvelopeError(ValueError):
    """Pages that do not have the declared shape."""


def require_good_pages(pages: DataFrame, decode: Decode) -> None:
    """Raises with faults, counts and a few page names; one aggregate reaches the driver."""
    require_no_faults(bad_pages(pages, decode))


def require_no_faults(bad: DataFrame) -> None:
    found = bad.groupBy("fault").agg(F.count("*").alias("n"), F.min(F.concat_ws("/", *PAGE_COLUMNS)).alias("first")).orderBy(F.desc("n")).limit(20).collect()
    if found:
        raise EnvelopeError("; ".join(f"{r['fault']} ({r['n']} pages, first {r['first']})" for r in found))


def records(pages: DataFrame, decode: Decode, strict: bool = False) -> DataFrame:
    """A row per record of the pages that have the declared shape: the pages' columns without the body, ``ordinal`` (place
    in the page), ``record`` (variant), ``stamped`` (map of record keys to stamped text). ``strict``: a page of another shape
    fails the job that meets it, and is named; otherwise such pages are left out (bad_pages() has them).

    A series gives a row per reading; records without one, or with an empty one, give none. Identity values are in
    ``identity`` (map of columns to variants), for readings that do not have the key themselves.
    """
    keep = [c for c in pages.columns if c not in ("body", "envelope")]
    items = F.col("_items")
    fault = faults(decode, items)
    named = F.concat_ws("/", *[F.col(c).cast("string") for c in PAGE_COLUMNS if c in pages.columns])
    fine = fault.isNull() if not strict else F.when(fault.isNull(), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("page refused: "), fault, F.lit(" ("), named, F.lit(")"))).cast("boolean"))
    rows = parsed(pages).select("*", once(elements(decode)).alias("_items")).where(fine).select(*keep, F.posexplode(items).alias("ordinal", "record"))
    if decode.item:
        rows = rows.withColumn("record", F.col("record")[decode.item])
    identity = F.create_map(*[x for name, keys in decode.identity for x in (F.lit(name), get(F.col("record"), *keys))]) if decode.identity else F.lit(None).cast("map<string,variant>")
    rows = rows.withColumn("identity", identity)
    if decode.series:
        readings = F.try_variant_get("record", f"$.{decode.series}", "array<variant>")
        rows = rows.select(*keep, F.col("ordinal").alias("_parent"), "identity", F.posexplode(readings).alias("_reading", "record")).select(*keep, F.struct("_parent", "_reading").alias("ordinal"), "record", "identity")
    stamps = F.create_map(*[x for key, sent in decode.stamps for x in (F.lit(key), F.col("sent_params")[sent])]) if decode.stamps else F.lit(None).cast("map<string,string>")
    return rows.withColumn("stamped", stamps)

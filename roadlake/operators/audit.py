"""Completeness of paginated walks, as set checks over landed pages. Each audit gives a row per fault."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from roadlake.functions.scalars import get, kind, text_of
from roadlake.operators.decode import parsed

CHAIN = ["provider", "endpoint", "chain_id"]


def order() -> WindowSpec:
    return Window.partitionBy(*CHAIN).orderBy("page_seq")


def whole(path: str) -> Column:
    """A number of the envelope, if it is a whole JSON number."""
    value = get(F.col("envelope"), *path.split("."))
    return F.when(kind(value) == "BIGINT", F.try_variant_get(value, "$", "bigint"))


def flag(path: str) -> Column:
    value = get(F.col("envelope"), *path.split("."))
    return F.when(kind(value) == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))


def label(path: str) -> Column:
    return text_of(get(F.col("envelope"), *path.split(".")))


def size(path: str) -> Column:
    return F.size(F.try_variant_get("envelope", f"$.{path}", "array<variant>"))


def found(rows: DataFrame, fault: Column) -> DataFrame:
    return rows.withColumn("fault", fault).where("fault is not null").select(*CHAIN, "page_seq", "fault")


def narrow(pages: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Only what an audit compares, never the bodies."""
    return parsed(pages).select(*CHAIN, "page_seq", *[c.alias(n) for n, c in columns.items()])


def ended(rows: DataFrame) -> DataFrame:
    return rows.withColumn("last", F.lead("page_seq").over(order()).isNull())


def offset_columns(records: str) -> dict[str, Column]:
    return {"no": whole("pagination.page_no"), "per": whole("pagination.per_page"), "total": whole("pagination.total"), "n": size(records)}


def offset_faults(rows: DataFrame) -> DataFrame:
    rows = ended(rows)
    rows = rows.withColumn("before", F.coalesce(F.lag("no").over(order()), F.lit(0))).withColumn("sum", F.sum("n").over(order()))
    done = F.col("no") * F.col("per") >= F.col("total")
    return found(
        rows,
        F.when(F.col("no").isNull() | F.col("per").isNull() | F.col("total").isNull(), "malformed pagination")
        .when(F.col("no") != F.col("before") + 1, "page missing before this one")
        .when(F.col("last") & ~done, "walk ends before the total")
        .when(~F.col("last") & done, "page after the end")
        .when(F.col("last") & (F.col("sum") != F.col("total")), "records do not add up to the total"),
    )


def offset_walk(pages: DataFrame, records: str) -> DataFrame:
    """Pages of a walk by number: numbers run from 1 without holes, the last page reaches the total and no earlier one
    does, and the records add up to the total."""
    return offset_faults(narrow(pages, offset_columns(records)))


def cursor_columns(records: str | None = None, param: str = "after") -> dict[str, Column]:
    return {"more": flag("pagination.hasNextPage"), "cursor": F.nullif(label("pagination.endCursor"), F.lit("")), "sent": F.col("sent_params")[param]}


def cursor_faults(rows: DataFrame) -> DataFrame:
    rows = ended(rows)
    rows = rows.withColumn("before", F.lag("cursor").over(order()))
    return found(
        rows,
        F.when(F.col("more").isNull(), "malformed pagination")
        .when(F.col("more") & F.col("cursor").isNull(), "next page without a cursor")
        .when(~F.col("sent").eqNullSafe(F.col("before")), "request does not continue the page before")
        .when(F.col("last") & F.col("more"), "walk ends before the last page")
        .when(~F.col("last") & ~F.col("more"), "page after the end"),
    )


def cursor_walk(pages: DataFrame, param: str = "after") -> DataFrame:
    """Pages of a walk by cursor: a page that has a next one names its cursor, the next request sent it, and the last page
    says that it is the last."""
    return cursor_faults(narrow(pages, cursor_columns(param=param)))


def feed_columns(records: str = "result.data", param: str = "fromVersion") -> dict[str, Column]:
    return {"version": label("result.toVersion"), "n": size(records), "limit": F.col("results_limit"), "sent": F.col("sent_params")[param]}


def feed_faults(rows: DataFrame) -> DataFrame:
    rows = ended(rows)
    rows = rows.withColumn("before", F.lag("version").over(order())).withColumn("first", F.lag("page_seq").over(order()).isNull())
    full = F.col("n") >= F.col("limit")
    return found(
        rows,
        F.when(F.col("version").isNull() | F.col("n").isNull(), "malformed feed page")
        .when(~F.col("first") & F.col("sent").isNull(), "seed after the first page")
        .when(~F.col("first") & (F.col("sent") != F.col("before")), "request does not continue the page before")
        .when(full & (F.col("version") == F.coalesce("sent", F.lit(""))), "feed stalled: a full page did not move the version")
        .when(F.col("last") & full, "walk ends on a full page")
        .when(~F.col("last") & ~full, "page after the end"),
    )


def feed_walk(pages: DataFrame, param: str = "fromVersion") -> DataFrame:
    """Pages of a feed: each continues from the version before it, a full page moves the version, and only the last one is
    short of its limit; only the first carries a seed instead of a version."""
    return feed_faults(narrow(pages, feed_columns(param=param)))


def seek_columns(records: str = "result", param: str = "offset") -> dict[str, Column]:
    items = F.try_variant_get("envelope", f"$.{records}", "array<variant>")
    return {"n": F.size(items), "last_id": text_of(get(F.try_element_at(items, F.lit(-1)), "id")), "sent": F.col("sent_params")[param]}


def seek_faults(rows: DataFrame) -> DataFrame:
    rows = ended(rows)
    rows = rows.withColumn("before", F.lag("last_id").over(order()))
    return found(
        rows,
        F.when(F.col("n").isNull(), "malformed page")
        .when((F.col("n") > 0) & F.col("last_id").isNull(), "last record has no text id")
        .when(~F.col("sent").eqNullSafe(F.col("before")), "request does not continue the page before")
        .when(F.col("last") & (F.col("n") > 0), "walk ends before an empty page")
        .when(~F.col("last") & (F.col("n") == 0), "page after the end"),
    )


def seek_walk(pages: DataFrame, param: str = "offset", records: str = "result") -> DataFrame:
    """Pages of a walk by last id: each request sent the last id of the page before, ids are text, and only the last page is
    empty."""
    return seek_faults(narrow(pages, seek_columns(records, param)))


#: By the pagination rule of a dataset: what a page is audited by, and the faults of rows of that.
WALKS = {"offset": (offset_columns, offset_faults), "cursor": (cursor_columns, cursor_faults), "feed": (feed_columns, feed_faults), "seek": (seek_columns, seek_faults)}


def overflowing(rows: DataFrame, limit: int) -> DataFrame:
    """Of pages (n: their records), those as full as the provider's silent cap: what is beyond it is missing."""
    return found(rows, F.when(F.col("n") >= limit, "page as full as the cap: its window has to be halved"))


def incomplete(harvested: DataFrame, expected: DataFrame) -> DataFrame:
    """provider, endpoint, expected, harvested where the count that the provider reports is not exactly the rows harvested."""
    return miscounted(harvested.groupBy("provider", "endpoint").agg(F.count("*").alias("harvested")), expected)


def miscounted(counts: DataFrame, expected: DataFrame) -> DataFrame:
    key = ["provider", "endpoint"]
    both = expected.select(*key, F.col("expected_count").alias("expected")).join(counts, key, "left")
    return both.withColumn("harvested", F.coalesce("harvested", F.lit(0))).where("expected <> harvested")


class WalkError(ValueError):
    """A walk that is not complete."""


def require_none(faults: DataFrame) -> None:
    """Raises if there is any fault, before anything is written."""
    if rows := faults.limit(5).collect():
        raise WalkError("; ".join(str(r.asDict()) for r in rows))

"""Half-open windows, members that can't be fetched, and guards on stored state."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_window(time: Column, start: Column | datetime, end: Column | datetime) -> Column:
    """start <= time < end; plain comparisons, which reach a parquet scan."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return (time >= lit(start)) & (time < lit(end))


def owned(rows: DataFrame, event_time: str, start, end) -> DataFrame:
    """Of rows fetched because they overlap a window, those whose own anchor lies in it: every row has one owner."""
    return rows.where(in_window(F.col(event_time), start, end))


def fetchable(members: DataFrame, column: str) -> DataFrame:
    """Without null and empty members."""
    return members.where(F.col(column).isNotNull() & (F.col(column).cast("string") != ""))


def member_report(members: DataFrame, column: str) -> DataFrame:
    """One row: fetchable, nulls, empties."""
    text = F.col(column).cast("string")
    return members.agg(F.count_if(text.isNotNull() & (text != "")).alias("fetchable"), F.count_if(text.isNull()).alias("nulls"), F.count_if(text == "").alias("empties"))


def broken_cursors(cursors: DataFrame, endpoints: DataFrame, now) -> DataFrame:
    """Cursors (provider, endpoint, kind, value) that can't be resumed from, with the reason: a watermark of the future,
    or a kind other than the endpoint's mode (endpoints: provider, endpoint, mode) asks for."""
    joined = cursors.join(endpoints.select("provider", "endpoint", "mode"), ["provider", "endpoint"])
    wanted = F.when(F.col("mode") == "watermark", "watermark").when(F.col("mode") == "feed", "token")
    reason = F.when(F.col("mode") == "snapshot", "a snapshot keeps no cursor").when(F.col("kind") != wanted, "cursor of another kind").when((F.col("kind") == "watermark") & (F.col("value").cast("timestamp") > F.lit(now)), "watermark in the future")
    return joined.withColumn("reason", reason).where("reason is not null").select("provider", "endpoint", "kind", "value", "reason")

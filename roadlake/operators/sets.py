"""Exact duplicates, unions, sweeps, splits by date."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_rows(rows: DataFrame, enabled: bool = True) -> DataFrame:
    """Rows equal in every column once; rows of one key with different payload all stay."""
    return rows.dropDuplicates() if enabled else rows


def concat(pieces: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), pieces)


def unswept(chains: DataFrame, param: str, values: Sequence[str]) -> DataFrame:
    """Of the values a sweep declares, those without a finished chain (chains: sent_params, finished)."""
    wanted = chains.sparkSession.createDataFrame([(x,) for x in values], "value string")
    done = chains.where("finished").select(F.col("sent_params")[param].alias("value"))
    return wanted.join(done, "value", "left_anti")


def with_date(rows: DataFrame, event_time: str) -> DataFrame:
    """``rows`` with ``date``, the UTC date of their event time (the session's time zone is UTC)."""
    return rows.withColumn("date", F.to_date(event_time))


def covered_dates(start: Column, end: Column) -> Column:
    """Array of the dates that a half-open window touches."""
    return F.when(start < end, F.sequence(F.to_date(start), F.to_date(end - F.expr("interval 1 microsecond")))).otherwise(F.array().cast("array<date>"))

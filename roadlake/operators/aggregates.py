"""Aggregates over rows, runs and work units; every one has partial aggregation before its shuffle."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = ["provider", "endpoint"]


def latest_event_time(rows: DataFrame, event_time: str) -> DataFrame:
    """One row: observed_max, null without rows."""
    return rows.agg(F.max(event_time).alias("observed_max"))


def merged_outcomes(outcomes: DataFrame, by: list[str]) -> DataFrame:
    """rows_written, duplicates_dropped and files_written summed, deleted dates together, observed_max at most."""
    sums = [F.sum(x).alias(x) for x in ("rows_written", "duplicates_dropped", "files_written")]
    return outcomes.groupBy(*by).agg(*sums, F.array_sort(F.array_distinct(F.flatten(F.collect_list("deleted_partitions")))).alias("deleted_partitions"), F.max("observed_max").alias("observed_max"))


def frontier(runs: DataFrame) -> DataFrame:
    """Latest window end of the succeeded windowed runs of each endpoint."""
    return runs.where("status = 'succeeded' and window_end is not null").groupBy(*KEY).agg(F.max("window_end").alias("frontier"))


def last_success(runs: DataFrame) -> DataFrame:
    return runs.where("status = 'succeeded'").groupBy(*KEY).agg(F.max("ended_at").alias("last_success"))


def done_prefix(units: DataFrame) -> DataFrame:
    """Latest observed_max of the done units that start before the earliest unit not done, per endpoint. Blind to units
    that were never enqueued. Two aggregations and a join of one row per endpoint, so that no endpoint's units meet in
    one task."""
    stop = units.groupBy(*KEY).agg(F.min(F.when(F.col("status") != "done", F.col("chunk_start"))).alias("stop"))
    before = units.where("status = 'done'").join(stop, KEY).where("stop is null or chunk_start < stop")
    return before.groupBy(*KEY).agg(F.max("observed_max").alias("observed_max")).where("observed_max is not null")


STATUSES = ["pending", "claimed", "done", "failed"]


def unit_progress(units: DataFrame) -> DataFrame:
    """Units of each status, zero where there is none."""
    return units.groupBy(*KEY).agg(*[F.count_if(F.col("status") == s).alias(s) for s in STATUSES])


def members(rows: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column as text."""
    return rows.select(F.col(column).cast("string").alias("member")).distinct()


def unit_state(events: DataFrame) -> DataFrame:
    """The latest status of each unit from an append-only log (provider, endpoint, partition_key, chunk_start, chunk_end,
    seq, status, observed_max). ``reset`` and ``released`` units are pending again; observed_max is the last one reported."""
    key = [*KEY, "partition_key", "chunk_start", "chunk_end"]
    last = F.max_by("status", "seq")
    return events.groupBy(*key).agg(F.when(last.isin("reset", "released", "enqueued"), "pending").otherwise(last).alias("status"), F.max_by(F.col("observed_max"), F.when(F.col("observed_max").isNotNull(), F.col("seq"))).alias("observed_max"), F.count_if(F.col("status") == "claimed").alias("attempts"))


def fenced(events: DataFrame) -> DataFrame:
    """``events`` of units with ``refused``: whether a run wrote one after another run of a higher fence had claimed the unit.
    Events without a fence are the planner's and are never refused."""
    unit = [*KEY, "partition_key", "chunk_start", "chunk_end"]
    higher = Window.partitionBy(*unit).orderBy(F.desc("fence")).rangeBetween(Window.unboundedPreceding, -1)
    taken = F.min(F.when(F.col("status") == "claimed", F.col("seq"))).over(higher)
    return events.withColumn("refused", F.col("fence").isNotNull() & F.coalesce(taken < F.col("seq"), F.lit(False)))


def leased_state(events: DataFrame, now) -> DataFrame:
    """The state of each unit from a log whose claims are leases (columns of unit_state, fence, expires_at, generation).

    A claim holds until it expires, and then the unit is pending again (``expired``); what a run reports after a newer one
    took its unit over counts for nothing. ``observed_max`` and ``generation`` (when the newest page of the stored rows was
    fetched) are those of the last done; ``fence`` is the highest that claimed the unit."""
    unit = [*KEY, "partition_key", "chunk_start", "chunk_end"]
    valid = fenced(events).where(~F.col("refused"))
    last, done = F.max_by(F.struct("status", "expires_at"), "seq"), F.when(F.col("status") == "done", F.col("seq"))
    state = valid.groupBy(*unit).agg(last.alias("last"), F.max_by("observed_max", done).alias("observed_max"), F.max_by("generation", done).alias("generation"), F.max("fence").alias("fence"), F.count_if(F.col("status") == "claimed").alias("attempts"))
    expired = (F.col("last.status") == "claimed") & (F.col("last.expires_at") <= F.lit(now))
    status = F.when(expired | F.col("last.status").isin("reset", "released", "enqueued"), "pending").otherwise(F.col("last.status"))
    return state.select(*unit, status.alias("status"), "observed_max", "generation", "fence", "attempts", expired.alias("expired"))


def latest_version(rows: DataFrame, key: str = "id", version: str = "version", ingested: str | None = None) -> DataFrame:
    """The current row of each id among rows stored as they were emitted: that of the highest version, by text order (an
    assumption: versions of one width), then the latest ingested. max_by keeps one row per id and task before the
    shuffle, so an id with very many versions is no hot key."""
    order = F.struct(version, ingested) if ingested else F.col(version)
    return rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), order).alias("row")).select("row.*")


def one_per_id(rows: DataFrame, key: str = "id") -> DataFrame:
    """For feeds that re-emit active rows unchanged."""
    return rows.dropDuplicates([key])


GRAIN = "grain_days"


class GrainError(ValueError):
    """Sums over windows that rollups can't tell."""


def grained(rows: DataFrame, days: int, start: str = "window_start") -> DataFrame:
    """``rows`` of rollups with their grain as metadata of the column ``start``, which it keeps through plans and parquet."""
    return rows.withMetadata(start, rows.schema[start].metadata | {GRAIN: days})


def rollup(rows: DataFrame, by: list[str], sums: list[str], window: tuple[datetime, datetime], start: str = "window_start", end: str = "window_end") -> DataFrame:
    """``sums`` by ``by`` over the rollups of one window of their own grain. What a provider rolled up over a day must not be
    added into wider windows, as it counts what lies across midnight twice or not at all: another width than the grain, and
    rows without a grain, are refused, and rows of another window that meets this one fail the job."""
    grain = rows.schema[start].metadata.get(GRAIN)
    if grain is None:
        raise GrainError(f"{start} has no grain")
    if window[1] - window[0] != timedelta(days=grain):
        raise GrainError(f"rollups of {grain} days can't be summed over {window[1] - window[0]}")
    exact = (F.col(start) == F.lit(window[0])) & (F.col(end) == F.lit(window[1]))
    meets = (F.col(start) < F.lit(window[1])) & (F.col(end) > F.lit(window[0]))
    other = F.raise_error(F.concat(F.lit("a rollup of another window overlaps: "), F.col(start).cast("string"), F.lit(" to "), F.col(end).cast("string"))).cast("boolean")
    return rows.where(F.when(exact, F.lit(True)).when(meets, other).otherwise(F.lit(False))).groupBy(*by).agg(*[F.sum(x).alias(x) for x in sums])

"""Windows and work units, for all endpoints at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["provider", "endpoint"]
UNIT = [*KEY, "partition_key", "chunk_start", "chunk_end"]


def days(n: Column) -> Column:
    return F.make_dt_interval(n)


def trailing_edge(now: Column, cutoff_days: Column) -> Column:
    """UTC midnight of now, less the cutoff."""
    return F.date_trunc("day", now - days(cutoff_days))


def resume_start(watermark: Column, lookback_days: Column, frontier: Column, default: Column) -> Column:
    """Midnight at or before: watermark less lookback, else the coverage frontier, else the default start."""
    return F.date_trunc("day", F.coalesce(watermark - days(lookback_days), frontier, default))


def windows(endpoints: DataFrame, now) -> DataFrame:
    """window_start, window_end for every row of ``endpoints`` (KEY, watermark, frontier, default_start, lookback_days,
    cutoff_days, ...) that is not caught up."""
    start = resume_start(F.col("watermark"), F.col("lookback_days"), F.col("frontier"), F.col("default_start"))
    found = endpoints.withColumn("window_start", start).withColumn("window_end", trailing_edge(F.lit(now).cast("timestamp"), F.col("cutoff_days")))
    return found.where("window_start < window_end")


def caught_up(endpoints: DataFrame, now) -> DataFrame:
    return endpoints.join(windows(endpoints, now).select(*KEY), KEY, "left_anti")


def unit_days(fixed: Column, configured: Column) -> Column:
    """Rollups of a fixed grain pin their width, whatever is configured."""
    return F.coalesce(fixed, configured)


def tiles(spans: DataFrame) -> DataFrame:
    """Contiguous units (chunk_start, chunk_end) of ``unit_days`` whole days over each row's window_start and window_end; the
    last may be shorter. A span that does not start and end at midnight fails the job."""
    midnight = lambda c: F.col(c) == F.date_trunc("day", c)
    checked = F.when(midnight("window_start") & midnight("window_end") & (F.col("unit_days") >= 1), F.col("window_start")).otherwise(F.raise_error(F.lit("a span must start and end at UTC midnight, in units of whole days")).cast("timestamp"))
    starts = F.sequence(checked, F.col("window_end") - F.expr("interval 1 microsecond"), days(F.col("unit_days")))
    rows = spans.where("window_start < window_end").withColumn("chunk_start", F.explode(starts))
    return rows.withColumn("chunk_end", F.least(F.col("chunk_start") + days(F.col("unit_days")), F.col("window_end")))


def to_enqueue(planned: DataFrame, known: DataFrame) -> DataFrame:
    """Planned units that are not known yet; a null partition key equals a null one."""
    old = known.select(*[F.col(c).alias(f"_{c}") for c in UNIT])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in UNIT]
    return planned.select(*UNIT).distinct().join(old, same, "left_anti")


def to_release(units: DataFrame, spans: DataFrame) -> DataFrame:
    """Done units that lie wholly inside their endpoint's window and so can be planned again; straddlers stay done."""
    inside = (F.col("chunk_start") >= F.col("window_start")) & (F.col("chunk_end") <= F.col("window_end"))
    return units.where("status = 'done'").join(spans.select(*KEY, "window_start", "window_end"), KEY).where(inside).select(*UNIT)


def advanced(stored: DataFrame, observed: DataFrame) -> DataFrame:
    """Watermarks (KEY, watermark) after observations (KEY, observed_max): set if absent, moved if later, never back."""
    latest = observed.groupBy(*KEY).agg(F.max("observed_max").alias("observed_max"))
    return stored.select(*KEY, "watermark").join(latest, KEY, "full_outer").select(*KEY, F.greatest("watermark", "observed_max").alias("watermark")).where("watermark is not null")


def feed_tokens(pages: DataFrame) -> DataFrame:
    """The last version committed of each feed chain, for audit; pages: KEY, chain_id, page_seq, to_version."""
    return pages.groupBy(*KEY).agg(F.max_by("to_version", F.struct("fetched_at", "page_seq")).alias("to_version"))


def run_faults(runs: DataFrame) -> DataFrame:
    """Runs whose columns do not fit their status or mode, with the reason."""
    windowed = F.col("window_start").isNotNull() & F.col("window_end").isNotNull()
    no_window, no_version = F.col("window_start").isNull() & F.col("window_end").isNull(), F.col("from_version").isNull() & F.col("to_version").isNull()
    reason = (
        F.when(~F.col("status").isin("running", "succeeded", "failed"), "unknown status")
        .when((F.col("status") == "running") & F.col("ended_at").isNotNull(), "a running run has no end")
        .when((F.col("status") != "running") & F.col("ended_at").isNull(), "an ended run has an end")
        .when((F.col("status") == "failed") & F.col("error_detail").isNull(), "a failed run says why")
        .when((F.col("status") == "succeeded") & F.col("row_count").isNull(), "a succeeded run counts its rows")
        .when((F.col("mode") == "watermark") & (~windowed | ~no_version), "a windowed run has a window and no versions")
        .when((F.col("mode") == "watermark") & (F.col("window_start") >= F.col("window_end")), "a window ends after it starts")
        .when((F.col("mode") == "snapshot") & (~no_window | ~no_version), "a snapshot has no range")
        .when((F.col("mode") == "feed") & ~no_window, "a feed has no window")
        .when(F.col("ended_at") < F.col("started_at"), "a run ends after it starts")
    )
    return runs.withColumn("reason", reason).where("reason is not null")

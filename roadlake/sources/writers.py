"""Write disciplines: snapshot replace, window replace with pruning, append, single-table window replace."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from roadlake.catalog import EndpointSpec
from roadlake.operators import sets
from roadlake.operators.filters import in_window
from roadlake.sources import versions
from roadlake.sources.scans import OLD, dataset, file_system


@dataclass(frozen=True)
class WriteReport:
    rows_written: int
    duplicates_dropped: int
    files_written: int
    observed_max: datetime | None = None
    deleted_partitions: list[str] = field(default_factory=list)


class OutOfWindow(ValueError):
    """Rows whose date the window does not cover."""


class Counted:
    """Counts rows before and after exact dedup, and the latest event time, while the write runs: no pass of their own."""

    def __init__(self, rows: DataFrame, event_time: str | None = None, dedup: bool = True):
        self.before, self.after = Observation(), Observation()
        top = F.max(event_time) if event_time else F.lit(None).cast("timestamp")
        seen = rows.observe(self.before, F.count(F.lit(1)).alias("n"))
        self.rows = sets.distinct_rows(seen, dedup).observe(self.after, F.count(F.lit(1)).alias("n"), top.alias("top"))

    def report(self, files: int, deleted: list[str] | None = None) -> WriteReport:
        after, before = self.after.get, self.before.get
        return WriteReport(after["n"], before["n"] - after["n"], files, after.get("top"), deleted or [])


def part_files(spark: SparkSession, path: str, dates: Iterable[date] | None = None) -> list[tuple[int, str]]:
    """(time, name) of the parquet files below a folder, or below some of its date partitions."""
    system, place = file_system(spark, path)
    out = []
    for folder in [place] if dates is None else [place.suffix(f"/date={d}") for d in dates]:
        if system.exists(folder):
            found = system.listFiles(folder, True)
            while found.hasNext():
                file = found.next()
                if (name := file.getPath().getName()).endswith(".parquet"):
                    out.append((file.getModificationTime(), name))
    return out


def of_last_job(files: list[tuple[int, str]]) -> int:
    """How many files have the job id, which Spark puts into their names, of the latest one."""
    jobs = [m[0] if (m := re.search(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", name)) else name for _, name in files]
    return jobs.count(jobs[max(range(len(files)), key=lambda k: files[k][0])]) if files else 0


def fresh(path: str) -> str:
    """Where the next version of a folder is written before it takes its place."""
    return f"{path}-new-{uuid.uuid4().hex[:8]}"


def swap(spark: SparkSession, new: str, path: str) -> None:
    """Puts a written folder in another's place. Between the two renames, and after a crash there, the old one lies beside it
    under a fixed name, by which scans.dataset finds it and the next swap goes on."""
    system, place = file_system(spark, path)
    old = place.suffix(OLD)
    if system.exists(place):
        system.delete(old, True)
        if not system.rename(place, old):
            raise OSError(f"cannot move {path} aside")
    if not system.rename(file_system(spark, new)[1], place):
        raise OSError(f"cannot move {new} to {path}")
    system.delete(old, True)


def replace_snapshot(rows: DataFrame, path: str, dedup: bool = True) -> WriteReport:
    """The whole dataset anew; a job that fails leaves the old one."""
    spark, new, counted = rows.sparkSession, fresh(path), Counted(rows, None, dedup)
    counted.rows.write.parquet(new)
    swap(spark, new, path)
    return counted.report(len(part_files(spark, path)))


def covered(start: datetime, end: datetime) -> list[date]:
    last = (end - timedelta(microseconds=1)).date()
    return [start.date() + timedelta(days=k) for k in range((last - start.date()).days + 1)]


def spread(rows: DataFrame) -> DataFrame:
    """Rows of a date together, as one file where a task can hold them: adaptive execution joins small dates into tasks and
    splits those that are too large for one by their observed size."""
    return rows.hint("rebalance", "date")


Spans = list[tuple[datetime, datetime]]


def replace_window(rows: DataFrame, path: str, event_time: str, start: datetime, end: datetime, dedup: bool = True) -> WriteReport:
    """replace_spans() of one window."""
    return replace_spans(rows, path, event_time, [(start, end)], dedup)


def replace_spans(rows: DataFrame, path: str, event_time: str, spans: Spans, dedup: bool = True, fence: int | None = None, sizes: dict[date, int] | None = None) -> WriteReport:
    """Every date that one of ``spans`` covers is replaced whole by what was fetched for it, in one write; those that got no
    row are deleted.

    A row of a date that no span covers fails the job before it commits, so nothing is replaced. Only partitions of covered
    dates are ever looked at or deleted, after the data is written. With a ``fence``, or where a dataset is kept in versions,
    the dates are replaced in a new version, which readers see whole, and a writer that a later run has overtaken is refused.
    ``sizes``: rows by date, if they are known; then one shuffle serves both exact dedup and the files.
    """
    spark, days, marks = rows.sparkSession, sorted({d for span in spans for d in covered(*span)}), Observation()
    base = versions.version(spark, path) if fence or versions.exists(spark, path) else None
    dated = sets.with_date(rows, event_time)
    inside = reduce(lambda a, b: a | b, [F.col("date").between(F.lit(c[0]), F.lit(c[-1])) for c in (covered(*span) for span in spans)])
    refused = F.raise_error(F.concat(F.lit("row outside the window: "), F.coalesce(F.col("date").cast("string"), F.lit("no event time")))).cast("date")
    if sizes is not None:
        dated = bucketed(dated, sizes)
    counted = Counted(dated, event_time, dedup)
    guarded = counted.rows.drop(BUCKET).withColumn("date", F.when(inside, F.col("date")).otherwise(refused))
    guarded = guarded if sizes is not None else spread(guarded)
    # which dates got rows, as bits, found while the write runs
    at, length = F.datediff("date", F.lit(days[0])), (days[-1] - days[0]).days + 1
    bits = [F.bit_or(F.when(F.floor(at / 60) == k, F.call_function("shiftleft", F.lit(1).cast("long"), (at % 60).cast("int")))).alias(f"b{k}") for k in range(length // 60 + 1)]
    try:
        if base is not None:
            had = {x.key for x in base[1] if x.folder}
            new = versions.replace(guarded, path, days, fence or 0, base)
            return counted.report(sum(x.files for x in new), sorted(had & {str(x) for x in days} - {x.key for x in new}))
        guarded.observe(marks, *bits).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)
    except Exception as error:
        if "row outside the window" in str(error):
            raise OutOfWindow(str(error).split("\n")[0]) from error
        raise
    written = {day for day in days if (marks.get.get(f"b{(day - days[0]).days // 60}") or 0) >> (day - days[0]).days % 60 & 1}
    deleted = prune(spark, path, days, written)
    return counted.report(len(part_files(spark, path, written)), deleted)


BUCKET, FILE_ROWS = "_bucket", 2_000_000


def bucketed(rows: DataFrame, sizes: dict[date, int], file_rows: int | None = None) -> DataFrame:
    """``rows`` dealt out by date and bucket, of which a date has as many as its rows ask for; equal rows are in one bucket, so
    that exact dedup over all columns needs no exchange of its own."""
    wanted = F.create_map(*[x for day, n in sizes.items() for x in (F.lit(day), F.lit(-(-n // (file_rows or FILE_ROWS))))]) if sizes else F.lit(None).cast("map<date,int>")
    plain = [F.to_json(F.struct(c)) if t.startswith("map") else F.col(c) for c, t in rows.dtypes]
    bucket = F.pmod(F.xxhash64(*plain), F.coalesce(F.element_at(wanted, F.col("date")), F.lit(1)))
    return rows.withColumn(BUCKET, bucket).repartition("date", BUCKET)


def prune(spark: SparkSession, path: str, days: list[date], written: set[date]) -> list[str]:
    """Deletes the partitions of ``days`` that were not written. Only these folders are probed; the table is not listed."""
    system, place = file_system(spark, path)
    deleted = []
    for day in days:
        folder = place.suffix(f"/date={day}")
        if day not in written and system.exists(folder):
            system.delete(folder, True)
            deleted.append(day.isoformat())
    return deleted


def append(rows: DataFrame, path: str, event_time: str) -> WriteReport:
    """New files by event date; nothing is read, rewritten or deduplicated. A row without event time fails the job before
    anything is committed. The dates written are observed as bits, so that only their folders are looked at for the report."""
    spark, counted, marks = rows.sparkSession, Counted(refuse_null_dates(sets.with_date(rows, event_time)), event_time, dedup=False), Observation()
    day = F.unix_date("date").cast("long") + 1  # bit positions count from 1, in buckets of 32768 days
    seen = counted.rows.observe(marks, F.bitmap_construct_agg(F.bitmap_bit_position(day)).alias("days"))
    spread(seen).write.mode("append").partitionBy("date").parquet(path)
    bits = marks.get["days"] or b""
    days = [date(1970, 1, 1) + timedelta(days=8 * k + j) for k, byte in enumerate(bits) for j in range(8) if byte >> j & 1]
    return counted.report(of_last_job(part_files(spark, path, days)))


def refuse_null_dates(rows: DataFrame) -> DataFrame:
    return rows.withColumn("date", F.when(F.col("date").isNotNull(), F.col("date")).otherwise(F.raise_error(F.lit("a row has no event time to be stored by")).cast("date")))


def replace_single_window(rows: DataFrame, path: str, event_time: str, start: datetime, end: datetime, dedup: bool = True) -> WriteReport:
    """A dataset without partitions: rows of the window go, the fetched rows come."""
    return replace_single_spans(rows, path, event_time, [(start, end)], dedup)


def replace_single_spans(rows: DataFrame, path: str, event_time: str, spans: Spans, dedup: bool = True) -> WriteReport:
    spark, new, counted = rows.sparkSession, fresh(path), Counted(rows, event_time, dedup)
    inside = reduce(lambda a, b: a | b, [in_window(F.col(event_time), *span) for span in spans])
    before = dataset(spark, path, rows.schema).where(~F.coalesce(inside, F.lit(False)))
    sets.concat([before, counted.rows]).write.parquet(new)
    swap(spark, new, path)
    return counted.report(len(part_files(spark, path)))


def write_dataset(rows: DataFrame, spec: EndpointSpec, root: str, window: tuple[datetime, datetime] | None = None, dedup: bool = True) -> WriteReport:
    """The discipline that a dataset's mode and layout ask for."""
    if (spec.mode == "watermark") != (window is not None):
        raise ValueError(f"{spec.key}: a window exactly for windowed datasets")
    if spec.mode == "watermark":
        return write_spans(rows, spec, root, [window], dedup)
    path = f"{root}/{spec.provider}/{spec.name}"
    return replace_snapshot(rows, path, dedup) if spec.mode == "snapshot" else append(rows, path, spec.event_time)


def write_spans(rows: DataFrame, spec: EndpointSpec, root: str, spans: Spans, dedup: bool = True, **more) -> WriteReport:
    """Rows of several windows of a windowed dataset, in one write."""
    path = f"{root}/{spec.provider}/{spec.name}"
    if spec.layout != "date":
        return replace_single_spans(rows, path, spec.event_time, spans, dedup)
    return replace_spans(rows, path, spec.event_time, spans, dedup, **more)


def append_rows(spark: SparkSession, rows: list[dict], schema: str, path: str) -> None:
    """Adds a few control rows (runs, unit events) to an append-only table."""
    spark.createDataFrame([tuple(r.get(c.split()[0]) for c in schema.split(", ")) for r in rows], schema).coalesce(1).write.mode("append").parquet(path)


RUNS = "run_id string, provider string, endpoint string, status string, mode string, window_start timestamp, window_end timestamp, from_version string, to_version string, row_count long, started_at timestamp, ended_at timestamp, error_detail string, report string"


def last_runs(runs: DataFrame) -> DataFrame:
    """The latest run of each endpoint as a JSON document for people to read."""
    last = runs.groupBy("provider", "endpoint").agg(F.max_by(F.struct(*runs.columns), F.coalesce("ended_at", "started_at")).alias("run"))
    return last.select("provider", "endpoint", F.to_json("run").alias("document"))


def project_metadata(runs: DataFrame, root: str) -> None:
    """Writes each document beside its dataset; best effort, after the data."""
    spark = runs.sparkSession
    for r in last_runs(runs).collect():  # a row per dataset
        system, place = file_system(spark, f"{root}/{r['provider']}/{r['endpoint']}.metadata.json")
        out = system.create(place, True)
        out.write(bytearray(r["document"].encode()))
        out.close()

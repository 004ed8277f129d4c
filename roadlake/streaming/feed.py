"""Feed ingestion: landed pages stream in, are audited, decoded and typed, and are appended by event date.

The checkpoint says which files have been taken, the feed's own table (``_control/feeds``) with which version and page the
last batch ended. Every batch is audited from there on, on page numbers and versions only, before anything of it is
written: a malformed page, a gap between versions or a stalled feed stops the stream before that batch and is named. A
rerun begins with the same batch, once the pages are mended.

A batch is stored under its number, so one that is repeated after a crash replaces itself. A page that the fetcher landed
twice breaks the chain. There is no event-time watermark, so late rows are never dropped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadlake.catalog import EndpointSpec
from roadlake.operators import audit, decode, typing
from roadlake.operators.sets import with_date
from roadlake.sources import scans, writers
from roadlake.staging import staged, unstage

FEEDS = "provider string, endpoint string, batch long, chain_id string, page_seq int, version string"


class FeedError(audit.WalkError):
    """A feed that can't be gone on with."""


def batches(pages: DataFrame, spec: EndpointSpec, strict: bool = True) -> DataFrame:
    """Typed rows of pages, batch or stream: the lazy plan from page to row. ``strict``: a malformed page or a record with
    errors fails the job that meets it."""
    own = pages.where((pages["provider"] == spec.provider) & (pages["endpoint"] == spec.name))
    return typing.valid(typing.typed(decode.records(own, spec.decode, strict), spec.schema), strict)


def asked_from(param: str = "fromVersion") -> Column:
    """The version that a request went on from: a parameter, or in the body of a JSON-RPC call."""
    return F.coalesce(F.col("sent_params")[param], F.get_json_object("sent_body", f"$.params.{param}"))


def page_faults(pages: DataFrame, spec: EndpointSpec, last_version: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(faults of landed pages of a feed, the pages' numbers and versions as staged for it), as the pages follow on
    ``last_version``. Pages are ordered by when they were fetched, then by chain and number. Unlike a walk that is over, a
    feed may end on any page; each must be well formed, ask from the version before it, and move it if it is full."""
    own = {"version": audit.label("result.toVersion"), "n": audit.size(".".join(spec.decode.path)), "limit": F.col("results_limit"), "sent": asked_from(), "at": F.col("fetched_at"), "malformed": decode.faults(spec.decode)}
    rows = staged(audit.narrow(pages, own))
    order = Window.partitionBy("provider", "endpoint").orderBy("at", "chain_id", "page_seq")
    told = rows.withColumn("before", F.coalesce(F.lag("version").over(order), F.lit(last_version)))
    full = F.col("n") >= F.col("limit")
    fault = (
        F.when(F.col("malformed").isNotNull(), F.col("malformed"))
        .when(F.col("version").isNull(), "result.toVersion: missing")
        .when(F.col("sent").isNull() & F.col("before").isNotNull(), F.concat(F.lit("seed after version "), "before"))
        .when(F.col("sent").isNotNull() & F.col("before").isNotNull() & (F.col("sent") != F.col("before")), F.concat(F.lit("asked from version "), "sent", F.lit(", the page before ends with "), "before"))
        .when(full & (F.col("version") == F.coalesce("sent", F.lit(""))), "feed stalled: a full page did not move the version")
    )
    return audit.found(told, fault), rows


def last_page(spark: SparkSession, root: str, spec: EndpointSpec, before: int | None = None) -> str | None:
    """The version with which the batches of a feed (before one of them) ended."""
    rows = scans.dataset(spark, f"{root}/_control/feeds", spark.createDataFrame([], FEEDS).schema)
    own = rows.where((F.col("provider") == spec.provider) & (F.col("endpoint") == spec.name))
    own = own if before is None else own.where(F.col("batch") < before)
    return own.agg(F.max_by("version", "batch")).first()[0]


def take_batch(batch: DataFrame, number: int, root: str, spec: EndpointSpec, observer: Callable[[DataFrame, int], None] | None = None) -> None:
    """Audits and stores one batch of pages: checks first, then data, then the page that the feed has come to."""
    spark = batch.sparkSession
    own = batch.where((F.col("provider") == spec.provider) & (F.col("endpoint") == spec.name))
    found, rows = page_faults(own, spec, last_page(spark, root, spec, number))
    if bad := found.orderBy("chain_id", "page_seq").limit(5).collect():
        raise FeedError("; ".join(f"{spec.key} {r['chain_id']}/{r['page_seq']}: {r['fault']}" for r in bad))
    last = rows.orderBy(F.desc("at"), F.desc("chain_id"), F.desc("page_seq")).select("chain_id", "page_seq", "version").first()
    if last is None:
        return
    typed = batches(own, spec)
    if observer:
        observer(typed, number)
    dated = writers.refuse_null_dates(with_date(typed, spec.event_time)).withColumn("batch", F.lit(number))
    writers.spread(dated).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date", "batch").parquet(f"{root}/{spec.provider}/{spec.name}")
    writers.append_rows(spark, [{"provider": spec.provider, "endpoint": spec.name, "batch": number, **last.asDict()}], FEEDS, f"{root}/_control/feeds")
    unstage(rows)


def start(spark: SparkSession, landed: str, root: str, spec: EndpointSpec, form: str = "json", files_per_batch: int | None = None, observer: Callable[[DataFrame, int], None] | None = None, once: bool = True) -> StreamingQuery:
    """Appends what has landed since the last run (``once``), or goes on as pages land. A malformed page, a broken chain, a
    record with errors or one without event time stops the stream before anything of its batch is stored. ``observer`` sees
    every batch of validated rows. Rows of a date are one file a batch, or several of observed size where they are many."""
    if spec.mode != "feed":
        raise ValueError(f"{spec.key} is no feed")
    pages = scans.page_stream(spark, landed, form, files_per_batch)
    writer = pages.writeStream.foreachBatch(lambda batch, number: take_batch(batch, number, root, spec, observer))
    writer = writer.option("checkpointLocation", f"{root}/_checkpoints/{spec.provider}/{spec.name}")
    return (writer.trigger(availableNow=True) if once else writer).start()

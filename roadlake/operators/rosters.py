"""Rosters: members of a listing with a count of the listings in a row that they were absent from."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlake.operators.filters import fetchable
from roadlake.staging import staged

KEY = ["provider", "name", "member"]
ROSTER = "provider string, name string, member string, absence_count int"


class EmptyListing(ValueError):
    """A listing without members would age the whole roster."""


def reconcile(stored: DataFrame, listed: DataFrame, policies: DataFrame) -> DataFrame:
    """provider, name, member, action, absence_count for every member of ``stored`` (KEY, absence_count) or ``listed`` (KEY).

    Listed members are at 0 (action zero if new or absent before, keep otherwise); absent ones count one more (increment),
    and go (evict) once that is over the roster's ``evict_after`` (policies: provider, name, evict_after; null: never).
    Only rosters that ``listed`` has members of are reconciled.
    """
    fresh = fetchable(listed, "member").select(*KEY).distinct().withColumn("present", F.lit(True))
    known = stored.join(fresh.select("provider", "name").distinct(), ["provider", "name"], "left_semi")
    both = known.join(fresh, KEY, "full_outer").join(policies.select("provider", "name", "evict_after"), ["provider", "name"], "left")
    count, here = F.coalesce("absence_count", F.lit(0)), F.coalesce("present", F.lit(False))
    action = F.when(here & (F.col("absence_count").isNull() | (count > 0)), "zero").when(here, "keep").when(F.col("evict_after").isNotNull() & (count + 1 > F.col("evict_after")), "evict").otherwise("increment")
    return both.select(*KEY, action.alias("action"), F.when(here, 0).otherwise(count + 1).cast("int").alias("absence_count"))


def require_listed(listed: DataFrame) -> None:
    if fetchable(listed, "member").isEmpty():
        raise EmptyListing("an empty listing is refused")


def applied(stored: DataFrame, delta: DataFrame) -> DataFrame:
    """The roster after ``delta``; rosters that it does not touch stay as they are."""
    untouched = stored.join(delta.select("provider", "name").distinct(), ["provider", "name"], "left_anti")
    return untouched.select(*KEY, "absence_count").unionByName(delta.where("action <> 'evict'").select(*KEY, "absence_count"))


def due(policies: DataFrame, successes: DataFrame, stored: DataFrame, now) -> DataFrame:
    """Rosters to refresh (policies: provider, name, feeder, max_age_days): never listed, older than their age, or empty."""
    sizes = stored.groupBy("provider", "name").agg(F.count("*").alias("members"))
    fed = policies.join(successes.select("provider", F.col("endpoint").alias("feeder"), "last_success"), ["provider", "feeder"], "left").join(sizes, ["provider", "name"], "left")
    age = F.lit(now).cast("timestamp") - F.col("last_success")
    reason = F.when(F.col("last_success").isNull(), "never listed").when(F.coalesce("members", F.lit(0)) == 0, "empty").when(age > F.make_dt_interval(F.col("max_age_days")), "too old")
    return fed.withColumn("reason", reason).where("reason is not null").select("provider", "name", "feeder", "reason")


def readiness(consumers: DataFrame, due_: DataFrame, failed: DataFrame, policies: DataFrame) -> DataFrame:
    """provider, endpoint, name, ready, why: whether each consumer (provider, endpoint, name of its roster) can be laid out
    over its roster, once the feeders of due rosters (due()) were listed anew or failed (provider, feeder). A roster that is
    too old is used as it is if its policy (provider, name, keep_stale) says so; one without members never is."""
    state = due_.join(failed.withColumn("failed", F.lit(True)), ["provider", "feeder"], "left").join(policies, ["provider", "name"], "left")
    both = consumers.join(state, ["provider", "name"], "left")
    refreshed, old = F.col("reason").isNotNull() & F.col("failed").isNull(), F.coalesce((F.col("reason") == "too old") & F.col("keep_stale"), F.lit(False))
    why = F.when(F.col("reason").isNull(), "fresh").when(refreshed, "listed anew").when(old, "the feeder failed, the old members stay").otherwise(F.concat(F.lit("the feeder failed, and the roster is "), "reason"))
    return both.select("provider", "endpoint", "name", (F.col("reason").isNull() | refreshed | old).alias("ready"), why.alias("why"))


def fan_out(members: DataFrame, windows: DataFrame) -> DataFrame:
    """Every member of a roster with every window of its provider (windows: provider, endpoint, window_start, window_end):
    the plan itself, one request per row."""
    return windows.join(members.select("provider", "member"), "provider")


def batches(members: DataFrame, size: int) -> DataFrame:
    """provider, name, batch, members: sorted members, ``size`` to a batch, joined by commas; a member with a comma
    fails the job. Members are ranked inside ranges of their order, whose sizes give each range its first rank, so a roster
    of any size is no single task."""
    roster = ["provider", "name"]
    checked = F.when(F.contains("member", F.lit(",")), F.raise_error(F.lit("a member holds a comma")).cast("string")).otherwise(F.col("member"))
    ranges = members.select(*roster, checked.alias("member")).repartitionByRange(*roster, "member")
    rows = staged(ranges.withColumn("_range", F.spark_partition_id()))
    earlier = Window.partitionBy(*roster).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(*roster, "_range").agg(F.count("*").alias("_n"))
    begin = sizes.select(*roster, "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_begin"))
    inside = F.row_number().over(Window.partitionBy(*roster, "_range").orderBy("member"))
    ranked = rows.withColumn("_rank", inside).join(begin, [*roster, "_range"])
    batch = F.floor((F.col("_begin") + F.col("_rank") - 1) / size).cast("int")
    return ranked.select(*roster, batch.alias("batch"), "member").groupBy(*roster, "batch").agg(F.concat_ws(",", F.array_sort(F.collect_list("member"))).alias("members"))

"""URL filters as a temporal list join: dated list entries become validity intervals, and each capture is judged by the
entries that were active when it was fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlake.llm import common

DAY = 86_400


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dot; empty where there is none."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*?)\.?(?:[:/?#]|$)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def keys_of(url: Column, segments: int = 2) -> Column:
    """What an entry can name to match a URL: its host, every parent domain of two or more labels, and its host with
    the first 1 to ``segments`` path segments."""
    labels = F.split(host_of(url), r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda k: F.concat_ws(".", F.slice(labels, k, F.size(labels))))
    parts = F.filter(F.split(path_of(url), "/"), lambda x: x != "")
    prefixes = F.transform(F.filter(F.sequence(F.lit(1), F.lit(segments)), lambda k: k <= F.size(parts)), lambda k: F.concat(host_of(url), F.lit("/"), F.concat_ws("/", F.slice(parts, F.lit(1), k))))
    return F.when(host_of(url) == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(domains, prefixes)))


def intervals(entries: DataFrame) -> DataFrame:
    """list_name, key, valid_from, valid_to (exclusive, null: still valid) from dated entries (list_name, key, listed_at,
    active): an entry holds until the next one of its list and key. Of several at one time, an active one wins. Rows
    without list, key or time are no entries."""
    dated = entries.where("list_name is not null and key is not null and listed_at is not null")
    one = dated.groupBy("list_name", "key", "listed_at").agg(F.max(F.coalesce("active", F.lit(False))).alias("active"))
    later = F.lead("listed_at").over(Window.partitionBy("list_name", "key").orderBy("listed_at"))
    return one.withColumn("valid_to", later).where("active").select("list_name", "key", F.col("listed_at").alias("valid_from"), "valid_to")


def judge(captures: DataFrame, entries: DataFrame, bucket_days: int = 30) -> DataFrame:
    """page_id, url, fetched_at, n_matches, lists (sorted), matched_key (the longest), blocked: a row per row of
    ``captures`` (page_id, url, fetched_at).

    Intervals are cut at bucket borders, within the span of all fetches, so that the as-of condition is an equality on
    (key, bucket) and a comparison: a capture meets only the few intervals of its own days, and a host of a third of all
    captures is dealt further by adaptive skew handling, as both sides are plain staged tables. Of the captures, only the
    first and last fetch time reach the driver.

    URLs give as many path prefixes as the deepest key of the lists has segments; that number reaches the driver too.

    The verdict depends on URL and time alone: it is found once for each pair and joined back. Null URLs or times,
    and URLs without a host, match nothing. Repeated rows are judged each; empty tables give no rows, or none
    matched. Columns other than the three are not read.
    """
    own = captures.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("fetched_at").cast("timestamp").alias("fetched_at"))
    bucket = lambda t: F.floor(F.unix_seconds(t) / (bucket_days * DAY)).cast("long")
    span = own.agg(F.min("fetched_at").alias("a"), F.max("fetched_at").alias("b")).first()
    valid = intervals(entries).withColumn("first", F.greatest("valid_from", F.lit(span["a"]).cast("timestamp"))).withColumn("last", F.least("valid_to", F.lit(span["b"]).cast("timestamp")))
    listed = common.staged(valid.where("first <= last").select("list_name", "key", "valid_from", "valid_to", F.explode(F.sequence(bucket(F.col("first")), bucket(F.col("last")))).alias("bucket")))
    deepest = listed.agg(F.max(F.size(F.split("key", "/")) - 1)).first()[0]
    asked = own.where("url is not null and fetched_at is not null").select("url", "fetched_at").distinct()
    asked = asked.select("url", "fetched_at", F.explode(keys_of(F.col("url"), max(1, deepest or 1))).alias("key"), bucket(F.col("fetched_at")).alias("bucket"))
    active = (F.col("valid_from") <= F.col("fetched_at")) & (F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to")))
    met = asked.join(listed, ["key", "bucket"]).where(active)
    verdict = met.groupBy("url", "fetched_at").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("list_name")).alias("lists"), F.max(F.struct(F.length("key"), "key"))["key"].alias("matched_key"))
    found = own.join(common.staged(verdict), ["url", "fetched_at"], "left")
    return found.select("page_id", "url", "fetched_at", F.coalesce("n", F.lit(0)).alias("n_matches"), F.concat_ws(",", "lists").alias("lists"), "matched_key", F.coalesce(F.col("n") > 0, F.lit(False)).alias("blocked"))


# Fetch times and list entries of the query are derived from the pages themselves: a page is fetched within 120 days, by
# its page_id; of the hosts, parent domains and hosts with their first path segment, some are listed, taken off and
# listed again, by their MD5.


def captures_of(pages: DataFrame) -> DataFrame:
    seconds = F.lit(1_704_067_200) + (F.col("page_id") * 7919) % (120 * DAY)
    return pages.select("page_id", "url", F.timestamp_seconds(seconds).alias("fetched_at"))


def entries_of(pages: DataFrame) -> DataFrame:
    """(list_name, key, listed_at, active) for a share of the hosts and host paths of ``pages``."""
    hosts = pages.select(F.explode(keys_of(F.col("url"), 1)).alias("key")).distinct().withColumn("h", F.md5("key"))
    digit = lambda k: F.conv(F.substring("h", k, 2), 16, 10).cast("long")
    start = 1_704_067_200 + digit(3) * 36_000
    dated = hosts.where(digit(1) < 64).select(F.when(digit(1) < 32, "adult").otherwise("spam").alias("list_name"), "key", F.explode(F.array(*[F.struct(F.timestamp_seconds(start + k * (1 + digit(5)) * 21_600).alias("listed_at"), F.lit(k % 2 == 0).alias("active"), F.lit(k).alias("k")) for k in range(4)])).alias("e"), digit(7).alias("z"))
    return dated.where(F.col("e.k") <= F.col("z") % 4).select("list_name", "key", "e.listed_at", "e.active")


ORACLE = r"""
WITH p AS (SELECT page_id, url, make_timestamp((1704067200 + (page_id * 7919) % 10368000) * 1000000) AS fetched_at,
  lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*?)\.?(?:[:/?#]|$)', 1)) AS host,
  list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS parts FROM pages),
q AS (SELECT *, string_split(host, '.') AS labels FROM p),
k AS (SELECT page_id, url, fetched_at, CASE WHEN host = '' THEN [] ELSE list_distinct(list_concat(
    list_transform(range(1, greatest(len(labels), 2)), lambda i: array_to_string(labels[i:], '.')),
    list_transform(range(1, least(len(parts), 2) + 1), lambda i: host || '/' || array_to_string(parts[1:i], '/')))) END AS keys, len(parts) AS np, host,
    CASE WHEN len(parts) > 1 THEN host || '/' || array_to_string(parts[1:2], '/') END AS second FROM q),
u AS (SELECT page_id, url, fetched_at, unnest(keys) AS key FROM k),
h AS (SELECT DISTINCT key, md5(key) AS h FROM (SELECT unnest(list_filter(keys, lambda x: second IS NULL OR x <> second)) AS key FROM k)),
n AS (SELECT key, ('0x' || h[1:2])::BIGINT AS a, ('0x' || h[3:4])::BIGINT AS b, ('0x' || h[5:6])::BIGINT AS c, ('0x' || h[7:8])::BIGINT AS z FROM h),
e AS (SELECT CASE WHEN a < 32 THEN 'adult' ELSE 'spam' END AS list_name, key, i % 2 = 0 AS active,
  make_timestamp((1704067200 + b * 36000 + i * (1 + c) * 21600) * 1000000) AS listed_at
  FROM n, (SELECT unnest(range(0, 4)) AS i) r WHERE a < 64 AND i <= z % 4),
v AS (SELECT list_name, key, active, listed_at AS valid_from, lead(listed_at) OVER (PARTITION BY list_name, key ORDER BY listed_at) AS valid_to FROM e),
m AS (SELECT page_id, u.url, u.fetched_at, v.list_name, u.key FROM u JOIN v ON u.key = v.key AND v.active AND v.valid_from <= u.fetched_at AND (v.valid_to IS NULL OR u.fetched_at < v.valid_to)),
g AS (SELECT page_id, count(*) AS n, array_to_string(list_sort(list_distinct(list(list_name))), ',') AS lists, max(lpad(CAST(length(key) AS VARCHAR), 6, '0') || key)[7:] AS matched_key FROM m GROUP BY page_id)
SELECT p.page_id, p.url, p.fetched_at, coalesce(n, 0) AS n_matches, coalesce(lists, '') AS lists, matched_key, n IS NOT NULL AS blocked FROM p LEFT JOIN g ON p.page_id = g.page_id
"""

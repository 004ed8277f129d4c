"""The current row of each id, kept up to date lot by lot.

Rows are kept in buckets by a hash of their id. A lot of new rows rewrites the buckets that it has ids of, and no others;
they take the old ones' place in one new version (sources.versions), so readers see every id once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlake.operators.aggregates import latest_version
from roadlake.sources import versions

BUCKET = T.StructField("bucket", T.IntegerType())


def version_order(version: Column, kind: str) -> Column:
    """What versions are ordered by: their text, the number that they are, or the number that their hexadecimal digits are,
    whatever their width. Versions that are no such number come before all others."""
    if kind == "text":
        return version
    if kind == "number":
        return version.try_cast("decimal(38,0)")
    if kind == "hex":
        digits = F.lower(version)
        return F.when(digits.rlike("^[0-9a-f]{1,64}$"), F.lpad(digits, 64, "0"))
    raise ValueError(f"versions are ordered by text, number or hex, not {kind}")


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int").alias(BUCKET.name)


def update(rows: DataFrame, path: str, key: str = "id", version: str = "version", buckets: int = 256, order: str = "text") -> list[int]:
    """Takes ``rows`` (all with the table's columns) in; returns the buckets that were rewritten. Of an id the row of the
    highest version stays, of equal ones that of the greatest other columns. The number of buckets is fixed by the first lot."""
    spark, base = rows.sparkSession, versions.version(rows.sparkSession, path)
    known = {x.key for x in base[1]}
    if known and known != {str(k) for k in range(buckets)}:
        raise ValueError(f"{path} has {len(known)} buckets, not {buckets}")
    touched = sorted(r[0] for r in rows.select(bucket_of(key, buckets)).distinct().collect())  # at most ``buckets`` numbers
    if known and not touched:
        return []
    old = versions.of_parts(spark, path, [x for x in base[1] if int(x.key) in touched], rows.schema, BUCKET)
    ranked = old.unionByName(rows).withColumn("_order", F.struct(version_order(F.col(version), order).alias("v"), F.struct(*rows.columns).alias("row")))
    newest = latest_version(ranked, key, "_order").drop("_order").withColumn(BUCKET.name, bucket_of(key, buckets))
    dealt = newest.repartition(max(1, len(touched)), BUCKET.name)
    versions.replace(dealt, path, touched if known else range(buckets), base=base, column=BUCKET.name)
    return touched


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The current rows; none while nothing was taken in."""
    return versions.of_parts(spark, path, versions.version(spark, path)[1], schema, BUCKET)

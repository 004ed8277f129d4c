"""Scans of landed pages (batch and stream) and of stored datasets that may not be there yet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: One row per API response, with the request that produced it.
PAGE = "provider string, endpoint string, chain_id string, page_seq int, sent_params map<string,string>, sent_body string, results_limit int, body string, fetched_at timestamp"


def pages(spark: SparkSession, path: str, provider: str | None = None, endpoint: str | None = None, form: str = "parquet") -> DataFrame:
    """Landed pages of one endpoint; the filters reach a parquet scan, and prune folders if pages are partitioned so."""
    found = spark.read.schema(PAGE).format(form).load(path)
    for name, value in (("provider", provider), ("endpoint", endpoint)):
        found = found.where(F.col(name) == value) if value is not None else found
    return found


def page_stream(spark: SparkSession, path: str, form: str = "json", files_per_batch: int | None = None) -> DataFrame:
    """The same rows as they arrive."""
    reader = spark.readStream.schema(PAGE).format(form)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).load(path)


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path) for stores that only Spark reaches."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = file_system(spark, path)
    return system.exists(place)


#: A folder that is being replaced lies beside its place under this name for a moment.
OLD = "-old"


def dataset(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored dataset, or no rows of its schema while nothing has been written. Date partitions give the column date,
    on which filters prune folders, if the schema has it. Of a dataset kept in versions, the newest."""
    from roadlake.sources import versions  # which reads through this module

    if versions.exists(spark, path):
        return versions.read(spark, path, schema)
    for place in (path, path + OLD):
        if exists(spark, place):
            return spark.read.schema(schema).parquet(place)
    return spark.createDataFrame([], schema)


def partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """dataset() of a date-partitioned table, with its column date."""
    return dataset(spark, path, T.StructType([*schema.fields, T.StructField("date", T.DateType())]))

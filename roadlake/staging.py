"""Tables kept for the length of a job in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. A session that names none gets a temporary folder if it runs on this machine alone, as in
    tests; on a cluster, whose executors would each write to a disk of their own, it is an error."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("roadlake.shared.dir", None)
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a folder that the driver and all executors of {master} share")
        found = f"file://{tempfile.mkdtemp(prefix='spark-roadlake-')}"
        spark.conf.set("roadlake.shared.dir", found)
    return found.rstrip("/")


def compiled(spark: SparkSession) -> None:
    """Plans over wide schemas generate methods of more than 8,000 bytes of code, which the JVM interprets and never compiles.
    With this limit Spark runs such a stage operator by operator, in short methods. Results are the same."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", 8000)


#: Tables staged inside the calls of condensed() that are going on, the innermost last; jobs in other threads have their own.
scratch: ContextVar[tuple[list[DataFrame], ...]] = ContextVar("scratch", default=())


def staged(df: DataFrame) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: lineage ends there, so a lost executor costs only the
    current step, and a row order or random choice is fixed from then on."""
    path = f"{shared_dir(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    vars(out)["_staged_at"] = path
    if made := scratch.get():
        made[-1].append(out)
    return out


def local(df: DataFrame) -> DataFrame:
    """A table of the driver's, for control rows that are few by their nature: a row per unit of one dataset, at most one a day."""
    return df.sparkSession.createDataFrame(df.toArrow(), df.schema)


def condensed(make: Callable[[], DataFrame]) -> DataFrame:
    """The staged result of ``make``; what it stages on the way is deleted."""
    made: list[DataFrame] = []
    outer = scratch.set((*scratch.get(), made))
    try:
        result = make()
    finally:
        scratch.reset(outer)
    out = staged(result)
    for df in made:
        unstage(df)
    return out


def unstage(df: DataFrame) -> None:
    """Deletes the files of a staged table that is not read again."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
    if path := vars(df).get("_staged_at"):
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)

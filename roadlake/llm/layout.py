"""Order and place of documents without a global task: prefix sums in blocks, used for sharding and for mixing.

A block is a range of the sort order that a seeded hash, or a fractional rank, cuts evenly, also inside a source that
holds a third of all rows. A row's place is what the blocks before it hold plus its place inside its block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Blocks of a group. At ten billion rows, a third of them in one source, a block has about three million narrow rows.
BLOCKS = 1024


def seeded(seed: int, doc_id: Column, text: Column) -> Column:
    """A hash that SQL engines share: MD5 of "seed-doc_id-MD5 of the text" (null: nothing in its place), as 32 hex digits.
    The text's part keeps rows of null or repeated doc_id from being one block."""
    part = lambda x: F.coalesce(x.cast("string"), F.lit(""))
    return F.md5(F.concat_ws("-", F.lit(str(seed)), part(doc_id), part(F.md5(text.cast("string")))))


def block_of(key: Column) -> Column:
    return F.floor(F.conv(F.substring(key, 1, 4), 16, 10).cast("int") / (65536 // BLOCKS)).cast("int")


def before(rows: DataFrame, by: list[str], order: list[str], amount: Column, name: str, facts: DataFrame | None = None) -> DataFrame:
    """``rows`` with ``name``: the sum of ``amount`` over the rows before each one of its group ``by`` in the order
    (block, *order), and with the columns of ``facts``, one row per group. ``rows`` has a column block and should be staged,
    as it is read twice; ``by`` has no nulls. All rows are dealt by group and block, never by group alone."""
    totals = rows.groupBy(*by, "block").agg(F.sum(amount).alias("_total"))
    order_of_blocks = Window.partitionBy(*by).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, "block", F.coalesce(F.sum("_total").over(order_of_blocks), F.lit(0)).alias("_offset"))
    offsets = offsets if facts is None else offsets.join(facts, by)
    inside = Window.partitionBy(*by, "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("_local", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    return local.join(offsets, [*by, "block"]).withColumn(name, F.col("_offset") + F.col("_local")).drop("_offset", "_local")


def with_facts(rows: DataFrame, by: list[str], facts: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``facts``, one row per group; met block by block, so that a hot group is many keys."""
    blocks = rows.groupBy(*by, "block").agg(F.count("*").alias("_n")).drop("_n").join(facts, by)
    return rows.join(blocks, [*by, "block"])


def named_source(source: Column) -> list[Column]:
    """A source as two columns without nulls, in code point order with null last."""
    return [source.isNull().cast("int").alias("no_source"), F.coalesce(source.cast("string"), F.lit("")).alias("source_name")]

"""Sharding by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.llm import common, layout


def shard(docs: DataFrame, shards: int = 40, seed: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law ("rows"), shard, slot, grown_shard (null): one row per row of ``docs``.

    Rows are shuffled by a seeded hash within each source and ranked; the fractional rank (rank - 1/2) / rows of the
    source orders all rows, so that any stretch of the order has each source in its share; the order is cut into
    ``shards`` pieces whose row counts differ by at most one.

    size is the text's UTF-8 bytes plus 16; null text counts as empty (CRC 0). Null source is a source of its own,
    null doc_id is ranked like any other id, repeated rows each have a slot, and an empty table gives no rows. Fewer
    rows than shards leave shards empty. Columns other than doc_id, text and source are not read.
    """
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    key = layout.seeded(seed, docs["doc_id"], text)
    rows = common.staged(
        docs.select(docs["doc_id"].cast("long").alias("doc_id"), *layout.named_source(docs["source"]), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), key.alias("key"), layout.block_of(key).alias("block"))
    )
    own = ["no_source", "source_name"]
    ties = ["key", "doc_id", "text_crc32", "size"]
    ranked = layout.before(rows, own, ties, F.lit(1), "rank", rows.groupBy(*own).agg(F.count("*").alias("n")))
    share = (F.col("rank") + 0.5) / F.col("n")
    mixed = common.staged(ranked.select("doc_id", "size", "text_crc32", "key", *own, share.alias("share"), F.floor(share * layout.BLOCKS).cast("int").alias("block"), F.lit(0).alias("all")))
    total = rows.groupBy(F.lit(0).alias("all")).agg(F.count("*").alias("total"))
    placed = layout.before(mixed, ["all"], ["share", "key", *own, "doc_id", "text_crc32", "size"], F.lit(1), "at", total)
    found = placed.select("doc_id", "size", "text_crc32", "at", "total", F.expr(f"cast((at * {shards}) div total as int)").alias("shard"))
    start = F.expr(f"(cast(shard as bigint) * total + {shards - 1}) div {shards}")
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("at") - start).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


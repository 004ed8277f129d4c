"""Shared helpers: tasks over few texts at a time, the held-out fold, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.staging import condensed, staged, unstage

#: Words are maximal runs of characters other than the six ASCII white space characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def map_columns(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, rows: int = 512) -> DataFrame:
    """mapInArrow over slices of at most ``rows`` rows, so that a task holds few texts at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                if (out := fn(batch.slice(at, rows))) is not None:
                    yield out

    return df.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """The fold that no model learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def components(edges: DataFrame, most_rounds: int = 40) -> DataFrame:
    """(node, component): the smallest node reachable over undirected ``edges`` (a, b), for nodes that have an edge.

    Contraction: every node points to the smallest of itself and its neighbours, pointers are shortened twice, and
    edges are rewritten to the pointers until none is left; the maps are then composed. A round shrinks any path at
    least threefold. Minima are taken with partial aggregation, and the joins read staged tables, so that a hub with
    a third of all edges is split by adaptive skew handling. Only a count per round reaches the driver. Null nodes
    have no edges; self-loops and repeated edges do no harm; no edges give an empty table.
    """
    clean = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b")
    current = staged(clean.unionAll(clean.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    maps: list[DataFrame] = []
    for _ in range(most_rounds):
        if current.isEmpty():
            break
        first = staged(current.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("to")))
        step = first
        for name in ("x", "y"):
            step = step.join(first.select(F.col("node").alias(name), F.col("to").alias("next")), F.col("to") == F.col(name)).select("node", F.col("next").alias("to"))
        step = staged(step)
        moved = current
        for side in ("a", "b"):
            moved = moved.join(step.select(F.col("node").alias(side), F.col("to").alias(f"{side}_to")), side)
        moved = staged(moved.select(F.col("a_to").alias("a"), F.col("b_to").alias("b")).where("a <> b").distinct())
        unstage(current)
        unstage(first)
        current = moved
        maps.append(step)
    else:
        raise RuntimeError(f"components: not settled after {most_rounds} rounds")
    if not maps:
        return current.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    found = maps[0].select("node", F.col("to").alias("component"))
    for later in maps[1:]:
        found = found.join(later.select(F.col("node").alias("was"), "to"), F.col("component") == F.col("was"), "left").select("node", F.coalesce("to", "component").alias("component"))
    return staged(found)

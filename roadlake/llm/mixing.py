"""Mixing sources to target weights along a time-varying curriculum, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlake.llm import common, layout

OWN = ["no_source", "source_name"]
ORDER = ["key", "doc_id", "size", "text_hash"]
#: Weights of the phases of equal length that training has; sources take the schedules in turn, as they do weights.
#: Only the shape of a schedule counts: its integral over all phases is the source's target.
PHASES = ((2.0, 1.0, 1.0, 1.0), (1.0, 1.0, 1.0, 1.0), (0.5, 1.0, 1.5, 3.0))


def targets(rows: DataFrame, weights: Sequence[int], most_epochs: int) -> DataFrame:
    """A row per source of ``rows`` (no_source, source_name, size): source_size, weight, turn (its number from 0) and
    target, the words to take of it.

    Sources share the total by weight. A target stops at ``most_epochs`` times the source's size, and the excess is
    shared again by weight until none is above: in the order of limit / weight, a source is at its limit as long as
    the level that all others would reach, (total - limits so far) / (weights left), is above its own limit / weight.
    One row per source: the windows below hold as many rows as there are sources.
    """
    sizes = rows.groupBy(*OWN).agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(*OWN)) - 1
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("turn") % len(weights) + 1).cast("int")).cast("long")
    every = Window.partitionBy()
    earlier = Window.orderBy(F.col("limit") / F.col("weight"), "turn").rowsBetween(Window.unboundedPreceding, -1)
    x = sizes.withColumn("turn", turn).withColumn("weight", weight).withColumn("limit", most_epochs * F.col("source_size"))
    x = x.withColumn("total", F.sum("source_size").over(every)).withColumn("weights", F.sum("weight").over(every))
    x = x.withColumn("limits_before", F.coalesce(F.sum("limit").over(earlier), F.lit(0))).withColumn("weights_before", F.coalesce(F.sum("weight").over(earlier), F.lit(0)))
    x = x.withColumn("full", F.col("limit").cast("double") * (F.col("weights") - F.col("weights_before")) <= (F.col("total") - F.col("limits_before")).cast("double") * F.col("weight"))
    x = x.withColumn("rest", F.col("total") - F.coalesce(F.sum(F.when(F.col("full"), F.col("limit"))).over(every), F.lit(0)))
    x = x.withColumn("rest_weights", F.col("weights") - F.coalesce(F.sum(F.when(F.col("full"), F.col("weight"))).over(every), F.lit(0)))
    shared = (F.col("weight") * F.col("rest")).cast("double") / F.col("rest_weights").cast("double")
    return x.select(*OWN, "source_size", "weight", "turn", F.when(F.col("full"), F.col("limit").cast("double")).otherwise(shared).alias("target"))


def position(demand: Column, turn: Column, phases: Sequence[Sequence[float]]) -> Column:
    """Inverts the cumulative demand: the time from 0 to 1 at which a source has taken the share ``demand`` of its
    target. Each phase adds the part of its length that the demand fills."""
    out: Column | None = None
    for k, plan in enumerate(phases):
        whole, done, time = float(sum(plan)), 0.0, F.lit(0.0)
        for weight in plan:
            if weight:
                time = time + F.least(F.greatest((demand - done / whole) / (weight / whole), F.lit(0.0)), F.lit(1.0)) / len(plan)
            else:
                time = time + F.when(demand > done / whole, 1.0 / len(plan)).otherwise(0.0)
            done += weight
        case = turn % len(phases) == k
        out = F.when(case, time) if out is None else out.when(case, time)
    return out


def plan(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), most_epochs: int = 3, phases: Sequence[Sequence[float]] = PHASES, seed: int = 10, keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, source, size (words), source_size, target, copies, taken, positions (one per copy, ascending), and the
    columns ``keep`` of ``docs``.

    Within its source a document lies on the line of the source's words at a place given by a seeded hash. Epoch e
    takes it if the middle of its stretch, e sizes of the source further on, is within the target. A copy's position is
    the time at which the source's cumulative demand reaches that middle. The words taken of a source then differ from
    its target by at most half a document; short documents, of at most half of that gap, make up for it in the
    line's order: they take part once more, or once less, until the next would be too much. What they add follows on
    what was taken before, so its positions are those of the demand that is still open.

    Null text has no words. Documents without words take part once at most. Null source is a source of its own, the
    last. Null doc_id is placed like any other, repeated rows are placed each, an empty table gives no rows. Columns
    other than doc_id, text and source are not read.
    """
    text = docs["text"].cast("string")
    key = layout.seeded(seed, docs["doc_id"], text)
    own = [docs[c].alias(f"_keep_{k}") for k, c in enumerate(keep)]
    size = F.coalesce(F.regexp_count(text, F.lit(common.WORD_PATTERN)), F.lit(0)).cast("long")
    rows = common.staged(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"), *layout.named_source(docs["source"]), F.xxhash64(text).alias("text_hash"), size.alias("size"), key.alias("key"), layout.block_of(key).alias("block"), *own))
    placed = layout.before(rows, OWN, ORDER, F.col("size"), "start", targets(rows, weights, most_epochs))
    middle = lambda e: (F.col("start") + e * F.col("source_size") + F.col("size") / 2).cast("double")
    taken = [F.when((middle(e) <= F.col("target")) & ((F.col("size") > 0) | F.lit(e == 0)), position(middle(e) / F.greatest("target", F.lit(1e-9)), F.col("turn"), phases)) for e in range(most_epochs)]
    positions = F.array_compact(F.array(*taken))
    first = common.staged(placed.withColumn("positions", positions).withColumn("copies", F.size("positions")))
    gaps = first.groupBy(*OWN).agg((F.max("target") - F.sum(F.col("size") * F.col("copies"))).alias("gap"))
    up, gap = F.col("gap") > 0, F.abs("gap")
    fits = (F.col("size") > 0) & (2 * F.col("size") <= gap) & F.when(up, F.col("copies") < most_epochs).otherwise(F.col("copies") > 0)
    tuned = layout.before(layout.with_facts(first, OWN, gaps).withColumn("fits", fits), OWN, ORDER, F.when(F.col("fits"), F.col("size")).otherwise(0), "passed")
    moved = F.col("fits") & (F.col("passed") + F.col("size") <= gap)
    open_ = F.col("target") - F.col("gap") + F.col("passed") + F.col("size").cast("double") / 2
    later = position(open_ / F.greatest("target", F.lit(1e-9)), F.col("turn"), phases)
    changed = F.when(moved & up, F.array_sort(F.array_append("positions", later))).when(moved, F.slice("positions", 1, F.col("copies") - 1)).otherwise(F.col("positions"))
    found = tuned.withColumn("positions", changed)
    kept = [F.col(f"_keep_{k}").alias(c) for k, c in enumerate(keep)]
    return found.select("doc_id", "source", "size", "source_size", "target", F.size("positions").alias("copies"), (F.col("size") * F.size("positions")).alias("taken"), "positions", *kept)


def in_training_order(planned: DataFrame, most_epochs: int = 3) -> DataFrame:
    """``planned`` with a column position_1, position_2, ... per copy (null: no such copy) in place of positions, range-sorted
    by the first; documents that are not taken are last."""
    each = [F.get("positions", F.lit(k)).alias(f"position_{k + 1}") for k in range(most_epochs)]
    return planned.select("*", *each).drop("positions").orderBy(F.col("position_1").asc_nulls_last(), "doc_id")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the plan takes it, range-sorted by training position; same columns.

    Rows are numbered as they are staged; the plan is made of narrow rows, and the texts meet it by number, so they are
    dealt twice: for that join and for the sort. Null and repeated doc_ids do no harm.
    """
    rows = common.staged(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("no")))
    narrow = rows.select("row.doc_id", "row.text", "row.source", "no")
    planned = common.condensed(lambda: plan(narrow, keep=("no",), **options).where(F.size("positions") > 0).select("no", "positions"))
    met = rows.join(planned, "no").select(F.explode("positions").alias("position"), "no", "row")
    return met.orderBy("position", F.col("row.doc_id"), "no").select("row.*")

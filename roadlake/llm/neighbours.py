"""Approximate nearest neighbours: a forest of random-projection trees, searched through one priority queue per query
over all trees, then exact reranking of the leaves' vectors."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlake.llm import common


@dataclass
class Forest:
    """``trees`` complete binary trees of one depth in heap order: node i splits at normals[t, i] . x > cuts[t, i] into
    2i + 1 and 2i + 2. Leaves are numbered from 0 over all trees; the size is bounded by the sample it was fitted on."""

    depth: int
    normals: np.ndarray
    cuts: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees): the leaf that each vector falls into."""
        out = np.empty((len(x), len(self.normals)), np.int64)
        rows = np.arange(len(x))
        for t, (normals, cuts) in enumerate(zip(self.normals, self.cuts)):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (np.einsum("ij,ij->i", x[rows], normals[at]) > cuts[at])
            out[:, t] = at - (2**self.depth - 1) + t * 2**self.depth
        return out

    def search(self, q: np.ndarray, reach: float) -> list[int]:
        """Leaves for a query, nearest first: one queue for all trees holds branches by the sum of the squared margins by which the query lies on the other side, an estimate of the squared
        distance to what is there. Ends where it is beyond ``reach``."""
        margins = (np.einsum("tij,j->ti", self.normals, q) - self.cuts).tolist()
        queue, found, first, most = [(0.0, t, 0, 0) for t in range(len(margins))], [], 2**self.depth - 1, reach * reach
        while queue:
            far, t, at, level = heapq.heappop(queue)
            if far > most:
                break
            while level < self.depth:
                margin, level = margins[t][at], level + 1
                near = 2 * at + 1 + (margin > 0)
                heapq.heappush(queue, (far + margin * margin, t, 4 * at + 3 - near, level))
                at = near
            found.append(at - first + t * 2**self.depth)
        return found

    def estimates(self, q: np.ndarray) -> np.ndarray:
        """(queries, leaves): the sums of squared margins by which search() orders leaves."""
        out = []
        for normals, cuts in zip(self.normals, self.cuts):
            margins, far = q @ normals.T - cuts, np.zeros((len(q), 1))
            for level in range(self.depth):
                own = margins[:, 2**level - 1 : 2 ** (level + 1) - 1]
                far = np.stack([far + np.maximum(own, 0) ** 2, far + np.minimum(own, 0) ** 2], 2).reshape(len(q), -1)
            out.append(far)
        return np.concatenate(out, 1)


def fit(sample: np.ndarray, trees: int, leaf: float, seed: int) -> Forest:
    """Splits along the difference of two random vectors, at the median of the projections, down to about ``leaf``
    sample vectors."""
    depth = max(0, round(np.log2(max(1, len(sample)) / leaf)))
    dim, inner, rng = sample.shape[1], 2**depth - 1, np.random.default_rng(seed)
    normals, cuts = np.zeros((trees, inner, dim)), np.zeros((trees, inner))
    for t in range(trees):
        member = {0: np.arange(len(sample))}
        for at in range(inner):
            own = member.pop(at, np.empty(0, int))
            if len(own) > 1:
                a, b = sample[rng.choice(own, 2, replace=False)]
                normal = a - b if (a != b).any() else rng.normal(size=dim)
            else:
                normal = rng.normal(size=dim)
            normals[t, at] = normal / max(1e-12, float(np.linalg.norm(normal)))
            along = sample[own] @ normals[t, at]
            cuts[t, at] = np.median(along) if len(own) else 0.0
            right = along > cuts[t, at]
            member[2 * at + 1], member[2 * at + 2] = own[~right], own[right]
    return Forest(depth, normals, cuts)


def calibrated(forest: Forest, sample: np.ndarray, k: int, recall: float, probes: int = 256) -> float:
    """How far a search has to go, as a share of the distance to the k-th neighbour, to meet the share ``recall`` of the
    k nearest in the sample, whose first vectors ask. A share of a distance holds at any number of vectors; data without
    structure makes it wide and clusters make it small. 1 or more: without end, which finds all."""
    if len(sample) < k + 2 or recall >= 1:
        return float("inf")
    asking, squares = sample[:probes], (sample**2).sum(1)
    distance = squares[None] + (asking**2).sum(1)[:, None] - 2 * asking @ sample.T
    distance[np.arange(len(asking)), np.arange(len(asking))] = np.inf
    near = np.argpartition(distance, k, axis=1)[:, :k]
    leaves, estimates, rows = forest.leaves(sample), forest.estimates(asking), np.arange(len(asking))[:, None]
    needed = np.min([estimates[rows, leaves[near, t]] for t in range(len(forest.normals))], axis=0)
    farthest = np.maximum(distance[rows, near].max(1), 1e-300)
    return float(np.quantile(np.sqrt(needed / farthest[:, None]), recall))


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding of the rows that take part: no null, zero or non-finite vector, and of the commonest length
    (of several, the least), as distances need one length."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where("vec_id is not null and embedding is not null")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    v = v.where(~F.exists("embedding", bad) & F.exists("embedding", lambda x: x != 0))
    length = v.groupBy(F.size("embedding").alias("length")).count().orderBy(F.desc("count"), "length").limit(1).collect()
    return v.where(F.size("embedding") == (length[0]["length"] if length else 0))


def matrix(vectors: pa.Array) -> np.ndarray:
    return np.asarray(vectors.flatten(), float).reshape(len(vectors), -1)


def nearest(own: pd.DataFrame, ask: pd.DataFrame, k: int) -> pd.DataFrame:
    """The entries of a bundle of leaves nearest to each query, among those of the leaves that it asks, up to k + 1 different
    smallest ids. A query is compared with the leaves it asks only; what it finds in all of them is cut once."""
    asked: dict[int, list[int]] = {}
    for row, leaves in enumerate(ask["leaves"]):
        for leaf in leaves:
            asked.setdefault(leaf, []).append(row)
    found = [nearest_of_leaf(own[:0], ask[:0], k), *[nearest_of_leaf(rows, ask.iloc[asked[leaf]], k) for leaf, rows in own.groupby("leaf") if leaf in asked]]
    rows = pd.concat(found).drop_duplicates(["query", "entry"]).sort_values(["query", "distance", "low"], kind="stable")
    different = (~rows.duplicated(["query", "low"])).groupby(rows["query"]).cumsum()
    return rows[different <= k + 1]


def nearest_of_leaf(own: pd.DataFrame, ask: pd.DataFrame, k: int) -> pd.DataFrame:
    """The entries of one leaf nearest to each query, up to k + 1 different smallest ids and not beyond the query's reach;
    nothing else can be among k nearest ids. Of entries of one id, only the nearest is of use."""
    out = [(np.empty(0, int), np.empty(0, int), np.empty(0, int), np.empty(0))]
    if len(own) and len(ask):
        own = own.sort_values(["low", "entry"])
        x, ids = np.stack(own["embedding"].to_numpy()).astype(float), own["entry"].to_numpy()
        lows, alone = own["low"].to_numpy(), own["alone"].to_numpy()
        squares, different = (x**2).sum(1), len(np.unique(lows)) == len(lows)
        names, reach = ask["entry"].to_numpy(), ask["reach"].to_numpy()
        for at in range(0, len(ask), 256):
            points = np.stack(ask["embedding"].to_numpy()[at : at + 256]).astype(float)
            about = squares[None] + (points**2).sum(1)[:, None] - 2 * points @ x.T  # only chooses what is measured
            spare = 1e-9 * (squares.max() + (points**2).sum(1))
            last = np.partition(about, k, axis=1)[:, k] if different and about.shape[1] > k + 1 else np.full(len(points), np.inf)
            for i, point in enumerate(points):
                some = np.flatnonzero(about[i] <= min(last[i], reach[at + i] ** 2) + spare[i])
                distance = np.sqrt(((x[some] - point) ** 2).sum(1))
                order = np.argsort(distance, kind="stable")
                order = order[distance[order] <= reach[at + i]]
                # rows up to the one that brings the (k + 1)-th different id
                firsts = np.sort(np.unique(lows[some[order]], return_index=True)[1])
                best = order[: firsts[k] + 1] if len(firsts) > k else order
                new = np.zeros(len(best), bool)
                new[firsts[firsts < len(best)]] = True
                best = best[new | ~alone[some[best]]]
                out.append((np.full(len(best), names[at + i]), ids[some[best]], lows[some[best]], distance[best]))
    return pd.DataFrame({c: np.concatenate([x[k] for x in out]) for k, c in enumerate(("query", "entry", "low", "distance"))})


def search(vectors: DataFrame, every: int = 100, k: int = 10, trees: int = 4, leaf: int = 256, sample: int = 16_384, recall: float = 0.95, tile: int = 8192, bundle: int = 16, seed: int = 6) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest found of every row whose vec_id is divisible by
    ``every``, by Euclidean distance in double precision, ties to the smaller vec_id, the query itself left out.

    The forest is fitted on at most ``sample`` different vectors, the first by hash; every vector is indexed, in leaves
    of about ``leaf`` entries (larger ones once a sample vector stands for over ``leaf`` / 4). Equal vectors are one entry
    that keeps its k + 1 smallest ids: no others can be among k nearest, so nothing is lost, and a vector that a third
    of all rows share costs no more than any other.

    A query first reads the leaf that it falls into in each tree. The distance to the k-th of what it finds there, times
    a share that is calibrated on the sample for ``recall``, is how far its queue then goes: on clustered vectors it
    reads a hundredth of the rows, on vectors without any structure about half, as nothing less meets that recall.
    ``bundle`` leaves that lie side by side in a tree are one group: a query's vector is sent once to each group it asks
    something of, and comes back with k + 1 entries at most, none beyond the distance known. Groups of over ``tile``
    entries, or of many queries, are dealt over several tasks.

    Vectors that are null, empty, all zero, of a rarer length, or hold null or non-finite components take no part, nor
    do rows without vec_id; they have no result rows. Repeated rows count once. A vec_id of several vectors has them all:
    it asks with each and is a neighbour once, by the nearest. A query's own id is left out whole, before the cut to k.
    With fewer than k candidates all are returned. An empty table gives no rows. Extra columns are not read.
    """
    rows = common.staged(usable(vectors))
    kind = rows.schema["embedding"].dataType.simpleString()
    by_vector = Window.partitionBy("embedding").orderBy("vec_id")
    kept = rows.dropDuplicates(["vec_id", "embedding"]).withColumn("_n", F.row_number().over(by_vector)).where(F.col("_n") <= k + 1)
    entries = kept.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    # several vectors can have one smallest id, so entries are named by numbers
    entries = common.staged(entries.select("*", F.monotonically_increasing_id().alias("entry"), F.element_at("ids", 1).alias("low"), (F.size("ids") == 1).alias("alone")))
    picked = entries.select("low", "embedding").orderBy(F.xxhash64("low"), "low", "embedding").limit(sample).toArrow()
    if picked.num_rows == 0:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    points, count = matrix(picked["embedding"].combine_chunks()), entries.count()
    forest = fit(points, trees, max(4.0, leaf * len(points) / count), seed)
    share = calibrated(forest, points, k, recall)

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                again = part.take(pa.array(np.repeat(np.arange(part.num_rows), trees)))
                yield pa.RecordBatch.from_arrays([pa.array(forest.leaves(matrix(part.column(1))).ravel()), *again.columns], ["leaf", *batch.schema.names])

    def asked_of(part: pa.RecordBatch, found: list) -> pa.RecordBatch:
        """The queries of ``part``, each once for every bundle of its leaves."""
        rows, groups, leaves = [], [], []
        for row, own in enumerate(found):
            by_group: dict[int, list[int]] = {}
            for leaf in own:
                by_group.setdefault(leaf // bundle, []).append(leaf)
            rows += [row] * len(by_group)
            groups += by_group
            leaves += by_group.values()
        return pa.RecordBatch.from_arrays([pa.array(groups, pa.int64()), pa.array(leaves, pa.list_(pa.int64())), *part.take(pa.array(rows, pa.int64())).columns], ["group", "leaves", *part.schema.names])

    def at_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield asked_of(batch, forest.leaves(matrix(batch.column(1))).tolist())

    def visited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                points, known = matrix(part.column(1)), np.asarray(part.column(2))
                more = [set(forest.search(v, np.inf if np.isinf(r) else share * r)) - set(home) for v, r, home in zip(points, known, forest.leaves(points).tolist())]
                yield asked_of(part, more)

    places = entries.select("entry", "embedding", "low", "alone").mapInArrow(indexed, f"leaf long, entry long, embedding {kind}, low long, alone boolean")
    places = common.staged(places.withColumn("group", F.floor(F.col("leaf") / bundle)))
    sizes = common.staged(places.groupBy("group").agg(F.count("*").alias("n")))  # at most trees * sample / 4 rows

    def met(asked: DataFrame) -> DataFrame:
        """query, entry, low, distance of what the asked leaves (group, leaves, entry, embedding, reach) hold near the query.
        Groups are cut into parts of entries and turns of queries, each pair of which is worked on together."""
        turns = asked.groupBy("group").agg(F.ceil(F.count("*") / tile).cast("int").alias("turns"))
        cut = F.broadcast(sizes.join(turns, "group").select("group", F.ceil(F.col("n") / tile).cast("int").alias("parts"), "turns"))
        pick = lambda of: F.pmod(F.xxhash64("entry"), F.col(of)).cast("int")
        each = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
        left = places.join(cut, "group").select("group", pick("parts").alias("part"), each("turns").alias("turn"), "leaf", "entry", "embedding", "low", "alone")
        right = asked.join(cut, "group").select("group", each("parts").alias("part"), pick("turns").alias("turn"), "leaves", "entry", "embedding", "reach")
        key = ["group", "part", "turn"]
        return common.staged(left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(lambda own, ask: nearest(own, ask, k), "query long, entry long, low long, distance double"))

    by_query = Window.partitionBy("query")

    def limits(found: DataFrame) -> DataFrame:
        """query, far: the distance within which k + 1 different ids are found, null where fewer are."""
        ranked = found.groupBy("query", "low").agg(F.min("distance").alias("distance")).withColumn("_r", F.row_number().over(by_query.orderBy("distance", "low"))).where(F.col("_r") <= k + 1)
        return ranked.groupBy("query").agg(F.max("distance").alias("far"), F.count("*").alias("n")).select("query", F.when(F.col("n") > k, F.col("far")).alias("far"))

    asking = common.staged(rows.where(F.col("vec_id") % every == 0).join(entries.select("embedding", "entry"), "embedding").select(F.col("vec_id").alias("query_id"), "entry").distinct())
    endless = F.lit(float("inf"))
    wanted = common.staged(asking.select("entry").distinct().join(entries.select("entry", "embedding"), "entry").select("entry", "embedding", endless.alias("reach")))
    schema = f"group long, leaves array<long>, entry long, embedding {kind}, reach double"
    home = met(common.staged(wanted.mapInArrow(at_home, schema)))
    known = wanted.drop("reach").join(limits(home), F.col("entry") == F.col("query"), "left").select("entry", "embedding", F.coalesce("far", endless).alias("reach"))
    found = common.staged(home.unionByName(met(common.staged(known.mapInArrow(visited, schema)))).dropDuplicates(["query", "entry"]))
    best = found.join(limits(found), "query").where(F.col("far").isNull() | (F.col("distance") <= F.col("far")))
    pairs = best.join(entries.select("entry", "ids"), "entry").select("query", "distance", F.explode("ids").alias("vec_id")).groupBy("query", "vec_id").agg(F.min("distance").alias("distance"))
    pairs = common.staged(pairs.withColumn("_r", F.row_number().over(by_query.orderBy("distance", "vec_id"))).where(F.col("_r") <= k + 1).drop("_r"))
    answers = asking.join(pairs, F.col("entry") == F.col("query")).where("vec_id <> query_id").groupBy("query_id", "vec_id").agg(F.min("distance").alias("distance"))
    ranked = answers.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "vec_id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.col("distance").alias("score"))

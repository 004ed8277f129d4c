"""Whitening of embeddings over their distinct vectors.

Entries become whole numbers, so that equal vectors are equal: x = floor(64 * entry) + 1,000,000. Rows are put together by
their x vector once, with how many there are; mean and covariance are taken over the distinct vectors, weighted by those
counts or by one; each distinct vector is projected once, and the result joined back to the rows.

Sums of x are exact. Products are of centred values, in blocks, with the weights on one side of each product: a task adds
up a d x d matrix over its vectors, and the tasks' matrices are added by rows, dealt out by row. What reaches the driver
is one matrix a vector length, which is the size of the model and does not grow with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.staging import condensed, staged

SHIFT, SCALE, COMPONENTS = 1_000_000, 64, 16
#: Entries beyond this are no whole number of 64 bits once scaled.
LARGEST = 2.0**55
VALUES = "values array<double>"


def usable(embeddings: DataFrame, key: str, vector: str) -> DataFrame:
    """key, x: rows whose vector is there and holds neither nulls nor entries that are not finite (or beyond 2^55)."""
    entries = F.col(vector).cast("array<double>")
    fine = F.col(vector).isNotNull() & ~F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= LARGEST))
    x = F.transform(entries, lambda c: F.floor(c * SCALE) + SHIFT)
    return embeddings.where(fine).select(F.col(key).alias("key"), x.alias("x"))


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """x, name (its digest), length, copies. Copies are counted before the shuffle, so a vector that a third of all rows
    have is one row a task."""
    counted = rows.groupBy("x").agg(F.count("*").alias("copies"))
    return counted.select("x", name_of("x").alias("name"), F.size("x").alias("length"), "copies")


def name_of(x: str) -> Column:
    return F.unhex(F.sha2(F.array_join(F.col(x).cast("array<string>"), ","), 256))


def matrix_of(column: pa.ListArray, length: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, length)


def by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    lengths = batch["length"].to_numpy()
    for length in np.unique(lengths).tolist():
        yield length, batch.filter(pa.array(lengths == length))


def added(parts: DataFrame) -> DataFrame:
    """length, row, values: the sums of ``parts`` by (length, row). A task adds what is dealt to it as it streams by, and
    holds only its own rows of the matrices."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for length, row, values in zip(batch["length"].to_pylist(), batch["row"].to_pylist(), batch["values"]):
                own = values.values.to_numpy()
                sums[length, row] = sums[length, row] + own if (length, row) in sums else own
        if sums:
            yield pa.record_batch({"length": pa.array([k[0] for k in sums], pa.int32()), "row": pa.array([k[1] for k in sums], pa.int32()), "values": pa.array(list(sums.values()), pa.list_(pa.float64()))})

    return parts.repartition("length", "row").mapInArrow(add, f"length int, row int, {VALUES}")


def scatter(vectors: DataFrame, column: str, means: dict[int, np.ndarray], origins: dict[int, np.ndarray] | None = None) -> dict[int, np.ndarray]:
    """By length: the weighted sum of (v - mean)(v - mean)' over ``vectors`` (length, weight, ``column``). ``origins``: whole
    numbers taken off first, exactly."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for length, own in by_length(batch):
                values = matrix_of(own[column], len(means[length]), float if origins is None else np.int64)
                centred = (values if origins is None else values - origins[length]) - means[length]
                weighted = centred * own["weight"].to_numpy()[:, None]
                sums[length] = sums.get(length, 0) + weighted.T @ centred
        for length, total in sums.items():
            yield pa.record_batch({"length": pa.array([length] * len(total), pa.int32()), "row": pa.array(range(len(total)), pa.int32()), "values": pa.array(list(total), pa.list_(pa.float64()))})

    parts = vectors.select("length", F.col("weight").cast("double").alias("weight"), column).mapInArrow(multiply, f"length int, row int, {VALUES}")
    out: dict[int, np.ndarray] = {}
    for r in added(parts).toLocalIterator():  # a matrix a length
        out.setdefault(r["length"], np.zeros((len(r["values"]),) * 2))[r["row"]] = r["values"]
    return out


@dataclass(frozen=True)
class Whitener:
    """Of vectors of one length: their number n and sums, the components (columns) with variance, and their variances."""

    n: int
    sums: tuple[int, ...]
    origin: np.ndarray
    mean: np.ndarray
    components: np.ndarray
    variances: np.ndarray
    total: float

    @property
    def shown(self) -> int:
        return min(COMPONENTS, len(self.sums))


def moments(vectors: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """(n, sums) by length, exact: a task adds whole numbers, and theirs are added as decimals."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for length, own in by_length(batch):
                x, weight = matrix_of(own["x"], length, np.int64), own["weight"].to_numpy()
                most = float(np.abs(x).max(initial=1)) * float(weight.sum())
                x, weight = (x, weight) if most < 2**62 else (x.astype(object), weight.astype(object))
                sums[length] = sums.get(length, 0) + np.append((x * weight[:, None]).sum(0), weight.sum()).astype(object)
        for length, total in sums.items():
            yield pa.record_batch({"length": pa.array([length] * len(total), pa.int32()), "row": pa.array(range(len(total)), pa.int32()), "value": pa.array([str(v) for v in total], pa.string())})

    parts = vectors.select("x", "length", "weight").mapInArrow(add, "length int, row int, value string")
    out: dict[int, dict[int, int]] = {}
    for r in parts.groupBy("length", "row").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("s")).collect():  # a number a dimension
        out.setdefault(r["length"], {})[r["row"]] = int(r["s"])
    return {k: (own[k], [own[j] for j in range(k)]) for k, own in out.items()}


def fit(vectors: DataFrame) -> dict[int, Whitener]:
    """By length, over ``vectors`` (x, length, weight)."""
    known = moments(vectors)
    # the mean's whole part comes off as a whole number, so that nothing of x is rounded
    origins = {k: np.array([s // n for s in sums], np.int64) for k, (n, sums) in known.items()}
    rests = {k: np.array([s % n / n for s in sums]) for k, (n, sums) in known.items()}
    found = {}
    for length, total in scatter(vectors, "x", rests, origins).items():
        n, sums = known[length]
        covariance = (total + total.T) / 2 / n
        variances, components = np.linalg.eigh(covariance)
        order = np.argsort(-variances, kind="stable")[:COMPONENTS]
        trace = float(np.trace(covariance))
        real = variances[order] > trace * length * np.finfo(float).eps
        found[length] = Whitener(n, tuple(sums), origins[length], rests[length], components[:, order][:, real], variances[order][real], trace)
    return found


def exact_deviation(model: Whitener, x: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (n * x - S)^2; None where it is no long."""
    rest = [s - model.n * int(o) for s, o in zip(model.sums, model.origin)]
    centred = x - model.origin
    most = (int(np.abs(centred).max(initial=0)) + 1) * model.n
    if most * most * len(rest) < 2**63:
        return (((model.n * centred - np.array(rest, np.int64)) ** 2).sum(1)).tolist()
    whole = [sum((model.n * v - r) ** 2 for v, r in zip(row, rest)) for row in centred.tolist()]
    return [v if v < 2**63 else None for v in whole]


def projected(vectors: DataFrame, models: dict[int, Whitener]) -> DataFrame:
    """name, length, weight, deviation, values: the whitened components of every vector, null those without variance."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, own in by_length(batch):
                model, x = models[length], matrix_of(own["x"], length, np.int64)
                values = ((x - model.origin) - model.mean) @ model.components / np.sqrt(model.variances)
                rest = [None] * (model.shown - values.shape[1])
                yield pa.record_batch({"name": own["name"], "length": own["length"], "weight": own["weight"], "deviation": pa.array(exact_deviation(model, x), pa.int64()), "values": pa.array([v + rest for v in values.tolist()], pa.list_(pa.float64()))})

    return vectors.select("x", "name", "length", "weight").mapInArrow(project, f"name binary, length int, weight long, deviation long, {VALUES}")


def identity_errors(white: DataFrame, models: dict[int, Whitener]) -> dict[int, float]:
    """By length: the largest entry, by amount, of the whitened vectors' own covariance less the identity."""
    known = {k: m for k, m in models.items() if len(m.variances)}
    means = {k: np.zeros(len(m.variances)) for k, m in known.items()}
    rows = white.where(F.get("values", F.lit(0)).isNotNull()).withColumn("values", F.filter("values", lambda v: v.isNotNull()))
    for r in rows.select("length", "weight", F.posexplode("values").alias("row", "value")).groupBy("length", "row").agg(F.sum(F.col("value") * F.col("weight")).alias("s")).collect():  # 16 numbers a length
        means[r["length"]][r["row"]] = r["s"] / known[r["length"]].n
    return {k: float(np.abs(total / known[k].n - np.eye(len(total))).max()) for k, total in scatter(rows, "values", means).items()}


def told(facts: dict[int, object], kind: str) -> Column:
    """The fact of a row's length, of a few numbers for each length in use."""
    pairs = [x for k, v in facts.items() for x in (F.lit(k), F.lit(v).cast(kind))]
    return (F.create_map(*pairs) if pairs else F.lit(None).cast(f"map<int,{kind}>"))[F.col("length")]


def whitened(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", weighted: bool = False) -> DataFrame:
    """key, component, n, deviation, whitened, explained, identity_error: a row per usable row of ``embeddings`` and
    component, of which there are 16, or as many as the vector has entries.

    ``weighted``: a distinct vector counts as often as it occurs; otherwise once. Rows without a vector, or whose vector
    holds nulls or entries that are not finite (or of 2^55 and more), take no part; zero vectors do. Vectors of each length
    are whitened by themselves; an empty vector has no component and so no row. Along a component without variance
    (all vectors alike, or fewer of them than components) ``whitened`` is null, ``explained`` 0, and the identity error
    leaves it out; it is null where no component has any. A deviation that is no long is null. Repeated rows, also of one
    id, and rows without id each give their rows. No usable rows give none. Other columns of ``embeddings`` are not read.
    """
    return condensed(lambda: whiten(embeddings, key, vector, weighted))


def whiten(embeddings: DataFrame, key: str, vector: str, weighted: bool) -> DataFrame:
    rows = usable(embeddings, key, vector)
    vectors = staged(distinct_vectors(rows).withColumn("weight", F.col("copies") if weighted else F.lit(1).cast("long")).where("length > 0"))
    models = fit(vectors)
    white = staged(projected(vectors, models))
    shares = {k: [float(v / m.total) for v in m.variances] + [0.0] * (m.shown - len(m.variances)) for k, m in models.items()}
    n, explained, error = told({k: m.n for k, m in models.items()}, "long"), told(shares, "array<double>"), told(identity_errors(white, models), "double")
    each = rows.select("key", name_of("x").alias("name")).join(white, "name").select("key", "length", "deviation", F.posexplode("values").alias("at", "whitened"))
    return each.select(F.col("key").alias(key), (F.col("at") + 1).alias("component"), n.alias("n"), "deviation", "whitened", explained[F.col("at")].alias("explained"), error.alias("identity_error"))

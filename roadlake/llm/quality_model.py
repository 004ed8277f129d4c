"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.llm import common
from roadlake.llm.statistics import RATIOS, ratios, statistics

STATS = len(RATIOS) + 3  # and the log of words, lines and declared length


def structure(text: str | None, n_chars: int | None) -> np.ndarray:
    """Structure statistics and the metadata column n_chars (null: the text's own length), as bounded numbers."""
    s = np.array([statistics(text)])
    logs = np.log1p([s[0, 0], s[0, 6], s[0, 5] if n_chars is None else max(0, n_chars)]) / 10
    return np.concatenate([np.tanh(ratios(s)[0] / SCALES), logs])


#: About the size of each ratio in ordinary prose; tanh flattens what lies far beyond.
SCALES = np.array([0.3, 6.0, 0.2, 0.3, 0.7, 0.1, 0.1, 0.05, 60.0, 20.0])


def features(text: str | None, n_chars: int | None, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Sparse features: (index, value), the statistics first, then words hashed to ``buckets``, scaled to length 1."""
    counts = Counter(text.encode().split()) if text else {}
    sums: dict[int, float] = {}
    for word, n in counts.items():
        at = STATS + zlib.crc32(word) % buckets
        sums[at] = sums.get(at, 0.0) + n
    index = np.fromiter(sums, np.int64, len(sums))
    value = np.fromiter(sums.values(), float, len(sums))
    return np.concatenate([np.arange(STATS), index]), np.concatenate([structure(text, n_chars), value / max(1e-9, float(np.sqrt((value**2).sum())))])


@dataclass
class FactorisationMachine:
    """score = sigmoid(bias + w x + sum over pairs <v_i, v_j> x_i x_j), pairs by the sum-of-squares identity
    0.5 * sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2): linear in the number of features."""

    bias: float
    w: np.ndarray
    v: np.ndarray

    def score(self, index: np.ndarray, value: np.ndarray) -> float:
        v = self.v[index] * value[:, None]
        z = self.bias + self.w[index] @ value + 0.5 * float((v.sum(0) ** 2).sum() - (v**2).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, size: int, rank: int, epochs: int, seed: int = 0, rate: float = 0.05, decay: float = 1e-4) -> FactorisationMachine:
    """Logistic loss, AdaGrad over shuffled batches of 64 rows. With no rows, or labels of one kind only, the score is
    the smoothed share of label 1 for every text."""
    rng, share = np.random.default_rng(seed), (float(labels.sum()) + 1) / (len(labels) + 2)
    model = FactorisationMachine(float(np.log(share / (1 - share))), np.zeros(size), rng.normal(0, 0.05, (size, rank)))
    if len(set(labels.tolist())) < 2:
        model.v[:] = 0
        return model
    gb, gw, gv = 1e-6, np.full(size, 1e-6), np.full((size, rank), 1e-6)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 64):
            part = order[at : at + 64]
            index = np.concatenate([rows[k][0] for k in part])
            x = np.concatenate([rows[k][1] for k in part])
            starts = np.cumsum([0, *[len(rows[k][0]) for k in part[:-1]]])
            which = np.repeat(np.arange(len(part)), [len(rows[k][0]) for k in part])
            vx = model.v[index] * x[:, None]
            sums = np.add.reduceat(vx, starts)
            z = model.bias + np.add.reduceat(model.w[index] * x, starts) + 0.5 * (sums**2 - np.add.reduceat(vx**2, starts)).sum(1)
            error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels[part]) / len(part)
            e = error[which]
            used, slot = np.unique(index, return_inverse=True)
            dw = np.bincount(slot, e * x, len(used)) + decay * model.w[used]
            dv = np.stack([np.bincount(slot, e * x * (sums[which, f] - vx[:, f]), len(used)) for f in range(rank)], 1) + decay * model.v[used]
            db = float(error.sum())
            gb, gw[used], gv[used] = gb + db * db, gw[used] + dw**2, gv[used] + dv**2
            model.bias -= rate * db / gb**0.5
            model.w[used] -= rate * dw / np.sqrt(gw[used])
            model.v[used] -= rate * dv / np.sqrt(gv[used])
    return model


def sample_of(labels: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows (doc_id, label) that a model may learn from, the first by hash of doc_id; for broadcast."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label")).where("doc_id is not null and label in (0, 1)")
    return known.where(~common.held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def narrow(docs: DataFrame) -> DataFrame:
    """doc_id, text, n_chars; a table without n_chars has null there."""
    n_chars = docs["n_chars"].cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), n_chars.alias("n_chars"))


def train(docs: DataFrame, labels: DataFrame, sample: int = 6000, buckets: int = 1 << 15, rank: int = 4, epochs: int = 12) -> FactorisationMachine:
    """Learns from at most ``sample`` labelled rows outside the held-out fold. Features are made by Spark; the driver
    gets sparse rows of the sample only, at most ``sample`` of them, and a model of fixed size. Of repeated rows of one
    id the least by its features counts. One row in 33 is an empty text of label 0, as no labels tell of these."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = [features(t.as_py(), n.as_py(), buckets) for t, n in zip(batch.column(1), batch.column(2))]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), pa.array([i.tolist() for i, _ in got], pa.list_(pa.int32())), pa.array([x.tolist() for _, x in got], pa.list_(pa.float32()))], ["doc_id", "label", "index", "value"])

    chosen = narrow(docs).join(F.broadcast(sample_of(labels, sample)), "doc_id")
    made = common.map_columns(chosen, one, "doc_id long, label int, index array<int>, value array<float>")
    got = made.groupBy("doc_id").agg(F.min(F.struct("label", "index", "value")).alias("x")).select("doc_id", "x.*").toArrow().sort_by("doc_id")
    index, value, target = got["index"], got["value"], np.array(got["label"].to_pylist(), float)
    rows = [(np.array(i.values, np.int64), np.array(x.values, float)) for i, x in zip(index, value)]
    if len(set(target.tolist())) > 1:
        blank = len(rows) // 32 + 1
        rows, target = rows + [features(None, None, buckets)] * blank, np.append(target, np.zeros(blank))
    return fit(rows, target, STATS + buckets, rank, epochs)


def scores(docs: DataFrame, model: FactorisationMachine, buckets: int = 1 << 15) -> DataFrame:
    """doc_id, score: the model over every whole text; one row per row of ``docs``.

    Null and empty texts are scored by their statistics alone, which the model has seen as no good ones. Null doc_id stays null, repeated rows are scored each,
    an empty table gives no rows. Columns other than doc_id, text and n_chars are not read.
    """

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = [model.score(*features(t.as_py(), n.as_py(), buckets)) for t, n in zip(batch.column(1), batch.column(2))]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.float64())], ["doc_id", "score"])

    return common.map_columns(narrow(docs), one, "doc_id long, score double")


def keep_good(docs: DataFrame, model: FactorisationMachine, least: float, buckets: int = 1 << 15) -> DataFrame:
    """The rows of ``docs`` whose score is ``least`` or more, with all their columns. Decided in the scan's own tasks,
    without a join."""
    names = docs.columns

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        text, chars = batch.column(names.index("text")), batch.column(names.index("n_chars")) if "n_chars" in names else None
        keep = [model.score(*features(t.as_py(), chars[k].as_py() if chars is not None else None, buckets)) >= least for k, t in enumerate(text)]
        return batch.filter(pa.array(keep, pa.bool_()))

    return common.map_columns(docs, one, docs.schema)

"""Whitening against numpy over the distinct vectors."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlake.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def whole(vector):
    return tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in vector)


def brute(rows, weighted=False):
    """vec_id -> (deviation, whitened without sign), n, explained."""
    kept = [(k, whole(v)) for k, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    copies = Counter(x for _, x in kept)
    xs = list(copies)
    w = [copies[x] if weighted else 1 for x in xs]
    n, sums = sum(w), [sum(x[j] * c for x, c in zip(xs, w)) for j in range(len(xs[0]))]
    centred = {x: np.array([(n * v - s) / n for v, s in zip(x, sums)]) for x in xs}
    matrix = np.array([centred[x] for x in xs])
    cov = (matrix * np.array(w)[:, None]).T @ matrix / n
    e, q = np.linalg.eigh(cov)
    order = np.argsort(-e)[:16]
    out = {}
    for k, x in kept:
        out.setdefault(k, []).append((sum((n * v - s) ** 2 for v, s in zip(x, sums)), centred[x] @ q[:, order] / np.sqrt(e[order])))
    return out, n, e[order] / np.trace(cov)


def check(got, rows, weighted=False):
    want, n, explained = brute(rows, weighted)
    shown = min(16, len(explained))
    assert len(got) == shown * sum(map(len, want.values())) and {r["n"] for r in got} == {n}
    signs = {}
    for r in got:
        k, c = r["vec_id"], r["component"] - 1
        near = [w for d, w in want[k] if d == r["deviation"]]
        assert near and r["explained"] == pytest.approx(explained[c], rel=1e-9)
        if abs(near[0][c]) > 1e-3:
            signs.setdefault(c, set()).add(np.sign(r["whitened"] / near[0][c]))
        assert min(abs(abs(r["whitened"]) - abs(w[c])) for w in near) < 1e-8
        assert r["identity_error"] < 1e-9
    assert all(len(s) == 1 for s in signs.values())


@pytest.mark.parametrize("weighted", [False, True])
def test_whitening_equals_numpy(spark, weighted):
    rng = np.random.default_rng(3)
    mixed = rng.normal(size=(300, 24)) @ np.diag(1.3 ** np.arange(24)) / 40
    rows = [(k, v.astype(np.float32).tolist()) for k, v in enumerate(mixed)]
    # a hot vector, other copies, one id twice, no id, a zero vector
    rows += [(1000 + k, rows[5][1]) for k in range(200)] + [(2000 + k, rows[k % 7][1]) for k in range(30)] + [(3, rows[9][1]), (3, rows[9][1]), (None, rows[2][1]), (4000, [0.0] * 24)]
    bad = [(9000, None), (9001, [None] * 24), (9002, [float("nan")] + [0.0] * 23), (9003, [float("inf")] + [0.0] * 23), (9004, []), (9005, [1.0] * 23 + [None])]
    table = spark.createDataFrame([(k, v, 0) for k, v in rows + bad], SCHEMA)
    clash = table.select("*", *[F.lit(1).alias(c) for c in ("x", "name", "length", "weight", "n", "key", "component", "values")])
    check(whitening.whitened(clash, weighted=weighted).collect(), [r for r in rows + bad if r[1] != []], weighted)


def test_lengths_apart_and_components_without_variance(spark):
    rows = [(k, [float(k % 4), float(k % 3), 5.0]) for k in range(12)] + [(100 + k, [float(k)]) for k in range(5)] + [(200, [1.0, 2.0])]
    got = whitening.whitened(spark.createDataFrame([(k, v, 0) for k, v in rows], SCHEMA)).collect()
    of = lambda a, b: [r for r in got if a <= r["vec_id"] < b]
    assert Counter(r["component"] for r in of(0, 100)) == {1: 12, 2: 12, 3: 12} and {r["n"] for r in of(0, 100)} == {12}
    assert all((r["whitened"] is None) == (r["component"] == 3) and (r["explained"] == 0) == (r["component"] == 3) for r in of(0, 100))
    assert sorted(r["whitened"] ** 2 for r in of(100, 200)) == pytest.approx([0, 0.5, 0.5, 2, 2]) and max(r["identity_error"] for r in of(0, 200)) < 1e-12
    assert [(r["component"], r["whitened"], r["deviation"], r["identity_error"]) for r in of(200, 201)] == [(1, None, 0, None), (2, None, 0, None)]


def test_large_entries_stay_exact(spark):
    rows = [(k, [2.0**40 * (k + 1), float(k)]) for k in range(3)] + [(9, [2.0**60, 0.0])]
    got = whitening.whitened(spark.createDataFrame([(k, v, 0) for k, v in rows], SCHEMA)).collect()
    assert {r["vec_id"] for r in got} == {0, 1, 2} and {r["deviation"] for r in got if r["vec_id"] != 1} == {None}
    assert {r["deviation"] for r in got if r["vec_id"] == 1} == {0}


def test_no_usable_rows(spark):
    for rows in ([], [(1, None, 0), (2, [], 0)]):
        assert whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_query_equals_numpy(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(queries.op12_embedding_whitening(spark, sf).collect(), rows)

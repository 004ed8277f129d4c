"""Nearest neighbours, sharding, mixing, and the pipeline."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from roadlake.llm import mixing, neighbours, sharding

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_neighbours_match_brute_force(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(700, 16)), np.tile(rng.normal(size=(1, 16)), (150, 1))]).astype(np.float32)
    rows = [(k, v.tolist(), 0) for k, v in enumerate(x)]
    bad = [(900, None, 0), (1000, [0.0] * 16, 0), (1100, [float("nan")] * 16, 0), (1200, [1.0] * 3, 0), (1300, [None] * 16, 0), (1400, [], 0)]
    got = neighbours.search(vectors(spark, rows + bad).withColumn("entry", F.lit(1)), every=50, k=10, leaf=64, tile=32).collect()
    hits = 0
    for q in range(0, 850, 50):
        distance = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        order = [k for k in np.lexsort((np.arange(len(x)), distance)) if k != q][:10]
        own = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 11)) and [r["score"] for r in own] == sorted(r["score"] for r in own)
        assert all(r["score"] == distance[r["vec_id"]] for r in own)
        hits += len({r["vec_id"] for r in own} & set(order))
        if q >= 700:
            assert [r["vec_id"] for r in own] == order
    assert hits >= 0.9 * 170 and {r["query_id"] for r in got} == set(range(0, 850, 50))


def test_neighbours_of_repeated_rows(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 8)).astype(np.float32)
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    rows += 2 * [rows[0]] + 14 * [rows[50]] + 5 * [rows[51]]
    rows += [(100, (x[100] + d / 1000).tolist()) for d in range(1, 15)] + [(7, (x[150] + d / 1000).tolist()) for d in range(1, 15)]
    rows += [(k, x[150].tolist()) for k in range(300, 330)]
    got = neighbours.search(vectors(spark, [(k, v, 0) for k, v in rows]), every=50, k=10, leaf=64, tile=32, recall=1.0).collect()
    ids, points = np.array([k for k, _ in rows]), np.array([v for _, v in rows], np.float32).astype(float)
    for q in (0, 50, 100, 150, 300):
        near = {}
        for point in points[ids == q]:
            for k, d in zip(ids.tolist(), np.sqrt(((points - point) ** 2).sum(1)).tolist()):
                near[k] = min(d, near.get(k, d))
        want = sorted((d, k) for k, d in near.items() if k != q)[:10]
        assert [(r["score"], r["vec_id"]) for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] == want
    assert len(got) == 50


@pytest.mark.parametrize("clusters", [0, 40])
def test_the_forest_prunes_and_finds(clusters):
    """On the driver: recall and the share of rows read, on vectors without structure and on clustered ones."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(30_000, 32)) if not clusters else rng.normal(size=(clusters, 32))[rng.integers(0, clusters, 30_000)] + 0.3 * rng.normal(size=(30_000, 32))
    sample = x[rng.choice(len(x), 4000, replace=False)]
    forest = neighbours.fit(sample, 4, 32, 1)
    share, leaves = neighbours.calibrated(forest, sample, 10, 0.95), forest.leaves(x)
    hits, read = 0, 0
    for q in range(0, len(x), 1000):
        distance = np.sqrt(((x - x[q]) ** 2).sum(1))
        order = np.argsort(distance)
        reach = np.sort(distance[np.isin(leaves, leaves[q]).any(1)])[10]
        seen = np.isin(leaves, [*forest.search(x[q], share * reach), *leaves[q]]).any(1)
        hits, read = hits + seen[order[1:11]].sum(), read + seen.mean()
    assert hits >= 0.9 * 300 and read / 30 < (0.1 if clusters else 0.9)


def test_few_and_no_vectors(spark):
    few = neighbours.search(vectors(spark, [(0, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [1.0, 0.0], 0)]), every=2, k=10).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in few) == [(0, 1, 2), (0, 2, 1), (2, 1, 0), (2, 2, 1)]
    assert neighbours.search(vectors(spark, [])).count() == 0


def corpus(spark, n=400):
    rows = [(k, None if k % 97 == 0 else "word " * (1 + k * 7 % 50), "en", None if k % 40 == 0 else "hot" if k % 3 == 0 else f"s{k % 7}", 1) for k in range(n)]
    return spark.createDataFrame([*rows, (None, "no id", None, "s1", 1), rows[5]], SCHEMA).withColumns({c: F.lit(0) for c in ("rank", "key", "block", "size", "at", "total", "target", "positions", "_n")})


def test_shards_are_even_and_proportional(spark):
    docs = corpus(spark)
    got = sharding.shard(docs, 8).toPandas()
    assert len(got) == 402 and set(got.law) == {"rows"} and got.grown_shard.isna().all()
    for _, own in got.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own))) and len(own) in (50, 51)
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert all(c == zlib.crc32(text[None if d != d else d].encode()) and s == len(text[None if d != d else d]) + 16 for d, c, s in zip(got.doc_id, got.text_crc32, got["size"]))
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    hot = got[[source[None if d != d else d] == "hot" for d in got.doc_id]].groupby("shard").size()
    assert hot.max() - hot.min() <= 2
    assert sharding.shard(docs, 8).orderBy("shard", "slot").collect() == sharding.shard(docs.repartition(7), 8).orderBy("shard", "slot").collect()
    assert sharding.shard(docs.limit(0), 8).count() == 0 and sharding.shard(docs.limit(3), 8).count() == 3


def test_shards_match_brute_force(spark):
    docs = corpus(spark)
    rows = [(r["doc_id"], r["source"], (r["text"] or "").encode()) for r in docs.collect()]
    sizes = {}
    for _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + 1

    def key(doc_id, text):
        return hashlib.md5(f"8-{'' if doc_id is None else doc_id}-{hashlib.md5(text).hexdigest()}".encode()).hexdigest()

    tail = lambda doc_id, text: ((doc_id is not None, doc_id or 0), zlib.crc32(text), len(text) + 16)
    seen, order = {}, []
    for doc_id, source, text in sorted(rows, key=lambda r: (key(r[0], r[2]), *tail(r[0], r[2]))):
        rank = seen[source] = seen.get(source, -1) + 1
        order.append(((rank + 0.5) / sizes[source], key(doc_id, text), (source is None, source or ""), *tail(doc_id, text)))
    want = []
    for at, (*_, (known, doc_id), crc, size) in enumerate(sorted(order)):
        shard = at * 8 // len(rows)
        want.append((doc_id if known else None, size, crc, shard, at - -(-shard * len(rows) // 8)))
    got = [(r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in sharding.shard(docs, 8).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def water_fill(sizes, weights, most):
    left, target = dict(zip(sizes, weights)), {}
    total = sum(sizes.values())
    while True:
        rest = total - sum(target.values())
        share = {s: rest * w / sum(left.values()) for s, w in left.items()}
        full = [s for s in left if share[s] >= most * sizes[s]]
        if not full:
            return target | share
        for s in full:
            target[s] = most * sizes[s]
            del left[s]
        if not left:
            return target


def test_mix_meets_its_targets(spark):
    docs = corpus(spark)
    got = mixing.plan(docs).toPandas()
    assert len(got) == 402
    sizes = got.groupby(got.source.fillna("~"))["size"].sum().to_dict()
    names = sorted(sizes)
    want = water_fill({s: sizes[s] for s in names}, [(5, 2, 1)[k % 3] for k in range(len(names))], 3)
    for name, own in got.groupby(got.source.fillna("~")):
        assert np.isclose(own.target.iloc[0], want[name]) and (own.source_size == sizes[name]).all()
        assert abs(own.taken.sum() - want[name]) <= max(own["size"].max() / 4, 4)
    assert (got.taken <= 3 * got["size"]).all() and (got.taken == got["size"] * got.copies).all()
    assert all(0 <= p <= 1 for ps in got.positions for p in ps) and all(list(ps) == sorted(ps) for ps in got.positions)
    key = ["doc_id", "size", "target", "taken"]
    assert mixing.plan(docs.repartition(5)).select(*key).orderBy(*key).collect() == mixing.plan(docs).select(*key).orderBy(*key).collect()
    assert mixing.plan(docs.limit(0)).count() == 0


def test_the_plan_is_in_training_order(spark):
    ordered = mixing.in_training_order(mixing.plan(corpus(spark)))
    rows = ordered.collect()
    first = [r["position_1"] for r in rows]
    taken = [p for p in first if p is not None]
    assert taken == sorted(taken) and first[len(taken) :] == [None] * (len(first) - len(taken)) and len(rows) == 402
    assert all(sum(r[f"position_{k}"] is not None for k in (1, 2, 3)) == r["copies"] for r in rows)
    assert "rangepartitioning" in ordered._jdf.queryExecution().toString()


def test_mixed_rows_repeat_in_training_order(spark):
    docs = corpus(spark)
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    want = {}
    for r in mixing.plan(docs).collect():
        want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["copies"]
    rows = out.collect()
    found = {}
    for r in rows:
        found[r["doc_id"]] = found.get(r["doc_id"], 0) + 1
    assert found == {k: n for k, n in want.items() if n}


def test_schedules_invert_their_integral(spark):
    phases = ((2.0, 1.0, 1.0, 0.0), (0.0, 1.0, 3.0))
    rows = spark.createDataFrame([(k / 20, turn) for k in range(21) for turn in (0, 1)], "demand double, turn int")
    for r in rows.select("demand", "turn", mixing.position(F.col("demand"), F.col("turn"), phases).alias("t")).collect():
        plan = phases[r["turn"]]
        edges = np.linspace(0, 1, len(plan) + 1)
        assert np.isclose(np.interp(r["t"], edges, np.cumsum([0, *plan]) / sum(plan)), r["demand"])


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.common.staged(stage(spark, docs, SF))
        assert docs.count() > 0
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    one = corpus_pipeline.run(spark, SF).select("doc_id", "piece", "length").orderBy("doc_id", "piece", "length").collect()
    assert one == docs.select("doc_id", "piece", "length").orderBy("doc_id", "piece", "length").collect()

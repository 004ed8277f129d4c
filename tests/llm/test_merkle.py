"""The Merkle manifest against a plain computation."""

import hashlib
import zlib

import numpy as np
from pyspark.sql import functions as F

from roadlake.llm import merkle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    doc_id, text, lang, source, n = row
    told = ["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n, text)]
    return sha(*told)


def climb(hashes):
    """(root, per leaf the (before, after) of every level)."""
    paths, at = [[] for _ in hashes], list(range(len(hashes)))
    while len(hashes) > 1:
        for k, own in enumerate(at):
            first = own // 16 * 16
            paths[k].append(("".join(hashes[first:own]), "".join(hashes[own + 1 : first + 16])))
            at[k] = own // 16
        hashes = [sha(*hashes[k : k + 16]) for k in range(0, len(hashes), 16)]
    return hashes[0], paths


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        own = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = own, *climb([leaf(r) for r in own])
    root, tops = climb([trees[s][1] for s in order])
    out = []
    for s, top in zip(order, tops):
        own, subroot, paths = trees[s]
        for row, path in zip(own, paths):
            text = row[1]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            found = leaf((row[0], text, *row[2:]))
            for before, after in path + top:
                found = sha(before, found, after)
            out.append((row[0], leaf(row), subroot, root, sha(*(a + b for a, b in path + top)), found, found == root))
    return sorted(out, key=repr)


def test_manifest_equals_a_plain_computation(spark):
    # a source with two layers of subtrees, sources of one row, of 16, of 17, and rows without anything
    rows = [(k * 3, f"Text {k % 7} É", "en", "hot", k) for k in range(4400)]
    rows += [(20_000 + k, f"T{k}", None, f"one{k}", None) for k in range(40)]
    rows += [(30_000 + k, "" if k % 2 else None, "fr", "sixteen", k) for k in range(16)] + [(31_000 + k, "Ab" * 5000, "fr", "seventeen", -k) for k in range(17)]
    rows += [(None, "X", None, None, None), (None, "Y", "de", None, 1), (5, None, None, None, None), (5, "Same", "en", "", 4), (5, "Same", "en", "", 4), (5, "Other", "en", "", 4)]
    rows += [(7, "A", "en", "", 1), (7, "A", "en", "ß", 1), (7, "A", "en", "\U0001f600", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    clash = docs.select("*", *[F.lit(1).alias(c) for c in ("at", "n", "digest", "block", "key", "group_name", "path", "_at", "salt")])
    got = [tuple(r) for r in merkle.verified(clash, merkle.case_changed()).collect()]
    assert sorted(got, key=repr) == brute(rows)
    assert {r[-1] for r in got} == {True, False}
    assert all(r["verified"] for r in merkle.manifest(docs.where("source <> 'hot'")).collect())


def test_manifest_of_nothing_and_of_one_row(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert merkle.verified(none, merkle.case_changed()).collect() == []
    one = [(3, "Only", "en", "s", 4)]
    assert [tuple(r) for r in merkle.verified(spark.createDataFrame(one, SCHEMA), merkle.case_changed()).collect()] == brute(one)


def test_layout_is_van_emde_boas():
    for levels in (1, 2, 3, 4, 5):
        every = np.concatenate([merkle.address(k, np.arange(16**k), levels) for k in range(levels)])
        assert sorted(every) == list(range(merkle.nodes(levels)))
    # half the height above, then whole lower trees, one after another
    assert merkle.address(1, np.arange(16), 4).tolist() == list(range(1, 17))
    assert merkle.address(2, np.arange(3), 4).tolist() == [17, 34, 51] and merkle.address(3, np.arange(17, 19), 4).tolist() == [36, 37]
    digests = np.random.default_rng(0).integers(0, 256, (1000, 32), np.uint8)
    store = merkle.laid_out(digests, 3)
    root, paths = climb([x.tobytes().hex() for x in digests])
    assert store[0].tobytes().hex() == root and list(merkle.siblings(store, 1000, 3)) == paths


def test_query_finds_what_was_changed(spark):
    rows = queries.op11_merkle_manifest(spark, "/root/testdata/sf0.01").collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    for r in rows:
        hit = zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and any("A" <= c <= "Z" for c in docs[r["doc_id"]] or "")
        assert r["verified"] != hit
    assert len(rows) == len(docs) and len({r["root"] for r in rows}) == 1

"""Merkle manifest of a dataset: a digest of every row, of every group, and of the whole, and proofs for rows.

A group's leaves ascend by their key; every run of 16 consecutive nodes has the digest of their joined digests above it,
until one node is left, the group's subroot. The subroots in the order of their groups are the leaves of one more tree.

Trees are stored as aligned subtrees of 4,096 leaves in the van Emde Boas layout: a subtree is cut at half its height, the
upper part comes first, then the lower ones one after another, each laid out the same way. A node's place follows from
its level and index alone (``address``), so both building a subtree and reading the siblings of a leaf are gathers from
one array, and neighbours of any level lie close whatever the size of a page or cache line. The roots of subtrees are the
leaves of the next layer, and so on: a tree of n leaves has about log(n) / log(4096) layers, and each is one shuffle of a
4,096th of the rows of the one below.

A task holds one subtree at a time. A hot group is as many subtrees as it needs; its leaves get their places from ranges
of the whole order, never from one task. The driver learns one number a layer and the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlake.staging import condensed, staged

FANOUT, EDGES, DIGEST = 16, 3, 32
WIDTH = FANOUT**EDGES
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def encoded(value: Column) -> Column:
    """A value as the byte count of its UTF-8 text, a colon and the text; null as a dash. No two rows of such values, put
    together, are the same text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*map(encoded, values)), 256))


def nodes(levels: int) -> int:
    """Nodes of a full subtree of so many levels."""
    return (FANOUT**levels - 1) // (FANOUT - 1)


def address(level: int, index: np.ndarray, levels: int) -> np.ndarray:
    """Where the nodes ``index`` of ``level`` (0: the root) lie in the layout of a subtree of ``levels`` levels."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if level < top:
        return address(level, index, top)
    below = FANOUT ** (level - top)
    return nodes(top) + index // below * nodes(levels - top) + address(level - top, index % below, levels - top)


def edges(count: int) -> int:
    """How often ``count`` nodes are put into runs until one is left."""
    height = 0
    while FANOUT**height < count:
        height += 1
    return height


def per_level(leaves: int, height: int) -> list[int]:
    """Nodes of each level, from the root down, of a subtree with ``leaves`` at the bottom."""
    counts = [leaves]
    for _ in range(height):
        counts.append(-(-counts[-1] // FANOUT))
    return counts[::-1]


def laid_out(leaves: np.ndarray, height: int) -> np.ndarray:
    """A subtree (digests by address) over ``leaves`` (one digest a row). What lies behind its last node is left off."""
    store = np.zeros((nodes(height + 1), DIGEST), np.uint8)
    counts = per_level(len(leaves), height)
    last = at = address(height, np.arange(len(leaves)), height + 1)
    store[at] = leaves
    for level in range(height, 0, -1):
        below = run_texts(store, level, counts[level], height)
        above = b"".join(hashlib.sha256(below[k : k + FANOUT * 2 * DIGEST].encode()).digest() for k in range(0, len(below), FANOUT * 2 * DIGEST))
        at = address(level - 1, np.arange(counts[level - 1]), height + 1)
        store[at] = np.frombuffer(above, np.uint8).reshape(-1, DIGEST)
    return store[: max(last.max(), nodes((height + 1) // 2) - 1) + 1]


def run_texts(store: np.ndarray, level: int, count: int, height: int) -> str:
    """The digests of a level as hex text, in order: 1,024 characters are a run."""
    return store[address(level, np.arange(count), height + 1)].tobytes().hex()


def siblings(store: np.ndarray, leaves: int, height: int) -> Iterator[list[tuple[str, str]]]:
    """For each leaf of a subtree, the texts before and after its ancestor in the run of every level, from the bottom up."""
    counts = per_level(leaves, height)
    texts = [run_texts(store, level, counts[level], height) for level in range(height, 0, -1)]
    run, one = FANOUT * 2 * DIGEST, 2 * DIGEST
    for leaf in range(leaves):
        index, path = leaf, []
        for text in texts:
            start, own = index // FANOUT * run, index * one
            path.append((text[start:own], text[own + one : start + run]))
            index //= FANOUT
        yield path


def folded(own: str, path: Sequence[tuple[str, str]]) -> str:
    for before, after in path:
        own = hashlib.sha256((before + own + after).encode()).hexdigest()
    return own


def placed(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """``rows`` (staged, as they are read twice) with ``at``, their place in their group ``by`` in ``order``, and ``n``, the
    size of the group. Ranges of the whole order are sorted, each in a task; a row's place is what the ranges before hold
    of its group, and its own place in its range."""
    cut = staged(rows.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33).alias("_part")
    runs = cut.groupBy(*by, part).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    group = Window.partitionBy(*by)
    begin = F.coalesce(F.sum("_n").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(*by, "_part", (begin - F.col("_first")).alias("_shift"), F.sum("_n").over(group).alias("n"))
    found = cut.select("*", part).join(runs, [*by, "_part"])
    return found.select(*rows.columns, (F.col("_at") + F.col("_shift")).alias("at"), "n")


def grouped(nodes_: DataFrame, by: list[str]):
    return nodes_.withColumn("block", F.floor(F.col("at") / WIDTH)).groupBy(*by, "block")


def subtrees(nodes_: DataFrame, by: list[str]) -> DataFrame:
    """by, block, n, store, root: a row per subtree over nodes (by, at, n, digest)."""
    kinds = dict(nodes_.dtypes)

    def build(key: tuple, table: pa.Table) -> pa.Table:
        order = np.argsort(table["at"].to_numpy())
        leaves = np.frombuffer(b"".join(table["digest"].to_pylist()), np.uint8).reshape(-1, DIGEST)[order]
        n = table["n"][0].as_py()
        store = laid_out(leaves, min(EDGES, edges(n)))
        return pa.table({name: [x.as_py()] for name, x in zip([*by, "block"], key)} | {"n": [n], "count": [len(leaves)], "store": [store.tobytes()], "root": [store[0].tobytes()]}, schema)

    spark_schema = ", ".join([*(f"{x} {kinds[x]}" for x in by), "block long, n long, count int, store binary, root binary"])
    schema = pa.schema([*((x, pa.string() if kinds[x] == "string" else pa.int32()) for x in by), ("block", pa.int64()), ("n", pa.int64()), ("count", pa.int32()), ("store", pa.binary()), ("root", pa.binary())])
    return grouped(nodes_, by).applyInArrow(build, spark_schema)


PATH = "array<struct<before:string,after:string>>"

def no_path() -> Column:
    return F.array().cast(PATH)


def layers(leaves: DataFrame, by: list[str]) -> list[DataFrame]:
    """The subtrees over ``leaves`` (by, at, n, digest), those over their roots, and so on until each group has one."""
    found = [staged(subtrees(leaves, by))]
    while (found[-1].agg(F.max("n")).first()[0] or 0) > WIDTH:
        below = found[-1].where(F.col("n") > WIDTH)
        found.append(staged(subtrees(below.select(*by, F.col("block").alias("at"), F.ceil(F.col("n") / WIDTH).alias("n"), F.col("root").alias("digest")), by)))
    return found


def leaf_paths(blocks: DataFrame, by: list[str]) -> DataFrame:
    """by, at, path: the siblings of every leaf of subtrees (with the path of their root), up to the root of the tree."""
    kinds = dict(blocks.dtypes)

    def walk(key: tuple, table: pa.Table) -> pa.Table:
        row = table.select(["n", "count", "store", "path"]).to_pylist()[0]
        height = min(EDGES, edges(row["n"]))
        store = np.frombuffer(row["store"], np.uint8).reshape(-1, DIGEST)
        paths = [[{"before": a, "after": b} for a, b in own] + row["path"] for own in siblings(store, row["count"], height)]
        first = key[-1].as_py() * WIDTH
        return pa.table({name: [x.as_py()] * len(paths) for name, x in zip(by, key)} | {"at": range(first, first + len(paths)), "path": paths}, schema)

    schema = pa.schema([*((x, pa.string() if kinds[x] == "string" else pa.int32()) for x in by), ("at", pa.int64()), ("path", pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())])))])
    return blocks.groupBy(*by, "block").applyInArrow(walk, ", ".join([*(f"{x} {kinds[x]}" for x in by), f"at long, path {PATH}"]))


def with_paths(found: list[DataFrame], by: list[str]) -> DataFrame:
    """The lowest subtrees with the path from their root to that of their group."""
    above = found[-1].withColumn("path", no_path())
    for lower in reversed(found[:-1]):
        upper = leaf_paths(above, by).withColumnRenamed("at", "block")
        above = lower.join(upper, [*by, "block"], "left").withColumn("path", F.coalesce("path", no_path()))
    return above


def roots(found: list[DataFrame], by: list[str]) -> DataFrame:
    """by, root: the subroot of each group."""
    out = found[0].where(F.col("n") <= WIDTH)
    for upper in found[1:]:
        out = out.unionByName(upper.where(F.col("n") <= WIDTH))
    return out.select(*by, "root")


def leaves_of(docs: DataFrame, fields: Sequence[str], group: str, key: str, changed: Column) -> DataFrame:
    """has_group, group_name, key, digest, altered (the digest that the row has now, where it is another), salt. The salt
    lets rows alike in everything be cut apart; which of them comes first makes no difference."""
    other = F.when(~changed.eqNullSafe(F.col("text")), digest(*[changed if c == "text" else F.col(c) for c in fields]))
    named = [F.col(group).isNotNull().cast("int").alias("has_group"), F.coalesce(F.col(group).cast("string"), F.lit("")).alias("group_name")]
    return docs.select(*named, F.col(key).alias("key"), digest(*map(F.col, fields)).alias("digest"), other.alias("altered"), F.rand(11).alias("salt"))


BY = ["has_group", "group_name"]


def verified(docs: DataFrame, changed: Column, fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), group: str = "source", key: str = "doc_id") -> DataFrame:
    """key, leaf, subroot, root, proof_sha256, folded_root, verified: a row per row of ``docs``, whose digests are those of
    its ``fields`` as they are stored; the root is computed again from the row with ``changed`` in place of its text and
    from the stored siblings, and compared.

    Groups ascend, null first; keys ascend, null first, rows of one key by their digest. A null in any field is a value of
    its own; empty texts have a byte count of zero. Rows alike in everything are each a leaf. No rows give no rows. Other
    columns of ``docs`` are not read, whatever they are called.
    """
    rows = condensed(lambda: placed(staged(leaves_of(docs, fields, group, key, changed)), BY, ["key", "digest", "salt"]).drop("salt"))
    trees = layers(rows.select(*BY, "at", "n", "digest"), BY)
    groups = condensed(lambda: placed(staged(roots(trees, BY).withColumn("whole", F.lit(0))), ["whole"], BY))
    upper = layers(groups.select("whole", "at", "n", F.col("root").alias("digest")), ["whole"])
    top = roots(upper, ["whole"]).first()
    # a group is a leaf of the upper tree at its rank
    of_groups = leaf_paths(with_paths(upper, ["whole"]), ["whole"]).join(groups.select(*BY, "at", F.col("root").alias("subroot")), "at").select(*BY, "subroot", F.col("path").alias("_rest"))
    blocks = with_paths(trees, BY).join(of_groups, BY).withColumn("path", F.concat("path", "_rest")).drop("_rest", "root")

    def prove(key_: tuple, own: pa.Table, tree: pa.Table) -> pa.Table:
        row = tree.select(["n", "count", "store", "path", "subroot"]).to_pylist()[0]
        store = np.frombuffer(row["store"], np.uint8).reshape(-1, DIGEST)
        rest = [(x["before"], x["after"]) for x in row["path"]]
        tail = "".join(a + b for a, b in rest)
        own = own.take(np.argsort(own["at"].to_numpy()))
        first = [x.hex() for x in own["digest"].to_pylist()]
        out = {"key": own["key"], "leaf": first, "subroot": [row["subroot"].hex()] * len(first), "proof_sha256": [], "folded_root": []}
        for leaf, other, path in zip(first, own["altered"].to_pylist(), siblings(store, row["count"], min(EDGES, edges(row["n"])))):
            out["proof_sha256"].append(hashlib.sha256(("".join(a + b for a, b in path) + tail).encode()).hexdigest())
            out["folded_root"].append(folded(leaf if other is None else other.hex(), path + rest))
        return pa.table(out)

    kind = dict(rows.dtypes)["key"]
    out = grouped(rows, BY).cogroup(blocks.groupBy(*BY, "block")).applyInArrow(prove, f"key {kind}, leaf string, subroot string, proof_sha256 string, folded_root string")
    root = F.lit(top["root"].hex() if top else None).cast("string")
    return out.select(F.col("key").alias(key), "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))


def manifest(docs: DataFrame, **more) -> DataFrame:
    """The same without changes: every row is verified, unless the rows changed while they were read."""
    return verified(docs, F.col("text"), **more)


def case_changed(every: int = 5) -> Column:
    """The text with A-Z in lower case where ``every`` divides the CRC32 of the decimal doc_id; a row without doc_id keeps its own."""
    hit = F.crc32(F.col("doc_id").cast("string")) % every == 0
    return F.when(hit, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))

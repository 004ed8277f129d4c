"""SimHash near-duplicates: fingerprints, bit-sliced comparison inside blocks, components over the links."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.llm import common

M64 = (1 << 64) - 1


def shingles(text: str | None, width: int) -> list[bytes]:
    """Runs of ``width`` words of the text with A-Z lower-cased, repeats included, joined by one space.

    A text of fewer words gives the whole sequence; one without words gives nothing.
    """
    found = text.encode().lower().split() if text else []
    if len(found) <= width:
        return [b" ".join(found)] if found else []
    line, ends, at = b" ".join(found), [], -1
    for word in found:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *[x + 1 for x in ends]]
    return [line[a:b] for a, b in zip(starts, ends[width - 1 :])]


def bit_counts(rows: np.ndarray) -> np.ndarray:
    """How many of the rows (n, lanes) of 64-bit words have each bit set; bit 0 of the first word first.

    Carry-save adders fold three rows of one weight into a row of that weight and one of twice it, until few words are
    left, which are counted bit by bit.
    """
    total, weight, few = np.zeros(64 * rows.shape[1], np.int64), 1, max(8, 400 // rows.shape[1])
    while len(rows):
        carries = []
        while len(rows) > few:
            m = len(rows) // 3
            a, b, c = rows[:m], rows[m : 2 * m], rows[2 * m : 3 * m]
            u = a ^ b
            carries.append((a & b) | (u & c))
            rows = np.concatenate([u ^ c, rows[3 * m :]])
        bits = np.unpackbits(np.ascontiguousarray(rows).astype("<u8", copy=False).view(np.uint8).reshape(len(rows), -1), axis=1, bitorder="little")
        total += weight * bits.sum(axis=0, dtype=np.int64)
        rows, weight = (np.concatenate(carries) if carries else rows[:0]), 2 * weight
    return total


def mixed(hashes: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """(n, len(steps)): rehashes of 64-bit hashes by the finalizer of SplitMix64; step 0: the hashes themselves."""
    x = hashes[:, None] + np.uint64(0x9E3779B97F4A7C15) * steps[None, :]
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    x[:, steps == 0] = hashes[:, None]
    return x


def fingerprint(hashes: np.ndarray, lanes: int) -> np.ndarray:
    """``lanes`` 64-bit words; a bit is set if it is set in over half the hashes; no hashes: zero."""
    if not len(hashes):
        return np.zeros(lanes, np.uint64)
    rows = mixed(hashes, np.arange(lanes, dtype=np.uint64)) if lanes > 1 else hashes[:, None]
    return np.packbits(2 * bit_counts(rows) > len(hashes), bitorder="little").view("<u8").astype(np.uint64)


def pigeonhole_keys(fp: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Two 64-bit fingerprints at 2 or fewer differing bits agree on two of their four 16-bit quarters, whichever:
    six keys, of which any such pair shares one. No pair is lost."""
    q = [int(fp[0]) >> s & 0xFFFF for s in (0, 16, 32, 48)]
    pairs = [(a, b) for a in range(4) for b in range(a)]
    return np.array([k << 32 | q[a] << 16 | q[b] for k, (a, b) in enumerate(pairs)], np.int64)


def shared_keys(count: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Blocks for wide radii, where quarters say little: the smallest value of each of ``count`` rehashes of the
    shingles. Texts of similarity J share a given key with probability J: at 0.8 and eight keys all are missed by 3
    pairs in a million. One more key is a digest of all shingles, so that texts of different shingles are never one node."""

    def keys(fp: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        rows = mixed(hashes, np.arange(1000, 1001 + count, dtype=np.uint64)) if len(hashes) else np.zeros((1, count + 1), np.uint64)
        low = np.append(rows[:, :count].min(axis=0), np.bitwise_xor.reduce(rows[:, count]))
        return ((low & np.uint64(M64 - 15)) | np.arange(count + 1, dtype=np.uint64)).view(np.int64)

    return keys


def hashes_of(text: str | None, width: int, seed: int, distinct: bool) -> np.ndarray:
    found = shingles(text, width)
    return np.array([xxhash.xxh64_intdigest(x, seed) for x in (set(found) if distinct else found)], np.uint64)


def fingerprints(docs: DataFrame, width: int = 3, lanes: int = 1, seed: int = 42, keys: Callable = pigeonhole_keys, distinct: bool = False) -> DataFrame:
    """doc_id, digest, fp array<long> of ``lanes`` words, keys array<long>: one row per row of ``docs`` (doc_id, digest, text).

    ``distinct``: count each different shingle once. Null and empty texts have the zero fingerprint.
    """

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps, blocks = [], []
        for text in batch.column(2):
            hashes = hashes_of(text.as_py(), width, seed, distinct)
            fp = fingerprint(hashes, lanes)
            fps.append(fp.view(np.int64).tolist())
            blocks.append(keys(fp, hashes).tolist())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.list_(pa.int64())), pa.array(blocks, pa.list_(pa.int64()))], ["doc_id", "digest", "fp", "keys"])

    return common.map_columns(docs.select("doc_id", "digest", "text"), one, "doc_id long, digest string, fp array<long>, keys array<long>")


def within(plane: Callable[[int], np.ndarray], planes: int, radius: int) -> np.ndarray:
    """Bit mask of the lanes whose number of set bits over all planes is at most ``radius``.

    ``plane(b)`` holds bit b of 64 lanes in each of its words. Planes are added with carry-save adders: eight of them
    fold into counters of weight 1, 2, 4 and one carry of weight 8, which ripples into the vertical counter above. A
    block is left as soon as every lane exceeds the radius.
    """
    zero = np.zeros_like(plane(0))
    ones, twos, fours, upper = zero, zero, zero, []

    def csa(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        u = a ^ b
        return u ^ c, (a & b) | (u & c)

    def over(digits: list[np.ndarray], most: int) -> np.ndarray:
        """Lanes whose count, written in ``digits`` from the lowest, is over ``most``."""
        above, same = zero.copy(), ~zero
        for k in range(max(len(digits), most.bit_length()) - 1, -1, -1):
            digit = digits[k] if k < len(digits) else zero
            if most >> k & 1:
                same = same & digit
            else:
                above |= same & digit
                same = same & ~digit
        return above

    for at in range(0, planes, 8):
        p = [plane(b) for b in range(at, at + 8)]
        ones, a = csa(ones, p[0], p[1])
        ones, b = csa(ones, p[2], p[3])
        twos, c = csa(twos, a, b)
        ones, a = csa(ones, p[4], p[5])
        ones, b = csa(ones, p[6], p[7])
        twos, d = csa(twos, a, b)
        fours, carry = csa(fours, c, d)
        for k, digit in enumerate(upper):
            upper[k], carry = digit ^ carry, digit & carry
        if carry.any():
            upper.append(carry)
        if at % 32 == 24 or at + 8 >= planes:
            beyond = over([ones, twos, fours, *upper], radius)
            if not (~beyond).any():
                break
    return ~beyond


def planes_of(fps: np.ndarray) -> np.ndarray:
    """Bit planes of (n, lanes) fingerprints: (64 * lanes, words), one bit per fingerprint, padded with zeros."""
    bits = np.unpackbits(np.ascontiguousarray(fps).astype("<u8").view(np.uint8).reshape(len(fps), -1), axis=1, bitorder="little").T
    packed = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))).view("<u8")


def linked_pairs(left: np.ndarray, right: np.ndarray, radius: int, rows: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Indices (i, j) of fingerprints within the radius, left against right."""
    vertical, nplanes, out = planes_of(right), 64 * left.shape[1], []
    for at in range(0, len(left), rows):
        part = left[at : at + rows]
        bits = np.unpackbits(np.ascontiguousarray(part).astype("<u8").view(np.uint8).reshape(len(part), -1), axis=1, bitorder="little")
        masks = (np.uint64(0) - bits.astype(np.uint64)).T.copy()
        hit = within(lambda b, masks=masks: vertical[b][None, :] ^ masks[b][:, None], nplanes, radius)
        if hit.any():
            lanes = np.unpackbits(hit.view(np.uint8), axis=1, bitorder="little")[:, : len(right)]
            i, j = np.nonzero(lanes)
            out.append((i + at, j))
    return (np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])) if out else (np.empty(0, int), np.empty(0, int))


def pair_mask(left: np.ndarray, right: np.ndarray, radius: int) -> np.ndarray:
    """For many small blocks at once: whether left[k] and right[k] are within the radius; a lane holds a pair."""
    spare = np.full((-len(left) % 64, left.shape[1]), M64, np.uint64)
    vertical = planes_of(np.concatenate([left ^ right, spare]))
    return np.unpackbits(within(lambda b: vertical[b], 64 * left.shape[1], radius).view(np.uint8), bitorder="little")[: len(left)].astype(bool)


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index of each one's component over the links (i, j)."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def dealt(nodes: DataFrame, tile: int) -> DataFrame:
    """node, key, part, x, y of the nodes that share a key: blocks are (key, x, y), and a key of more than ``tile`` nodes is
    dealt over pairs of parts."""
    keyed = nodes.select("node", F.explode("keys").alias("key"))
    counts = common.staged(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    parts = F.ceil(F.col("n") / tile).cast("int")
    return common.staged(
        keyed.join(counts, "key")
        .select("node", "key", parts.alias("parts"), F.pmod(F.xxhash64("node"), parts).cast("int").alias("part"))
        .select("node", "key", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
        .select("node", "key", "part", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"))
    )


def in_blocks(rows: DataFrame, *more: str) -> DataFrame:
    """key, x, y, part, node and ``more``, each block in one task and its rows in order of part and node."""
    return rows.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "part", "node").select("key", "x", "y", "part", "node", *more)


def links(nodes: DataFrame, radius: int, tile: int = 1024) -> DataFrame:
    """Edges (a, b) that connect the same nodes as all links of ``nodes`` (node long, fp, keys) at ``radius`` or fewer
    differing bits among nodes that share a key.

    Keys of one node are dropped first. A key of more than ``tile`` nodes is dealt over pairs of parts of about
    ``tile`` nodes, so that every pair still meets and no task holds more than two parts. A task returns a spanning
    forest of each block's links, never all pairs.
    """
    blocks = in_blocks(dealt(nodes, tile).join(nodes.select("node", "fp"), "node"), "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small: list[tuple[np.ndarray, np.ndarray]] = []
        pairs, held = 0, None
        for batch in batches:
            cols = [np.asarray(batch.column(k)) for k in range(4)]
            fps = np.asarray(batch.column(5).flatten()).view(np.uint64).reshape(batch.num_rows, -1)
            node = np.asarray(batch.column(4))
            if held is not None:
                cols, fps, node = [np.concatenate(x) for x in zip(held[0], cols)], np.concatenate([held[1], fps]), np.concatenate([held[2], node])
            new = np.flatnonzero((cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]) | (cols[2][1:] != cols[2][:-1])) + 1
            cuts = [0, *new.tolist()]
            for a, b in zip(cuts, cuts[1:]):
                if b - a < 2:
                    continue
                if b - a <= 32 and cols[1][a] == cols[2][a]:
                    small.append((node[a:b], fps[a:b]))
                    pairs += (b - a) * (b - a - 1) // 2
                    if pairs > 20_000:
                        yield few(small, radius)
                        small, pairs = [], 0
                else:
                    yield many(node[a:b], fps[a:b], cols[3][a:b], bool(cols[1][a] != cols[2][a]), radius)
            held = ([x[cuts[-1] :] for x in cols], fps[cuts[-1] :], node[cuts[-1] :])
        if held is not None and len(held[2]) > 1:
            if len(held[2]) <= 32 and held[0][1][0] == held[0][2][0]:
                small.append((held[2], held[1]))
            else:
                yield many(held[2], held[1], held[0][3], bool(held[0][1][0] != held[0][2][0]), radius)
        if small:
            yield few(small, radius)

    return blocks.mapInArrow(run, "a long, b long")


def edges_of(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def few(blocks: list[tuple[np.ndarray, np.ndarray]], radius: int) -> pa.RecordBatch:
    """Links of many blocks of up to 32 nodes, compared together."""
    left, right, at = [], [], 0
    for node, _ in blocks:
        i, j = np.triu_indices(len(node), 1)
        left.append(i + at)
        right.append(j + at)
        at += len(node)
    i, j = np.concatenate(left), np.concatenate(right)
    node, fps = np.concatenate([x for x, _ in blocks]), np.concatenate([x for _, x in blocks])
    hit = pair_mask(fps[i], fps[j], radius)
    low = forest(at, i[hit], j[hit])
    moved = low != np.arange(at)
    return edges_of(node[moved], node[low[moved]])


def many(node: np.ndarray, fps: np.ndarray, part: np.ndarray, two: bool, radius: int) -> pa.RecordBatch:
    """Links of one block: all pairs within it, or, of a block of two parts, those between the parts."""
    if two:
        second = int(np.searchsorted(part, part[0], side="right"))
        i, j = linked_pairs(fps[:second], fps[second:], radius) if second < len(node) else (np.empty(0, int), np.empty(0, int))
        j = j + second
    else:
        i, j = linked_pairs(fps, fps, radius)
    low = forest(len(node), i, j)
    moved = low != np.arange(len(node))
    return edges_of(node[moved], node[low[moved]])


def whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[int]]]:
    """Rows of whole blocks (key, x, y, ...) with the places where blocks begin, the end included."""
    held = None
    for batch in batches:
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        if batch.num_rows:
            cols = [np.asarray(batch.column(k)) for k in range(3)]
            cuts = [0, *(np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1).tolist()]
            if cuts[-1]:
                yield batch.slice(0, cuts[-1]), cuts
            held = batch.slice(cuts[-1])
    if held is not None:
        yield held, [0, held.num_rows]


@cache
def all_pairs(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(n, 1)


def candidates(batch: pa.RecordBatch, cuts: list[int], radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (i, j) of one block within the radius, of whole blocks (key, x, y, part, node, fp, keys); each pair of nodes
    comes once of all blocks, in that of the first key they share."""
    key, x, y, part = (np.asarray(batch.column(k)) for k in range(4))
    fps, keys = (np.asarray(batch.column(k).flatten()).reshape(batch.num_rows, -1) for k in (5, 6))
    fps = fps.view(np.uint64)

    def first(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        same = keys[i] == keys[j]
        kept = keys[i, same.argmax(1)] == key[i]
        return i[kept], j[kept]

    def together(small: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
        i, j = (np.concatenate([all_pairs(n)[side] + a for a, n in small]) for side in (0, 1))
        i, j = first(i, j)
        hit = pair_mask(fps[i], fps[j], radius) if len(i) else np.zeros(0, bool)
        return i[hit], j[hit]

    small, pairs = [], 0
    for a, b in zip(cuts, cuts[1:]):
        if b - a < 2:
            continue
        if x[a] == y[a] and b - a <= 32:
            small.append((a, b - a))
            pairs += (b - a) * (b - a - 1) // 2
            if pairs > 20_000:
                yield together(small)
                small, pairs = [], 0
        elif x[a] == y[a]:
            i, j = linked_pairs(fps[a:b], fps[a:b], radius)
            yield first(i[i < j] + a, j[i < j] + a)
        else:
            second = a + int(np.searchsorted(part[a:b], part[a], side="right"))
            if second < b:
                i, j = linked_pairs(fps[a:second], fps[second:b], radius)
                yield first(i + a, j + second)
    if small:
        yield together(small)


def similar(nodes: DataFrame, named_rows: DataFrame, radius: int, width: int, least: float, tile: int, seed: int = 42) -> DataFrame:
    """Edges (a, b) that connect the same nodes as all links of ``nodes`` (node long, low, fp, keys) that share a key, are
    within ``radius`` and whose different shingles have a Jaccard similarity of ``least`` or more.

    Fingerprints only choose what is compared. Nodes that are within the radius of another in a block meet there
    again with their shingle hashes, made from the texts of ``named_rows``, for the rows ``low`` of these nodes only; no pairs are
    shuffled. Pairs that confirmed links already connect in a block are not compared.
    """
    kept, own = dealt(nodes, tile), nodes.select("node", "fp", "keys")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, cuts in whole_blocks(batches):
            if found := [np.concatenate(x) for x in candidates(batch, cuts, radius)]:
                yield pa.RecordBatch.from_arrays([c.take(pa.array(np.unique(np.concatenate(found)))) for c in batch.columns[:5]], batch.schema.names[:5])

    blocks = kept.join(own, "node").where(F.array_contains("keys", F.col("key")))
    close = common.staged(in_blocks(blocks, "fp", "keys").mapInArrow(near, "key long, x int, y int, part int, node long"))

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [hashes_of(x.as_py(), width, seed, True) for x in batch.column(1)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64()))], ["node", "hashes"])

    first = nodes.join(close.select("node").distinct(), "node").select("node", *same_row(F.col("low.doc_id"), F.col("low.digest")))
    texts = named_rows.select("text", *same_row(F.col("doc_id"), F.col("digest"))).join(first, ROW).select("node", "text")
    # repeated rows give one set of hashes
    hashed = common.map_columns(texts, sets, "node long, hashes array<long>").groupBy("node").agg(F.first("hashes").alias("hashes"))
    hashed = common.staged(hashed)
    again = close.join(own.join(hashed, "node"), "node").where(F.array_contains("keys", F.col("key")))

    def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, cuts in whole_blocks(batches):
            node, values = np.asarray(batch.column(4)), np.asarray(batch.column(7).flatten())
            sizes = np.asarray(batch.column(7).value_lengths()).astype(int)
            ends, low = np.cumsum(sizes), list(range(len(node)))

            def root(k: int, low: list[int] = low) -> int:
                while low[k] != k:
                    low[k] = k = low[low[k]]
                return k

            for i, j in candidates(batch, cuts, radius):
                fits = np.minimum(sizes[i], sizes[j]) >= least * np.maximum(sizes[i], sizes[j]) - 1e-6
                for a, b in zip(i[fits].tolist(), j[fits].tolist()):
                    s, t = root(a), root(b)
                    if s != t:
                        both = len(np.intersect1d(values[ends[a] - sizes[a] : ends[a]], values[ends[b] - sizes[b] : ends[b]], assume_unique=True))
                        if both and both / (sizes[a] + sizes[b] - both) >= least:
                            low[max(s, t)] = min(s, t)
            roots = np.array([root(k) for k in range(len(node))], int)
            moved = roots != np.arange(len(node))
            yield edges_of(node[moved], node[roots[moved]])

    return in_blocks(again, "fp", "keys", "hashes").mapInArrow(confirmed, "a long, b long")


ROW = ["_id", "_none", "_digest"]


def same_row(doc_id: Column, digest: Column) -> list[Column]:
    """What rows are told apart by: doc_id, also null, and the MD5 of the text; columns ROW."""
    return [F.coalesce(doc_id, F.lit(0)).alias("_id"), doc_id.isNull().alias("_none"), digest.alias("_digest")]


def narrow(docs: DataFrame) -> DataFrame:
    """doc_id, text, digest."""
    text = docs["text"].cast("string")
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"), F.coalesce(F.md5(text), F.lit("")).alias("digest"))


def node_groups(docs: DataFrame, radius: int = 2, width: int = 3, lanes: int = 1, keys: Callable = pigeonhole_keys, distinct: bool = False, tile: int = 1024, least: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(a row per row of ``docs``: doc_id, digest, fp, keys; a row per node: fp, keys, component, and low, its first row by
    doc_id, null last, and text). Nodes are the different fingerprints, numbered, so rows without an id link what they are
    near to."""
    rows = narrow(docs)
    prints = common.staged(fingerprints(rows, width, lanes, keys=keys, distinct=distinct))

    def grouped() -> DataFrame:
        low = F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "digest")).alias("low")
        nodes = common.staged(prints.groupBy("fp", "keys").agg(low).withColumn("node", F.monotonically_increasing_id()))
        found = common.components(links(nodes, radius, tile) if least is None else similar(nodes, rows, radius, width, least, tile))
        return nodes.join(found, "node", "left").select("fp", "keys", "low", F.coalesce("component", "node").alias("component"))

    return prints, common.condensed(grouped)


def groups(docs: DataFrame, **how) -> DataFrame:
    """doc_id, fp array<long>, component_id: near-duplicate groups of all rows of ``docs`` (doc_id, text); ``how``: as for
    node_groups.

    Rows of one fingerprint are one node, so copies are never compared. component_id is the smallest doc_id reachable
    over links of ``radius`` or fewer differing bits; with ``least``, over those of them whose different shingles have a
    Jaccard similarity of ``least`` or more.

    Null and empty texts share the zero fingerprint and are linked like any other. Repeated rows are returned each. Rows
    of null doc_id get the component of what they reach, null only if nothing of it has an id. An empty table gives no
    rows. Extra columns are not read.
    """
    prints, nodes = node_groups(docs, **how)
    low = nodes.groupBy("component").agg(F.min("low.doc_id").alias("component_id"))
    named = common.staged(nodes.join(low, "component").select("fp", "keys", "component_id"))
    return prints.join(named, ["fp", "keys"]).select("doc_id", "fp", "component_id")


#: Five-word shingles at a similarity of 0.8, found by fingerprints and confirmed on the shingles. Of long texts at 0.8, 15 %
#: of bits differ; of all texts at 0.8 or more, those of 4 and 5 shingles differ most, in 3 of 16: 192 of 1024 with a
#: deviation of 12.5. The radius is 4.6 deviations above.
SIMILAR = {"radius": 250, "width": 5, "lanes": 16, "keys": shared_keys(8), "distinct": True, "tile": 512, "least": 0.8}


def first_of_groups(docs: DataFrame, **how) -> DataFrame:
    """``docs`` (doc_id, text and others) with one row of each near-duplicate group of groups(**how): the first by doc_id,
    null last, then by the MD5 of its text.

    Rows are told apart by doc_id and text, so null and repeated ids do no harm: of rows equal in both, one stays. Texts
    are shuffled once, for the join with the rows that stay.
    """

    def winners() -> DataFrame:
        prints, nodes = node_groups(docs, **how)
        return nodes.groupBy("component").agg(F.min("low").alias("low")).select(*same_row(F.col("low.doc_id"), F.col("low.digest")))

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    own = same_row(docs["doc_id"].cast("long"), F.coalesce(F.md5(docs["text"].cast("string")), F.lit("")))
    return docs.select(row, *own).join(common.condensed(winners), ROW, "left_semi").dropDuplicates(ROW).select("_row.*")

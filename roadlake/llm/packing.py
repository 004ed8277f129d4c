"""Best-fit packing of tokenized documents into sequences (bounded-space online best fit)."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class Encoder:
    """Token ids as little-endian unsigned 32-bit bytes.

    Texts are cut before single spaces and the ids of pieces of up to ``longest`` characters are kept in a dictionary of at
    most ``kept`` entries, so its bytes are bounded, also for texts without spaces. Only a token with
    a space after its first byte can span such a cut: texts that hold one's bytes, neighbouring spaces or a special
    token's string take the tokenizer's whole path.
    """

    def __init__(self, path: str, kept: int = 400_000, longest: int = 64):
        from tokenizers import Tokenizer

        self.full, self.kept, self.longest, self.ids, self.fast = Tokenizer.from_file(path), kept, longest, {}, None
        if path.endswith("byte_bpe_50k.json"):
            import public_tokenizers
            import tiktoken

            with open(path[: -len("json")] + "tiktoken", "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.spanning = spanning(ranks)
            self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def spans(self, text: str) -> bool:
        whole, cut = self.spanning
        if any(x in text for x in whole):
            return True
        raw = text.encode() if cut else b""
        return any(x in raw for x in cut)

    def __call__(self, text: str) -> bytes:
        if self.fast is None or "  " in text or "<|endoftext|>" in text or self.spans(text):
            return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        first, *rest = text.split(" ")
        parts = ([first] if first else []) + [" " + x for x in rest]
        ids = self.ids
        try:
            return b"".join([ids[x] for x in parts])
        except KeyError:
            return b"".join([ids[x] if x in ids else self.piece(x) for x in parts])

    def piece(self, text: str) -> bytes:
        found = np.array(self.fast.encode_ordinary(text), "<u4").tobytes()
        if len(text) <= self.longest:
            if len(self.ids) >= self.kept:
                self.ids.clear()
            self.ids[text] = found
        return found


def spanning(tokens: Iterable[bytes]) -> tuple[list[str], list[bytes]]:
    """The shortest strings, and bytes that are no whole characters, of which every token with a space after its first
    byte and without neighbouring spaces holds one."""
    found: list[bytes] = []
    for token in sorted((x for x in tokens if b" " in x[1:] and b"  " not in x), key=len):
        if not any(x in token for x in found):
            found.append(token)
    text = [x for x in found if x.decode(errors="ignore").encode() == x]
    return [x.decode() for x in text], [x for x in found if x not in text]


class Bins:
    """Open bins in a bitset keyed by free space: bit f is set while a bin with f free tokens is open.

    ``place`` takes the open bin with the least free space that still fits (best fit), else opens one; with
    ``most`` bins open, the fullest is closed first. A full bin closes itself.
    """

    def __init__(self, size: int, most: int):
        self.size, self.most, self.bits, self.open, self.made = size, most, 0, 0, 0
        self.at: list[list[int]] = [[] for _ in range(size + 1)]

    def _take(self, free: int) -> int:
        found = self.at[free].pop()
        if not self.at[free]:
            self.bits &= ~(1 << free)
        self.open -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset in it)."""
        if fits := self.bits >> length:
            free = length + (fits & -fits).bit_length() - 1
            found = self._take(free)
        else:
            if self.open >= self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
            free, found, self.made = self.size, self.made, self.made + 1
        if left := free - length:
            self.at[left].append(found)
            self.bits |= 1 << left
            self.open += 1
        return found, self.size - free


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, open_bins: int = 256, window: int = 1024) -> DataFrame:
    """One row per piece of every row of ``docs`` (doc_id, text): see SCHEMA.

    A document is its ids and then id 0. Documents longer than ``size`` are cut into pieces of ``size`` tokens, of
    which the first may be shorter; full pieces are sequences of their own. All other pieces go to the bounded-space
    best fit of ``open_bins`` bins. A task packs what its partition holds and no row is shuffled: pieces (numbers only, no
    texts or ids) wait for ``window`` others and are placed longest first, so that short pieces fill what long ones
    leave; bins stay open across windows. Sequence ids are unique because they hold the partition's number; a
    repeated task gives the same rows.

    Null text counts as empty: one token. An empty table gives no rows. Repeated rows are packed each. Null doc_id
    stays null. Extra columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = Encoder(tokenizer), TaskContext.get().partitionId() << 33
        bins, held = Bins(size, open_bins), []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "") + b"\0\0\0\0"
                n, start, piece = len(ids) // 4, 0, 0
                while start < n:
                    stop = min(n, start + ((n - start) % size or size))
                    held.append((stop - start, doc_id, piece, start, zlib.crc32(ids[4 * start : 4 * stop])))
                    start, piece = stop, piece + 1
                while len(held) >= window:
                    yield from placed(bins, held[:window], part)
                    held = held[window:]
        yield from placed(bins, held, part)

    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(run, SCHEMA)


def placed(bins: Bins, held: list[tuple], part: int) -> Iterator[pa.RecordBatch]:
    """Places the pieces (length, doc_id, piece, start, crc), longest first."""
    held.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0, x[2]))
    for at in range(0, len(held), 20_000):
        rows = held[at : at + 20_000]
        where = [bins.place(x[0]) for x in rows]
        columns = ([x[1] for x in rows], pa.array([x[2] for x in rows], pa.int32()), [x[3] for x in rows], [x[0] for x in rows], [x[4] for x in rows], [part + b for b, _ in where], [o for _, o in where])
        yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, pa.int64()) for x in columns], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

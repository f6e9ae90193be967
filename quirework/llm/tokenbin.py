"""Token ids in patched frame-of-reference blocks.

A block holds 128 values: their minimum is subtracted, the rest is packed at the width that 90 % of the block's values
fit in, and what doesn't fit keeps its low bits there and its whole value in the exception list. An index says where
each block starts, so any block can be read alone.

A token file is a Parquet table of segments, so that Spark's committer writes and recovers it: part, before (ids in the
part before the segment), doc_ids, tokens (n of the segment), lengths and ids (coded as above). Parts are ranges of
ascending doc_id.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirework.llm.common import cached, prepare, renamed, slices

MAGIC = b"PFR1"
BLOCK = 128
#: Share of a block's values that fit in its width.
SHARE = 0.9
#: A segment is closed when it has so many ids; a document is never split.
SEGMENT = 1 << 20
#: Bytes that a task may spend on remembered units, and the bytes of the longest unit that it remembers.
REMEMBERED, UNIT = 64 << 20, 64
#: Characters of text that are cut and looked up together.
TOGETHER = 1 << 22

SCHEMA = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("before", T.LongType()), T.StructField("tokens", T.LongType()), T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("lengths", T.BinaryType()), T.StructField("ids", T.BinaryType())])


def encode(values: np.ndarray) -> bytes:
    """Unsigned 32-bit values as patched frame-of-reference blocks."""
    values = np.ascontiguousarray(values, "<u4")
    n = len(values)
    blocks = -(-n // BLOCK)
    full = np.concatenate((values, np.full(blocks * BLOCK - n, values[-1] if n else 0, "<u4"))).reshape(blocks, BLOCK)
    least = full.min(axis=1) if n else np.empty(0, "<u4")
    rest = full - least[:, None]
    rank = int(np.ceil(SHARE * BLOCK)) - 1
    widths = np.ceil(np.log2(np.partition(rest, rank, axis=1)[:, rank].astype(np.float64) + 1)).astype(np.uint8) if n else np.empty(0, np.uint8)
    odd = (rest >> np.minimum(widths, 31)[:, None].astype(np.uint32) > 0) & (widths < 32)[:, None]
    starts = np.concatenate(([0], np.cumsum(widths.astype(np.uint32) * (BLOCK // 8)))).astype("<u4")
    packed = np.zeros(int(starts[-1]), np.uint8)
    for width in np.unique(widths[widths > 0]).tolist():
        at = np.flatnonzero(widths == width)
        lanes = rest[at].astype("<u2" if width <= 16 else "<u4")
        bits = np.unpackbits(lanes.view(np.uint8).reshape(len(at), BLOCK, -1), axis=2, bitorder="little", count=width)
        rows = np.packbits(bits.reshape(len(at), -1), axis=1, bitorder="little")
        packed[starts[at][:, None] + np.arange(width * BLOCK // 8)] = rows
    where, slot = np.nonzero(odd)
    first = np.concatenate(([0], np.cumsum(odd.sum(axis=1)))).astype("<u4")
    return b"".join([MAGIC, struct.pack("<III", n, blocks, len(where)), least.astype("<u4").tobytes(), widths.tobytes(), starts.tobytes(), first.tobytes(), slot.astype(np.uint8).tobytes(), rest[where, slot].astype("<u4").tobytes(), packed.tobytes()])


class Blocks:
    """Reads what encode() wrote, whole or block by block."""

    def __init__(self, raw: bytes):
        if raw[:4] != MAGIC:
            raise ValueError("not a patched frame-of-reference section")
        self.n, self.blocks, odd = struct.unpack_from("<III", raw, 4)
        at = 16

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, count, at)
            at += out.nbytes
            return out

        self.least, self.widths = take("<u4", self.blocks), take("u1", self.blocks)
        self.starts, self.first = take("<u4", self.blocks + 1), take("<u4", self.blocks + 1)
        self.slot, self.value = take("u1", odd), take("<u4", odd)
        self.packed = take("u1", int(self.starts[-1]))

    def _rows(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros((len(at), BLOCK), np.uint32)
        for width in np.unique(self.widths[at]).tolist():
            if width:
                own = np.flatnonzero(self.widths[at] == width)
                raw = self.packed[self.starts[at[own]][:, None] + np.arange(width * BLOCK // 8, dtype=np.uint32)]
                bits = np.zeros((len(own), BLOCK, 16 if width <= 16 else 32), np.uint8)
                bits[:, :, :width] = np.unpackbits(raw, axis=1, bitorder="little").reshape(len(own), BLOCK, width)
                out[own] = np.packbits(bits, axis=2, bitorder="little").view("<u2" if width <= 16 else "<u4")[:, :, 0]
        return out

    def block(self, k: int) -> np.ndarray:
        """One block, found through the index."""
        out = self._rows(np.array([k]))[0]
        a, b = int(self.first[k]), int(self.first[k + 1])
        out[self.slot[a:b]] = self.value[a:b]
        return (out + self.least[k])[: self.n - k * BLOCK]

    def all(self) -> np.ndarray:
        out = self._rows(np.arange(self.blocks))
        out[np.repeat(np.arange(self.blocks), np.diff(self.first)), self.slot] = self.value
        return (out + self.least[:, None]).reshape(-1)[: self.n]


#: What an ordinary text does not have: white space in runs, at an edge or other than spaces and line feeds; and NUL.
ODD = "  | \n|\n |\n\n|^[ \n]|[ \n]$|[\\x00\t\r\x0b\x0c\x1c-\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
#: Marks that such a tokenizer keeps apart from a letter before them.
STOPS = ".,;:!?"
LETTER = np.isin(np.arange(256), list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"))
BETWEEN = re.compile(r"(?<=\S) (?=\S)")
_RANDOM = np.random.default_rng(8).integers(0, 1 << 64, (UNIT, 256), np.uint64)


def _hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit tabulation hashes of byte strings of UNIT bytes at most; 0 for empty ones."""
    out = np.zeros(len(starts), np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        size = sizes[some]
        ends = np.cumsum(size)
        place = _runs(np.zeros(len(size), np.int64), size)
        out[some] = np.add.reduceat(_RANDOM[place, data[np.repeat(starts[some], size) + place]], ends - size)
    return out


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Each start and the numbers after it, as many as its size says."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class Encoder:
    """Texts to ids by a byte-level BPE tokenizer that splits words before single spaces.

    A text is cut before each single space, and around each single line feed, between two non-spaces, and between an
    ASCII letter and one stop at a unit's end: such a tokenizer always ends a word there. The distinct units of some texts are
    looked up together. The ids of a unit are the library's, asked for once; units of UNIT bytes or fewer are remembered, by a
    64-bit hash, until that takes REMEMBERED bytes. Texts with the strings of added tokens, or NULs, go to the library whole.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        #: The id of each stop that is one token.
        self.stops = np.zeros(256, np.uint32)
        for stop, found in zip(STOPS, self._ask(list(STOPS)), strict=True):
            self.stops[ord(stop)] = found[0] if len(found) == 1 else 0
        self._forget()

    def _forget(self) -> None:
        self.keys, self.slots = np.empty(0, np.uint64), np.empty(0, np.uint32)
        self.starts, self.pool, self.used = np.zeros(1, np.uint32), np.empty(0, np.uint32), 0

    def _ask(self, units: list[str]) -> list[list[int]]:
        """The library's ids of each unit."""
        return [x.ids for x in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)] if units else []

    def _split(self, texts: pa.Array) -> pa.ListArray:
        odd = pc.match_substring_regex(texts, ODD)
        cut = pc.replace_substring(pc.replace_substring(texts, " ", "\0 "), "\n", "\0\n\0")
        if pc.any(odd).as_py():
            cut = pc.replace_with_mask(cut, odd, pa.array(["\0 ".join(BETWEEN.split(t)) for t in texts.filter(odd).to_pylist()], cut.type))
        return pc.split_pattern(cut, "\0")

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each unit; -1 if it is not known."""
        slots = np.full(len(hashes), -1, np.int64)
        if len(self.keys):
            near = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
            held = self.keys[near] == hashes
            slots[held] = self.slots[near[held]]
        return slots

    def _store(self, hashes: np.ndarray, ids: list[list[int]]) -> None:
        """Remembers units, all new, by their hashes."""
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        more = self.used + int(sizes.sum())
        if more > len(self.pool):
            self.pool = np.concatenate((self.pool[: self.used], np.empty(more + (more >> 2) - self.used, np.uint32)))
        self.pool[self.used : more] = np.fromiter(chain.from_iterable(ids), np.uint32, more - self.used)
        order = np.argsort(hashes)
        at = np.searchsorted(self.keys, hashes[order])
        self.keys = np.insert(self.keys, at, hashes[order])
        self.slots = np.insert(self.slots, at, (len(self.starts) - 1 + order).astype(np.uint32))
        self.starts = np.concatenate((self.starts, (self.used + np.cumsum(sizes)).astype(np.uint32)))
        self.used = more

    def _units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pool, start, size): where the ids of each of these distinct units stand."""
        if self.keys.nbytes + self.slots.nbytes + self.starts.nbytes + self.pool.nbytes > REMEMBERED:
            self._forget()
            pa.default_memory_pool().release_unused()
        ends = np.frombuffer(units.buffers()[1], np.int64, len(units) + 1, units.offset * 8)
        raw = units.buffers()[2]
        data, sizes = np.frombuffer(raw if raw and raw.size else b"\0", np.uint8), np.diff(ends)
        hashes = _hashes(data, ends[:-1], np.where(sizes <= UNIT, sizes, 0))
        last, before = data[np.maximum(ends[1:] - 1, 0)], data[np.maximum(ends[1:] - 2, 0)]
        ended = np.flatnonzero((sizes > 1) & (sizes <= UNIT) & (self.stops[last] > 0) & LETTER[before])
        hashes[ended] -= _RANDOM[sizes[ended] - 1, last[ended]]  # now of the unit without its stop
        slots = self._find(hashes)
        fresh = np.flatnonzero((slots < 0) & (hashes != 0))
        if len(fresh):
            keys, first = np.unique(hashes[fresh], return_index=True)
            cut = np.isin(fresh[first], ended).tolist()
            self._store(keys, self._ask([u[:-1] if c else u for u, c in zip(units.take(pa.array(fresh[first])).to_pylist(), cut, strict=True)]))
            slots[fresh] = self._find(hashes[fresh])
        starts = self.starts.astype(np.int64)
        start, size = starts[slots], starts[slots + 1] - starts[slots]
        more = [np.empty(0, np.uint32)]
        if len(ended):
            to = np.cumsum(size[ended] + 1)
            own = np.empty(to[-1], np.uint32)
            own[to - 1] = self.stops[last[ended]]
            rest = np.ones(to[-1], bool)
            rest[to - 1] = False
            own[rest] = self.pool[_runs(start[ended], size[ended])]
            size[ended] += 1
            start[ended] = len(self.pool) + to - size[ended]
            more.append(own)
        long = np.flatnonzero(hashes == 0)
        if len(long):  # and the empty unit
            own = self._ask(units.take(pa.array(long)).to_pylist())
            size[long] = [len(x) for x in own]
            start[long] = len(self.pool) + sum(map(len, more)) + np.cumsum(size[long]) - size[long]
            more.append(np.fromiter(chain.from_iterable(own), np.uint32))
        return np.concatenate((self.pool, *more)), start, size

    def _some(self, texts: list[str]) -> list[np.ndarray]:
        parts = self._split(pa.array(texts, pa.large_string()))
        flat = parts.flatten().dictionary_encode()
        pool, start, size = self._units(flat.dictionary)
        which = flat.indices.to_numpy()
        sizes = size[which]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        ids = pool[_runs(start[which], sizes)]
        borders = ends[parts.offsets.to_numpy()]
        return [ids[a:b] for a, b in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        return list(self._encoded(texts))

    def _encoded(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Some texts at a time. A long text goes in pieces, cut where units are."""
        held: list[str] = []
        count: list[int] = []

        def done() -> Iterator[np.ndarray]:
            found = iter(self._some(held))
            for n in count:
                yield np.concatenate([next(found) for _ in range(n)]) if n != 1 else next(found)
            held.clear()
            count.clear()

        size = 0
        for text in texts:
            if "\0" in text or self.added and self.added.search(text):
                if held:
                    yield from done()
                    size = 0
                yield np.array(self._ask([text])[0], np.uint32)
                continue
            pieces = _pieces(text)
            held += pieces
            count.append(len(pieces))
            size += len(text)
            if size >= TOGETHER:
                yield from done()
                size = 0
        if held:
            yield from done()


def _pieces(text: str) -> list[str]:
    """A text in pieces of about TOGETHER characters, cut before single spaces between non-spaces."""
    out, at = [], 0
    while len(text) - at > TOGETHER:
        found = BETWEEN.search(text, at + TOGETHER)
        if not found:
            break
        out.append(text[at : found.start()])
        at = found.start()
    return [*out, text[at:]]


def encoder(spec: str) -> Encoder:
    """One a worker, kept from task to task; it holds no more than REMEMBERED bytes of units."""
    return cached(("encoder", hash(spec)), lambda: Encoder(spec))


def _segments(shared, segment: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        coder, part, before = encoder(shared.value), TaskContext.get().partitionId(), 0
        names: list[int | None] = []
        coded: list[np.ndarray] = []
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal names, coded, size, before
            lengths = np.array([len(c) + 1 for c in coded], np.int64)
            ids = np.zeros(size, "<u4")  # the end ids are zero
            keep = np.ones(size, bool)
            keep[np.cumsum(lengths) - 1] = False
            ids[keep] = np.concatenate(coded)
            columns = [pa.array([part], pa.int32()), pa.array([before], pa.int64()), pa.array([size], pa.int64()), pa.array([names], pa.list_(pa.int64())), pa.array([encode(lengths)], pa.binary()), pa.array([encode(ids)], pa.binary())]
            before += size
            names, coded, size = [], [], 0
            return pa.RecordBatch.from_arrays(columns, SCHEMA.names)

        for batch in slices(batches, 2000):
            texts = [x or "" for x in batch.column(1).to_pylist()]
            for name, ids in zip(batch.column(0).to_pylist(), coder.encode(texts), strict=True):
                names.append(name)
                coded.append(ids)
                size += len(ids) + 1
                if size >= segment:
                    yield close()
        if names:
            yield close()

    return run


def write(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", segment: int = SEGMENT) -> None:
    """Writes the ids of each text and then id 0, by ascending doc_id, as a token file at path.

    tokenizer is the path of a byte-level BPE's JSON file on the driver. Null and empty texts have the end id only.
    Null ids come first and stay null. Repeated rows are each written; rows of one doc_id stand in the order of their
    texts' hashes, by which they are dealt too, so that no id, null least of all, fills one task. Other columns are not looked at. No rows: no segments.
    """
    spark = docs.sparkSession
    prepare(spark)
    with open(tokenizer, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())
    rows = renamed(docs, {"doc_id": doc_id, "body": text}).select(F.col("doc_id").cast("long").alias("doc_id"), "body")
    rows = rows.withColumn("mark", F.xxhash64("body"))
    dealt = rows.repartitionByRange("doc_id", "mark").sortWithinPartitions("doc_id", "mark").drop("mark")
    dealt.mapInArrow(_segments(shared, segment), SCHEMA).write.parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            lengths, raw = Blocks(row["lengths"]).all().astype(np.int64), Blocks(row["ids"]).all().astype("<u4").tobytes()
            starts = np.concatenate(([0], np.cumsum(lengths)))
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
            n = len(lengths)
            columns = [pa.array([row["part"]] * n, pa.int32()), pa.array(row["doc_ids"], pa.int64()), pa.array(row["before"] + starts[:-1]), pa.array(lengths), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["part", "doc_id", "start", "n_tokens", "ids_crc32"])


def documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document of a token file, in no order. start counts the ids of all
    documents before it. What parts hold is summed on the driver: one number for each part."""
    prepare(spark)
    file = spark.read.schema(SCHEMA).parquet(path)
    sums = sorted(tuple(r) for r in file.groupBy("part").agg(F.sum("tokens")).collect())
    base = spark.createDataFrame([(p, b) for (p, _), b in zip(sums, accumulate([0, *[n for _, n in sums]]), strict=False)], "part int, base long")
    rows = file.mapInArrow(_documents, "part int, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    return rows.join(F.broadcast(base), "part").select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")

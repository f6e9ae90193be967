"""Substring dedup by content-defined chunking.

A gear hash rolls over a text's bytes: h = 2 h + G[byte], so its upper bits depend on the last 32 bytes only. A chunk
ends after white space where the three upper bits are zero, after about 8 words. The places follow the content: an
insertion moves the cuts near it and no others. Equal chunks are found by digest; of each, the first in the order of
(doc_id, place) stays. passages() needs no whole chunk: its anchors are places of the least gear hash near them, and what
meets there is extended byte by byte.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quirework.llm.common import bytes_of, drop_table, prepare, renamed, slices, table

#: Upper bits of the hash that are zero at a cut: one white space in 2 ** BITS ends a chunk.
BITS = 3
#: A chunk of more bytes is cut regardless.
LONGEST = 4096
#: Bytes whose hash is rolled at once; the 32 before them are rolled again.
STRETCH = 1 << 20

#: Of so many byte positions in a row, the one of the least gear hash is an anchor.
WINDOW = 64
#: Bytes on either side of a match's places, besides the 31 + WINDOW in which another place must follow, that are compared.
MARGIN = 256
#: The number of a row in remove().
ROW = "cdc__row"
#: What is known of a text's places before its bytes are compared.
FOUND = "row bigint, from bigint, far bigint, first_doc_id bigint, found array<bigint>"
#: Words of a span: an ideograph or kana, four letters of a script without spaces, or a run between white space.
_ALONE, _FOUR = "\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff", "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff"
WORDS = re.compile(f"[{_ALONE}]|[{_FOUR}]{{1,4}}|[^\\s{_ALONE}{_FOUR}]+")

GEAR = np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=4, key=b"gear").digest(), "little") for b in range(256)], np.uint32)
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def rolled(data: np.ndarray) -> np.ndarray:
    """The gear hash after each byte, from the 32 bytes that end there, by doubling: sums over 1, 2, 4 ... 32 bytes."""
    h, reach = GEAR[data], 1
    while reach < 32:
        longer = h.copy()
        longer[reach:] += h[:-reach] << np.uint32(reach)
        h, reach = longer, reach * 2
    return h


def cuts(raw: bytes) -> list[int]:
    """Ends of a text's chunks; the last is its length. None for an empty text."""
    data = np.frombuffer(raw, np.uint8)
    ends = []
    for at in range(0, len(data), STRETCH):
        lead = min(at, 31)
        part = data[at - lead : at + STRETCH]
        ends.append(np.flatnonzero((rolled(part) >> np.uint32(32 - BITS) == 0)[lead:] & SPACE[part[lead:]]) + at + 1)
    found = np.unique(np.concatenate([*ends, [len(data)]])).astype(np.int64) if len(data) else np.empty(0, np.int64)
    gaps = np.diff(found, prepend=0)
    if len(gaps) and gaps.max() > LONGEST:
        found = np.unique(np.concatenate([np.append(np.arange(end - gap + LONGEST, end, LONGEST), end) for end, gap in zip(found, gaps, strict=True)]))
    return found.tolist()


def chunks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, no, start, size, words, hi, lo): the chunks of each text, by byte offsets, with their 128-bit digests."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, nos, starts, sizes, words, digests = [], [], [], [], [], []
            for name, raw in zip(batch.column(0).to_pylist(), bytes_of(batch, "body"), strict=True):
                ends = cuts(raw)
                begins = [0, *ends][:-1]
                parts = [raw[a:b] for a, b in zip(begins, ends, strict=True)]
                ids += [name] * len(ends)
                nos += range(len(ends))
                starts += begins
                sizes += map(len, parts)
                words += [len(p.split()) for p in parts]
                digests += [hashlib.blake2b(p, digest_size=16).digest() for p in parts]
            two = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            columns = [pa.array(ids, pa.int64()), pa.array(nos, pa.int32()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int32()), pa.array(words, pa.int32()), pa.array(two[:, 0].copy()), pa.array(two[:, 1].copy())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "no", "start", "size", "words", "hi", "lo"])

    rows = renamed(docs, {"doc_id": doc_id, "body": text}).select(F.col("doc_id").cast("long").alias("doc_id"), "body")
    return rows.mapInArrow(run, "doc_id bigint, no int, start bigint, size int, words int, hi bigint, lo bigint")


def repeats(docs: DataFrame, min_words: int = 20, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, end, words, chunks, first_doc_id): byte spans of texts that repeat what stands earlier.

    A chunk repeats if its digest stands before, in the order of (doc_id, place); a span is a run of adjacent chunks
    that repeat, of min_words words or more, so that no short phrase counts. first_doc_id is the document in which most
    of the span's chunks stand first, the smaller of several. A passage of over 50 words that repeats holds such a run, less a partial chunk
    at either end. Copies of a whole text are one span. Null ids stand before all others; rows of one id are told
    apart by nothing but their place, so repeated rows repeat each other's chunks only if their places differ.
    Null and empty texts have no chunks. Other columns are not looked at. Nothing is dropped to escape a frequent chunk:
    its rows meet its first place in a join that is split where it is skewed.
    """
    all_chunks = table(chunks(docs, doc_id, text), "cdc-chunks")
    place = F.struct("doc_id", "no")
    first = table(all_chunks.groupBy("hi", "lo").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").select("hi", "lo", "first"), "cdc-first")
    later = all_chunks.join(first, ["hi", "lo"]).where(F.struct("doc_id", "no") > F.col("first"))
    own = W.partitionBy("doc_id").orderBy("no")
    runs = later.withColumn("run", F.col("no") - F.row_number().over(own)).groupBy("doc_id", "run")
    spans = runs.agg(F.min("start").alias("start"), F.max(F.col("start") + F.col("size")).alias("end"), F.sum("words").alias("words"), F.count("*").alias("chunks"), F.mode("first.doc_id", True).alias("first_doc_id"))
    return spans.where(F.col("words") >= min_words).drop("run")


def anchors(raw: bytes) -> np.ndarray:
    """Last bytes of the 32-byte windows that stand for a text: of each WINDOW positions, the least gear hash.

    A run of 31 + WINDOW bytes or more, wherever it stands, holds an anchor that its copies have too. It needs no white space."""
    data, found = np.frombuffer(raw, np.uint8), []
    for at in range(0, max(0, len(data) - 31), STRETCH):
        part = data[at : at + STRETCH + 31 + WINDOW]
        hashes = rolled(part)[31:]
        key = hashes.astype(np.uint64) << np.uint64(32) | np.arange(len(hashes), dtype=np.uint64)
        reach = 1
        while reach < WINDOW and len(key) > reach:
            key, reach = np.minimum(key[:-reach], key[reach:]), reach * 2
        key = key if reach >= WINDOW else key.min(keepdims=True)
        place = np.unique((key & np.uint64(0xFFFFFFFF)).astype(np.int64))
        # Where equal windows follow one another, as in "aaaa", one in each WINDOW / 2 positions is enough.
        fresh = np.concatenate(([True], hashes[place[1:]] != hashes[place[:-1]]))
        step = (place - place[np.maximum.accumulate(np.where(fresh, np.arange(len(place)), 0))]) // (WINDOW // 2)
        found.append(place[fresh | np.concatenate(([True], step[1:] != step[:-1]))] + at + 31)
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)


def _same(a: np.ndarray, b: np.ndarray) -> int:
    """How many bytes two texts begin with alike."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        other = np.flatnonzero(a[at : min(n, at + step)] != b[at : min(n, at + step)])
        if len(other):
            return at + int(other[0])
        at, step = at + step, step * 2
    return n


def _groups(margin: int):
    """Of rows (row, places): places that lie near each other and as far from the same earlier text's, as FOUND."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[tuple] = []
            for row, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                last: list = []
                for earlier, far, at, first in sorted(((p["from"], p["pos"] - p["was"], p["pos"], p["first_doc_id"]) for p in places), key=lambda x: x[:3]):
                    if last[:2] == [earlier, far] and at - last[2][-1] <= 2 * margin:
                        last[2].append(at)
                    else:
                        last = [earlier, far, [at]]
                        out.append((row, earlier, far, first, last[2]))
            types = [pa.int64()] * 4 + [pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate(types)], ["row", "from", "far", "first_doc_id", "found"])

    return run


def _compared(min_words: int):
    """Of rows (doc_id, body, groups): the spans that repeat."""

    def whole(raw: bytes, group: dict) -> Iterator[tuple[int, int, int | None]]:
        a, b, away, reached = np.frombuffer(raw, np.uint8), np.frombuffer(group["part"], np.uint8), group["far"] + group["low"], -1
        for pos in group["found"]:
            was = pos - away
            if pos >= reached and raw[pos - 31 : pos + 1] == group["part"][was - 31 : was + 1]:
                reached = pos + _same(a[pos:], b[was:])
                yield pos + 1 - _same(a[pos::-1], b[was::-1]), reached, group["first_doc_id"]

    def merged(raw: bytes, parts: Iterable[tuple[int, int, int | None]]) -> Iterator[tuple]:
        spans: list[list] = []
        for start, end, first in sorted(parts, key=lambda p: p[:2]):
            if spans and start <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], end)
            else:
                spans.append([start, end, 0, Counter()])
            spans[-1][2] += 1
            spans[-1][3][first] += end - start
        for start, end, n, firsts in spans:
            while start < end and raw[start] & 0xC0 == 0x80:  # whole characters only
                start += 1
            while start < end < len(raw) and raw[end] & 0xC0 == 0x80:
                end -= 1
            words = len(WORDS.findall(raw[start:end].decode("utf-8", "replace")))
            if words >= min_words:
                yield start, end, words, n, min(firsts, key=lambda x: (-firsts[x], x is not None, x or 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 100):
            out = [(name, *span) for name, raw, groups in zip(batch.column(0).to_pylist(), bytes_of(batch, "body"), batch.column(2).to_pylist(), strict=True) for span in merged(raw, (x for g in groups for x in whole(raw, g)))]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(6)], ["doc_id", "start", "end", "words", "chunks", "first_doc_id"])

    return run


def passages(docs: DataFrame, min_words: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, end, words, chunks, first_doc_id): like repeats(), but each match is extended byte by byte.

    Each anchor of a text meets the first place of its 32 bytes, in the order of (doc_id, row, place), and the match is
    extended to left and right as far as both texts agree. Matches that touch are one span, `chunks` is how many; only
    then min_words counts, in words of WORDS. first_doc_id is the document of most matched bytes. What repeats on
    95 bytes or more holds an anchor, so over 50 words always do. Rows are told apart by number, so ids may repeat or be
    null; a null id stands before all others. Null and empty texts repeat nothing. Other columns are not looked at.

    Texts are never joined to texts: of an earlier text, what lies around the places is cut out first. A match is
    extended 95 + MARGIN bytes beyond its places at most. It would go on further only past other places whose first place
    stands in yet another text, and those are matches of their own that touch it. As each place is compared with its first
    place only, what agrees longer with a later one may lack under WINDOW bytes at an edge.
    """
    prepare(docs.sparkSession)
    rows = table(renamed(docs, {"doc_id": doc_id, "body": text}).select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "body").where("body is not null"), "cdc-rows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [(raw, anchors(raw)) for raw in bytes_of(batch, "body")]
            of = np.repeat(np.arange(len(found)), [len(x) for _, x in found])
            digests = [xxhash.xxh3_64_intdigest(raw[at - 31 : at + 1]) for raw, places in found for at in places.tolist()]
            place = np.concatenate([np.empty(0, np.int64), *(x for _, x in found)])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of)), batch.column(1).take(pa.array(of)), pa.array(place), pa.array(np.array(digests, np.uint64).view(np.int64))], ["row", "doc_id", "pos", "hash"])

    marks = table(rows.mapInArrow(run, "row bigint, doc_id bigint, pos bigint, hash bigint"), "cdc-anchors")
    often = table(marks.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "cdc-often")
    shared = table(marks.join(often, "hash"), "cdc-shared")
    drop_table(marks)
    drop_table(often)
    at = F.struct("doc_id", "row", "pos")
    first = table(shared.groupBy("hash").agg(F.min(at).alias("first")), "cdc-first")
    later = shared.join(first, "hash").where(at > F.col("first"))
    places = later.groupBy("row").agg(F.collect_list(F.struct("pos", F.col("first.row").alias("from"), F.col("first.pos").alias("was"), F.col("first.doc_id").alias("first_doc_id"))).alias("places"))
    groups = table(places.mapInArrow(_groups(MARGIN), FOUND), "cdc-groups")
    drop_table(shared)
    drop_table(first)
    margin = MARGIN + 31 + WINDOW
    low = F.greatest(F.lit(0), F.element_at("found", 1) - F.col("far") - 31 - margin)
    asked = groups.withColumn("low", low).withColumn("high", F.element_at("found", -1) - F.col("far") + 1 + margin)
    part = F.substr(F.col("body").cast("binary"), (F.col("low") + 1).cast("int"), (F.col("high") - F.col("low")).cast("int"))
    cut = asked.join(rows.select(F.col("row").alias("from"), "body"), "from").select("row", F.struct("far", "first_doc_id", "found", "low", part.alias("part")).alias("group"))
    met = cut.groupBy("row").agg(F.collect_list("group").alias("groups")).join(rows, "row").select("doc_id", "body", "groups")
    return met.mapInArrow(_compared(min_words), "doc_id bigint, start bigint, end bigint, words bigint, chunks bigint, first_doc_id bigint")


def remove(docs: DataFrame, min_words: int = 50, text: str = "text") -> DataFrame:
    """docs less the spans that passages() finds; all rows and columns stay. Rows are told apart by number, so ids play no part:
    what stands first in the table stays, and of repeated rows the first keeps its text. Null texts stay null."""
    rows = table(docs.withColumn(ROW, F.monotonically_increasing_id()), "cdc-numbered")
    spans = passages(rows, min_words, ROW, text).groupBy(F.col("doc_id").alias(ROW)).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cdc__spans"))
    joined = rows.join(spans, ROW, "left")
    names, at = docs.columns, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            gone = batch.column(batch.num_columns - 1).to_pylist()
            out = []
            for raw, spans in zip(batch.column(at).cast(pa.binary()).to_pylist(), gone, strict=True):
                if raw is not None and spans:
                    kept, last = [], 0
                    for s in spans:
                        kept.append(raw[last : s["start"]])
                        last = s["end"]
                    raw = b"".join([*kept, raw[last:]])
                out.append(raw)
            columns = batch.columns[: len(names)]
            columns[at] = pa.array(out, pa.binary()).cast(batch.column(at).type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return joined.select(*[rows[f"`{c}`"] for c in docs.columns], "cdc__spans").mapInArrow(run, docs.schema)

"""SimHash near-duplicates through a segment-popcount embedding.

A 64-bit fingerprint becomes 16 segments of 4 bits, and each segment its number of set bits: a point of a 16-dimensional
grid. Points of two fingerprints are at most as far apart, under Manhattan distance, as the fingerprints are under
Hamming distance, so a range-join on the grid loses no pair. Each point is put into all cells within half the radius;
two points within the radius meet in a cell between them. What meets in a cell is then compared exactly, and of what
matches only a spanning forest leaves the cell, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirework.llm.common import bytes_of, chosen, drop_table, prepare, renamed, slices, table
from quirework.llm.components import connected_components

SEED = 42
#: Shingles whose bits are counted at once.
BLOCK = 1 << 15
#: Cells with more distinct fingerprints than this are matched through shared neighbours instead of pair by pair.
PAIRWISE = 256


def shingle_hashes(raw: bytes, width: int) -> np.ndarray:
    """XXH64 (seed 42) of each run of `width` words of the A-Z-lower-cased text, repeats included; of the whole sequence
    if there are fewer words; none if there are none."""
    words = raw.lower().split()
    if not words:
        return np.empty(0, "<u8")
    line = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], "<u8")
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-width])).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], SEED) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist(), strict=True)], "<u8")


def fold(hashes: np.ndarray) -> int:
    """The fingerprint: a bit is 1 if set in over half the hashes; zero for none."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        part = hashes[at : at + BLOCK]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp): the 64-bit fingerprint, as a signed long, of each row. Null and empty texts have fingerprint zero."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = np.array([fold(shingle_hashes(raw, shingle)) for raw in bytes_of(batch, "body")], "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["doc_id", "fp"])

    rows = renamed(docs, {"doc_id": doc_id, "body": text})
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], T.StructField("fp", T.LongType())]))


def embed(fp: Column) -> Column:
    """Per-segment bit counts, 0 to 4 in each of 16 nibbles of a long."""
    ones = [F.shiftrightunsigned(fp, k).bitwiseAND(F.lit(0x1111111111111111)) for k in range(4)]
    return ones[0] + ones[1] + ones[2] + ones[3]


def _around(cell: Column) -> Column:
    """A cell and those one step away; a count stays within 0 to 4."""
    steps = [F.array(cell)]
    for i in range(16):
        nibble, one = F.shiftrightunsigned(cell, 4 * i).bitwiseAND(F.lit(15)), F.lit(1 << (4 * i)).cast("long")
        steps += [F.when(nibble < 4, F.array(cell + one)).otherwise(F.array().cast("array<bigint>")), F.when(nibble > 0, F.array(cell - one)).otherwise(F.array().cast("array<bigint>"))]
    return F.concat(*steps)


def cells(fp: Column, radius: int) -> Column:
    """All grid cells within half the radius, rounded up: two points within the radius share one at least."""
    found = F.array(embed(fp))
    for k in range(-(-radius // 2)):
        found = _around(found[0]) if k == 0 else F.array_distinct(F.flatten(F.transform(found, _around)))
    return found


def _links(fps: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Index pairs within the radius; for large cells only as many as connect what is within it."""
    n = len(fps)
    if n > PAIRWISE and radius in (0, 2):
        flips = np.concatenate(([0], np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64)))) if radius else np.zeros(1, np.uint64)
        # Fingerprints that share a neighbour one bit away differ in two bits at most, and any that do share one.
        near, owner = (fps[:, None] ^ flips.astype(np.uint64)[None, :]).ravel(), np.repeat(np.arange(n), len(flips))
        order = np.argsort(near, kind="stable")
        near, owner = near[order], owner[order]
        same = np.flatnonzero(near[1:] == near[:-1])
        yield from zip(owner[same].tolist(), owner[same + 1].tolist(), strict=True)
        return
    for at in range(0, n, PAIRWISE):
        part = fps[at : at + PAIRWISE]
        for to in range(at, n, PAIRWISE):
            i, j = np.nonzero(np.bitwise_count(part[:, None] ^ fps[None, to : to + PAIRWISE]) <= radius)
            ok = i + at < j + to
            yield from zip((i[ok] + at).tolist(), (j[ok] + to).tolist(), strict=True)


def _forest(fps: np.ndarray, reps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of what matches in one cell."""
    root = list(range(len(fps)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i, j in _links(fps, radius):
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((int(reps[i]), int(reps[j])))
    return out


def _verify(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []  # parts of the last cell, which may go on
        for batch in batches:
            now = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
            if len(now[0]) and not (held and held[0][0][0] == now[0][-1]):
                cut = int(np.searchsorted(now[0], now[0][-1]))
                yield _edges(_joined([*held, [x[:cut] for x in now]]), radius)
                held, now = [], [x[cut:] for x in now]
            if len(now[0]):
                held.append([x.copy() for x in now])
        yield _edges(_joined(held), radius)

    return run


def _joined(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    return [np.concatenate([np.empty(0, np.int64), *(p[k] for p in parts)]) for k in range(3)]


def _edges(rows: list[np.ndarray], radius: int) -> pa.RecordBatch:
    cell, fps, reps = rows[0], rows[1].view(np.uint64), rows[2]
    starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))) if len(cell) else np.empty(0, np.int64)
    sizes = np.diff(np.append(starts, len(cell)))
    pairs = starts[sizes == 2]
    pairs = pairs[np.bitwise_count(fps[pairs] ^ fps[pairs + 1]) <= radius]
    a, b = reps[pairs].tolist(), reps[pairs + 1].tolist()
    for at, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
        for x, y in _forest(fps[at : at + n], reps[at : at + n], radius):
            a.append(x)
            b.append(y)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def link(points: DataFrame, radius: int) -> DataFrame:
    """(a, b): reps of distinct fingerprints (fp, rep) that connect all that differ in `radius` bits or fewer."""
    spread = points.where("rep is not null").select(F.explode(cells(F.col("fp"), radius)).alias("cell"), "fp", "rep")
    dealt = spread.repartition("cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(_verify(radius), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fp, component_id) of each row of docs, whose ids are integers.

    Rows whose fingerprints differ in `radius` bits or fewer are linked; component_id is the smallest id reachable over
    links, the row's own included. Equal fingerprints are one point before the join, so copies cost nothing there.
    Null and empty texts have fingerprint zero and are linked like any other. A null id is never the smallest: its
    row has the component of its fingerprint, null if only null ids have that. Repeated rows each come back. Other
    columns of docs are not looked at. No rows: no rows. Radius 0 to 4; cells grow with its square.
    """
    fps = table(fingerprints(docs, doc_id, text, shingle).select(F.col("doc_id").cast("long").alias("doc_id"), "fp"), "simhash-fp")
    points = table(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-points")
    edges = table(link(points, radius), "simhash-edges")
    found = connected_components(edges)
    named = table(points.join(found, points.rep == found.node, "left").select("fp", F.coalesce("component", "rep").alias("component_id")), "simhash-named")
    drop_table(edges)
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


#: Views of a document's shingles that similar_documents() takes beside the whole, and shingles in each.
VIEWS, SAMPLE = 16, 4
#: Bits in which fingerprints of candidates may differ.
RADIUS = 2
#: The number of a row in deduplicate().
ROW = "dedup__row"
#: Shingles, and documents, of a block of a cell's members; two blocks are compared in one task.
BLOCK_SHINGLES, BLOCK_DOCS = 1 << 19, 4096
_MIX = np.array([int.from_bytes(xxhash.xxh64_digest(f"view {v}".encode()), "big") | 1 for v in range(VIEWS)], np.uint64)


def view_prints(hashes: np.ndarray) -> np.ndarray:
    """For each view: the fingerprint of the SAMPLE shingles that come first in the view's order."""
    out = np.empty(VIEWS, np.uint64)
    step = max(1, min(VIEWS, (1 << 20) // max(1, len(hashes))))
    for at in range(0, VIEWS, step):
        mix = _MIX[at : at + step, None]
        order = (hashes[None, :] ^ (mix >> np.uint64(7))) * mix
        order ^= order >> np.uint64(32)
        least = np.sort(np.partition(order, SAMPLE - 1, axis=1)[:, :SAMPLE] if len(hashes) > SAMPLE else order, axis=1)
        drawn = np.ascontiguousarray(least * mix, "<u8")
        counts = np.unpackbits(drawn.view(np.uint8).reshape(*drawn.shape, 8), axis=2, bitorder="little").sum(axis=1, dtype=np.int64)
        out[at : at + step] = np.packbits(counts * 2 > drawn.shape[1], axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def view_cells(hashes: np.ndarray) -> np.ndarray:
    """For each view: its fingerprint's own grid cell, as one number."""
    bits = view_prints(hashes)
    ones = sum((bits >> np.uint64(k)) & np.uint64(0x1111111111111111) for k in range(4))
    return ((ones ^ _MIX) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for raw in bytes_of(batch, "body"):
                hashes = np.unique(shingle_hashes(raw, shingle))
                digest = np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), "<i8")
                small = np.unique((hashes >> np.uint64(32)).astype("<u4"))
                prints = [np.uint64(fold(hashes)).astype("<i8").item(), *(view_prints(hashes) ^ _MIX).view("<i8").tolist()] if len(hashes) else []
                rows.append((int(digest[0]), int(digest[1]), len(small), small.tobytes(), prints))
            types = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(types))], ["doc_id", "hi", "lo", "n", "shingles", "prints"])

    return run


def _alike(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keep = []
            for i, (x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                one, two = np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4")
                both = len(np.intersect1d(one, two, assume_unique=True))
                if both >= similarity * (len(one) + len(two) - both):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), batch.column(1).take(pa.array(keep, pa.int64()))], ["a", "b"])

    return run


def _across(sets: list[np.ndarray], roots: np.ndarray, side: np.ndarray | None, similarity: float) -> Iterator[tuple[int, int]]:
    """Index pairs that connect what is alike and not of one root yet; with side, only pairs of two sides are compared.

    Alike sets share one at least of their rarest shingles, the first size - similarity * size + 1 of each in one order of all
    shingles, so only what meets there is compared."""
    sizes = np.array([len(x) for x in sets])
    kinds, tokens, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(kinds), np.int64)
    rank[np.argsort(counts, kind="stable")] = np.arange(len(kinds))
    own = [np.sort(x) for x in np.split(rank[tokens], np.cumsum(sizes)[:-1])]
    alone = int((counts == 1).sum())  # shingles of one set come first and lead to no other
    first = [x[: n - int(np.ceil(similarity * n - 1e-9)) + 1] for x, n in zip(own, sizes.tolist(), strict=True)]
    first = [x[np.searchsorted(x, alone) :] for x in first]
    place, holder = np.concatenate(first), np.repeat(np.arange(len(first)), [len(x) for x in first])
    order = np.argsort(place, kind="stable")
    place, holder = place[order], holder[order]
    roots, mark = roots.copy(), np.zeros(len(kinds), bool)
    for i, mine in enumerate(first):
        lows, highs = np.searchsorted(place, mine), np.searchsorted(place, mine, "right")
        met = np.unique(np.concatenate([holder[a:b] for a, b in zip(lows, highs, strict=True)])) if len(mine) else mine
        met = met[(met > i) & (roots[met] != roots[i]) & (sizes[met] >= similarity * sizes[i]) & (sizes[i] >= similarity * sizes[met])]
        if side is not None:
            met = met[side[met] != side[i]]
        mark[own[i]] = True
        for j in met.tolist():
            if roots[j] != roots[i]:
                both = int(mark[own[j]].sum())
                if both >= similarity * (int(sizes[i]) + int(sizes[j]) - both):
                    roots[roots == roots[j]] = roots[i]
                    yield i, j
        mark[own[i]] = False


def _compare(similarity: float):
    """Of rows (cell, i, j, block, rep, component, shingles) in the order of (cell, i, j): the links of each two blocks."""

    def links(group: list[tuple]) -> list[tuple[int, int]]:
        side = None if group[0][1] == group[0][2] else np.array([x[3] for x in group])
        sets = [np.frombuffer(x[6], "<u4") for x in group]
        return [(group[a][4], group[b][4]) for a, b in _across(sets, np.array([x[5] for x in group]), side, similarity)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        for batch in slices(batches):
            out: list[tuple[int, int]] = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group and row[:3] != group[0][:3]:
                    out += links(group)
                    group = []
                group.append(row)
            yield pairs_of(out)
        yield pairs_of(links(group) if group else [])

    def pairs_of(out: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    return run


def _rest(shared: DataFrame, centres: DataFrame, found: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b): the links that the comparison with centres does not show. In each cell whose members less the centre are of
    two components or more, all pairs of two components are compared, in blocks; of cells of the same members, one."""
    named = shared.join(found, shared.rep == found.node, "left").select("cell", "rep", "n", F.coalesce("component", "rep").alias("component"))
    others = table(named.join(centres.select("cell", "centre"), "cell").where("rep <> centre").drop("centre"), "set-others")
    mark = F.xxhash64("rep")
    cells_left = others.groupBy("cell").agg(F.count("*").alias("docs"), F.sum("n").alias("total"), F.min("component").alias("low"), F.max("component").alias("high"), F.bit_xor(mark).alias("x"), F.sum(F.shiftright(mark, 8)).alias("y")).where("low < high")
    blocks = F.greatest(F.ceil(F.col("total") / BLOCK_SHINGLES), F.ceil(F.col("docs") / BLOCK_DOCS)).cast("int").alias("blocks")
    cells_left = table(cells_left.groupBy("docs", "total", "x", "y").agg(F.min("cell").alias("cell")).select("cell", blocks), "set-cells-left")
    dealt = others.join(cells_left, "cell").withColumn("block", F.pmod(F.xxhash64("rep", F.lit("block")), F.col("blocks")).cast("int"))
    both = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least("block", k).alias("i"), F.greatest("block", k).alias("j")))).alias("at")
    dealt = table(dealt.select("cell", both, "block", "rep", "component").select("cell", "at.i", "at.j", "block", "rep", "component"), "set-dealt")
    held = chosen(sets, table(dealt.select(F.col("rep").alias("row")).distinct(), "set-left"), "row", "left_semi").select(F.col("row").alias("rep"), "shingles")
    rows = dealt.join(held, "rep").select("cell", "i", "j", "block", "rep", "component", "shingles")
    return rows.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j").mapInArrow(_compare(similarity), "a bigint, b bigint")


def _grid(view: Column, fp: Column) -> Column:
    """All grid cells within one step, half of RADIUS, of a fingerprint's counts of bits in 4 segments of 16, less the last bit
    of each count; each view has a grid of its own. Two points within RADIUS share one at least."""
    counts = [F.bit_count(F.shiftrightunsigned(fp, 16 * k).bitwiseAND(F.lit(0xFFFF))).cast("long") for k in range(4)]
    own = F.shiftleft(view.cast("long") + 1, 32)
    for k, count in enumerate(counts):
        own = own + F.shiftleft(F.shiftright(count, 1), 8 * k)
    return F.array(own, *[own + F.when(count.bitwiseAND(F.lit(1)) == 1, F.lit(1 << 8 * k)).otherwise(F.lit(-1 << 8 * k)) for k, count in enumerate(counts)])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b): of rows (cell, fp) in the order of cells, fingerprints of a cell that connect all within RADIUS. Such two agree
    in one at least of RADIUS + 1 parts of their bits, and what agrees in a part is compared exactly."""
    ends = np.linspace(0, 64, RADIUS + 2).astype(int).tolist()
    parts = [np.uint64(((1 << b) - 1) ^ ((1 << a) - 1)) for a, b in zip(ends, ends[1:], strict=False)]

    def links(cell: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        for part in parts if len(cell) else []:
            some = fps.view(np.uint64) & part
            order = np.lexsort((some, cell))
            one, two = cell[order], some[order]
            group = np.cumsum(np.concatenate(([0], (one[1:] != one[:-1]) | (two[1:] != two[:-1]))))
            yield _edges([group, fps[order], fps[order]], RADIUS)

    held: list[list[np.ndarray]] = []  # parts of the last cell, which may go on
    for batch in slices(batches, 1 << 16):
        now = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(2)]
        if not (held and held[0][0][0] == now[0][-1]):
            cut = int(np.searchsorted(now[0], now[0][-1]))
            yield from links(*(np.concatenate([np.empty(0, np.int64), *(p[k] for p in held), now[k][:cut]]) for k in range(2)))
            held, now = [], [x[cut:] for x in now]
        held.append([x.copy() for x in now])
    yield from links(*(np.concatenate([np.empty(0, np.int64), *(p[k] for p in held)]) for k in range(2)))


def link_views(points: DataFrame) -> DataFrame:
    """(a, b): of distinct fingerprints (view, fp), those that connect all of one view that differ in RADIUS bits or fewer.

    The range-join of link() on a grid of 4 segments in place of 16: 5 cells a point in place of some 30, as there are
    many more points."""
    spread = points.select(F.explode(_grid(F.col("view"), F.col("fp"))).alias("cell"), "fp")
    return spread.repartition("cell").sortWithinPartitions("cell").mapInArrow(_near, "a bigint, b bigint")


def _classes(prints: DataFrame) -> DataFrame:
    """(rep, n, cell) of rows (rep, n, view, fp), a table: in place of each fingerprint the class of those of its view that
    the range-join links, which is the least of them; fingerprints of two views are as good as never equal."""
    points = table(prints.select("view", "fp").distinct(), "set-points")
    links = table(link_views(points), "set-links")
    drop_table(points)
    classes = table(connected_components(links), "set-classes")
    return prints.join(classes, prints.fp == classes.node, "left").select("rep", "n", F.coalesce("component", "fp").alias("cell"))


def similar_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """(doc_id, component_id) of each row: documents linked by a Jaccard similarity of their word shingles of at least
    `similarity`, and the smallest id reachable.

    Candidates come from the range-join of near_duplicates(). At 0.8, fingerprints of whole documents differ in 5 to 15
    bits of 64, too many for a grid. So each document has, beside that of the whole, VIEWS fingerprints, each of the SAMPLE
    shingles that come first in an order of the view's own. Documents whose fingerprints of one view are linked, at RADIUS
    bits or fewer from one to the next, are of one class and candidates: at 0.8, 41 % a view and 99.98 % in 16 if shingles
    are many, 20 % and 97 % for sets of 4 and 5. In each class, the document that shares the most classes with others is the centre, and all others are compared with it, exactly, by
    their sets of shingles (of 32-bit hashes). What that leaves in several components is then compared among itself, in
    blocks, so that each pair of one class is compared or of one component already. Equal sets are one point. Documents of fewer words than a shingle are one shingle; those without words are alike. Rows are
    told apart by number, not by id: a null id, or one that stands in several rows, is linked by its text, and a null id is
    never the smallest (component_id is null if a component has no other). Repeated rows each come back.
    """
    prepare(docs.sparkSession)
    rows = renamed(docs, {"doc_id": doc_id, "body": text}).select(F.col("doc_id").cast("long").alias("doc_id"), "body")
    sets = table(rows.mapInArrow(_sets(shingle), "doc_id bigint, hi bigint, lo bigint, n int, shingles binary, prints array<bigint>").withColumn("row", F.monotonically_increasing_id()), "sets")
    reps = table(sets.groupBy("hi", "lo").agg(F.min("row").alias("rep"), F.min("doc_id").alias("least")), "set-reps")
    points = sets.join(reps, sets.row == reps.rep).select("rep", "n", "prints")
    spread = table(_classes(table(points.select("rep", "n", F.posexplode("prints").alias("view", "fp")), "set-prints")), "set-cells")
    sizes = table(spread.groupBy("cell").agg(F.count("*").alias("size")).where("size > 1"), "set-sizes")
    shared = table(spread.join(sizes, "cell"), "set-shared")
    weight = table(shared.groupBy("rep").agg(F.sum("size").alias("weight")), "set-weights")
    centres = table(shared.join(weight, "rep").groupBy("cell").agg(F.max(F.struct("weight", (-F.col("rep")).alias("neg"), "n")).alias("c")).select("cell", (-F.col("c.neg")).alias("centre"), F.col("c.n").alias("m")), "set-centres")
    near = shared.join(centres, "cell").where("rep <> centre").where((F.col("n") >= F.col("m") * F.lit(similarity)) & (F.col("m") >= F.col("n") * F.lit(similarity)))
    pairs = table(near.select("rep", "centre").distinct(), "set-pairs")
    held = sets.select("row", "shingles")
    asked = pairs.select(F.col("rep").alias("row")).union(pairs.select("centre")).distinct()
    held = table(chosen(held, table(asked, "set-asked"), "row", "left_semi"), "set-held")
    both = pairs.join(held.select(F.col("row").alias("rep"), F.col("shingles").alias("x")), "rep").join(held.select(F.col("row").alias("centre"), F.col("shingles").alias("y")), "centre").select("rep", "centre", "x", "y")
    found = table(connected_components(table(both.mapInArrow(_alike(similarity), "a bigint, b bigint"), "set-edges")), "set-found")
    rest = table(_rest(shared, centres, found, sets, similarity), "set-rest")
    if not rest.isEmpty():
        found = connected_components(rest.union(found.select("node", "component")))
    named = table(reps.join(found, reps.rep == found.node, "left").select("hi", "lo", "least", F.coalesce("component", "rep").alias("component")), "set-named")
    named = named.join(named.groupBy("component").agg(F.min("least").alias("component_id")), "component")
    return sets.select("doc_id", "hi", "lo").join(named, ["hi", "lo"]).select("doc_id", "component_id")


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """docs less near-duplicates: of each component of similar_documents() one row stays, that of the smallest id, null last;
    of several rows of that id, any. So each group keeps one row whatever its ids, and rows of one id whose texts differ
    are of different groups."""
    rows = table(docs.withColumn(ROW, F.monotonically_increasing_id()), "dedup-rows")
    found = similar_documents(rows, ROW, text, shingle, similarity).withColumnRenamed("doc_id", ROW)
    ids = rows.select(ROW, rows[f"`{doc_id}`"].cast("long").alias("id"))
    order = F.struct(F.col("id").isNull().alias("none"), "id", ROW)
    stays = table(found.join(ids, ROW).groupBy("component_id").agg(F.min(order).alias("least")).select(F.col(f"least.{ROW}").alias(ROW)), "dedup-stays")
    gone = table(ids.select(ROW).join(stays, ROW, "left_anti"), "dedup-gone")
    return chosen(rows, gone, ROW, "left_anti").select(*[rows[f"`{c}`"] for c in docs.columns])

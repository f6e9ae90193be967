"""Exact top-k search by inner product as a Voronoi kNN join.

Vectors get one more component, so that inner products become distances: with M the largest norm, a datum x is
(x, sqrt(M^2 - |x|^2)) and a query (q, 0); then |q - x|^2 = |q|^2 + M^2 - 2 q.x. Data are grouped by their nearest pivot.
Summaries of the groups (radii, and the distances of the k + 1 nearest members to the pivot) bound, for each group of
queries, how far its k-th neighbour can be. A group's data are cut, by distance from the pivot, into chunks of bounded
size; a chunk goes to a block of queries, and the block's queries to the chunk, only if the triangle inequality does not
rule its farthest member out. Each pair of block and chunk is solved exactly, in integers, and the best k of all are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quirework.llm.common import prepare, renamed, table

#: Most pivots; there are as many as the square root of the number of vectors, up to that.
PIVOTS = 256
#: Queries and data that meet in one task.
QUERIES, DATA = 2048, 8192
#: Bands of distance in a group.
BANDS = 8
#: Slack on distances for rounding.
SLACK = 1e-6


def scaled(vectors: DataFrame, vec_id: str, embedding: str, factor: int) -> DataFrame:
    """(vec_id, v): floor(factor * x) of each component; without vectors that are null or hold null or non-finite ones.
    Shorter vectors have zeros for what they lack, so that inner products are over what both have. Rows of the same id and
    vector are one."""
    rows = renamed(vectors, {"vec_id": vec_id, "e": embedding}).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("e").cast("array<double>").alias("e"))
    good = rows.where("vec_id is not null and e is not null and size(e) > 0 and forall(e, x -> x is not null and not isnan(x) and abs(x) < double('inf'))")
    width = good.agg(F.max(F.size("e"))).first()[0] or 0
    whole = F.expr(f"concat(transform(e, x -> cast(floor({factor} * x) as bigint)), array_repeat(bigint(0), {width} - size(e)))")
    return table(good.select("vec_id", whole.alias("v")).distinct(), "knn-vectors")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _distances(x: np.ndarray, extra: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    full = np.concatenate((x, extra[:, None]), axis=1)
    return np.sqrt(np.maximum((full**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)[None, :] - 2 * full @ pivots.T, 0))


def _assign(shared, every: int):
    """Each vector as datum, and as query if it is one, with its nearest pivot and the distance to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, top = shared.value
        for batch in batches:
            if batch.num_rows:
                ids, x = batch.column(0).to_numpy(), _matrix(batch.column(1), pivots.shape[1] - 1).astype(np.float64)
                asks = np.flatnonzero(ids % every == 0)
                data = _distances(x, np.sqrt(np.maximum(top - (x**2).sum(axis=1), 0)), pivots)
                query = _distances(x[asks], np.zeros(len(asks)), pivots)
                rows = np.concatenate((np.arange(len(ids)), asks))
                is_query = np.arange(len(rows)) >= len(ids)
                cells = np.concatenate((data.argmin(axis=1), query.argmin(axis=1)))
                far = np.concatenate((data.min(axis=1), query.min(axis=1)))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows)), pa.array(is_query), pa.array(cells.astype(np.int32)), pa.array(far)], ["vec_id", "v", "is_query", "cell", "far"])

    return run


def bounds(pivots: np.ndarray, reach: dict[int, float], near: dict[int, list[float]], k: int) -> dict[int, list[tuple[int, float]]]:
    """For each cell of queries, the cells of data with the least distance to their own pivot that a datum must have.

    reach: largest distance of a query to its pivot, by cell; near: the k + 1 least distances of data to theirs.
    """
    between = _distances(pivots[:, :-1], pivots[:, -1], pivots)
    out = {}
    for i, radius in reach.items():
        # One datum may be the query itself, so k + 1 upper bounds are needed for k neighbours.
        upper = sorted(radius + between[i, j] + d for j, found in near.items() for d in found)
        limit = upper[k] if len(upper) > k else np.inf
        out[i] = [(j, max(0.0, between[i, j] - radius - limit) - SLACK * (1 + between[i, j])) for j in near]
    return out


def _ranges(numbers: list[int]) -> list[tuple[int, int]]:
    """Runs of consecutive numbers as (first, last)."""
    out: list[list[int]] = []
    for x in numbers:
        if out and x == out[-1][1] + 1:
            out[-1][1] = x
        else:
            out.append([x, x])
    return [(a, b) for a, b in out]


def _solve(k: int):
    def run(queries: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(data):
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="int64")})
        data = data.sort_values("vec_id", kind="stable")
        ids, asks = data["vec_id"].to_numpy(), queries["query_id"].to_numpy()
        x, q = np.stack(data["v"].to_list()).astype(np.int64), np.stack(queries["query"].to_list()).astype(np.int64)
        exact = float(np.abs(x).max()) * float(np.abs(q).max()) * x.shape[1] < 2.0**53
        out: list[list[np.ndarray]] = [[], [], []]
        for at in range(0, len(q), 256):
            part = q[at : at + 256]
            scores = (part.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64) if exact else part @ x.T
            own = asks[at : at + 256, None] == ids[None, :]
            order = np.argsort(np.where(own, np.iinfo(np.int64).max, -scores), axis=1, kind="stable")[:, : k + 1]  # ties to smaller ids
            row = np.repeat(np.arange(len(part)), order.shape[1])
            col = order.ravel()
            ok = ~own[row, col]
            out[0].append(asks[at + row[ok]])
            out[1].append(ids[col[ok]])
            out[2].append(scores[row[ok], col[ok]])
        return pd.DataFrame({n: np.concatenate(o) for n, o in zip(("query_id", "vec_id", "score"), out, strict=True)})

    return run


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, factor: int = 256, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each vector whose id is divisible by `every`, the k others of the highest
    inner product of floor(factor * x) vectors; all of them if there are fewer; ties to smaller ids; rank from 1.

    Null ids and vectors that are null, empty, or hold null or non-finite components take no part. Vectors of different lengths
    are compared over what both have. Repeated rows are one. Vectors that share an id are each data; queries of
    such an id give the best of all. Inner products are asked to fit a long; an ArithmeticError says if they may not. Other columns are not looked at. The driver holds
    pivots (PIVOTS at most) and, for each, k + 2 numbers.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = scaled(vectors, vec_id, embedding, factor)
    norm = F.expr("aggregate(v, 0D, (a, x) -> a + double(x) * double(x))")
    n, top = rows.agg(F.count("*"), F.max(norm)).first()
    if n and top >= 2.0**62:  # no inner product is above the largest of squares
        raise ArithmeticError("inner products may not fit a long; take a smaller factor")
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not n:
        return spark.createDataFrame([], schema)
    # Pivots only steer; any choice gives the same result. These are the vectors of the least hashes.
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(min(PIVOTS, int(np.ceil(np.sqrt(n))))).select("v").collect()
    pivots = np.array([r["v"] for r in chosen], np.float64)
    pivots = np.unique(np.concatenate((pivots, np.sqrt(np.maximum(top - (pivots**2).sum(axis=1), 0))[:, None]), axis=1), axis=0)
    placed = table(rows.select("vec_id", "v").mapInArrow(_assign(spark.sparkContext.broadcast((pivots, top)), every), "vec_id bigint, v array<bigint>, is_query boolean, cell int, far double"), "knn-placed")
    data, asks = placed.where("not is_query"), placed.where("is_query")
    radius = {r[0]: (r[1], r[2]) for r in asks.groupBy("cell").agg(F.max("far"), F.count("*")).collect()}
    nearest = data.select("cell", "far", F.row_number().over(W.partitionBy("cell").orderBy("far")).alias("i")).where(F.col("i") <= k + 1)
    near: dict[int, list[float]] = {}
    for r in nearest.groupBy("cell").agg(F.sort_array(F.collect_list("far"))).collect():
        near[r[0]] = r[1]
    if not radius:
        return spark.createDataFrame([], schema)
    need = bounds(pivots, {i: r[0] for i, r in radius.items()}, near, k)
    # Neighbouring cells of queries share blocks of about QUERIES; a larger cell is several blocks with one bound.
    order = sorted(radius, key=lambda i: (float(np.linalg.norm(pivots[i] - pivots[next(iter(radius))])), i))
    of, parts, size, block = {}, {}, 0, 0
    for i in order:
        if size and size + radius[i][1] > QUERIES:
            block, size = block + parts[block], 0
        of[i] = block
        size += radius[i][1]
        parts[block] = max(1, -(-size // QUERIES))
    groups = sorted(parts)
    least = np.full((len(groups), len(pivots)), np.inf)
    for i, found in need.items():
        g = groups.index(of[i])
        for j, d in found:
            least[g, j] = min(least[g, j], d)
    # Bands of distance in each cell; small ones are packed into a chunk, large ones are several. PIVOTS * BANDS rows at most.
    reach = spark.createDataFrame([(c, float(f)) for c, f in data.groupBy("cell").agg(F.max("far")).collect()], "cell int, reach double")
    banded = data.join(F.broadcast(reach), "cell").withColumn("band", F.when(F.col("reach") > 0, F.least(F.lit(BANDS - 1), F.floor(F.col("far") / F.col("reach") * BANDS))).otherwise(0).cast("int"))
    chunks: list[tuple[int, int, int, int, list[int]]] = []  # cell, band, first chunk, how many, groups that need it
    wanted: dict[int, set[int]] = {g: set() for g in groups}
    chunk = held = 0
    for cell, band, count, far in sorted(map(tuple, banded.groupBy("cell", "band").agg(F.count("*"), F.max("far")).collect())):
        if held and held + count > DATA:
            chunk, held = chunk + 1, 0
        own = -(-count // DATA)
        asked = [groups[g] for g in np.flatnonzero(far >= least[:, cell])]
        chunks.append((cell, band, chunk, own, asked))
        for g in asked:
            wanted[g].update(range(chunk, chunk + own))
        chunk, held = (chunk + own, 0) if own > 1 else (chunk, held + count)
    placed_in = F.broadcast(spark.createDataFrame(chunks, "cell int, band int, first int, own int, groups array<int>"))
    of_group = F.broadcast(spark.createDataFrame([(g, parts[g]) for g in groups], "grp int, parts int"))
    part = lambda of: F.pmod(F.xxhash64("vec_id", F.lit("part")), F.col(of)).cast("int")
    spread = banded.join(placed_in, ["cell", "band"]).select((F.col("first") + part("own")).alias("chunk"), "vec_id", "v", F.explode("groups").alias("grp")).join(of_group, "grp")
    spread = spread.select(F.explode(F.expr("sequence(grp, grp + parts - 1)")).alias("block"), "chunk", "vec_id", "v")
    homes = F.broadcast(spark.createDataFrame([(i, of[i], parts[of[i]]) for i in radius], "cell int, grp int, parts int"))
    runs = F.broadcast(spark.createDataFrame([(g, a, b) for g in groups for a, b in _ranges(sorted(wanted[g]))], "grp int, a int, b int"))
    copies = asks.join(homes, "cell").join(runs, "grp").select((F.col("grp") + part("parts")).alias("block"), F.explode(F.sequence("a", "b")).alias("chunk"), F.col("vec_id").alias("query_id"), F.col("v").alias("query"))
    solved = copies.groupBy("block", "chunk").cogroup(spread.groupBy("block", "chunk")).applyInPandas(_solve(k), "query_id bigint, vec_id bigint, score bigint")
    best = solved.distinct().withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return best.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

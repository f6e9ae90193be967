"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree, in DataFrame functions only.

A source's documents are cut into blocks of words. Its blocks, in the order of a seeded permutation, are drawn until
their words come nearest to the source's target; a source whose target is above its size is drawn whole first and then
permuted anew. The number drawn is the source's quota. A binary tree shares the quotas among output shards: at each
node the left half's share of every source is a hypergeometric draw given the draws before it, so that shards have equal
block counts and sources exact quotas. A block walks down the tree by its place in the permutation: each shard gets
a run of each source's permuted blocks, disjoint from all others, and orders what it got by hash.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quirework.llm.common import renamed, table, word_count

#: Sources whose shares are drawn in one fold.
FOLDED = 1000


def targets(sizes: DataFrame, weights: DataFrame, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(src, source, source_size, target) of each source of sizes (source, size).

    share times all sizes is divided in proportion to weights (source, weight > 0), no target above cap times its
    source's size; what is above is shared anew by weight until none is. The result is the level L with target =
    least(cap * size, L * weight): sources are filled up in the order of cap * size / weight. A source without a weight
    has weight 0 and target 0. src numbers the sources by code point, null last. One row a source is windowed at once.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    known = weights.select(F.col("source").alias("of"), F.col("weight").cast("double").alias("weight"))
    rows = sums.join(known, sums.source.eqNullSafe(known.of), "left").select("source", "source_size", F.coalesce("weight", F.lit(0.0)).alias("weight"), (F.col("source_size") * F.lit(cap)).alias("most"))
    whole = W.partitionBy(F.lit(1))
    filled = whole.orderBy(F.when(F.col("weight") > 0, F.col("most") / F.col("weight")).asc_nulls_last(), F.col("source").asc_nulls_last())
    before = filled.rowsBetween(W.unboundedPreceding, -1)
    level = (F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.nullif(F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)), F.lit(0.0))
    rows = rows.withColumn("full", (F.col("weight") > 0) & (F.col("most") <= level * F.col("weight"))).withColumn("left", F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(whole), F.lit(0.0)))
    rest = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(whole)
    target = F.when(F.col("full"), F.col("most")).when(F.col("weight") > 0, F.least("most", F.col("left") * F.col("weight") / rest)).otherwise(0.0)
    return rows.select((F.row_number().over(whole.orderBy(F.col("source").asc_nulls_last())) - 1).alias("src"), "source", "source_size", target.alias("target"))


def cycled(sizes: DataFrame, cycle: tuple[float, ...] = (5, 2, 1)) -> DataFrame:
    """(source, weight): weights that repeat over the sources by code point, null last."""
    place = F.row_number().over(W.partitionBy(F.lit(1)).orderBy(F.col("source").asc_nulls_last())) - 1
    return sizes.select("source").distinct().select("source", F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), (F.pmod(place, F.lit(len(cycle))) + 1).cast("int")).alias("weight"))


def _let(name: str, value: str, body: str) -> str:
    """SQL of body, in which name stands for a value that is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _log_factorial(x: str) -> str:
    """ln x! by Stirling's series, shifted by 8; good to 1e-10."""
    shift = " * ".join(f"({x} + {k}D)" for k in range(1, 9))
    z = f"({x} + 9D)"
    return f"(({z} - 0.5D) * ln({z}) - {z} + {0.5 * math.log(2 * math.pi)}D + 1D / (12D * {z}) - 1D / (360D * {z} * {z} * {z}) - ln({shift}))"


def hypergeometric(total: str, own: str, drawn: str, u: str) -> str:
    """SQL of how many of `own` marked ones are among `drawn` of `total`, by inversion of u in [0, 1).

    Values further than 8 standard deviations and 8 from the mean, of a chance below 1e-14, are left out.
    """
    n, k, d = f"bigint({total})", f"bigint({own})", f"bigint({drawn})"
    weight = lambda x: "(-" + " - ".join(map(_log_factorial, (x, f"({k} - {x})", f"({d} - {x})", f"({n} - {k} - {d} + {x})"))) + ")"
    mean = f"(double({d}) * {k} / greatest({n}, 1L))"
    spread = f"(sqrt(greatest({mean} * ({n} - {d}) / greatest({n} - 1L, 1L) * ({n} - {k}) / greatest({n}, 1L), 0D)) * 8D + 8D)"
    low = f"greatest(0L, {d} - ({n} - {k}), bigint(floor({mean} - {spread})))"
    high = f"greatest(least({d}, {k}, bigint(ceil({mean} + {spread}))), {low})"
    passed = "aggregate(t, named_struct('sum', 0D, 'n', 0L), (a, x) -> named_struct('sum', a.sum + x, 'n', a.n + if(a.sum + x <= aim, 1L, 0L))).n"
    out = f"least(h.high, h.low + {_let('aim', f'{u} * aggregate(t, 0D, (a, x) -> a + x)', passed)})"
    out = _let("t", f"transform(sequence(h.low, h.high), x -> exp({weight('x')} - {weight('h.mid')}))", out)
    return _let("h", f"named_struct('low', {low}, 'high', {high}, 'mid', least({high}, greatest({low}, bigint(round({mean})))))", out)


def _shares(parts: str, total: str, drawn: str, seed: int) -> Column:
    """Draws `drawn` of `total` from parts (id, q) one part after another; the array gets each part's share as x."""
    u = f"(pmod(xxhash64({seed}, node, p.id), {1 << 53}L) / {1 << 53}D)"
    row = "named_struct('id', p.id, 'q', p.q, 'x', y)"
    step = _let("y", hypergeometric("st.total", "p.q", "st.drawn", u), f"named_struct('total', st.total - p.q, 'drawn', st.drawn - y, 'out', concat(st.out, array({row})))")
    start = f"named_struct('total', bigint({total}), 'drawn', bigint({drawn}), 'out', cast(array() as array<struct<id:int,q:bigint,x:bigint>>))"
    return F.expr(f"aggregate({parts}, {start}, (st, p) -> {step}).out")


def tree(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(src, q, lefts) of each source of quotas (src, q): how many of its blocks go left at each inner node of the tree.

    Nodes are numbered as in a heap, from 1. shards is a power of two. Shards differ by one block at most. Sources are
    held in groups of FOLDED: a node's draw is shared among groups first, and then within each.
    """
    quotas = table(quotas, "mix-quotas")
    rows = quotas.groupBy(F.floor(F.col("src") / FOLDED).cast("int").alias("grp")).agg(F.array_sort(F.collect_list(F.struct(F.col("src").cast("int").alias("id"), F.col("q").cast("long").alias("q")))).alias("parts")).withColumn("node", F.lit(1))
    split = []
    for level in range(shards.bit_length() - 1):
        sums = rows.select("node", F.struct(F.col("grp").alias("id"), F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["q"]).alias("q")).alias("g")).groupBy("node").agg(F.array_sort(F.collect_list("g")).alias("groups"))
        total = F.aggregate("groups", F.lit(0).cast("long"), lambda a, g: a + g["q"])
        shared = sums.withColumn("total", total).select("node", F.explode(_shares("groups", "total", "ceil(total / 2)", seed + 1)).alias("g")).select("node", F.col("g.id").alias("grp"), F.col("g.q").alias("total"), F.col("g.x").alias("drawn"))
        rows = rows.join(shared, ["node", "grp"]).withColumn("parts", _shares("parts", "total", "drawn", seed))
        rows = table(rows.select("node", "grp", "parts"), "mix-level")
        split.append(rows.select("node", F.explode("parts").alias("p")).select("node", F.col("p.id").alias("src"), F.col("p.x").alias("x")))
        side = lambda keep: F.transform("parts", lambda p: F.struct(p["id"].alias("id"), keep(p).alias("q")))
        rows = rows.select("grp", F.explode(F.array(F.struct((F.col("node") * 2).alias("node"), side(lambda p: p["x"]).alias("parts")), F.struct((F.col("node") * 2 + 1).alias("node"), side(lambda p: p["q"] - p["x"]).alias("parts")))).alias("c")).select("grp", "c.node", "c.parts")
    if not split:
        return quotas.select("src", "q", F.array(F.lit(0).cast("long")).alias("lefts"))
    lefts = reduce(DataFrame.unionByName, split).groupBy("src").agg(F.transform(F.array_sort(F.collect_list(F.struct("node", "x"))), lambda s: s["x"]).alias("lefts"))
    return quotas.join(lefts, "src")


def shard_of(lefts: Column, quota: Column, place: Column, depth: int) -> Column:
    """The shard at which a block ends that walks down the tree from its place in its source's permutation; null for what
    lies beyond the quota, which no shard draws."""

    def down(state: Column, _: Column) -> Column:
        left = F.element_at(lefts, state["node"])
        return F.struct((state["node"] * 2 + F.when(state["at"] < left, 0).otherwise(1)).cast("int").alias("node"), (state["at"] - F.when(state["at"] < left, 0).otherwise(left)).cast("long").alias("at"))

    start = F.struct(F.lit(1).alias("node"), place.cast("long").alias("at"))
    leaf = F.aggregate(F.sequence(F.lit(1), F.lit(depth)), start, down)["node"] - F.lit(1 << depth) if depth else F.lit(0)
    return F.when(place < quota, leaf)


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(row, doc_id, source, size) as a table: a number for each row, and the words of its text."""
    rows = renamed(docs, {"doc_id": doc_id, "source": source, "body": text})
    return table(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", word_count(F.col("body")).alias("size")), "mix-sizes")


def draw(sizes: DataFrame, aims: DataFrame, block: int | None = 512, shards: int = 16, seed: int = 7) -> DataFrame:
    """The mix: one row (row, src, epoch, block, words, at, shard, place) for each block that a shard draws; a table. at is
    its place in its source's permutation.

    sizes is what sized() gives, aims what targets() gives. block: words in a block, the last of a document may be
    shorter; None: whole documents. Within a shard, blocks stand in the order of place. The words drawn from a source
    are within half a block of its target, if its documents have as many words as the target divided by the number
    of epochs. A document is drawn at most once an epoch; a source with target t and size s has ceil(t / s) epochs.
    Documents without words have no blocks. Rows that agree in id, source and size are told apart by their row number
    only, so reruns draw the same ids as often. A null id or source is a value like any other.
    """
    if shards & (shards - 1):
        raise ValueError("shards must be a power of two")
    of_size = F.ceil(F.col("size") / block).cast("long") if block else F.when(F.col("size") > 0, 1).otherwise(0).cast("long")
    blocks = sizes.groupBy(F.col("source").alias("named")).agg(F.sum(of_size).alias("blocks"))
    aims = aims.join(blocks, F.col("source").eqNullSafe(F.col("named"))).withColumnRenamed("source", "of")
    rows = sizes.join(aims, sizes.source.eqNullSafe(F.col("of"))).where("size > 0 and target > 0")
    words = F.least(F.lit(block), F.col("size") - F.col("block") * F.lit(block)).cast("long") if block else F.col("size")
    cut = rows.select("row", "doc_id", "src", "source_size", "target", "size", "blocks", F.explode(F.sequence(F.lit(0).cast("long"), of_size - 1)).alias("block"))
    rounds = cut.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("target") / F.col("source_size")).cast("int") - 1))))
    # As many buckets as blocks in each, so that neither a window over a bucket nor one over buckets holds a source.
    bucket = F.pmod(F.shiftright("key", 20), F.ceil(F.sqrt("blocks")).cast("int")).cast("int")
    key = F.xxhash64(F.lit(seed), "epoch", "doc_id", "src", "size", "block")
    rounds = rounds.select("row", "src", "epoch", F.col("block").cast("int").alias("block"), "blocks", words.alias("words"), (F.col("target") - F.col("epoch") * F.col("source_size")).alias("aim"), key.alias("key")).withColumn("bucket", bucket)
    held = ["src", "epoch", "bucket"]
    counts = table(rounds.groupBy(*held).agg(F.count("*").alias("n"), F.sum("words").alias("w")), "mix-buckets")
    before = W.partitionBy("src", "epoch").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(*held, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), F.coalesce(F.sum("w").over(before), F.lit(0)).alias("w0"))
    inside = W.partitionBy(*held).orderBy("key", "row", "block")
    ranked = rounds.withColumn("i", F.row_number().over(inside) - 1).withColumn("upto", F.sum("words").over(inside.rowsBetween(W.unboundedPreceding, 0))).join(offsets, held)
    ranked = table(ranked.select("row", "src", "epoch", "block", "words", "key", (F.col("epoch") * F.col("blocks") + F.col("n0") + F.col("i")).alias("at"), (F.col("w0") + F.col("upto") - F.col("words") / 2 <= F.col("aim")).alias("due")), "mix-ranked")
    quotas = ranked.where("due").groupBy("src").agg(F.count("*").alias("q"))
    paths = table(tree(quotas, shards, seed), "mix-tree")
    walked = ranked.join(paths, "src").withColumn("shard", shard_of(F.col("lefts"), F.col("q"), F.col("at"), shards.bit_length() - 1)).where("shard is not null")
    return table(walked.select("row", "src", "epoch", "block", "words", "at", "shard", F.xxhash64(F.lit(seed), F.lit("place"), "key", "row").alias("place")), "mix-drawn")


def taken(sizes: DataFrame, aims: DataFrame, drawn: DataFrame) -> DataFrame:
    """(row, doc_id, size, source_size, target, taken, shards) of each row: the words that all shards take of it, repeats
    counted, and the shards, in order."""
    sums = drawn.groupBy("row").agg(F.sum("words").alias("taken"), F.array_sort(F.collect_set("shard")).alias("shards"))
    rows = sizes.join(aims.withColumnRenamed("source", "of"), sizes.source.eqNullSafe(F.col("of"))).join(sums, "row", "left")
    return rows.select("row", "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), F.coalesce("shards", F.array().cast("array<int>")).alias("shards"))


def mix(docs: DataFrame, weights: DataFrame | None = None, share: float = 1.5, cap: float = 2.0, shards: int = 16, seed: int = 7, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix of whole documents, with the columns of docs: a document stands there once for each time it is drawn.

    Rows are ordered by shard and place within each partition. They are told apart by number, so ids may repeat or be null.
    weights: (source, weight); without them, 5, 2, 1 repeat over the sources. The words drawn from a source come within
    half a document of its target.
    """
    rows = table(docs.withColumn("mix__row", F.monotonically_increasing_id()), "mix-rows")
    named = renamed(rows, {"row": "mix__row", "doc_id": doc_id, "source": source, "body": text})
    sizes = table(named.select("row", "doc_id", "source", word_count(F.col("body")).alias("size")), "mix-sizes")
    aims = table(targets(sizes, cycled(sizes) if weights is None else weights, share, cap), "mix-aims")
    drawn = draw(sizes, aims, None, shards, seed).select(F.col("row").alias("mix__row"), F.col("shard").alias("mix__shard"), F.col("place").alias("mix__place"))
    return rows.join(drawn, "mix__row").sortWithinPartitions("mix__shard", "mix__place").select(*[rows[f"`{c}`"] for c in docs.columns])

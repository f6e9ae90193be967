"""Language-model scoring with a probabilistic suffix tree.

Symbols are the bytes of a text's words, a space after each word, and an end. A context is up to DEPTH bytes before a
symbol. Counts of all (context, symbol) pairs of the training texts are gathered by grouped aggregation; a context is
retained as a state if its next-symbol distribution diverges enough from its longest proper suffix's. A state's
distribution is smoothed towards that of the next shorter retained suffix, and each symbol of a text is scored in the
longest retained suffix of what stands before it. A text's probability is the product over its symbols, so those of all
texts sum to one at most.

All states that pass the test are kept, however many. They go to the tasks in shards of SHARD_ROWS symbols by the
last two bytes of their contexts, one pass over the texts for each; a symbol is scored wholly in one of them.

The module also scores the add-one unigram base from exact counts. The counts of frequent words are broadcast, at most
FREQUENT of them; all other words meet their counts in a join.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.llm.common import bytes_of, drop_table, prepare, renamed, slices, table

DEPTH = 5
#: Least occurrences of a retained context.
LEAST = 4
#: Symbols of states that are broadcast together.
SHARD_ROWS = 3_000_000
#: Words whose counts are broadcast.
FREQUENT = 150_000
#: Distinct words that a task counts before it hands their counts on.
COUNTED = 200_000
#: Symbols scored or counted at once.
CHUNK = 1 << 22
END = 10
#: The last two bytes of contexts, and all of them.
PAIR, PAIRS = 0xFFFF, 1 << 16


def in_training(doc_id: object) -> bool:
    """Whether a document trains: crc32 of its id as text, modulo 7, is not 2. Null as the empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 != 2


def line_of(words: list[bytes]) -> bytes:
    """A text's symbols before its end: a space after each word."""
    return b" ".join([*words, b""])


def grams(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(keys, starts): for each symbol of each line and its end, the DEPTH bytes before it and itself in one number."""
    pad = bytes([END]) * DEPTH
    buffer = np.frombuffer(b"".join(x for line in lines for x in (pad, line, pad[:1])), np.uint8)
    keys = np.zeros(len(buffer) - DEPTH, np.int64)
    for k in range(DEPTH + 1):
        keys = keys << 8 | buffer[k : len(buffer) - DEPTH + k]
    sizes = np.array([len(x) + 1 for x in lines])
    starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    keep = np.ones(len(keys), bool)
    edges = np.cumsum(sizes + DEPTH)[:-1]  # of each next line's pad
    keep[(edges[:, None] + np.arange(-DEPTH, 0)[None, :]).ravel()] = False
    return keys[keep], starts


def chunks(lines: list[bytes]) -> Iterator[list[int]]:
    """Line numbers in runs of about CHUNK symbols; a longer line is a run of its own."""
    out, size = [], 0
    for i, line in enumerate(lines):
        if out and size + len(line) > CHUNK:
            yield out
            out, size = [], 0
        out.append(i)
        size += len(line) + 1 + DEPTH
    if out:
        yield out


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) - (1 << 63)


def row_key(name: object, raw: bytes) -> int:
    """A number for a row's id and text."""
    return xxhash.xxh64_intdigest(raw, xxhash.xxh32_intdigest(repr(name))) - (1 << 63)


def _counted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, how often each occurs)."""
    codes, distinct = pd.factorize(keys)
    return distinct, np.bincount(codes, counts, len(distinct)).astype(np.int64)


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of training rows only. Kind 0: counts of the longest grams; 1: of words; 2: tokens (key) and texts (n)."""
    words: Counter[bytes] = Counter()
    keys, counts, tokens, texts = np.empty(0, np.int64), np.empty(0, np.int64), 0, 0
    lines: list[bytes] = []
    held = 0

    def rows(kind: int, key: np.ndarray, n: np.ndarray, word: list[bytes] | None = None) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(n), 100_000):
            size = len(n[at : at + 100_000])
            own = pa.array(word[at : at + size], pa.binary()) if word else pa.nulls(size, pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(size, kind, np.int32)), pa.array(key[at : at + size], pa.int64()), own, pa.array(n[at : at + size], pa.int64())], ["kind", "key", "word", "n"])

    def handed() -> Iterator[pa.RecordBatch]:
        yield from rows(1, np.zeros(len(words), np.int64), np.fromiter(words.values(), np.int64, len(words)), list(words))
        words.clear()

    def settle() -> None:
        nonlocal keys, counts, held
        for run in chunks(lines):
            k, n = _counted(grams([lines[i] for i in run])[0])
            keys, counts = _counted(np.concatenate((keys, k)), np.concatenate((counts, n)))
        lines.clear()
        held = 0

    for batch in slices(batches):
        for name, raw in zip(batch.column(0).to_pylist(), bytes_of(batch, "body"), strict=True):
            if in_training(name):
                own = raw.lower().split()
                words.update(own)
                tokens += len(own) + 1
                texts += 1
                lines.append(line_of(own))
                held += len(lines[-1])
        if held > CHUNK:
            settle()
        if len(words) > COUNTED:
            yield from handed()
    settle()
    yield from handed()
    yield from rows(0, keys, counts)
    if texts:
        yield from rows(2, np.array([tokens]), np.array([texts]))


def tree(counts: DataFrame, least: int = LEAST) -> DataFrame:
    """(depth, key, n) of all symbols of the retained states, from counts (key, n) of the longest grams.

    key holds the context's bytes and then the symbol. A context is tested by how much likelier, in nats, it makes its
    next symbols than its longest proper suffix does: total times the divergence of the two distributions. That must
    reach what its distribution costs to tell: half the logarithm of its occurrences for each distinct symbol, and 2.
    The root always stays.
    """
    at = [counts]
    for d in range(DEPTH - 1, -1, -1):
        mask = (1 << 8 * (d + 1)) - 1
        at.append(table(at[-1].groupBy(F.col("key").bitwiseAND(F.lit(mask).cast("long")).alias("key")).agg(F.sum("n").alias("n")), "pst-counts"))
    at.reverse()
    context = lambda c: F.shiftright(c, 8)
    sums = [a.groupBy(context("key").alias("ctx")).agg(F.sum("n").alias("total")) for a in at]
    parts = [at[0].select(F.lit(0).alias("depth"), "key", "n")]
    for d in range(1, DEPTH + 1):
        up = at[d - 1].select(F.col("key").alias("up"), F.log("n").alias("ln"))
        own = at[d].withColumn("up", F.col("key").bitwiseAND(F.lit((1 << 8 * d) - 1).cast("long"))).join(up, "up")
        each = own.groupBy(context("key").alias("ctx")).agg(F.sum("n").alias("total"), F.count("*").alias("kinds"), F.sum(F.col("n") * (F.log("n") - F.col("ln"))).alias("ratio"))
        each = each.where(F.col("total") >= least).withColumn("up", F.col("ctx").bitwiseAND(F.lit((1 << 8 * (d - 1)) - 1).cast("long")))
        over = sums[d - 1].select(F.col("ctx").alias("up"), F.log("total").alias("ln"))
        gain = F.col("ratio") - F.col("total") * (F.log("total") - F.col("ln"))
        kept = each.join(over, "up").where(gain >= F.col("kinds") * 0.5 * F.log("total") + 2).select("ctx")
        parts.append(at[d].withColumn("ctx", context("key")).join(kept, "ctx").select(F.lit(d).alias("depth"), "key", "n"))
    return reduce(DataFrame.unionByName, parts)


def deal(sizes: dict[int, int], most: int) -> np.ndarray:
    """The shard of each pair of bytes, from the symbols that states of the pair have: as many pairs as fit, the largest first.
    States of one byte or none are in all shards and don't count."""
    of, load = np.zeros(PAIRS, np.int64), [0]
    for pair, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        shard = min(range(len(load)), key=load.__getitem__)
        if load[shard] and load[shard] + size > most:
            shard = len(load)
            load.append(0)
        of[pair] = shard
        load[shard] += size
    return of


class Model:
    """A suffix tree, or a shard of one, as sorted arrays, depth by depth."""

    def __init__(self, rows: pa.Table):
        depth, key, n = (rows.column(c).to_numpy() for c in ("depth", "key", "n"))
        self.levels = []
        for d in range(DEPTH + 1):
            own = np.flatnonzero(depth == d)
            own = own[np.argsort(key[own])]
            ctx, place, kinds = np.unique(key[own] >> 8, return_inverse=True, return_counts=True)
            weight = np.bincount(place, weights=n[own], minlength=len(ctx)) + kinds
            self.levels.append((key[own], (n[own] / weight[place]).astype(np.float32), ctx, (kinds / weight).astype(np.float32)))

    def probability(self, keys: np.ndarray) -> np.ndarray:
        """Of each gram's symbol in the longest retained suffix of its context: from the root, whose distribution is
        smoothed towards all 256 bytes alike, down to that state."""
        out = np.full(len(keys), 1 / 256)
        for d, (rows, share, contexts, rest) in enumerate(self.levels):
            if len(rows):
                own = keys & ((1 << 8 * (d + 1)) - 1)
                at = np.minimum(np.searchsorted(contexts, own >> 8), len(contexts) - 1)
                held = contexts[at] == own >> 8
                to = np.minimum(np.searchsorted(rows, own), len(rows) - 1)
                out = np.where(held, out * rest[at] + np.where(rows[to] == own, share[to], 0.0), out)
        return out

    def scores(self, lines: list[bytes], mine: np.ndarray | None = None) -> np.ndarray:
        """log10 probability of each line, its end included; with mine, of those symbols only whose pair is there."""
        out = np.zeros(len(lines))
        for run in chunks(lines):
            keys, starts = grams([lines[i] for i in run])
            owner = np.repeat(np.array(run), np.diff(np.append(starts, len(keys))))
            if mine is not None:
                held = mine[keys >> 8 & PAIR]
                keys, owner = keys[held], owner[held]
            codes, distinct = pd.factorize(keys)
            order = np.argsort(distinct)  # neighbours are found faster one after another
            logs = np.empty(len(distinct))
            logs[order] = np.log10(self.probability(distinct[order]))
            out += np.bincount(owner, logs[codes], len(lines))
        return out


COLUMNS = ["doc_id", "at", "held_out", "n_tokens", "n_known", "logs", "score", "key"]
FIELDS = "at bigint, held_out boolean, n_tokens bigint, n_known bigint, logs double, score double, key bigint"


def _score(shared):
    """A row for each text, with what its frequent words and its end add, and one for each occurrence of a rare word
    (key) in a row (at)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, mine, frequent, counts, ends = shared.value
        known = {w: i for i, w in enumerate(frequent)}
        counts = np.concatenate((counts, [ends, -1])).astype(np.float64)  # then the end, and what is rare
        types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        for batch in slices(batches, 2000):
            names, texts = batch.column(0).to_pylist(), bytes_of(batch, "body")
            words = [raw.lower().split() for raw in texts]
            scores = model.scores([line_of(own) for own in words], mine)
            rows, rare_at, rare = [], [], []
            for name, raw, own, score in zip(names, texts, words, scores.tolist(), strict=True):
                at = row_key(name, raw)
                places = np.append(np.fromiter(map(known.get, own, repeat(-1)), np.int64, len(own)), len(known))
                c = counts[places]
                common = c >= 0
                rows.append((at, not in_training(name), len(places), int((c > 0).sum()), float(np.log10(c[common] + 1).sum()), score))
                odd = np.flatnonzero(~common).tolist()
                rare_at.append(np.full(len(odd), at))
                rare += [word_hash(own[i]) for i in odd]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)), pa.nulls(len(rows), pa.int64())], COLUMNS)
            where, what = np.concatenate(rare_at), np.array(rare, np.int64)
            for start in range(0, len(what), 100_000):
                n = len(what[start : start + 100_000])
                yield pa.RecordBatch.from_arrays([pa.nulls(n, batch.column(0).type), pa.array(where[start : start + n], pa.int64()), *(pa.nulls(n, t) for t in types[1:]), pa.array(what[start : start + n])], COLUMNS)

    return run


def _more(shared):
    """(at, score): what a further shard adds to each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, mine = shared.value
        for batch in slices(batches, 2000):
            names, texts = batch.column(0).to_pylist(), bytes_of(batch, "body")
            scores = model.scores([line_of(raw.lower().split()) for raw in texts], mine)
            yield pa.RecordBatch.from_arrays([pa.array(map(row_key, names, texts), pa.int64()), pa.array(scores)], ["at", "score"])

    return run


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", frequent: int = FREQUENT, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row of docs.

    Learns from the rows that in_training() names and scores all. Tokens are the A-Z-lower-cased words and one end a
    text; null and empty texts have the end only. base_score adds log10((c + 1) / (N + V + 1)) over the tokens; score
    is the tree's log10 probability of the text. Repeated rows count and come back as often as they stand there; null
    ids train. Without training rows the tree is one root that gives all bytes alike. Rare words are told apart by
    64-bit hashes. Other columns of docs are not looked at.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = renamed(docs, {"doc_id": doc_id, "body": text})
    kind = rows.schema["doc_id"].dataType.simpleString()
    gathered = table(rows.mapInArrow(_gather, "kind int, key bigint, word binary, n bigint"), "pst-gathered")
    counts = table(gathered.where("kind = 0").groupBy("key").agg(F.sum("n").alias("n")), "pst-grams")
    words = table(gathered.where("kind = 1").groupBy("word").agg(F.sum("n").alias("n")), "pst-words")
    tokens, texts = (x or 0 for x in gathered.where("kind = 2").agg(F.sum("key"), F.sum("n")).first())
    drop_table(gathered)
    top = words.orderBy(F.desc("n"), "word").limit(frequent).toArrow()
    kinds = words.count() + (texts > 0)
    states = table(tree(counts), "pst-states").withColumn("pair", F.shiftright("key", 8).bitwiseAND(F.lit(PAIR).cast("long")))
    dealt = deal(dict(map(tuple, states.where("depth > 1").groupBy("pair").count().collect())), shard_rows)

    def shard(k: int) -> tuple[Model, np.ndarray | None]:
        if not dealt.any():
            return Model(states.select("depth", "key", "n").toArrow()), None
        of = F.broadcast(spark.createDataFrame([(int(p),) for p in np.flatnonzero(dealt == k)], "pair long"))
        return Model(states.where("depth < 2").unionByName(states.where("depth > 1").join(of, "pair", "left_semi").select(states.columns)).select("depth", "key", "n").toArrow()), dealt == k

    shared = spark.sparkContext.broadcast((*shard(0), top["word"].to_pylist(), top["n"].to_numpy(), texts))
    found = table(rows.mapInArrow(_score(shared), f"doc_id {kind}, {FIELDS}"), "pst-scored")
    shared.destroy()
    texts_of = found.where("key is null").drop("key")
    zero = F.lit(0).cast("long")
    sums = [texts_of.select("at", zero.alias("known"), F.lit(0.0).alias("part"), F.lit(0.0).alias("score"), F.lit(1).cast("long").alias("rows"))]
    for k in range(1, int(dealt.max()) + 1):
        shared = spark.sparkContext.broadcast(shard(k))
        more = table(rows.mapInArrow(_more(shared), "at bigint, score double"), "pst-more")
        shared.destroy()
        sums.append(more.select("at", zero.alias("known"), F.lit(0.0).alias("part"), "score", zero.alias("rows")))
    pa.default_memory_pool().release_unused()
    hashed = words.where("word is not null").mapInArrow(_hashed, "key bigint, n bigint")
    rare = found.where("key is not null").select("at", "key").join(hashed, "key", "left")
    sums.append(rare.select("at", F.when(F.col("n") > 0, 1).otherwise(0).cast("long").alias("known"), F.log10(F.coalesce("n", zero) + 1).alias("part"), F.lit(0.0).alias("score"), zero.alias("rows")))
    by = reduce(DataFrame.unionByName, sums).groupBy("at").agg(*[F.sum(c).alias(f"all_{c}") for c in ("known", "part", "score", "rows")])
    whole = float(np.log10(tokens + kinds + 1))
    joined = texts_of.join(by, "at")
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + (F.col("all_known") / F.col("all_rows")).cast("long")).alias("n_known"),
        F.lit(int(tokens)).cast("long").alias("train_tokens"),
        (F.col("logs") + F.col("all_part") / F.col("all_rows") - F.col("n_tokens") * F.lit(whole)).alias("base_score"),
        (F.col("score") + F.col("all_score") / F.col("all_rows")).alias("score"),
    )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(map(word_hash, batch.column(0).to_pylist()), pa.int64()), batch.column(1)], ["key", "n"])

"""Benchmark decontamination with a generalised suffix automaton of the benchmark's items.

The automaton holds every substring, in words, of the items. A document's words are streamed through it; the length of
the longest match that ends at each word says which words lie in an occurrence of an item's window. Words that no item
has reset the automaton, so only runs of item words that are long enough for a window are streamed at all.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirework.llm.common import bytes_of, cached, prepare, renamed, slices, table, without

#: Item bytes in one automaton. More items make more automata, each streamed in a pass of its own.
SHARD_BYTES = 2_000_000
#: Upper case to lower case, and all that is no word character to a space.
FOLD = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ADDED = ["decon_words", "decon_hit", "decon_longest", "decon_items", "decon_spans", "decon_text"]
SPANS = ("first", "last", "longest")
SPAN = T.ArrayType(T.StructType([T.StructField(n, T.IntegerType()) for n in SPANS]))
SPAN_TYPE = pa.list_(pa.struct([(n, pa.int32()) for n in SPANS]))
#: The number of a row, and what shards have found in it.
ROW, JOINED = "decon__row", ("decon__spans", "decon__items")
FIELDS = [T.StructField("decon_words", T.LongType()), T.StructField("decon_hit", T.LongType()), T.StructField("decon_longest", T.IntegerType()), T.StructField("decon_items", T.ArrayType(T.StringType())), T.StructField("decon_spans", SPAN), T.StructField("decon_text", T.StringType())]


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(FOLD).split()


class Automaton:
    """Generalised suffix automaton over word numbers; says, for each word of a stream, which windows end there."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window, self.vocabulary = window, {}
        self.step, self.link, self.length = [{}], [-1], [0]
        number = self.vocabulary
        coded = [(name, [number.setdefault(w, len(number)) for w in words]) for name, words in items if words]
        for _, codes in coded:
            last = 0
            for code in codes:
                last = self._extend(last, code)
        #: Items whose window is the state's string of window words.
        self.owners: dict[int, set[str]] = {}
        #: Whole items under a window's length, by the state that holds them: (length, item).
        self.short: dict[int, list[tuple[int, str]]] = {}
        for name, codes in coded:
            state = 0
            for n, code in enumerate(codes, 1):
                state = self.step[state][code]
                if n >= window:
                    state = self._cut(state, window)
                    self.owners.setdefault(state, set()).add(name)
            if len(codes) < window:
                self.short.setdefault(self._cut(state, len(codes)), []).append((len(codes), name))
        #: The nearest state up the suffix links, itself included, that holds a short item.
        self.near = [-1] * len(self.link)
        for state in sorted(range(len(self.link)), key=self.length.__getitem__):
            self.near[state] = state if state in self.short else self.near[self.link[state]] if state else -1
        self.least = min([window, *(n for found in self.short.values() for n, _ in found)])

    def _extend(self, last: int, code: int) -> int:
        step, link, length = self.step, self.link, self.length
        if code in step[last]:
            old = step[last][code]
            return old if length[old] == length[last] + 1 else self._split(last, code, old)
        new = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and code not in step[at]:
            step[at][code] = new
            at = link[at]
        if at >= 0:
            old = step[at][code]
            link[new] = old if length[old] == length[at] + 1 else self._split(at, code, old)
        return new

    def _split(self, at: int, code: int, old: int) -> int:
        step, link, length = self.step, self.link, self.length
        twin = len(step)
        step.append(dict(step[old]))
        link.append(link[old])
        length.append(length[at] + 1)
        link[old] = twin
        while at >= 0 and step[at].get(code) == old:
            step[at][code] = twin
            at = link[at]
        return twin

    def _cut(self, state: int, n: int) -> int:
        """The state of the last n words of a state's strings."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def matches(self, words: list[bytes]) -> tuple[list[tuple[int, int, int]], set[str]]:
        """Occurrences of windows as (first word, word after, longest match there), and the items that own them."""
        spans, found, known = [], set(), self.vocabulary
        mask = bytes(map(known.__contains__, words))
        run = b"\x01" * self.least
        at = mask.find(run)
        while at >= 0:
            end = mask.find(b"\x00", at)
            end = len(mask) if end < 0 else end
            self._stream(words, at, end, spans, found)
            at = mask.find(run, end)
        return spans, found

    def _stream(self, words, first, end, spans, found) -> None:
        step, link, length, near, window = self.step, self.link, self.length, self.near, self.window
        state = matched = 0
        for i in range(first, end):
            code = self.vocabulary[words[i]]
            while state and code not in step[state]:
                state = link[state]
                matched = length[state]
            if code in step[state]:
                state = step[state][code]
                matched += 1
            hit = 0
            if matched >= window:
                found |= self.owners.get(self._cut(state, window), set())
                hit = window
            holder = near[state]
            while holder > 0:
                for n, name in self.short[holder]:
                    if n <= matched:
                        found.add(name)
                        hit = max(hit, n)
                holder = near[link[holder]]
            if hit:
                spans.append((i - hit + 1, i + 1, matched))


def merged(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Disjoint spans of hit words, each with the longest match in it; spans that only touch become one."""
    out: list[tuple[int, int, int]] = []
    for first, last, longest in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], last), max(out[-1][2], longest))
        else:
            out.append((first, last, longest))
    return out


def cut(raw: bytes, spans: list[tuple[int, int, int]], least: int) -> bytes:
    """The text less the spans whose longest match has at least that many words."""
    gone = [s for s in spans if s[2] >= least]
    if not gone:
        return raw
    at = [m.span() for m in WORD.finditer(raw)]
    kept, start = [], 0
    for first, last, _ in gone:
        kept.append(raw[start : at[first][0]])
        start = at[last - 1][1]
    return b"".join([*kept, raw[start:]])


def _automaton(items: list[tuple[str, bytes]], window: int) -> Automaton:
    """Built once a worker for each shard."""
    key = hashlib.sha256(repr((items, window)).encode()).digest()
    return cached(key, lambda: Automaton([(name, words_of(raw)) for name, raw in items], window))


def _hits(shared, window: int):
    """Of rows (row, body): spans and items of those that one shard has hits in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built = _automaton(shared.value, window)
        for batch in slices(batches):
            found = [(row, *built.matches(words_of(raw))) for row, raw in zip(batch.column(0).to_pylist(), bytes_of(batch, "body"), strict=True)]
            found = [(row, [dict(zip(SPANS, s, strict=True)) for s in merged(spans)], sorted(items)) for row, spans, items in found if spans]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], t) for k, t in enumerate((pa.int64(), SPAN_TYPE, pa.list_(pa.string())))], ["row", "spans", "items"])

    return run


def _marked(text: str, least: int, look):
    """Adds what is known of each text; look gives its spans and items from the batch, the number of a row and its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        see = look()
        for batch in slices(batches):
            rows = {n: [] for n in ADDED}
            given = see(batch)
            for i, raw in enumerate(bytes_of(batch, text)):
                words = words_of(raw)
                spans, found = given(i, words)
                spans = merged(spans)
                rows["decon_words"].append(len(words))
                rows["decon_hit"].append(sum(b - a for a, b, _ in spans))
                rows["decon_longest"].append(max((n for *_, n in spans), default=0))
                rows["decon_items"].append(sorted(found))
                rows["decon_spans"].append([dict(zip(SPANS, s, strict=True)) for s in spans])
                rows["decon_text"].append(cut(raw, spans, least).decode("utf-8", "replace"))
            kept = [n for n in batch.schema.names if n not in (*ADDED, *JOINED)]
            types = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.string()), SPAN_TYPE, pa.string()]
            columns = [batch.column(batch.schema.get_field_index(n)) for n in kept]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(rows[n], t) for n, t in zip(ADDED, types, strict=True)], [*kept, *ADDED])

    return run


def _by_automaton(shared, window: int):
    def look():
        built = _automaton(shared.value, window)
        return lambda batch: lambda i, words: built.matches(words)

    return look


def _by_column():
    def see(batch: pa.RecordBatch):
        spans, items = (batch.column(batch.schema.get_field_index(n)).to_pylist() for n in JOINED)
        return lambda i, words: ([tuple(s[n] for n in SPANS) for part in spans[i] or [] for s in part], {x for part in items[i] or [] for x in part})

    return see


def shard(items: DataFrame, k: int, count: int) -> list[tuple[str, bytes]]:
    """The items (item, body) of one of `count` shards, of about SHARD_BYTES each."""
    part = items if count == 1 else items.where(F.pmod(F.xxhash64("item"), F.lit(count)) == k)
    return sorted((r["item"], r["body"].encode()) for r in part.collect())


def scan(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10, min_match: int = 10) -> DataFrame:
    """docs with what the items left in them; every row and every other column stays.

    Adds decon_words (words), decon_hit (words inside an occurrence of an item's window), decon_longest (longest match
    in words), decon_items (ids, as sorted strings, of items with an occurring window), decon_spans (disjoint spans of
    hit words: first, last (exclusive), longest) and decon_text (the text less the spans whose longest match has at
    least min_match words; shorter whole items are hits that stay). Columns of docs under these names are replaced.

    A window is `window` consecutive words of an item; an item of fewer words is one window; an item without words has
    none. Null and empty texts have no words and no hits. Items with a null id or text take no part. Repeated rows and
    repeated items are each scanned; equal ids are one item. No items: no hits.

    The items, not the documents, are broadcast, in shards of about SHARD_BYTES. Each further shard takes a pass of its own,
    which gives the rows that it has hits in; these are joined to their documents at the end.
    """
    spark = docs.sparkSession
    prepare(spark)
    body = renamed(items, {"item": item_id, "body": item_text}).select(F.col("item").cast("string").alias("item"), "body").where("item is not null and body is not null")
    out = without(docs, ADDED)
    schema = T.StructType([*out.schema.fields, *FIELDS])
    total = body.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    count = -(-total // SHARD_BYTES) or 1
    if count == 1:
        return out.mapInArrow(_marked(text, min_match, _by_automaton(spark.sparkContext.broadcast(shard(body, 0, 1)), window)), schema)
    rows = table(out.withColumn(ROW, F.monotonically_increasing_id()), "decon-rows")
    found = []
    for k in range(count):
        shared = spark.sparkContext.broadcast(shard(body, k, count))
        found.append(table(renamed(rows, {"row": ROW, "body": text}).mapInArrow(_hits(shared, window), T.StructType([T.StructField("row", T.LongType()), T.StructField("spans", SPAN), T.StructField("items", T.ArrayType(T.StringType()))])), "decon-hits"))
        shared.destroy()
    hits = reduce(DataFrame.union, found).groupBy(F.col("row").alias(ROW)).agg(F.collect_list("spans").alias(JOINED[0]), F.collect_list("items").alias(JOINED[1]))
    return rows.join(hits, ROW, "left").drop(ROW).mapInArrow(_marked(text, min_match, lambda: _by_column()), schema)


def remove(docs: DataFrame, items: DataFrame, max_coverage: float = 0.5, text: str = "text", **how) -> DataFrame:
    """docs, with their own columns only, after removal: spans of matches go, and so do documents of which more than
    max_coverage of the words are hit. A document without hits stays as it is, null text included."""
    marked = scan(docs, items, text=text, **how)
    kept = marked.where((F.col("decon_hit") == 0) | (F.col("decon_hit") <= F.col("decon_words") * F.lit(max_coverage)))
    return kept.select(*[(F.when(F.col("decon_hit") > 0, F.col("decon_text")).otherwise(F.col(f"`{c}`")).alias(c) if c == text else F.col(f"`{c}`")) for c in docs.columns if c not in ADDED])

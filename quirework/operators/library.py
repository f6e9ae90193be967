"""Library operators: search, headings, plans, polling, merging, indexing, trimming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quirework.functions import rules, text as T

IMAGE = "^!\\[[^\\]]*\\]\\(images/([^)\\s]+)\\)$"


def search(lines: DataFrame, query: str, per_book: int = 5, most: int = 20) -> DataFrame:
    """(book, line_no, line, total): case-blind substring hits; per book the first few by line; then the highest line
    numbers of all, ties by book. total counts hits after the per-book limit. An empty query has no hits. Columns
    besides book, line_no and line break ties in a book (file)."""
    extra = [c for c in lines.columns if c not in ("book", "line_no", "line")]
    hits = lines.where(F.lower("line").contains(query.lower()) & F.lit(bool(query)))
    first = hits.withColumn("i", F.row_number().over(W.partitionBy("book").orderBy("line_no", *extra))).where(F.col("i") <= per_book).drop("i")
    total = first.agg(F.count("*").alias("total"))
    top = first.orderBy(F.desc("line_no"), "book", *extra).limit(most or 20)
    return top.join(F.broadcast(total)).select("book", *extra, "line_no", F.substring("line", 1, 300).alias("line"), "total")


def headings(lines: DataFrame, most: int = 500) -> DataFrame:
    """(book, line_no, level, title) of # to #### lines, the first `most` a book."""
    found = lines.where(F.col("line").rlike("^#{1,4}\\s")).select("book", "line_no", F.length(F.regexp_extract("line", "^(#+)", 1)).alias("level"), T.strip(F.regexp_extract("line", "^#+\\s+(.*)$", 1)).alias("title"))
    return found.withColumn("i", F.row_number().over(W.partitionBy("book").orderBy("line_no"))).where(F.col("i") <= most).drop("i")


def chunk_plan(files: DataFrame, chunk: int = 200, merged: DataFrame | None = None) -> DataFrame:
    """(book, start, end, label) of page ranges; one range without a label if the pages fit; none for merged books."""
    rows = files if merged is None else files.join(merged.select("book"), "book", "left_anti")
    pages = F.greatest(F.coalesce("pages", F.lit(1)), F.lit(1))
    out = rows.select("book", pages.alias("pages"), F.explode(F.sequence(F.lit(1), pages, F.lit(chunk))).alias("start"))
    end = F.least(F.col("start") + chunk - 1, F.col("pages"))
    return out.select("book", "start", end.alias("end"), F.when(F.col("pages") > chunk, F.concat_ws("-", "start", end)).alias("label"))


def batches(entries: DataFrame, order: list[str], size: int = 40) -> DataFrame:
    """Entries with data_id f0, f1 ... in order and their batch. Numbers come from counts of range partitions' rows, so
    no task sees all entries."""
    ranged = entries.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    inside = F.row_number().over(W.partitionBy("part").orderBy(*order))
    counts = ranged.groupBy("part").count()
    before = counts.select("part", F.coalesce(F.sum("count").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    n = F.col("before") + F.col("i") - 1
    return ranged.withColumn("i", inside).join(F.broadcast(before), "part").withColumn("data_id", F.concat(F.lit("f"), n)).withColumn("batch", F.floor(n / size)).drop("part", "before", "i")


def poll(tasks: DataFrame, results: DataFrame, order: str) -> DataFrame:
    """Tasks (task, batch, data_id) with the state of the first result by (batch, data_id); running without one; error
    counts as failed."""
    first = results.withColumn("i", F.row_number().over(W.partitionBy("batch", "data_id").orderBy(order))).where("i = 1").select("batch", "data_id", F.col("state").alias("found"))
    state = F.when(F.col("found") == "error", "failed").otherwise(F.coalesce("found", F.lit("running")))
    return tasks.join(first, ["batch", "data_id"], "left").withColumn("state", state).drop("found")


def ready_books(tasks: DataFrame) -> DataFrame:
    """Books all of whose tasks (book, fetched, state) are fetched or failed, and one at least fetched."""
    done = tasks.groupBy("book").agg(F.bool_and(F.col("fetched") | (F.col("state") == "failed")).alias("all_done"), F.bool_or("fetched").alias("some"), F.count("*").alias("tasks"))
    return done.where("all_done and some").select("book", "tasks")


def largest(files: DataFrame) -> DataFrame:
    """(task, path, size): the largest .md of each task; ties to the first path."""
    md = files.where(F.lower("path").endswith(".md"))
    return md.groupBy("task").agg(F.max(F.struct("size", F.col("path"))).alias("m"), F.count("*").alias("candidates")).select("task", "m.path", "m.size", "candidates")


def flatten_names(files: DataFrame) -> DataFrame:
    """(book, rel, name, final): a repeated base name gets 1-, 2- ... before it, in order of rel."""
    named = files.withColumn("name", T.base_name(F.col("rel")))
    i = F.row_number().over(W.partitionBy("book", "name").orderBy("rel")) - 1
    return named.withColumn("i", i).select("book", "rel", "name", F.when(F.col("i") == 0, F.col("name")).otherwise(F.concat_ws("-", "i", "name")).alias("final"))


def image_target(url: Column) -> Column:
    """images/ and the base name of an address, without its query and fragment."""
    return F.concat(F.lit("images/"), T.base_name(F.regexp_replace(F.regexp_replace(url, "[?#].*$", ""), "^\\./", "")))


def merge_chunks(chunks: DataFrame) -> DataFrame:
    """(book, text, chunks): chunks (book, start, text) by start, each between its marks."""
    wrapped = F.concat(F.lit("<!-- 分片 "), F.col("n"), F.lit(" 开始 -->\n\n"), F.col("text"), F.lit("\n\n<!-- 分片 "), F.col("n"), F.lit(" 结束 -->"))
    rows = chunks.withColumn("n", F.row_number().over(W.partitionBy("book").orderBy("start", "text")).cast("string"))
    return rows.groupBy("book").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("n").cast("int").alias("n"), wrapped.alias("w")))), lambda x: x["w"]), "\n").alias("text"), F.count("*").alias("chunks"))


def index(docs: DataFrame, found: DataFrame, shown: int = 200) -> DataFrame:
    """(book, kb, headings, titles): size in KB, number of headings, and the first ones' titles as one string."""
    sums = found.groupBy("book").agg(F.count("*").alias("headings"), F.array_join(F.transform(F.slice(F.array_sort(F.collect_list(F.struct("line_no", "level", "title"))), 1, shown), lambda x: x["title"]), "|").alias("titles"))
    return docs.join(sums, "book", "left").select("book", F.floor(F.col("size") / 1024 + 0.5).cast("bigint").alias("kb"), F.coalesce("headings", F.lit(0)).alias("headings"), F.coalesce("titles", F.lit("")).alias("titles"))


def collapse_blank(text: Column) -> Column:
    """No trailing blanks, at most one empty line in a row, one line end at the end."""
    out = F.regexp_replace(F.regexp_replace(text, "(?m)[ \\t]+$", ""), "\\n{3,}", "\n\n")
    return F.concat(F.regexp_replace(out, "\\s+\\z", ""), F.lit("\n"))


def single_blanks(lines: DataFrame) -> DataFrame:
    """Lines right-trimmed, at most one blank in a row, none at either end of a book."""
    own = W.partitionBy("book").orderBy("line_no")
    rows = lines.withColumn("line", T.sub(F.col("line"), f"{T.SPACE}+$", ""))
    full = F.when(F.col("line") != "", F.col("line_no"))
    rows = rows.withColumn("before", F.lag("line").over(own)).withColumn("first", F.min(full).over(W.partitionBy("book"))).withColumn("last", F.max(full).over(W.partitionBy("book")))
    kept = rows.where(((F.col("line") != "") | (F.col("before") != "")) & F.col("line_no").between(F.col("first"), F.col("last")))
    return kept.select("book", "line_no", "line")


def trim_images(refs: DataFrame, files: DataFrame, least: int = 8192) -> DataFrame:
    """References (book, line_no, name) to files (book, name, size) under `least` bytes; a missing file stays."""
    return refs.join(files, ["book", "name"]).where(F.col("size") < least).select("book", "line_no", "name", "size")


def orphans(files: DataFrame, refs: DataFrame) -> DataFrame:
    """Raster files that no reference names."""
    raster = files.where(F.lower("name").rlike("\\.(jpg|jpeg|png|webp|gif)$"))
    return raster.join(refs.select("book", "name").distinct(), ["book", "name"], "left_anti")


def is_junk_label(line: Column) -> Column:
    return T.strip(line).rlike(rules.JUNK_LABEL)


def is_chunk_mark(line: Column) -> Column:
    return line.rlike("^\\s*<!--\\s*分片")


def counted(text: Column, rule: dict[str, str]) -> list[Column]:
    """Matches of each named pattern."""
    return [F.regexp_count(text, F.lit(p)).alias(n) for n, p in rule.items()]

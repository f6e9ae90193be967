"""Sources: library folders, Markdown books, page texts, JSON; all with fixed schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.functions.text import SPACE

BOOKMARKS = "pdfPages INT, tocEntries INT, chapters ARRAY<STRUCT<title STRING, pdfPage INT, anchor STRING>>, coverEditors ARRAY<STRUCT<kind STRING, names STRING>>"


def listing(spark: SparkSession, root: str, depth: int = 4) -> DataFrame:
    """(path, rel, size) of the files under root, at most depth folders down; contents are never read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", F.col("length").alias("size"))
    base = root.rstrip("/").removeprefix("file://").removeprefix("file:")
    rel = F.element_at(F.split("path", F.lit(base + "/"), 2), -1)
    return files.select("path", rel.alias("rel"), "size").where(F.size(F.split("rel", "/")) - 1 <= depth)


def books(spark: SparkSession, library: str, book: str = "*") -> DataFrame:
    """(book, md_path, text, size) of library/book/book.md; chunk files beside it are no books."""
    rows = spark.read.text(f"{library}/{book}/*.md", wholetext=True).select("value", "_metadata.file_path", "_metadata.file_size")
    part = F.split(F.url_decode("file_path"), "/")
    named = rows.select(F.element_at(part, -2).alias("book"), F.col("file_path").alias("md_path"), F.col("value").alias("text"), F.col("file_size").alias("size"), F.element_at(part, -1).alias("file"))
    return named.where(F.col("file") == F.concat("book", F.lit(".md"))).drop("file")


def page_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(page_no, text) of pNNN.txt files, pages 1 to 999; gaps are skipped."""
    rows = spark.read.text(f"{folder}/p*.txt", wholetext=True).select(F.col("value").alias("text"), "_metadata.file_name")
    return rows.select(F.regexp_extract("file_name", r"^p(\d{3})\.txt$", 1).alias("n"), "text").where("n <> '' and n <> '000'").select(F.col("n").cast("int").alias("page_no"), "text")


def bookmarks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BOOKMARKS).json(path, multiLine=True)


def outline(text: Column) -> Column:
    """[[level, title, page], ...] as an array of structs."""
    return F.transform(F.from_json(text, "array<array<string>>"), lambda x: F.struct(x[0].cast("int").alias("level"), x[1].alias("title"), x[2].cast("int").alias("page")))


def overlay(given: DataFrame, defaults: dict) -> DataFrame:
    """A configuration row over defaults; a missing or null field takes its default."""
    return given.select(*[F.coalesce(F.col(k), F.lit(v)).alias(k) if k in given.columns else F.lit(v).alias(k) for k, v in defaults.items()], *[c for c in given.columns if c not in defaults])


def lines(docs: DataFrame, text: str = "text", keys: tuple[str, ...] = ("book",)) -> DataFrame:
    """(keys, line_no from 1, line); empty lines and a last empty one stay."""
    return docs.select(*keys, F.posexplode(F.split(text, "\n")).alias("pos", "line")).select(*keys, (F.col("pos") + 1).alias("line_no"), "line")


def dealt(rows: DataFrame, count: int, key: str = "book", most: int = 150_000, least: int = 10_000) -> DataFrame:
    """Rows dealt out by key, about `most` to a part at most however many there are; few rows are not cut below `least`."""
    given = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(-(-count // most), min(given, -(-count // least)), 1), key)


def paragraphs(docs: DataFrame, text: str = "text", keys: tuple[str, ...] = ("book",)) -> DataFrame:
    return docs.select(*keys, F.posexplode(F.split(text, "\n\n")).alias("pos", "para")).select(*keys, (F.col("pos") + 1).alias("para_no"), "para")


def pdf_pages(content: Column) -> Column:
    """Pages by page objects or the first page count, whichever is more, from a PDF's bytes as Latin-1 text."""
    return F.greatest(F.regexp_count(content, F.lit("/Type\\s*/Page[^s]")), F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(content, "/Count\\s+([0-9]+)", 1), F.lit("")), F.lit("999999999")).cast("int"), F.lit(0)))


def first_anchor(page: Column) -> Column:
    """The first line of a page of 20 characters or more."""
    return F.get(F.filter(F.transform(F.split(page, "\n"), lambda x: F.regexp_replace(x, f"^{SPACE}+|{SPACE}+$", "")), lambda x: F.length(x) >= 20), F.lit(0))


def cover_editors(pages: DataFrame, first_pages: int = 4) -> DataFrame:
    """(book, kind, names): editors named on the first pages; white space collapsed; the first of each kind and names."""
    from pyspark.sql import Window as W

    from quirework.functions.rules import EDITOR_KINDS

    rows = lines(pages.where(F.col("page_no") <= first_pages), "text", ("book", "page_no"))
    found = rows.select("book", "page_no", "line_no", F.regexp_extract("line", f"^\\s*({EDITOR_KINDS})\\s*[|｜:：]\\s*(.+)$", 1).alias("kind"), F.regexp_replace(F.trim(F.regexp_extract("line", f"^\\s*({EDITOR_KINDS})\\s*[|｜:：]\\s*(.+)$", 2)), f"{SPACE}+", " ").alias("names")).where("kind <> ''")
    place = F.row_number().over(W.partitionBy("book", "kind", "names").orderBy("page_no", "line_no"))
    return found.withColumn("i", place).where("i = 1").drop("i")

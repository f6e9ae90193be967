"""Tables: HTML grids, pipe tables, checks, and guarded replacements."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quirework.functions import text as T
from quirework.operators.structure import back, own, renumber
from quirework.session import workers_import


def cells(html: Column, span_only: bool = False) -> Column:
    """Rows of (txt, rs, cs) of a table's HTML."""
    rows = F.regexp_extract_all(html, F.lit("(?s)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    cell = F.lit("(?s)<t[dh](?:\\s[^>]*)?>.*?</t[dh]>")
    number = lambda x, name: F.coalesce(F.nullif(F.regexp_extract(x, f'^<t[dh][^>]*{name}\\s*=\\s*"?([0-9]+)', 1), F.lit("")).cast("int"), F.lit(1))
    return F.transform(rows, lambda r: F.transform(F.regexp_extract_all(r, cell, F.lit(0)), lambda x: F.struct(T.cell_text(T.sub(T.sub(x, "^<t[dh][^>]*>", ""), "</t[dh]>$", "")).alias("txt"), number(x, "rowspan").alias("rs"), number(x, "colspan").alias("cs"))))


def _layout(rows: list) -> Iterator[tuple[dict[int, str], int]]:
    """Of each row of (txt, rs, cs): its texts by column, and the column after the last that it or a cell from above holds."""
    covered: dict[int, int] = {}
    for row in rows:
        line: dict[int, str] = dict.fromkeys(covered, "")
        below = {c: n - 1 for c, n in covered.items() if n > 1}
        at = 0
        for cell in row:
            while at in line:
                at += 1
            for k in range(cell["cs"]):
                line[at + k] = "" if k else cell.get("txt") or ""
                if cell["rs"] > 1:
                    below[at + k] = cell["rs"] - 1
            at += cell["cs"]
        yield line, max(line, default=-1) + 1
        covered = below


def grid(rows: list) -> list[list[str]]:
    """Rows of (txt, rs, cs) as a rectangle: a cell takes the next free columns; what a span covers is empty."""
    found = list(_layout(rows))
    width = max((reach for _, reach in found), default=0)
    return [[line.get(c, "") for c in range(width)] for line, _ in found]


def expand(tables: DataFrame, rows: str = "rows", out: str = "grid") -> DataFrame:
    """tables with the grid of each; spans carry from row to row, so each table is one Python call, in Arrow batches."""
    workers_import(tables.sparkSession)

    @F.pandas_udf("string")
    def each(column: pd.Series) -> pd.Series:
        return column.map(lambda t: None if t is None else json.dumps(grid(json.loads(t))))

    return tables.withColumn(out, F.from_json(each(F.to_json(rows)), "array<array<string>>"))


def pipe_table(rows: Column) -> Column:
    """A grid as a pipe table with its first row as header."""
    line = lambda r: F.concat(F.lit("| "), F.array_join(r, " | "), F.lit(" |"))
    rule = F.concat(F.lit("|"), F.repeat(F.lit("---|"), F.size(rows[0])))
    return F.array_join(F.concat(F.array(line(rows[0]), rule), F.transform(F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0))), line)), "\n")


def row_spans(line: Column) -> Column:
    """(cs, rs) of the cells that open on a line."""
    number = lambda x, name: F.coalesce(F.nullif(F.regexp_extract(x, f'{name}="([0-9]+)"', 1), F.lit("")).cast("int"), F.lit(1))
    return F.transform(F.regexp_extract_all(line, F.lit("<t[dh][^>]*>"), F.lit(0)), lambda x: F.struct(number(x, "colspan").alias("cs"), number(x, "rowspan").alias("rs")))


def html_widths(lines: DataFrame) -> DataFrame:
    """(book, table_no, line_no, width, expected): rows of HTML tables whose width, spans from above counted, is not
    the first row's; an empty table gives one row with nulls. Table tags stand alone on lines, a row on one line.

    A row's width is that of the row that grid_widths() gives: one table, as far as its rows go, is one array.
    """
    c = T.strip(F.col("line"))
    rows = lines.withColumn("table_no", F.sum((c == "<table>").cast("int")).over(own())).withColumn("ends", F.sum((c == "</table>").cast("int")).over(own()))
    inside = rows.where((F.col("table_no") > F.col("ends")) & ((c == "<table>") | F.col("line").contains("<tr")))
    packed = inside.groupBy("book", "table_no").agg(F.min("line_no").alias("start"), F.array_sort(F.collect_list(F.when(c != "<table>", F.struct("line_no", row_spans(F.col("line")).alias("cells"))))).alias("rows"))
    measured = packed.withColumn("widths", grid_widths(F.transform("rows", lambda r: r["cells"])))
    each = measured.select("book", "table_no", "start", F.col("widths")[0].alias("expected"), F.explode_outer(F.arrays_zip(F.transform("rows", lambda r: r["line_no"]).alias("at"), F.col("widths").alias("width"))).alias("r"))
    empty = F.col("r").isNull()
    return each.where(empty | (F.col("r.width") != F.col("expected"))).select("book", "table_no", F.coalesce("r.at", "start").alias("line_no"), F.col("r.width").alias("width"), F.when(~empty, F.col("expected")).alias("expected"))


def grid_widths(rows: Column) -> Column:
    """How far right each row of (cs, rs) of a table reaches, cells from above counted, by the layout of grid()."""

    @F.pandas_udf("array<int>")
    def each(column: pd.Series) -> pd.Series:
        return column.map(lambda t: [reach for _, reach in _layout(json.loads(t))])

    return each(F.to_json(rows))


def columns_of(line: Column) -> Column:
    return F.size(F.split(T.sub(T.strip(line), "^\\|+|\\|+$", ""), "\\|"))


def pipe_widths(lines: DataFrame) -> DataFrame:
    """(book, line_no, columns, expected): rows after a separator row whose number of columns is not the header's. A
    block of | lines is an island; each separator in it begins a check with the line before it as header."""
    c = F.col("line")
    separator = c.rlike("^\\s*\\|[\\s\\-|:]+\\|\\s*$")
    rows = lines.withColumn("cols", columns_of(c)).withColumn("head", F.lag("cols").over(own())).withColumn("island", F.sum((~c.startswith("|")).cast("int")).over(own()))
    seps = rows.where(separator).select("book", "island", F.col("line_no").alias("at"), F.col("head").alias("expected"))
    body = rows.where(c.startswith("|")).select("book", "island", "line_no", "cols")
    return body.join(seps, ["book", "island"]).where("line_no > at and cols <> expected").select("book", "line_no", F.col("cols").alias("columns"), "expected")


def title_blocks(lines: DataFrame, titles: DataFrame) -> DataFrame:
    """(book, title, line_no, start, end): the | lines after a title that begins exactly one line; blanks and one other
    line may stand between."""
    c = T.strip(F.col("line"))
    rows = lines.withColumn("pipe", F.col("line").startswith("|")).withColumn("island", F.sum((~F.col("line").startswith("|")).cast("int")).over(own()))
    rows = rows.withColumn("t", c).withColumn("full", F.when(c != "", F.struct("line_no", "pipe")))
    rows = rows.withColumn("n1", F.last("full", True).over(back().rowsBetween(W.unboundedPreceding, -1)))
    second = rows.where("full is not null").withColumn("n2", F.lead("full").over(own())).select("book", F.col("line_no").alias("m"), "n2")
    hits = rows.join(titles, "book").where(F.col("t").startswith(F.col("title"))).withColumn("hits", F.count("*").over(W.partitionBy("book", "title"))).where("hits = 1")
    hits = hits.join(second.withColumnRenamed("book", "b2"), (F.col("b2") == F.col("book")) & (F.col("m") == F.col("n1.line_no")), "left")
    start = F.when(F.col("n1.pipe"), F.col("n1.line_no")).when(F.col("n2.pipe"), F.col("n2.line_no"))
    ends = rows.where("pipe").groupBy("book", "island").agg(F.min("line_no").alias("first"), F.max("line_no").alias("end"))
    members = rows.where("pipe").select("book", F.col("line_no").alias("start"), "island").join(ends, ["book", "island"]).select("book", "start", "end")
    return hits.withColumn("start", start).join(members, ["book", "start"]).select("book", "title", "line_no", "start", "end")


def replace_line(lines: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rules (book, ord, old, new, count): a rule applies if as many lines equal old as it says; only the first is
    replaced. Gives the lines and (book, ord, hits, applied)."""
    hits = lines.withColumn("t", T.strip(F.col("line"))).join(rules.withColumn("t", T.strip(F.col("old"))), ["book", "t"]).groupBy("book", "ord").agg(F.min("line_no").alias("at"), F.count("*").alias("hits"))
    outcome = rules.join(hits, ["book", "ord"], "left").withColumn("hits", F.coalesce("hits", F.lit(0))).withColumn("applied", F.col("hits") == F.col("count"))
    new = outcome.where("applied and hits > 0").groupBy("book", F.col("at").alias("line_no")).agg(F.min_by(T.strip(F.col("new")), "ord").alias("put"))
    return lines.join(new, ["book", "line_no"], "left").withColumn("line", F.coalesce("put", "line")).select("book", "line_no", "line"), outcome.select("book", "ord", "hits", "applied")


def replace_run(lines: DataFrame, olds: list[str], news: list[str]) -> DataFrame:
    """The first run of lines that equals olds becomes news, in each book."""
    rows = lines.withColumn("t", T.strip(F.col("line")))
    same = F.lit(True)
    for k, old in enumerate(olds):
        same = same & (F.lead("t", k).over(own()) == old.strip())
    rows = rows.withColumn("same", F.coalesce(same, F.lit(False))).withColumn("at", F.min(F.when(F.col("same"), F.col("line_no"))).over(W.partitionBy("book")))
    kept = rows.where(F.col("at").isNull() | (F.col("line_no") < F.col("at")) | (F.col("line_no") >= F.col("at") + len(olds))).select("book", "line_no", F.lit(-1).alias("sub_no"), "line")
    added = rows.where(F.col("line_no") == F.col("at")).select("book", "line_no", F.posexplode(F.array(*[F.lit(n.strip()) for n in news])).alias("sub_no", "line"))
    return renumber(kept.unionByName(added), "line_no", "sub_no")


def replace_text(text: Column, old: Column, new: Column, count: Column) -> Column:
    """Every occurrence, if there are as many as expected; else the text as it is."""
    found = (F.length(text) - F.length(F.replace(text, old, F.lit("")))) / F.length(old)
    return F.when(found == count, F.replace(text, old, new)).otherwise(text)


def replace_table(lines: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rules (book, title, html): the pipe table after a title that begins exactly one line becomes the lines of html. Gives the
    lines and (book, title, rows, applied): the rows of the old table, null where a rule does not apply. Of rules that meet the same
    table, the first by title counts."""
    found = title_blocks(lines, rules.select("book", "title").distinct())
    first = found.groupBy("book", "start", "end").agg(F.min("title").alias("title"))
    put = first.join(rules.groupBy("book", "title").agg(F.min("html").alias("html")), ["book", "title"])
    spans = put.select("book", F.col("start").alias("from"), F.col("end").alias("to"))
    marks = spans.select("book", F.col("from").alias("line_no"), "to")
    inside = lines.join(marks, ["book", "line_no"], "left").withColumn("upto", F.max("to").over(own().rowsBetween(W.unboundedPreceding, 0)))
    kept = inside.where(F.col("upto").isNull() | (F.col("line_no") > F.col("upto"))).select("book", "line_no", F.lit(-1).alias("sub_no"), "line")
    added = put.select("book", F.col("start").alias("line_no"), F.posexplode(F.split("html", "\n")).alias("sub_no", "line"))
    outcome = rules.join(put.select("book", "title", (F.col("end") - F.col("start") + 1).alias("rows")), ["book", "title"], "left")
    return renumber(kept.unionByName(added), "line_no", "sub_no"), outcome.select("book", "title", "rows", F.col("rows").isNotNull().alias("applied"))

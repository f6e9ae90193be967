"""Operators on the order of lines: headings, merges, insertions, tables of contents. Lines are (book, line_no, line)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quirework.functions import rules, text as T

N = f"[{rules.NUMERALS}]"
N10 = "[一二三四五六七八九十]"


def own():
    return W.partitionBy("book").orderBy("line_no")


def back():
    """From the last line to the first: what is nearest below is last in it, so no frame has to be evaluated anew for each line."""
    return W.partitionBy("book").orderBy(F.desc("line_no"))


def so_far():
    return own().rowsBetween(W.unboundedPreceding, 0)


def before():
    return own().rowsBetween(W.unboundedPreceding, -1)


def renumber(lines: DataFrame, *order: str) -> DataFrame:
    """line_no from 1 without gaps, by the given order."""
    return lines.withColumn("line_no", F.row_number().over(W.partitionBy("book").orderBy(*(order or ("line_no",))))).select("book", "line_no", "line")


def heading_levels(lines: DataFrame) -> DataFrame:
    """The polish cascade: first matching rule wins, only ## lines change level. 一、 goes down only after a section of
    its chapter."""
    c, body = F.col("line"), T.sub(F.col("line"), "^##\\s+", "")
    rows = lines.withColumn("chapter", F.sum(c.rlike(f"^#\\s*第{N}+章").cast("int")).over(so_far()))
    in_chapter = W.partitionBy("book", "chapter").orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("seen", F.max(c.rlike(f"^##\\s*第{N}+节").cast("int")).over(in_chapter))
    section = f"^(#{{1,6}})\\s+(第{N}+节\\s*)[|｜]\\s*(.+)$"
    other = f"^(#{{1,6}})\\s+(第{N}+节)\\s+(.+)$"
    new = (
        F.when(T.strip(c).rlike("^思考题\\s*[：:]?$"), "## 思考题")
        .when(~c.rlike("^#{1,6}\\s"), c)
        .when(c.rlike(f"^#\\s*第{N}+章"), c)
        .when(c.rlike(section), F.concat(F.lit("## "), T.sub(F.regexp_extract(c, section, 2), "\\s+", "　"), F.regexp_extract(c, section, 3)))
        .when(c.rlike(other) & ~c.rlike("^##\\s"), F.concat(F.lit("## "), F.regexp_extract(c, other, 2), F.lit("　"), F.regexp_extract(c, other, 3)))
        .when(c.rlike("^##\\s*(附[：:]|【附)"), c)
        .when(c.rlike(f"^##\\s+{N10}+、"), F.when(F.col("seen") == 1, F.concat(F.lit("### "), body)).otherwise(c))
        .when(c.rlike(f"^##\\s+[（(]{N10}+[）)]"), F.concat(F.lit("#### "), T.sub(body, "^[（(]([^）)]*)[）)]", "（$1）")))
        .when(c.rlike("^##\\s+[0-9]+[.、]"), F.concat(F.lit("##### "), body))
        .when(c.rlike("^##\\s+[（(][0-9]+[）)]"), F.concat(F.lit("##### "), body))
        .when(c.rlike("^##\\s+【"), F.concat(F.lit("#### "), body))
        .when(c.rlike("^##\\s*思考题\\s*[：:]"), "## 思考题")
        .otherwise(T.sub(c, "\\s[|｜]\\s", "　"))
    )
    return rows.withColumn("line", new).select("book", "line_no", "line")


def intro_names(lines: DataFrame) -> DataFrame:
    """Between an editors' introduction and what ends it, short names in ## go down to ###."""
    c = F.col("line")
    start, end = c.rlike("^##\\s*(主编简介|副主编简介)\\s*$"), c.rlike(f"^##\\s*({rules.INTRO_END}|第{N}+章)")
    inside = F.last(F.when(start, 1).when(end, 0), True).over(so_far())
    name = c.rlike("^##\\s+[\\u3400-\\u9fff]{1,4}(\\s[\\u3400-\\u9fff]{1,2})?\\s*$")
    return lines.withColumn("inside", inside).withColumn("line", F.when((F.col("inside") == 1) & ~start & ~end & name, F.concat(F.lit("### "), T.sub(c, "^##\\s+", ""))).otherwise(c)).select("book", "line_no", "line")


def split_glued(lines: DataFrame) -> DataFrame:
    """## N. title body。 becomes a ##### heading and a line of text."""
    pattern, c = "^##\\s+([0-9]+[.、])\\s*(\\S{2,12}?)\\s+(\\S.*[。；，])$", F.col("line")
    glued = c.rlike(pattern) & ~F.regexp_extract(c, pattern, 2).rlike("[（(]")
    parts = F.when(glued, F.array(F.concat(F.lit("##### "), F.regexp_extract(c, pattern, 1), F.lit(" "), F.regexp_extract(c, pattern, 2)), F.regexp_extract(c, pattern, 3))).otherwise(F.array(c))
    return renumber(lines.select("book", "line_no", F.posexplode(parts).alias("sub_no", "line")), "line_no", "sub_no")


def heading_levels_plain(lines: DataFrame) -> DataFrame:
    """The stateless cascade; blanks between Chinese characters of a heading go first."""
    c = F.when(F.col("line").startswith("#"), T.sub(F.col("line"), "(?<=[\\u4e00-\\u9fff]) (?=[\\u4e00-\\u9fff])", "")).otherwise(F.col("line"))
    steps = ((f"^#\\s+(第{N}+节)\\s*[|｜]?\\s*(.*)$", "## $1　$2"), (f"^##\\s+(第{N}+节)\\s*[|｜]\\s*(.*)$", "## $1　$2"), (f"^##\\s+({N10}+)、(.*)$", "### $1、$2"), (f"^##\\s+（({N10}+)）(.*)$", "#### （$1）$2"), ("^##\\s+([0-9]+)[.、]\\s*(.*)$", "##### $1. $2"), ("^##\\s+(【[^】]+】.*)$", "#### $1"))
    out = F.lit(None).cast("string")
    for pattern, to in steps:
        out = F.coalesce(out, F.when(c.rlike(pattern), T.sub(c, pattern, to)))
    return lines.withColumn("line", F.coalesce(out, c))


def split_long(lines: DataFrame) -> DataFrame:
    """A ##### heading is cut at its first gap between Chinese characters; a blank line follows; the number stays."""
    pattern, c = "^(#####\\s+[0-9]+[.、].*?[\\u4e00-\\u9fff])\\s+([\\u4e00-\\u9fff（(].*)$", F.col("line")
    parts = F.when(c.rlike(pattern), F.array(F.regexp_extract(c, pattern, 1), F.lit(""), F.regexp_extract(c, pattern, 2))).otherwise(F.array(c))
    return renumber(lines.select("book", "line_no", F.posexplode(parts).alias("sub_no", "line")), "line_no", "sub_no")


def unique_intro(lines: DataFrame) -> DataFrame:
    """Of repeated introduction headings, the first of each text stays."""
    intro = F.col("line").rlike("^##\\s*(主编简介|副主编简介)\\s*$")
    i = F.row_number().over(W.partitionBy("book", intro, T.strip(F.col("line"))).orderBy("line_no"))
    return lines.withColumn("i", i).where(~intro | (F.col("i") == 1)).select("book", "line_no", "line")


def insert_chapters(lines: DataFrame, marks: DataFrame, length: int = 24) -> DataFrame:
    """A heading and a blank line before the first plain line whose key starts with a bookmark's anchor key; marks are
    (book, ord, title, anchor). Not where the last full line above already is that heading.

    Keys are cut to the anchor's length and joined by equality, one join for all lengths, not tried one by one.
    """
    keyed = marks.withColumn("akey", F.substring(T.anchor_key(F.coalesce("anchor", F.lit(""))), 1, length)).where("akey <> ''").withColumn("n", F.length("akey"))
    rows = lines.withColumn("above", F.last(F.when(T.strip(F.col("line")) != "", T.strip(F.col("line"))), True).over(before()))
    plain = rows.where(~F.col("line").rlike("^#{1,6}\\s")).withColumn("key", T.anchor_key(F.col("line"))).where("key <> ''")
    sizes = keyed.select("book", "n").distinct()
    heads = plain.join(sizes, "book").where(F.length("key") >= F.col("n")).select("book", "line_no", "above", F.expr("substring(key, 1, n)").alias("akey"))
    hit = keyed.join(heads, ["book", "akey"]).groupBy("book", "ord", "title").agg(F.min(F.struct("line_no", "above")).alias("h"))
    new = hit.where(~F.coalesce(F.col("h.above") == F.concat(F.lit("# "), F.col("title")), F.lit(False)))
    added = new.select("book", F.col("h.line_no").alias("line_no"), F.col("ord").alias("sub_no"), F.posexplode(F.array(F.concat(F.lit("# "), "title"), F.lit(""))).alias("part", "line"))
    kept = lines.select("book", "line_no", F.lit(1 << 30).alias("sub_no"), F.lit(0).alias("part"), "line")
    return renumber(kept.unionByName(added), "line_no", "sub_no", "part")


def preface_heading(lines: DataFrame) -> DataFrame:
    """## 前言 before the first paragraph of 60 characters above a signature and a date that stand before 目录."""
    c = T.strip(F.col("line"))
    whole, upto = W.partitionBy("book"), back().rowsBetween(W.unboundedPreceding, 0)
    date, head, sign = c.rlike("^[0-9]{4}\\s*年\\s*[0-9]{1,2}\\s*月\\s*[0-9]{1,2}\\s*日$"), c.rlike("^#{1,6}\\s"), c.rlike("^.{1,18}(大学|医院|学院|研究院|医学院)$")
    count = lambda x: F.coalesce(F.sum(x.cast("int")).over(upto), F.lit(0))
    # Nothing is joined: each step marks lines among those that the one before left, from the last to the first.
    rows = lines.withColumn("toc", F.min(F.when(c.rlike("^#{1,6}\\s*目录$"), F.col("line_no"))).over(whole)).withColumn("left", F.coalesce((F.col("line_no") < F.col("toc")) & (F.trim("line") != ""), F.lit(False)))
    rows = rows.withColumn("left", F.col("left") & (count(F.col("left") & head) == 0))
    rows = rows.withColumn("left", F.col("left") & (count(F.col("left") & date) > 0))
    rows = rows.withColumn("left", F.col("left") & (count(F.col("left")) > 1))  # the last of them is the date
    rows = rows.withColumn("others", count(F.col("left") & ~sign))
    bio = c.rlike("^(男|女)[，,]\\s*[0-9]|^(从|现|获|担|曾|先后|任)\\S{1,4}(教学|任|职|教)")
    signed = F.min(F.when(F.col("left") & (F.col("others") == 0), F.col("line_no"))).over(whole)
    at = F.min(F.when(F.col("left") & (F.col("others") > 0) & (F.length(c) >= 60) & ~bio, F.col("line_no"))).over(whole)
    rows = rows.withColumn("signed", signed).withColumn("at", at)
    here = (F.col("line_no") == F.col("at")) & (F.col("at") < F.col("signed"))
    parts = F.when(here, F.array(F.lit("## 前言"), F.lit(""), "line")).otherwise(F.array("line"))
    return renumber(rows.select("book", "line_no", F.posexplode(parts).alias("sub_no", "line")), "line_no", "sub_no")


CONTINUES = f"[，、；：,;:]{T.SPACE}*$"
BLOCK = f"^(\\||#|\\*\\*|!|- |（|[①②③④⑤⑥⑦⑧⑨⑩])|^[0-9]+[.、]|^{N10}+、"


def merge_continued(lines: DataFrame) -> DataFrame:
    """A line that ends open takes in the next full line unless that begins a block; what is taken in is not tested
    again, so chains pair up: of a run of links, every second is made. Blanks between the two go."""
    c, full = F.col("line"), F.col("line") != ""
    text = F.when(full, F.struct("line", "line_no"))
    open_ = c.rlike(CONTINUES) | T.strip(c).rlike("(分为|包括|如下)$")
    rows = lines.where("line is not null").withColumn("below", F.last(text, True).over(back().rowsBetween(W.unboundedPreceding, -1))).withColumn("next", F.col("below.line")).withColumn("next_no", F.col("below.line_no"))
    rows = rows.withColumn("link", F.coalesce(full & open_ & ~F.col("next").rlike(BLOCK), F.lit(False))).withColumn("n", F.sum(full.cast("int")).over(so_far()))
    odd = (F.col("n") - F.coalesce(F.last(F.when(full & ~F.col("link"), F.col("n")), True).over(before()), F.lit(0))) % 2 == 1
    rows = rows.withColumn("made", F.col("link") & odd)
    rows = rows.withColumn("gone", full & F.coalesce(F.last(F.when(full, F.col("made")), True).over(before()), F.lit(False))).withColumn("upto", F.max(F.when(F.col("made"), F.col("next_no"))).over(before()))
    kept = rows.where(~F.col("gone") & ~(~full & (F.col("line_no") < F.coalesce("upto", F.lit(0)))))
    return kept.select("book", "line_no", F.when(F.col("made"), F.concat("line", T.sub(F.col("next"), f"^{T.SPACE}+", ""))).otherwise(c).alias("line"))


def with_entries(lines: DataFrame) -> DataFrame:
    """lines with first, the line of the first chapter, and entry of each heading of level 3 or less from there on."""
    c = F.col("line")
    rows = lines.withColumn("first", F.min(F.when(c.rlike(f"^#\\s*第{N}+章"), F.col("line_no"))).over(W.partitionBy("book")))
    rows = rows.withColumn("level", F.length(F.regexp_extract(c, "^(#{1,6})\\s+.+$", 1))).withColumn("title", T.strip(F.regexp_extract(c, "^#{1,6}\\s+(.+?)\\s*$", 1)))
    shown = (F.col("line_no") >= F.col("first")) & F.col("level").between(1, 3) & ~F.col("title").rlike("^(思考题|【知识要点】|本章数字资源)")
    return rows.withColumn("entry", F.when(shown, F.concat(F.expr("repeat('  ', level - 1)"), F.lit("- ["), "title", F.lit("](#"), T.slug(F.col("title")), F.lit(")"))))


def toc(lines: DataFrame) -> DataFrame:
    """(book, line_no, entry): links to the headings of level 3 or less from the first chapter on."""
    return with_entries(lines).where("entry is not null").select("book", "line_no", "entry")


def rebuild_toc(lines: DataFrame) -> DataFrame:
    """Lines with 目录 up to the first chapter replaced by the linked table of contents; books without both stay. Each line
    gives what becomes of it and its entry, so lines are read once."""
    rows = with_entries(lines).withColumn("at", F.min(F.when(T.strip(F.col("line")).rlike("^#{1,6}\\s*目录$"), F.col("line_no"))).over(W.partitionBy("book")))
    ok = F.coalesce(F.col("at") < F.col("first"), F.lit(False))
    part = lambda a, b, line: F.struct(a.alias("a"), F.lit(b).cast("int").alias("b") if isinstance(b, int) else b.cast("int").alias("b"), line.alias("line"))
    at, no = F.col("at"), F.col("line_no")
    kept = F.when(~ok | (no < at) | (no >= F.col("first")), F.array(part(no, 0, F.col("line")))).when(no == at, F.array(part(at, -2, F.lit("# 目录")), part(at, -1, F.lit("")), part(at, 1 << 30, F.lit("")))).otherwise(F.array().cast("array<struct<a:int,b:int,line:string>>"))
    parts = F.when(ok & F.col("entry").isNotNull(), F.concat(kept, F.array(part(at, no, F.col("entry"))))).otherwise(kept)
    return renumber(rows.select("book", F.explode(parts).alias("e")).select("book", "e.*"), "a", "b")


def outline_toc(outline: DataFrame, lines: DataFrame) -> DataFrame:
    """(book, ord, entry): outline rows (book, ord, level, title) of level 3 or less, each under the first body heading of
    the same key."""
    heads = lines.where(F.col("line").rlike("^#{1,6}\\s+")).select("book", "line_no", F.regexp_extract("line", "^#{1,6}\\s+(.*)$", 1).alias("head"))
    heads = heads.withColumn("key", T.match_key(F.col("head"))).where("key <> ''").groupBy("book", "key").agg(F.min_by("head", "line_no").alias("head"))
    clean = T.sub(T.sub(T.strip(F.col("title")), f"{T.SPACE}+", " "), " ", "　")
    rows = outline.where((F.col("level") <= 3) & ~T.strip(F.col("title")).isin("目录", "封底页")).withColumn("t", clean).withColumn("key", T.match_key(F.col("t")))
    shown = T.sub(T.sub(F.coalesce("head", "t"), "[|｜]", "　"), "(?<=[\\u4e00-\\u9fff]) (?=[\\u4e00-\\u9fff])", "")
    joined = rows.join(heads, ["book", "key"], "left").withColumn("shown", shown)
    return joined.select("book", "ord", F.concat(F.expr("repeat('  ', level - 1)"), F.lit("- ["), "shown", F.lit("](#"), T.anchor(F.col("shown")), F.lit(")")).alias("entry"))


def front_images(lines: DataFrame) -> DataFrame:
    """Image lines before the first chapter without a caption in the next three lines become blank."""
    c = F.col("line")
    caption = T.strip(c).rlike("^图\\s*[0-9]+\\s*[-－]\\s*[0-9]+").cast("int")
    rows = lines.withColumn("first", F.min(F.when(c.rlike(f"^#\\s*第{N}+章"), F.col("line_no"))).over(W.partitionBy("book"))).withColumn("near", F.max(caption).over(own().rowsBetween(1, 3)))
    gone = c.rlike("^!\\[[^\\]]*\\]\\(images/") & (F.col("line_no") < F.col("first")) & (F.coalesce("near", F.lit(0)) == 0)
    return rows.withColumn("line", F.when(gone, "").otherwise(c)).select("book", "line_no", "line")


def strip_page_numbers(line: Column) -> Column:
    return T.sub(line, "\\s*……\\s*[0-9]+\\s*$", "")


def drop_between(lines: DataFrame, start: str, end: str) -> DataFrame:
    """Lines from the first that equals `start` up to the first that equals `end` go, if they stand in that order."""
    c, whole = T.strip(F.col("line")), W.partitionBy("book")
    rows = lines.withColumn("b", F.min(F.when(c == end, F.col("line_no"))).over(whole)).withColumn("a", F.min(F.when(c == start, F.col("line_no"))).over(whole))
    gone = F.coalesce((F.col("line_no") >= F.col("a")) & (F.col("line_no") < F.col("b")), F.lit(False))
    return rows.where(~gone).select("book", "line_no", "line")


def insert_at_phrases(lines: DataFrame, phrases: DataFrame) -> DataFrame:
    """A heading and a blank line before the first line that begins with a phrase; phrases are (book, ord, phrase, title). Phrases
    that no line begins with give nothing; empty ones are left out."""
    asked = phrases.where("phrase <> ''").withColumn("n", F.length("phrase"))
    starts = lines.join(asked.select("book", "n").distinct(), "book").select("book", "line_no", F.expr("left(line, n)").alias("phrase"))
    first = asked.join(starts, ["book", "phrase"]).groupBy("book", "ord", "title").agg(F.min("line_no").alias("line_no"))
    added = first.select("book", "line_no", F.col("ord").alias("sub_no"), F.posexplode(F.array(F.concat(F.lit("# "), "title"), F.lit(""))).alias("part", "line"))
    kept = lines.select("book", "line_no", F.lit(1 << 30).alias("sub_no"), F.lit(0).alias("part"), "line")
    return renumber(kept.unionByName(added), "line_no", "sub_no", "part")


def media_lines(lines: DataFrame) -> DataFrame:
    """Without image references and lines that announce digital extras; captions of figures and tables with a text in bold."""
    c = T.strip(F.col("line"))
    gone = (c.startswith("![") & F.col("line").contains("images/")) | c.isin(*rules.MEDIA_LINES)
    figure, table = "^图\\s*([0-9]+-[0-9]+[A-Z]?)\\s*[　 \u2002\u2003\\t]+(.+)$", "^(表[0-9]+-[0-9]+[A-Z]?)[\\s　]*(.+)$"
    bold = lambda name, pattern: F.concat(F.lit("**"), name, F.lit("　"), T.strip(F.regexp_extract(c, pattern, 2)), F.lit("**"))
    new = F.when(F.col("line").startswith("**"), F.col("line")).when(c.rlike(figure), bold(F.concat(F.lit("图"), F.regexp_extract(c, figure, 1)), figure)).when(c.rlike(table), bold(F.regexp_extract(c, table, 1), table)).otherwise(F.col("line"))
    return lines.where(~gone).withColumn("line", new)

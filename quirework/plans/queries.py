"""Queries of the library's operators over the driver's tables, each with SQL of the same result where SQL can say it.

The tables hold no Markdown books, so most queries derive one from them; the deriving SQL runs in both engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.functions import rules
from quirework.functions import text as T
from quirework.operators import audit, figures, library, structure, tables
from quirework.sources import files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

#: Lines of books of some 2,000 lines, more books where there are more rows: headings of all kinds, blanks, captions, images and open or closed text.
BOOK_LINES = """select book, cast(line_no as int) as line_no, case kind
 when 0 then concat('# 第',num,'章　T',n)  when 1 then concat('## 第',num,'节 | S',n) when 2 then concat('## ',num,'、A',n)
 when 3 then concat('## （',num,'）B',n)   when 4 then concat('## ',n,'. C',n)       when 5 then concat('## 【D',n,'】')
 when 6 then ''                            when 7 then concat('图',n,'-',kk,' cap')   when 8 then concat('![](images/',md5(cast(pk as varchar(20))),'.jpg)')
 else concat('p',pk,case when n%3=0 then '，' when n%3=1 then '。' else '分为' end) end as line
from (select concat('b',cast(cast(floor(l_orderkey/500) as int) as varchar(20))) as book,
  row_number() over (partition by floor(l_orderkey/500) order by l_orderkey,l_linenumber,l_partkey,l_suppkey,l_extendedprice) as line_no,
  (l_partkey*7+l_linenumber)%10 as kind, substring('一二三四五六七八九十', cast(1+l_suppkey%10 as int),1) as num,
  l_suppkey%9+1 as n, l_linenumber as kk, l_partkey as pk from {lineitem}) q"""
BOOK = "concat('b',cast(cast(floor(l_orderkey/500) as int) as varchar(20)))"
NOTATION = """select o_orderkey, concat('Na+ pNa+ HCO3- ',cast(o_custkey%30 as varchar(9)),':',cast(o_orderkey%70 as varchar(9)),' SO4 2- ',cast(o_orderkey%5 as varchar(9)),'x',cast(o_custkey%7 as varchar(9)),'，<sub>',cast(o_orderkey%10 as varchar(9)),'</sub>') as t from {orders}"""
IMAGES = "select distinct concat('b',cast(cast(floor(l_orderkey/500) as int) as varchar(20))) as book, concat(md5(cast(l_partkey as varchar(20))),'.jpg') as name, cast(l_partkey%50*500 as bigint) as size from {lineitem} where l_linenumber <= 3"
#: All lines of all documents as paragraphs, some as headings, some with variant characters; and one over each two documents of a source.
PARAS = """select * from (select doc_id*100000+i as para_no, book, case when i%5=4 then concat('# ',line) when doc_id%3=1 then replace(line,'e','é') else line end as para from (select doc_id, source as book, {split}) p
 union all select doc_id*100000+99999, book, concat(right(text,40),' ',left(nx,30)) from (select doc_id, source as book, text, lead(text) over (partition by source order by doc_id) as nx from {documents}) d where nx is not null) q"""
PARAS_HERE = PARAS.replace("{split}", "i, line from {documents} lateral view posexplode(split(text, '\\\\n')) x as i, line").replace("text, lead(text)", "right(text,40) as text, lead(left(text,30))")  # ends of texts are sorted, not texts
PARAS = PARAS.replace("{split}", "unnest(range(0,len(string_split(text,chr(10))))) as i, unnest(string_split(text,chr(10))) as line from {documents}")
TASKS = "select o_orderkey as task, concat('batch',cast(o_custkey%20 as varchar(9))) as batch, concat('f',cast(o_orderkey%40 as varchar(9))) as data_id from {orders}"
RESULTS = "select event_id as rid, concat('batch',cast(user_id%20 as varchar(9))) as batch, concat('f',cast(event_id%50 as varchar(9))) as data_id, case when event_type='purchase' then 'done' when event_type='error' then 'error' else 'running' end as state from {events}"
PIPES = "select concat('t',cast(n_regionkey as varchar(3))) as book, cast(row_number() over (partition by n_regionkey order by k, n_nationkey) as int) as line_no, line from (select n_regionkey, 0 as k, -1 as n_nationkey, '| h | g |' as line from {nation} group by n_regionkey union all select n_regionkey, 1, -1, '|---|---|' from {nation} group by n_regionkey union all select n_regionkey, 2, n_nationkey, case when n_nationkey%4=0 then concat('| ',n_name,' | a |') when n_nationkey%4=1 then concat('| ',n_name,' |') else concat('|',n_name,'|b|') end from {nation}) q"


def here(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Deriving SQL over the tables of a folder."""
    for name in NAMES:
        sql = sql.replace("{" + name + "}", f"parquet.`{sf_dir}/{name}.parquet`")
    return spark.sql(sql.replace("varchar(20)", "string").replace("varchar(9)", "string").replace("varchar(3)", "string"))


def there(sql: str) -> str:
    for name in NAMES:
        sql = sql.replace("{" + name + "}", name)
    return sql


LINES = f"({there(BOOK_LINES)})"


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE[f.__name__] = there(oracle)
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def book_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BOOK_LINES, numbered by book, which says the same as the number that a book is named after: all of a book then is where it is numbered, so it is dealt out
    once, in as many parts as there are rows for."""
    rows = read(spark, sf_dir, "lineitem")
    named = rows.select(F.expr(BOOK.replace("varchar(20)", "string")).alias("book"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    sql = BOOK_LINES.replace(f"{BOOK} as book", "book").replace("partition by floor(l_orderkey/500)", "partition by book")
    return spark.sql(sql.replace("varchar(20)", "string"), lineitem=files.dealt(named, rows.count()))


@query("""with l as (select source as book, doc_id as file, unnest(range(1, len(string_split(text, chr(10))) + 1)) as line_no, unnest(string_split(text, chr(10))) as line from documents),
h as (select *, row_number() over (partition by book order by line_no, file) as i from l where contains(lower(line), 'the')),
k as (select * from h where i <= 5)
select book, file, cast(line_no as int) as line_no, substring(line, 1, 300) as line, (select count(*) from k) as total from k order by line_no desc, book, file limit 20""")
def ag1_search(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select(F.col("source").alias("book"), F.col("doc_id").alias("file"), "text")
    return library.search(files.lines(docs, keys=("book", "file")), "the")


@query("select doc_id, cast(unnest(range(1, len(string_split(text, chr(10))) + 1)) as int) as line_no, md5(unnest(string_split(text, chr(10)))) as line_md5 from documents")
def sc4_lines(spark, sf_dir):
    return files.lines(read(spark, sf_dir, "documents"), keys=("doc_id",)).select("doc_id", "line_no", F.md5("line").alias("line_md5"))


@query(f"with h as (select book, line_no, len(regexp_extract(line, '^(#+)', 1)) as level, trim(regexp_extract(line, '^#+\\s+(.*)$', 1)) as title, row_number() over (partition by book order by line_no) as i from {LINES} where regexp_matches(line, '^#{{1,4}}\\s')) select book, line_no, cast(level as int) as level, title from h where i <= 500")
def ag2_headings(spark, sf_dir):
    return library.headings(book_lines(spark, sf_dir))


@query("with p as (select concat('k', cast(p_partkey as varchar)) as book, cast(greatest(p_partkey % 900, 1) as int) as pages from part), s as (select book, pages, unnest(generate_series(1, pages, 200)) as s from p) select book, cast(s as int) as \"start\", cast(least(s + 199, pages) as int) as \"end\", case when pages > 200 then concat(s, '-', least(s + 199, pages)) end as label from s")
def ag3_chunk_plan(spark, sf_dir):
    return library.chunk_plan(here(spark, sf_dir, "select concat('k', cast(p_partkey as varchar(20))) as book, cast(greatest(p_partkey % 900, 1) as int) as pages from {part}"))


@query("select o_orderkey, concat('f', row_number() over (order by o_orderkey) - 1) as data_id, cast(floor((row_number() over (order by o_orderkey) - 1) / 40) as bigint) as batch from orders")
def ag4_batches(spark, sf_dir):
    return library.batches(read(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])


@query(f"with t as ({TASKS}), r as (select *, row_number() over (partition by batch, data_id order by rid) as i from ({RESULTS})) select t.task, t.batch, t.data_id, case when r.state = 'error' then 'failed' else coalesce(r.state, 'running') end as state from t left join (select * from r where i = 1) r on t.batch = r.batch and t.data_id = r.data_id")
def ag5_poll(spark, sf_dir):
    return library.poll(here(spark, sf_dir, TASKS), here(spark, sf_dir, RESULTS), "rid").select("task", "batch", "data_id", "state")


@query("select concat('b', cast(o_custkey % 300 as varchar)) as book, count(*) as tasks from orders group by 1 having bool_and(o_orderkey % 3 > 0 or o_orderstatus = 'F') and bool_or(o_orderkey % 3 > 0)")
def ag6_ready_books(spark, sf_dir):
    rows = here(spark, sf_dir, "select concat('b', cast(o_custkey % 300 as varchar(20))) as book, o_orderkey % 3 > 0 as fetched, case when o_orderstatus = 'F' then 'failed' else 'done' end as state from {orders}")
    return library.ready_books(rows)


@query("with n as (select o_orderkey, regexp_extract_all(t, 'Na\\+') as a, regexp_extract_all(t, '[0-9]x[0-9]') as m from ({N}) q) select sum(len(a)) as sodium, sum(len(m)) as products, count(*) as texts from n".replace("{N}", NOTATION))
def ag7_counters(spark, sf_dir):
    rows = here(spark, sf_dir, NOTATION).select(*library.counted(F.col("t"), {"sodium": "Na\\+", "products": "[0-9]x[0-9]"}))
    return rows.agg(F.sum("sodium").alias("sodium"), F.sum("products").alias("products"), F.count("*").alias("texts"))


@query("with f as (select p_partkey % 50 as task, concat(p_name, '-', p_partkey, case when p_partkey % 3 = 0 then '.MD' else '.md' end) as path, cast(p_size as bigint) as size from part) select task, max(struct_pack(size := size, path := path)).path as path, max(size) as size, count(*) as candidates from f group by task")
def sk1_largest_md(spark, sf_dir):
    return library.largest(here(spark, sf_dir, "select p_partkey % 50 as task, concat(p_name, '-', p_partkey, case when p_partkey % 3 = 0 then '.MD' else '.md' end) as path, cast(p_size as bigint) as size from {part}"))


@query("with f as (select p_partkey % 5 as book, concat('d', p_partkey, '/', p_brand, '.jpg') as rel, concat(p_brand, '.jpg') as name from part), n as (select *, row_number() over (partition by book, name order by rel) - 1 as i from f) select book, rel, name, case when i = 0 then name else concat(i, '-', name) end as final from n")
def sk2_collision(spark, sf_dir):
    return library.flatten_names(here(spark, sf_dir, "select p_partkey % 5 as book, concat('d', p_partkey, '/', p_brand, '.jpg') as rel from {part}"))


@query("with c as (select o_custkey % 50 as book, o_orderkey as s, concat(o_orderpriority, ' ', o_orderkey) as text, row_number() over (partition by o_custkey % 50 order by o_orderkey) as n from orders) select book, md5(string_agg(concat('<!-- 分片 ', n, ' 开始 -->', chr(10), chr(10), text, chr(10), chr(10), '<!-- 分片 ', n, ' 结束 -->'), chr(10) order by n)) as text_md5, count(*) as chunks from c group by book")
def sk4_merge(spark, sf_dir):
    return library.merge_chunks(here(spark, sf_dir, "select o_custkey % 50 as book, o_orderkey as start, concat(o_orderpriority, ' ', o_orderkey) as text from {orders}")).select("book", F.md5("text").alias("text_md5"), "chunks")


@query(f"with l as {LINES}, d as (select book, sum(len(line)) as size from l group by book), h as (select book, line_no, trim(regexp_extract(line, '^#+\\s+(.*)$', 1)) as title, row_number() over (partition by book order by line_no) as i from l where regexp_matches(line, '^#{{1,4}}\\s')), s as (select book, count(*) as headings, string_agg(case when i <= 200 then title end, '|' order by line_no) as titles from h where i <= 500 group by book) select d.book, cast(floor(size / 1024.0 + 0.5) as bigint) as kb, coalesce(headings, 0) as headings, coalesce(titles, '') as titles from d left join s on d.book = s.book")
def sk5_index(spark, sf_dir):
    lines = book_lines(spark, sf_dir)
    return library.index(lines.groupBy("book").agg(F.sum(F.length("line")).alias("size")), library.headings(lines))


@query(r"select doc_id, md5(regexp_replace(regexp_replace(regexp_replace(replace(text, '. ', concat('. ', chr(9), repeat(chr(10), 4))), '(?m)[ \t]+$', '', 'g'), '\n{3,}', concat(chr(10), chr(10)), 'g'), '\s+$', '') || chr(10)) as text_md5 from documents")
def sk6_blank_collapse(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(library.collapse_blank(F.replace("text", F.lit(". "), F.lit(". \t\n\n\n\n")))).alias("text_md5"))


@query("select p_partkey, concat('<' , p_name, '>: ', p_type) as raw, trim(regexp_replace(regexp_replace(substring(concat('<' , p_name, '>: ', p_type), 1, 400), '[<>:\"/\\\\|?*\\x00-\\x1f]', '_', 'g'), '\\s+', ' ', 'g')) as safe from part")
def pj1_sanitize(spark, sf_dir):
    rows = here(spark, sf_dir, "select p_partkey, concat('<' , p_name, '>: ', p_type) as raw from {part}")
    return rows.select("p_partkey", "raw", T.safe_name(F.col("raw")).alias("safe"))


@query("select page_id, string_split(url, '/')[-1] as base, lower(regexp_extract(url, '(\\.[^./\\\\]+)$', 1)) as ext from pages")
def pj2_ext(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", F.element_at(F.split("url", "/"), -1).alias("base"), T.extension(F.col("url")).alias("ext"))


H1 = "regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)"


@query(f"select page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower({H1}), '[^\\p{{L}}\\p{{N}}\\-\\s]', '', 'g'), '\\s+', '-', 'g'), '-+', '-', 'g'), '^-|-$', '', 'g') as slug from pages")
def pj3_slug(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", T.slug(F.expr(H1.replace("\\", "\\\\"))).alias("slug"))


@query(f"select page_id, lower(regexp_replace(regexp_replace(replace(replace(regexp_replace(trim(concat({H1}, ' _(A b)')), '[^\\p{{L}}\\p{{N}}_\\-\\s]', '', 'g'), '　', '-'), ' ', '-'), '-+', '-', 'g'), '^-+|-+$', '', 'g')) as anchor from pages")
def pj4_anchor(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", T.anchor(F.concat(F.expr(H1.replace("\\", "\\\\")), F.lit(" _(A b)"))).alias("anchor"))


@query(f"select page_id, regexp_replace(lower({H1}), '[\\s　，。、；：？！（）()【】《》“”\"''‘’「」·…—\\-.,/\\\\|]+', '', 'g') as key from pages")
def pj5_key(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", T.match_key(F.expr(H1.replace("\\", "\\\\"))).alias("key"))


@query(f"select o_orderkey, concat(split_part(t, '<sub>', 1), translate(regexp_extract(t, '<sub>([^<]*)</sub>', 1), '0123456789', '₀₁₂₃₄₅₆₇₈₉')) as out from ({NOTATION}) q")
def pj7_supsub(spark, sf_dir):
    return here(spark, sf_dir, NOTATION).select("o_orderkey", T.sup_sub(F.col("t")).alias("out"))


def _ions_sql() -> str:
    out = "t"
    for pattern, to in rules.IONS:
        out = f"regexp_replace({out}, '(^|[^A-Za-z0-9]){pattern}($|[^A-Za-z0-9])', '\\1{to}\\2', 'g')"
    return f"select o_orderkey, {out} as out from ({NOTATION}) q"


@query(_ions_sql())
def pj10_ions(spark, sf_dir):
    return here(spark, sf_dir, NOTATION).select("o_orderkey", T.ions(F.col("t")).alias("out"))


@query(f"with n as (select o_orderkey, t, regexp_extract(t, ' ([0-9]+):([0-9]+) ', 1) as a, regexp_extract(t, ' ([0-9]+):([0-9]+) ', 2) as b from ({NOTATION}) q) select o_orderkey, case when len(a) <= 2 and regexp_matches(b, '^[0-5][0-9]$') then t else replace(t, concat(a, ':', b), concat(a, '∶', b)) end as out from n")
def pj11_ratio(spark, sf_dir):
    return here(spark, sf_dir, NOTATION).select("o_orderkey", T.ratio(F.col("t")).alias("out"))


@query(f"select o_orderkey, regexp_replace(regexp_replace(t, '([0-9])\\s*[xX]\\s*([0-9])', '\\1×\\2', 'g'), '([0-9])\\s*[xX]\\s*([0-9])', '\\1×\\2', 'g') as out from ({NOTATION}) q")
def pj13_mul(spark, sf_dir):
    return here(spark, sf_dir, NOTATION).select("o_orderkey", T.times(F.col("t")).alias("out"))


@query("select o_orderkey, case when o_orderkey % 3 = 0 then concat('x', chr(10), '**表', o_orderkey % 9, '-', o_custkey % 9, '　', o_orderpriority, '**') else concat('见表', o_orderkey % 9, '-1 y') end as out from orders")
def pj14_title_bold(spark, sf_dir):
    rows = here(spark, sf_dir, "select o_orderkey, case when o_orderkey % 3 = 0 then concat('x', chr(10), '表 ', o_orderkey % 9, '-', o_custkey % 9, ' ', o_orderpriority) else concat('见表', o_orderkey % 9, '-1 y') end as t from {orders}")
    return rows.select("o_orderkey", T.bold_titles(F.col("t")).alias("out"))


def _fold_sql(column: str, folds: tuple) -> str:
    out = f"translate(replace({column}, '*', ''), '{rules.FOLD_FROM}', '{rules.FOLD_TO.replace(chr(39), chr(39) * 2)}')"
    for a, b in folds:
        out = f"replace({out}, '{a}', '{b}')"
    for i, c in enumerate(rules.CIRCLED, 1):
        out = f"replace({out}, '{c}', '{i})')"
    return out


FOLDED = "select o_orderkey, concat(t, '*β*①≥½（x）') as t from ({N}) q".replace("{N}", NOTATION)


@query(f"select o_orderkey, {_fold_sql('t', rules.STRICT_FOLDS)} as strict, {_fold_sql('t', rules.LENIENT_FOLDS)} as lenient from ({FOLDED}) q")
def pj15_fold(spark, sf_dir):
    return here(spark, sf_dir, FOLDED).select("o_orderkey", T.fold_strict(F.col("t")).alias("strict"), T.fold_lenient(F.col("t")).alias("lenient"))


@query("select doc_id, md5(concat(text, chr(10), 'z')) as out from documents")
def pj18_page_clean(spark, sf_dir):
    page = F.concat(F.lit("12\n第一章 绪论\n"), F.replace("text", F.lit("\n"), F.lit("\n 7 \n")), F.lit("\n本章数字资源 | 12z"))
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(T.clean_page(page)).alias("out"))


@query("select o_orderkey, concat('x（*alpha beta*，', 'AB', o_orderkey % 9, '）') as out from orders")
def pj22_italic(spark, sf_dir):
    return here(spark, sf_dir, "select o_orderkey, concat('x（alpha beta，AB', o_orderkey % 9, '）') as t from {orders}").select("o_orderkey", T.italic_terms(F.col("t")).alias("out"))


@query("select o_orderkey, o_orderkey % 2 = 0 as junk from orders")
def fl3_junk(spark, sf_dir):
    rows = here(spark, sf_dir, "select o_orderkey, case when o_orderkey % 4 = 0 then ' 视频 ' when o_orderkey % 4 = 2 then concat('数字人案例', o_orderkey) else '视频课' end as t from {orders}")
    return rows.select("o_orderkey", library.is_junk_label(F.col("t")).alias("junk"))


@query(f"with l as {LINES}, m as (select *, min(case when regexp_matches(line, '^#\\s*第[一二三四五六七八九十百]+章') then line_no end) over (partition by book) as f, max(case when regexp_matches(line, '^图\\s*[0-9]+\\s*[-－]\\s*[0-9]+') then 1 else 0 end) over (partition by book order by line_no rows between 1 following and 3 following) as near from l) select book, line_no, case when regexp_matches(line, '^!\\[') and line_no < f and coalesce(near, 0) = 0 then '' else line end as line from m")
def fl7_front_images(spark, sf_dir):
    return structure.front_images(book_lines(spark, sf_dir))


REFS = f"(select book, line_no, regexp_extract(line, 'images/([^)\\s]+)', 1) as name from {LINES} where regexp_matches(line, '^!\\['))"


def refs(spark, sf_dir) -> DataFrame:
    lines = book_lines(spark, sf_dir).where(F.col("line").rlike(library.IMAGE))
    return lines.select("book", "line_no", F.regexp_extract("line", library.IMAGE, 1).alias("name"))


@query(f"select r.book, r.line_no, r.name, f.size from {REFS} r join ({IMAGES}) f on r.book = f.book and r.name = f.name where f.size < 8192")
def fl8_trim(spark, sf_dir):
    return library.trim_images(refs(spark, sf_dir), here(spark, sf_dir, IMAGES))


@query(f"with l as {LINES}, c as (select *, sum(case when regexp_matches(line, '^#\\s*第[一二三四五六七八九十百]+章') then 1 else 0 end) over (partition by book order by line_no) as ch from l), s as (select *, max(case when regexp_matches(line, '^##\\s*第[一二三四五六七八九十百]+节') then 1 else 0 end) over (partition by book, ch order by line_no) as seen from c) select book, line_no, case when not regexp_matches(line, '^#') then line when regexp_matches(line, '^## 第') then replace(line, '节 | ', '节　') when regexp_matches(line, '^## [一二三四五六七八九十]+、') then case when seen = 1 then concat('#', line) else line end when regexp_matches(line, '^## （') then concat('##', line) when regexp_matches(line, '^## [0-9]') then concat('###', line) when regexp_matches(line, '^## 【') then concat('##', line) else line end as line from s")
def sq1_levels(spark, sf_dir):
    return structure.heading_levels(book_lines(spark, sf_dir))


INTRO = "select concat('b', cast(o_custkey % 20 as varchar(20))) as book, cast(row_number() over (partition by o_custkey % 20 order by o_orderkey) as int) as line_no, case o_orderkey % 7 when 0 then '## 主编简介' when 3 then '## 前言' when 5 then '## 王 某' when 6 then '## 李四五六七' else '## 张三' end as line from {orders}"


@query(f"with l as ({INTRO}), s as (select *, last_value(case line when '## 主编简介' then 1 when '## 前言' then 0 end ignore nulls) over (partition by book order by line_no rows between unbounded preceding and current row) as inside from l) select book, line_no, case when inside = 1 and line in ('## 王 某', '## 张三') then concat('#', line) else line end as line from s")
def sq2_intro(spark, sf_dir):
    return structure.intro_names(here(spark, sf_dir, INTRO))


GLUED = "select concat('b', cast(o_custkey % 20 as varchar(20))) as book, cast(row_number() over (partition by o_custkey % 20 order by o_orderkey) as int) as line_no, case o_orderkey % 3 when 0 then concat('## ', o_orderkey % 9, '. 子宫韧带 共有', o_orderkey, '对。') else concat('正文', o_orderkey) end as line from {orders}"


@query(f"with l as ({GLUED}), e as (select book, line_no, 0 as sub, case when line like '##%' then concat('##### ', regexp_extract(line, '([0-9]+\\.)', 1), ' 子宫韧带') else line end as line from l union all select book, line_no, 1, regexp_extract(line, '(共有.*)$', 1) from l where line like '##%') select book, cast(row_number() over (partition by book order by line_no, sub) as int) as line_no, line from e")
def sq3_split(spark, sf_dir):
    return structure.split_glued(here(spark, sf_dir, GLUED))


@query(f"select book, line_no, case when regexp_matches(line, '^## 第') then replace(line, '节 | ', '节　') when regexp_matches(line, '^## [一二三四五六七八九十]+、') then concat('#', line) when regexp_matches(line, '^## （') then concat('##', line) when regexp_matches(line, '^## [0-9]') then concat('###', line) when regexp_matches(line, '^## 【') then concat('##', line) else line end as line from {LINES}")
def sq4_levels_md(spark, sf_dir):
    return structure.heading_levels_plain(book_lines(spark, sf_dir))


@query(f"with l as ({INTRO}), i as (select *, row_number() over (partition by book, line order by line_no) as i from l) select book, line_no, line from i where line <> '## 主编简介' or i = 1")
def sq6_dedup(spark, sf_dir):
    return structure.unique_intro(here(spark, sf_dir, INTRO))


MARKS = "select concat('b', cast(n_nationkey as varchar(20))) as book, k as ord, concat('第', k, '章　X') as title, concat('p', n_nationkey * 10 + k, '，') as anchor from {nation}, (select 1 as k union all select 2 union all select 3) t"


@query(f"with l as {LINES}, m as ({MARKS}), h as (select m.book, m.ord, m.title, min(l.line_no) as hit from m join l on l.book = m.book and l.line not like '#%' and starts_with(regexp_replace(l.line, '[\\s　，。；：、（）(),.;:''\"!?]', '', 'g'), regexp_replace(m.anchor, '[，]', '', 'g')) group by 1, 2, 3), e as (select book, line_no, 1000000 as s, 0 as p, line from l union all select book, hit, ord, 0, concat('# ', title) from h union all select book, hit, ord, 1, '' from h) select book, cast(row_number() over (partition by book order by line_no, s, p) as int) as line_no, line from e")
def sq7_chapters(spark, sf_dir):
    return structure.insert_chapters(book_lines(spark, sf_dir), here(spark, sf_dir, MARKS))


@query(f"""with l as {LINES}, f as (select *, lead(line) over w as nx, lead(line_no) over w as nn from l where line <> '' window w as (partition by book order by line_no)),
k as (select *, coalesce((regexp_matches(line, '[，、；：,;:]\\s*$') or regexp_matches(line, '(分为|包括|如下)$')) and nx is not null and not regexp_matches(nx, '^(\\||#|\\*\\*|!|- |（|[①②③④⑤⑥⑦⑧⑨⑩])|^[0-9]+[.、]|^[一二三四五六七八九十]+、'), false) as link from f),
r as (select *, sum(case when link then 0 else 1 end) over (partition by book order by line_no) - case when link then 0 else 1 end as run from k),
o as (select *, link and row_number() over (partition by book, run order by line_no) % 2 = 1 as made from r),
g as (select *, coalesce(lag(made) over (partition by book order by line_no), false) as gone from o),
b as (select book, line_no, made, gone, nn, case when made then concat(line, nx) else line end as line from g union all select book, line_no, false, false, null, line from l where line = ''),
u as (select *, max(case when made then nn end) over (partition by book order by line_no rows between unbounded preceding and 1 preceding) as upto from b)
select book, line_no, line from u where not gone and not (line = '' and line_no < coalesce(upto, 0))""")
def sq11_merge(spark, sf_dir):
    return structure.merge_continued(book_lines(spark, sf_dir))


@query(f"with l as {LINES}, f as (select *, min(case when regexp_matches(line, '^#\\s*第[一二三四五六七八九十百]+章') then line_no end) over (partition by book) as f0 from l), h as (select book, line_no, len(regexp_extract(line, '^(#{{1,6}})\\s+.+$', 1)) as v, trim(regexp_extract(line, '^#{{1,6}}\\s+(.+?)\\s*$', 1)) as t from f where line_no >= f0) select book, line_no, concat(repeat('  ', v - 1), '- [', t, '](#', regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(t), '[^\\p{{L}}\\p{{N}}\\-\\s　]', '', 'g'), '[\\s　]+', '-', 'g'), '-+', '-', 'g'), '^-|-$', '', 'g'), ')') as entry from h where v between 1 and 3 and not regexp_matches(t, '^(思考题|【知识要点】|本章数字资源)')")
def sq12_toc(spark, sf_dir):
    return structure.toc(book_lines(spark, sf_dir))


OUTLINE = "select concat('b', cast(p_partkey % 50 as varchar(20))) as book, p_partkey as ord, cast(p_size % 4 + 1 as int) as level, concat('第', substring('一二三四五六七八九十', cast(1 + p_partkey % 10 as int), 1), '章 t', p_size % 10) as title from {part}"


@query(f"with l as {LINES}, h as (select book, line_no, regexp_extract(line, '^#{{1,6}}\\s+(.*)$', 1) as head from l where regexp_matches(line, '^#{{1,6}}\\s+')), k as (select book, regexp_replace(lower(head), '[\\s　，。、；：？！（）()【】·…—\\-.,/\\\\|]+', '', 'g') as key, arg_min(head, line_no) as head from h group by 1, 2), o as (select *, replace(title, ' ', '　') as t from ({OUTLINE}) where level <= 3), j as (select o.book, o.ord, o.level, replace(coalesce(k.head, o.t), '|', '　') as s from o left join k on o.book = k.book and k.key = regexp_replace(lower(o.t), '[\\s　]+', '', 'g')) select book, ord, concat(repeat('  ', level - 1), '- [', s, '](#', lower(regexp_replace(replace(replace(s, '　', '-'), ' ', '-'), '-+', '-', 'g')), ')') as entry from j")
def sq13_toc_join(spark, sf_dir):
    return structure.outline_toc(here(spark, sf_dir, OUTLINE), book_lines(spark, sf_dir))


OWNERS = f"""with l as {LINES}, m as (select *, case when regexp_matches(line, '^图\\s*[0-9]+\\s*[-－]\\s*[0-9]+') then line_no end as c from l),
n as (select *, last_value(c ignore nulls) over (partition by book order by line_no rows between unbounded preceding and 1 preceding) as a, first_value(c ignore nulls) over (partition by book order by line_no rows between 1 following and unbounded following) as b from m),
o as (select book, line_no, regexp_extract(line, 'images/([^)\\s]+)', 1) as image, case when a is null then b else coalesce(b, a) end as owner from n where regexp_matches(line, '^!\\['))"""


@query(f"{OWNERS} select * from o where owner is not null")
def fg3_owner(spark, sf_dir):
    return figures.owners(book_lines(spark, sf_dir)).drop("owner_cap")


@query(f"{OWNERS}, t as (select o.book, o.line_no, o.image, regexp_extract(l.line, '^图\\s*([0-9]+)', 1) as x, regexp_extract(l.line, '^图\\s*[0-9]+-([0-9]+)', 1) as y, row_number() over (partition by o.book, o.owner order by o.line_no) - 1 as k from o join l on o.book = l.book and o.owner = l.line_no) select book, line_no, image, concat('fig', x, '-', y, case when k > 0 then concat('-', chr(cast(96 + k as int))) else '' end, '.jpg') as target from t")
def fg5_names(spark, sf_dir):
    return figures.named(book_lines(spark, sf_dir))


@query(f"{OWNERS}, w as (select distinct book, owner from o), e as (select l.book, l.line_no, 1 as s, case when m.c is null then l.line else concat('**图', regexp_extract(l.line, '([0-9]+-[0-9]+)', 1), '　cap**') end as line from l join m on l.book = m.book and l.line_no = m.line_no union all select m.book, m.line_no, 0, concat('[fig', regexp_extract(m.line, '([0-9]+-[0-9]+)', 1), ']') from m left join w on m.book = w.book and m.line_no = w.owner where m.c is not null and w.owner is null) select book, cast(row_number() over (partition by book order by line_no, s) as int) as line_no, line from e")
def fg6_missing(spark, sf_dir):
    return figures.finish_captions(book_lines(spark, sf_dir))


@query(f"select f.book, f.name, f.size from ({IMAGES}) f where not exists (select 1 from {REFS} r where r.book = f.book and r.name = f.name)")
def fg7_orphans(spark, sf_dir):
    return library.orphans(here(spark, sf_dir, IMAGES), refs(spark, sf_dir))


@query(f"""with l as {LINES}, m as (select *, case when regexp_matches(line, '^图\\s*[0-9]+\\s*[-－]\\s*[0-9]+') then line_no end as c, nullif(line, '') as txt from l),
n as (select *, last_value(c ignore nulls) over p as a, first_value(c ignore nulls) over f as b, first_value(txt ignore nulls) over f as nx from m window p as (partition by book order by line_no rows between unbounded preceding and 1 preceding), f as (partition by book order by line_no rows between 1 following and unbounded following)),
j as (select n.*, i.size from n left join ({IMAGES}) i on n.book = i.book and regexp_extract(n.line, 'images/([^)\\s]+)', 1) = i.name where regexp_matches(line, '^!\\[')),
r as (select book, line_no, case when not coalesce(line_no - a <= 15 or b - line_no <= 15, false) then 'no-caption' when coalesce(size, 0) < 7000 then 'small' end as reason from j) select * from r where reason is not null""")
def fg1_junk(spark, sf_dir):
    return figures.junk_reasons(book_lines(spark, sf_dir), here(spark, sf_dir, IMAGES))


@query()
def fg1_cascade(spark, sf_dir):
    return figures.junk_cascade(book_lines(spark, sf_dir), here(spark, sf_dir, IMAGES))


@query()
def fg9_class(spark, sf_dir):
    return figures.blocks(book_lines(spark, sf_dir))


HTML = "select n_nationkey as k, concat('<table><tr><td rowspan=\"',cast(1+n_nationkey%3 as varchar(3)),'\">',n_name,'</td><td colspan=\"2\">x</td></tr><tr><td>y</td></tr></table>') as html from {nation}"


@query(f"select k, case when (1 + k % 3) > 1 then concat('| ', name, ' | x |  |', chr(10), '|---|---|---|', chr(10), '|  | y |  |') else concat('| ', name, ' | x |  |', chr(10), '|---|---|---|', chr(10), '| y |  |  |') end as pipe from (select n_nationkey as k, n_name as name from nation)")
def tb2_expand(spark, sf_dir):
    rows = here(spark, sf_dir, HTML).select("k", tables.cells(F.col("html")).alias("rows"))
    return tables.expand(rows).select("k", tables.pipe_table(F.col("grid")).alias("pipe"))


@query(f"with p as ({PIPES}) select book, line_no, 1 as columns, 2 as expected from p where len(line) - len(replace(line, '|', '')) = 2")
def tb6_gfm_width(spark, sf_dir):
    return tables.pipe_widths(here(spark, sf_dir, PIPES))


@query()
def tb5_html_width(spark, sf_dir):
    sql = "select concat('t', cast(n_regionkey as varchar(3))) as book, cast(row_number() over (partition by n_regionkey order by k, n_nationkey) as int) as line_no, line from (select n_regionkey, 0 as k, -1 as n_nationkey, '<table>' as line from {nation} group by n_regionkey union all select n_regionkey, 1, n_nationkey, concat('<tr><td rowspan=\"', cast(1 + n_nationkey % 2 as varchar(3)), '\">a</td><td>b</td></tr>') from {nation} union all select n_regionkey, 2, 99, '</table>' from {nation} group by n_regionkey) q"
    return tables.html_widths(here(spark, sf_dir, sql))


@query(f"with p as ({PIPES}) select book, 'T' as title, 0 as line_no, 1 as \"start\", count(*) as \"end\" from p group by book")
def tb7_block(spark, sf_dir):
    lines = here(spark, sf_dir, PIPES)
    titled = lines.unionByName(lines.select("book").distinct().select("book", F.lit(0).alias("line_no"), F.lit("T").alias("line")))
    return tables.title_blocks(titled, lines.select("book", F.lit("T").alias("title")).distinct())


RULES = "select concat('b', cast(n_nationkey as varchar(20))) as book, n_nationkey as ord, case when n_nationkey % 2 = 0 then '' else concat('## 【D', n_nationkey % 9 + 1, '】') end as old, 'new' as new, cast(n_nationkey % 4 as int) as count from {nation}"


@query(f"with l as {LINES}, r as ({RULES}), h as (select r.book, r.ord, count(l.line_no) as hits from r left join l on l.book = r.book and l.line = r.old group by 1, 2) select r.book, r.ord, h.hits, h.hits = r.count as applied from r join h on r.book = h.book and r.ord = h.ord")
def tb10_replace_line(spark, sf_dir):
    return tables.replace_line(book_lines(spark, sf_dir), here(spark, sf_dir, RULES))[1]


@query("select doc_id, md5(case when (len(text) - len(replace(text, 'tion', ''))) / 4 = 3 then replace(text, 'tion', 'TION') else text end) as out from documents")
def tb11_replace_sub(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(tables.replace_text(F.col("text"), F.lit("tion"), F.lit("TION"), F.lit(3))).alias("out"))


def _audit_sql(folds: tuple) -> str:
    body, page = (f"regexp_replace({_fold_sql(c, folds)}, '\\s+', '', 'g')" for c in ("para", "text"))
    return f"with p as (select *, {body} as body from ({PARAS}) q where trim(para) <> '' and not regexp_matches(para, '^\\s*(#{{1,6}}\\s|\\||- \\[)')), g as (select source as book, string_agg({page}, '' order by doc_id) as page from documents group by 1) select p.para_no, p.book from p left join g on g.book = p.book where len(p.body) >= 8 and not coalesce(contains(g.page, p.body), false)"


def _audit(spark, sf_dir, fold) -> DataFrame:
    pages = read(spark, sf_dir, "documents").select(F.col("source").alias("book"), F.col("doc_id").alias("page_no"), F.col("text").alias("page"))
    return audit.contained(here(spark, sf_dir, PARAS_HERE), pages, fold)[1].select("para_no", "book")


@query(_audit_sql(rules.STRICT_FOLDS))
def au1_strict(spark, sf_dir):
    return _audit(spark, sf_dir, T.fold_strict)


@query(_audit_sql(rules.LENIENT_FOLDS))
def au2_lenient(spark, sf_dir):
    return _audit(spark, sf_dir, T.fold_lenient)


@query()
def au4_backfill(spark, sf_dir):
    paras = F.split(F.replace("text", F.lit(","), F.lit("")), "\\n|(?<=[.!?。！？])\\s+")
    docs = read(spark, sf_dir, "documents").select("doc_id", paras.alias("paras"), T.no_space(T.fold_repair(F.col("text"))).alias("page"))
    return audit.backfill_pages(docs).select("doc_id", "para_no", "status", F.md5("fixed").alias("fixed"))


@query(f"with d as (select book, string_agg(line, chr(10) order by line_no) as t from {LINES} group by book) select book, cast(0 as bigint) as figure_refs, cast(0 as bigint) as captions, cast(0 as bigint) as dollars, cast(len(regexp_extract_all(t, 'images/[0-9a-f]{{20,}}\\.')) as bigint) as hash_refs, cast(0 as bigint) as inline, cast(0 as bigint) as placeholders from d")
def au7_selfcheck(spark, sf_dir):
    docs = book_lines(spark, sf_dir).groupBy("book").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("t"))
    return docs.select("book", *audit.self_check(F.col("t")))


@query()
def pj8_math(spark, sf_dir):
    rows = here(spark, sf_dir, "select o_orderkey, concat('a $\\\\mathrm{CO} _ {', o_orderkey % 9, '} ^ {+} \\\\times ', o_custkey % 7, '$ b') as t from {orders}")
    return rows.select("o_orderkey", T.convert_math(F.col("t")).alias("out"))


@query()
def pj9_latex(spark, sf_dir):
    rows = here(spark, sf_dir, "select o_orderkey, concat('\\\\alpha\\\\beta ', o_orderkey % 9, ' \\\\geqslant \\\\mathrm x \\\\foo y') as t from {orders}")
    return rows.select("o_orderkey", T.latex_clean(F.col("t")).alias("out"))


def polish(lines: DataFrame) -> DataFrame:
    """Marks out, front images out, intro names, glued headings, levels, duplicate intros, contents, captions, blanks."""
    out = lines.where(~library.is_chunk_mark(F.col("line")))
    for step in (structure.preface_heading, structure.front_images, structure.intro_names, structure.split_glued, structure.heading_levels, structure.unique_intro):
        out = step(out)
    return library.single_blanks(figures.finish_captions(structure.rebuild_toc(structure.renumber(out))))


@query()
def polish_pipeline(spark, sf_dir):
    return polish(book_lines(spark, sf_dir))


MEDIA = "select concat('b', cast(o_custkey % 20 as varchar(20))) as book, cast(row_number() over (partition by o_custkey % 20 order by o_orderkey) as int) as line_no, case o_orderkey % 9 when 0 then ' 视频 ' when 1 then '![x](images/a.jpg)' when 2 then concat('图', o_orderkey % 7, '-2A  cap ') when 3 then concat('表', o_orderkey % 5, '-1　t') when 4 then '本章思维导图' when 5 then '**图1-1　x**' when 6 then '图1-2' when 7 then '表1-2' else concat('text 视频 ', o_orderkey) end as line from {orders}"


@query(f"with l as ({MEDIA}) select book, line_no, case when regexp_matches(line, '^图[0-9]-2A') then concat('**', left(line, 5), '　cap**') when regexp_matches(line, '^表[0-9]-1　') then concat('**', line, '**') else line end as line from l where not regexp_matches(line, '^( 视频 |!.*|本章思维导图)$')")
def fl10_media(spark, sf_dir):
    return structure.media_lines(here(spark, sf_dir, MEDIA))


PHRASES = "select concat('b', cast(n_nationkey as varchar(20))) as book, k as ord, concat('p', n_nationkey * 10 + k) as phrase, concat('第', k, '章') as title from {nation}, (select 1 as k union all select 2 union all select 3) t"


@query(f"with l as {LINES}, m as ({PHRASES}), h as (select m.book, m.ord, m.title, min(l.line_no) as hit from m join l on l.book = m.book and starts_with(l.line, m.phrase) group by 1, 2, 3), e as (select book, line_no, 1000000 as s, 0 as p, line from l union all select book, hit, ord, 0, concat('# ', title) from h union all select book, hit, ord, 1, '' from h) select book, cast(row_number() over (partition by book order by line_no, s, p) as int) as line_no, line from e")
def sq8_phrases(spark, sf_dir):
    return structure.insert_at_phrases(book_lines(spark, sf_dir), here(spark, sf_dir, PHRASES))


@query("select o_orderkey, concat('a', chr(10), case when o_orderkey % 3 = 0 then concat('$$', chr(10), '\\frac', chr(10), '$$') else concat('x', chr(10), o_orderkey) end, chr(10), 'b') as out from orders")
def pj24_unwrap(spark, sf_dir):
    rows = here(spark, sf_dir, "select o_orderkey, concat('a\\n$$\\n', case when o_orderkey % 3 = 0 then '\\\\frac' else concat('x\\n', o_orderkey) end, '\\n$$\\nb') as t from {orders}")
    return rows.select("o_orderkey", T.unwrap_plain(F.col("t")).alias("out"))


@query("select o_orderkey, o_orderkey % 6 in (1, 3) as gone from orders")
def sk9_clean(spark, sf_dir):
    rows = here(spark, sf_dir, "select o_orderkey, case o_orderkey % 6 when 0 then '.medlib-token' when 1 then concat('.medlib-', o_orderkey) when 2 then '.medlib-out' when 3 then '.tmp' when 4 then 'tmp' else 'a.medlib-x' end as name from {orders}")
    return rows.select("o_orderkey", T.is_leftover(F.col("name"), F.lit(".medlib-out")).alias("gone"))


TITLED = f"(select book, 0 as line_no, concat('表', right(book, 1), '-1 x') as line from ({PIPES}) a group by book union all select book, line_no, line from ({PIPES}) b)"


@query(f"with l as {TITLED}, e as (select book, 0 as a, 0 as b, line from l where line_no = 0 union all select distinct book, 1, k, case k when 0 then '<table>' else '</table>' end from l, (select 0 as k union all select 1) t where book <> 't0' union all select book, 2, line_no, line from l where line_no > 0 and book = 't0') select book, cast(row_number() over (partition by book order by a, b) as int) as line_no, line from e")
def tb8_replace_table(spark, sf_dir):
    lines = here(spark, sf_dir, f"select * from {TITLED} q")
    found = lines.select("book").distinct().select("book", F.when(F.col("book") == "t0", "none").otherwise(F.concat(F.lit("表"), F.right("book", F.lit(1)), F.lit("-1"))).alias("title"), F.lit("<table>\n</table>").alias("html"))
    return tables.replace_table(lines, found)[0]


#: Its lines have neither labels nor signatures, so the cascade removes what the plain reasons do; tests have both.
ORACLE["fg1_cascade"] = ORACLE["fg1_junk"]

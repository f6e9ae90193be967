"""Scalar normalisers, each Column to Column, null to null."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirework.functions import rules

#: White space as other engines' \\s has it.
SPACE = "[\\s\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"


def sub(c: Column, pattern: str, to: str) -> Column:
    return F.regexp_replace(c, pattern, to)


def strip(c: Column) -> Column:
    """Without white space at either end."""
    return F.btrim(c, F.lit(SPACES))


#: The same characters, one by one.
SPACES = " \t\n\x0b\f\r\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Ranges that hold all variant characters which are folded, but * (a test asks for all of them).
VARIANTS = "\\u00b2-\\u00be\\u00d7\\u0370-\\u03ff\\u2010-\\u2bff\\u3000-\\u303f\\uff00-\\uffef"


def safe_name(c: Column) -> Column:
    """A file-safe name of at most 120 characters; "unnamed" for an empty one."""
    out = sub(sub(c, '[<>:"/\\\\|?*\\x00-\\x1f]', "_"), f"{SPACE}+", " ")
    return F.coalesce(F.nullif(F.substring(strip(out), 1, 120), F.lit("")), F.lit("unnamed"))


def base_name(c: Column) -> Column:
    return F.element_at(F.split(c, "[/\\\\]"), -1)


def extension(c: Column) -> Column:
    """The last .ext, lower case; empty without one."""
    return F.lower(F.regexp_extract(c, "(\\.[^./\\\\]+)$", 1))


def is_input(path: Column) -> Column:
    return path.rlike(f"(?i)\\.({rules.INPUT_EXTENSIONS})$")


def slug(c: Column) -> Column:
    """Lower case; letters, digits and hyphens; white space to one hyphen; no hyphen at the edges."""
    out = sub(F.lower(c), f"[^\\p{{L}}\\p{{N}}\\-\\s\\u3000\\u00a0]", "")
    return sub(sub(sub(out, f"{SPACE}+", "-"), "-+", "-"), "^-|-$", "")


def anchor(c: Column) -> Column:
    """As slug(), but underscores stay, and only U+3000 and spaces become hyphens."""
    out = sub(strip(c), "[^\\p{L}\\p{N}_\\-\\s\\u3000\\u00a0]", "")
    return F.lower(sub(sub(F.translate(out, "　 ", "--"), "-+", "-"), "^-+|-+$", ""))


def match_key(c: Column) -> Column:
    """What titles are compared by: lower case, without white space and punctuation."""
    return sub(F.lower(c), f"[\\s\\u3000，。、；：？！（）()【】《》“”\"'‘’「」·…—\\-.,/\\\\|]+", "")


def anchor_key(c: Column) -> Column:
    """What chapter anchors are compared by."""
    return sub(c, "[\\s\\u3000，。；：、（）(),.;:'\"!?]", "")


def no_space(c: Column) -> Column:
    common = sub(c, "[\\s\\u00a0]+", "")
    return F.when(common.rlike("[\\u1680-\\u3000]"), sub(common, f"{SPACE}+", "")).otherwise(common)  # the long class is slow


def sup_sub(c: Column) -> Column:
    """<sup> and <sub> to Unicode forms; characters without one stay. A text is cut at tags; each inner part is mapped."""

    def one(c: Column, tag: str, chars: str, to: str) -> Column:
        pattern = f"<{tag}>{SPACE}*([^<]*?){SPACE}*</{tag}>"
        mark = "\x02"
        cut = F.split(sub(c, pattern, f"{mark}$1{mark}"), mark)
        return F.array_join(F.transform(cut, lambda x, i: F.when(i % 2 == 1, F.translate(x, chars, to)).otherwise(x)), "")

    return one(one(c, "sup", rules.SUP_FROM, rules.SUP_TO), "sub", rules.SUB_FROM, rules.SUB_TO)


def ions(c: Column) -> Column:
    """Charges of listed ions, not beside a letter or digit."""
    return reduce(lambda x, r: sub(x, f"(?<![A-Za-z0-9]){r[0]}(?![A-Za-z0-9])", r[1]), rules.IONS, c)


def ratio(c: Column) -> Column:
    """The colon of a ratio of two numbers of up to 4 digits becomes U+2236. A match that a time overlaps stays: one or
    two digits before and minutes 00 to 59 behind."""
    spaced = f"{SPACE}*[:：]{SPACE}*"
    return sub(c, f"(?<![0-9])(?![0-9]{{1,2}}{spaced}[0-5][0-9](?![0-9]))([0-9]{{1,4}}){spaced}([0-9]{{1,4}})(?![0-9])", "$1∶$2")


def ion_ratio(c: Column) -> Column:
    return sub(c, f"(?<=[⁺⁻₊₋]){SPACE}*[:：]{SPACE}*(?=[⁺⁻₊₋])", "∶")


def times(c: Column) -> Column:
    """x between digits."""
    return sub(c, f"(?<=[0-9]){SPACE}*[xX]{SPACE}*(?=[0-9])", "×")


def bold_titles(c: Column) -> Column:
    """Table titles on a line of their own."""
    return sub(c, "(?m)^表 ?([0-9]+)-([0-9]+)[ \\u2003\\u3000]+(\\S.*)$", "**表$1-$2　$3**")


def _folded(c: Column, folds: tuple) -> Column:
    variants = f"[*{VARIANTS}]"
    out = F.translate(F.replace(c, F.lit("*"), F.lit("")), rules.FOLD_FROM, rules.FOLD_TO)
    out = reduce(lambda x, r: F.replace(x, F.lit(r[0]), F.lit(r[1])), folds, out)
    out = reduce(lambda x, r: F.replace(x, F.lit(r[1]), F.lit(f"{r[0]})")), enumerate(rules.CIRCLED, 1), out)
    return F.when(c.rlike(variants), out).otherwise(c)  # one pass finds most texts to have none


def fold_strict(c: Column) -> Column:
    return _folded(c, rules.STRICT_FOLDS)


def fold_lenient(c: Column) -> Column:
    return _folded(c, rules.LENIENT_FOLDS)


def fold_repair(c: Column) -> Column:
    return _folded(c, rules.COMMON_FOLDS)


def clean_page(c: Column) -> Column:
    """A page without control characters, page labels, page numbers and running heads."""
    out = sub(sub(c, "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]", ""), f"本章数字资源{SPACE}*\\|{SPACE}*[0-9]+", "")
    return F.array_join(F.filter(F.split(out, "\n"), lambda x: ~x.rlike(f"^{SPACE}*[0-9]+{SPACE}*$") & ~x.rlike(f"^{SPACE}*第[一二三四五六七八九十]+[章节]{SPACE}")), "\n")


def italic_terms(c: Column) -> Column:
    """English terms of two or more words before an abbreviation; separator rows of tables stay."""
    return F.when(c.rlike("^\\|[\\s:|-]+\\|$"), c).otherwise(sub(c, "（([A-Za-z]+(?: [A-Za-z]+)+)[，,]\\s*([A-Za-z][A-Za-z0-9/]*?)）", "（*$1*，$2）"))


def cd_marks(c: Column) -> Column:
    return F.replace(c, F.lit("CD4+"), F.lit("CD4⁺"))


def replaced(c: Column, pairs: list[tuple[str, str]]) -> Column:
    """Literal replacements, one after another."""
    return reduce(lambda x, r: F.replace(x, F.lit(r[0]), F.lit(r[1])), pairs, c)


def circled(n: Column) -> Column:
    return F.substring(F.lit(rules.CIRCLED), n, 1)


def list_marks(c: Column) -> Column:
    return sub(c, "(?m)^\\\\- ", "- ")


def only_marks(c: Column) -> Column:
    """Nothing but punctuation; true for an empty string."""
    return F.translate(c, rules.MARKS, "") == ""


def cell_text(c: Column) -> Column:
    """The text of an HTML table cell."""
    out = sup_sub(sub(sub(c, "<(?!/?su[bp]>)[^>]+>", ""), "(?<=<su[bp]>)<[^>]+>", ""))
    out = replaced(sub(out, "<[^>]+>", ""), [("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"), ("&nbsp;", " "), (";", "；"), ("\n", " ")])
    return sub(sub(strip(out), "(?<![0-9]),", "，"), "(?<=[\\u4e00-\\u9fff]):", "：")


def latex_clean(c: Column) -> Column:
    """Commands outside kept formulas: symbols, Greek, fonts, spacing, known junk, unknown ones, stray backslashes.

    Formulas with a mean and its deviation are kept: the text is cut at formulas, and those parts pass unchanged.
    """
    mark = "\x02"
    kept = "\\$\\$?[^$\\n]*?\\\\bar\\s*\\{\\s*x\\s*\\}\\s*\\\\pm\\s*s[^$\\n]*?\\$\\$?"
    cut = F.split(sub(c, f"({kept})", f"{mark}$1{mark}"), mark)

    def clean(x: Column) -> Column:
        x = sub(x, "\\\\Delta\\s*c\\b", "")
        for name, char in rules.SYMBOLS:
            x = sub(x, f"\\\\{name}\\b", char)
        for name, char in rules.GREEK.items():
            x = F.replace(x, F.lit(f"\\{name}"), F.lit(char))
        for pattern, to in ((f"\\\\(?:{rules.FONT_COMMANDS})\\s*", ""), ("\\\\(?:left|right)\\s*", ""), ("\\\\[,!;]", ""), ("\\\\\\*\\s*", "*"), ("\\\\、", "、"), ("\\\\~", "～"), ("\\\\cdot\\s*", "·"), ("\\\\substack\\s*", ""), ("\\\\big[lr]?\\s*", ""), ("\\\\(?:begin|end)\\{[a-zA-Z*]*\\}\\s*", ""), (f"\\\\(?:{'|'.join(rules.JUNK_COMMANDS)})\\b", ""), ("\\\\log\\b", "kg"), ("\\\\k(?=[a-z])", "k"), (f"\\\\(?!(?:{rules.KEPT_COMMANDS})\\b)[a-zA-Z]{{1,8}}\\s*", ""), ("\\\\\\s*(?=[^\\\\\\s])", "")):
            x = sub(x, pattern, to)
        return x

    return F.array_join(F.transform(cut, lambda x, i: F.when(i % 2 == 1, x).otherwise(clean(x))), "")


def math_text(c: Column) -> Column:
    """What stands inside a formula, as plain Unicode: scripts, signs and spacing. A formula with a mean and its
    deviation stays."""
    out = sub(sub(c, "\\\\(?:mathrm|text[a-z]*)\\s*", ""), "\\\\left|\\\\right", "")

    def scripts(x: Column, pattern: str, chars: str, to: str) -> Column:
        cut = F.split(sub(x, pattern, "\x02$1\x02"), "\x02")
        return F.array_join(F.transform(cut, lambda y, i: F.when(i % 2 == 1, F.translate(F.replace(sub(y, " ", ""), F.lit("\\circ"), F.lit("°")), chars, to)).otherwise(y)), "")

    out = scripts(out, "_\\s*\\{\\s*([0-9][0-9\\s]*?)\\s*\\}", rules.SUB_FROM, rules.SUB_TO)
    out = sub(out, "_\\s*\\{\\s*[a-zA-Z]\\s*(?:_\\s*\\{\\s*[a-zA-Z]\\s*\\}\\s*)?\\}", "")
    out = scripts(out, "\\^\\s*\\{\\s*([^{}]*?)\\s*\\}", rules.SUP_FROM, rules.SUP_TO)
    for _ in range(4):
        out = sub(out, "\\{\\s*([^{}]{1,80}?)\\s*\\}", "$1")
    out = scripts(out, "_\\s*([0-9]+)", rules.SUB_FROM, rules.SUB_TO)
    out = scripts(out, "\\^\\s*([+\\-]?[0-9]+|[+\\-]+)", rules.SUP_FROM, rules.SUP_TO)
    out = sub(sub(sub(out, "(?<=[0-9])\\s*,\\s*(?=[0-9])", ","), "(?<=[0-9])\\s*\\.\\s*(?=[0-9])", "."), "(?<=[0-9])\\s+(?=[0-9])", "")
    out = replaced(out, [("\\pm", "±"), ("\\geqslant", "≥"), ("\\leqslant", "≤"), ("\\sim", "～"), ("\\downarrow", "↓"), ("\\uparrow", "↑"), ("\\times", "×"), ("\\div", "÷"), ("\\circ", "°"), ("\\%", "%")])
    for pattern, to in (("\\\\\\s*([<>()])", "$1"), ("(?<![0-9]),(?![0-9])", "、"), ("(?<![0-9])\\.(?![0-9])", "、"), ("\\s+", ""), ("PaC0", "PaCO"), ("TcS0", "TcSO"), ("\\(0H\\)", "(OH)"), ("[_^]", ""), ("[.,，。;；、]+$", "")):
        out = sub(out, pattern, to)
    return F.when(c.rlike("\\\\bar\\s*\\{\\s*x\\s*\\}\\s*\\\\pm\\s*s"), F.concat(F.lit("$"), c, F.lit("$"))).otherwise(out)


def convert_math(c: Column) -> Column:
    """Each $...$ of one line as plain text."""
    cut = F.split(sub(c, "\\$([^$\\n]+)\\$", "\x03$1\x03"), "\x03")
    return F.array_join(F.transform(cut, lambda x, i: F.when(i % 2 == 1, math_text(x)).otherwise(x)), "")


def unwrap_plain(c: Column) -> Column:
    """Display blocks ($$ alone on lines) without a command become their body; a block ends at the first closing $$."""
    cut = F.split(sub(c, "(?s)\\$\\$\n(.*?)\n\\$\\$", "\x04$1\x04"), "\x04")
    kept = lambda x: F.concat(F.lit("$$\n"), x, F.lit("\n$$"))
    return F.array_join(F.transform(cut, lambda x, i: F.when((i % 2 == 1) & x.contains("\\"), kept(x)).otherwise(x)), "")


def is_leftover(name: Column, own: Column) -> Column:
    """Whether a clean-up of a folder removes this name: scratch files, never the token or the output that is being written."""
    scratch = name.startswith(rules.LEFTOVER_PREFIX) | (name == rules.LEFTOVER_NAME)
    return scratch & (name != rules.TOKEN_NAME) & ~F.coalesce(name == own, F.lit(False))

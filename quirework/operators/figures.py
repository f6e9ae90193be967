"""Figures: junk images, caption ownership, naming, placeholders. Lines are (book, line_no, line)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quirework.functions import text as T
from quirework.operators.library import is_junk_label
from quirework.operators.structure import back, own, renumber

CAPTION = "^图\\s*([0-9]+)\\s*[-－]\\s*([0-9]+)\\s*(.*)$"
IMAGE = "^!\\[[^\\]]*\\]\\(images/([^)\\s]+)\\)$"
HASHED = "^!\\[[^\\]]*\\]\\(images/[a-f0-9]{16,}\\.\\w+\\)$"
SIGNED = "^[（(][\\u3400-\\u9fff\\s]{2,12}[）)]$"


def caption_text(line: Column) -> Column:
    return T.sub(T.sub(T.strip(line), "^\\*\\*", ""), "\\*\\*$", "")


def captions(lines: DataFrame) -> DataFrame:
    """lines with cap (fig key of a caption) and title."""
    cap = caption_text(F.col("line"))
    key = F.when(cap.rlike(CAPTION), F.concat(F.lit("fig"), F.regexp_extract(cap, CAPTION, 1), F.lit("-"), F.regexp_extract(cap, CAPTION, 2)))
    return lines.withColumn("cap", key).withColumn("title", T.sub(T.strip(F.regexp_extract(cap, CAPTION, 3)), "\\s+", " "))


def marked(lines: DataFrame) -> DataFrame:
    """captions() with image (name), the next and previous full lines, the nearest captions, and the nearest placeholder from the line on. What is
    below comes first and what is above then, so lines are sorted twice."""
    c = F.col("line")
    full = F.when(T.strip(c) != "", T.strip(c))
    rows = captions(lines).withColumn("image", F.when(c.rlike(IMAGE), F.regexp_extract(c, IMAGE, 1)))
    above, below = own().rowsBetween(W.unboundedPreceding, -1), back().rowsBetween(W.unboundedPreceding, -1)
    at = F.when(F.col("cap").isNotNull(), F.col("line_no"))
    mark = F.regexp_extract(T.strip(c), "^\\[(fig[0-9]+-[0-9]+)\\]$", 1)
    up = rows.withColumn("mark_at", F.last(F.when(mark != "", F.struct(F.col("line_no").alias("at"), mark.alias("key"))), True).over(back().rowsBetween(W.unboundedPreceding, 0)))
    up = up.withColumn("next", F.last(full, True).over(below)).withColumn("cap_below", F.last(at, True).over(below)).withColumn("key_below", F.last("cap", True).over(below))
    return up.withColumn("prev", F.last(full, True).over(above)).withColumn("cap_above", F.last(at, True).over(above))


def junk_reasons(lines: DataFrame, files: DataFrame, radius: int = 15, least: int = 7000) -> DataFrame:
    """(book, line_no, reason) of hash-named images that go, by windows only: the first reason that holds. A signature
    counts if it is the previous full line as the text stands; junk_cascade() also follows removed lines."""
    rows = marked(lines).where(F.col("line").rlike(HASHED)).join(files.select("book", F.col("name").alias("image"), "size"), ["book", "image"], "left")
    near = (F.col("line_no") - F.col("cap_above") <= radius) | (F.col("cap_below") - F.col("line_no") <= radius)
    reason = F.when(is_junk_label(F.col("next")), F.concat(F.lit("label:"), F.col("next"))).when(F.col("next").rlike("^#{1,6}\\s*思考题"), "before-exercises").when(F.col("prev").rlike(SIGNED), "after-signature").when(~F.coalesce(near, F.lit(False)), "no-caption").when(F.coalesce("size", F.lit(0)) < least, "small")
    return rows.withColumn("reason", reason).where("reason is not null").select("book", "line_no", "reason")


def junk_cascade(lines: DataFrame, files: DataFrame, radius: int = 15, least: int = 7000) -> DataFrame:
    """As junk_reasons(), with the signature rule over what is left: lines already removed are passed over.

    An image that goes leaves the line before it in force, and one that stays is no signature and had none before it, so
    images never change what stands before the next: that is the nearest other full line, less the labels
    that go with an image before them. All of it is windows.
    """
    rows = marked(lines)
    above = own().rowsBetween(W.unboundedPreceding, -1)
    t, next_label = T.strip(F.col("line")), is_junk_label(F.col("next"))
    hashed, label = F.col("line").rlike(HASHED), is_junk_label(F.col("line"))
    near = F.coalesce((F.col("line_no") - F.col("cap_above") <= radius) | (F.col("cap_below") - F.col("line_no") <= radius), F.lit(False))
    full = rows.where(t != "").select("book", "line_no", "image", "next", hashed.alias("hashed"), label.alias("label"), t.rlike(SIGNED).alias("signed"), near.alias("near"), F.coalesce(next_label, F.lit(False)).alias("labelled"))
    full = full.withColumn("dropped", F.col("label") & F.coalesce(F.last(F.when(~F.col("label"), F.col("hashed") & F.col("labelled")), True).over(above), F.lit(False)))
    full = full.withColumn("after", F.coalesce(F.last(F.when(~F.col("hashed") & ~F.col("dropped"), F.col("signed")), True).over(above), F.lit(False)))
    reason = F.when(F.col("labelled"), F.concat(F.lit("label:"), "next")).when(F.col("next").rlike("^#{1,6}\\s*思考题"), "before-exercises").when(F.col("after"), "after-signature").when(~F.col("near"), "no-caption").when(F.coalesce("size", F.lit(0)) < least, "small")
    left = full.where("hashed").join(files.select("book", F.col("name").alias("image"), "size"), ["book", "image"], "left")  # images only
    return left.withColumn("reason", reason).where("reason is not null").select("book", "line_no", "reason")


def panel(line: Column) -> Column:
    """The number of a panel label: (1), 1. or a capital letter's code."""
    numbered = "^[（(]?([0-9]+)[）)]?[.、．]?\\s"
    return F.when(line.rlike(numbered), F.regexp_extract(line, numbered, 1).cast("int")).when(line.rlike("^[A-Z]$"), F.ascii(line))


def with_owners(lines: DataFrame) -> DataFrame:
    """marked() with owner of each image: the caption line that it belongs to, and key_above.

    A placeholder of the caption below, between the two, decides; else the only caption; else the one below unless the
    one above is nearer, stands right before the image, and the image's panel number goes on from the last image's
    before it by one.
    """
    above = own().rowsBetween(W.unboundedPreceding, -1)
    rows = marked(lines).withColumn("key_above", F.last("cap", True).over(above))
    rows = rows.withColumn("panel", F.when(F.col("image").isNotNull(), panel(F.col("next")))).withColumn("after_caption", F.last(F.when(T.strip(F.col("line")) != "", F.struct(F.col("cap").isNotNull().alias("c"), F.col("line_no").alias("n"))), True).over(above))
    rows = rows.withColumn("last_panel", F.last(F.when(F.col("image").isNotNull(), F.struct(F.col("panel").alias("p"))), True).over(above))
    placed = (F.col("mark_at.key") == F.col("key_below")) & (F.col("mark_at.at") <= F.col("cap_below"))
    goes_on = (F.col("line_no") - F.col("cap_above") < F.col("cap_below") - F.col("line_no")) & F.col("after_caption.c") & (F.col("panel") == F.col("last_panel.p") + 1)
    owner = F.when(F.coalesce(placed, F.lit(False)), F.col("cap_below")).when(F.col("cap_above").isNull(), F.col("cap_below")).when(F.col("cap_below").isNull(), F.col("cap_above")).when(F.coalesce(goes_on, F.lit(False)), F.col("cap_above")).otherwise(F.col("cap_below"))
    return rows.withColumn("owner", F.when(F.col("image").isNotNull(), owner))


def owners(lines: DataFrame) -> DataFrame:
    """(book, line_no, image, owner, owner_cap): the caption line each image belongs to, and its key."""
    cap = F.when(F.col("owner") == F.col("cap_below"), F.col("key_below")).otherwise(F.col("key_above"))
    return with_owners(lines).where("owner is not null").select("book", "line_no", "image", "owner", cap.alias("owner_cap"))


def named(lines: DataFrame) -> DataFrame:
    """(book, line_no, image, target): figX-Y.ext for a caption's first image, -a, -b ... for the next ones."""
    k = F.row_number().over(W.partitionBy("book", "owner").orderBy("line_no")) - 1
    ext = F.coalesce(F.nullif(F.regexp_extract("image", "\\.(\\w+)$", 1), F.lit("")), F.lit("jpg"))
    rows = owners(lines).withColumn("k", k)
    return rows.select("book", "line_no", "image", F.concat("owner_cap", F.when(F.col("k") > 0, F.concat(F.lit("-"), F.char(F.col("k") + 96))).otherwise(""), F.lit("."), ext).alias("target"))


def finish_captions(lines: DataFrame, placeholder: str = "[{}]") -> DataFrame:
    """Captions in bold; above one without an image a placeholder, unless the nearest full line of the three above is
    it."""
    # An image above a caption belongs to none below that, and one below it to none above: so those that are nearest to it tell.
    rows = with_owners(lines).withColumn("last_owner", F.max("owner").over(own().rowsBetween(W.unboundedPreceding, -1)))
    rows = rows.withColumn("near", F.last(F.when(T.strip(F.col("line")) != "", T.strip(F.col("line"))), True).over(own().rowsBetween(-3, -1)))
    rows = rows.withColumn("next_owner", F.min("owner").over(back().rowsBetween(W.unboundedPreceding, -1)))
    owned = F.coalesce(F.col("last_owner") == F.col("line_no"), F.lit(False)) | F.coalesce(F.col("next_owner") == F.col("line_no"), F.lit(False))
    a, b = placeholder.split("{}")
    mark = F.concat(F.lit(a), "cap", F.lit(b))
    number = T.sub(F.col("cap"), "^fig", "")
    bold = F.when(F.col("cap").isNull() | T.strip(F.col("line")).startswith("**"), F.col("line")).otherwise(F.concat(F.lit("**图"), number, F.lit("　"), "title", F.lit("**")))
    missing = F.col("cap").isNotNull() & ~owned & ~F.coalesce(F.col("near") == mark, F.lit(False))
    parts = F.when(missing, F.array(mark, bold)).otherwise(F.array(bold))
    return renumber(rows.select("book", "line_no", F.posexplode(parts).alias("sub_no", "line")), "line_no", "sub_no")


def blocks(lines: DataFrame, ahead: int = 12) -> DataFrame:
    """(book, line_no, images, kind, caption) of each run of images (blank and single-capital lines between them count
    in): what the first telling one of the next full lines is. Others are passed over; a next image ends the search."""
    c = T.strip(F.col("line"))
    full = lines.where(c != "").withColumn("t", c)
    image = F.col("t").startswith("![")
    part = image | F.col("t").rlike("^[A-Z]$")
    rows = full.withColumn("grp", F.sum((~part).cast("int")).over(own())).withColumn("is_image", image)
    runs = rows.where(part).groupBy("book", "grp").agg(F.min(F.when(F.col("is_image"), F.col("line_no"))).alias("line_no"), F.max("line_no").alias("last"), F.sum(F.col("is_image").cast("int")).alias("images")).where("images > 0")
    caption = "^图\\s*[0-9]+-[0-9]+[A-Z]?\\s*[　 \\u2003\\u2002\\t]+(.+)$"
    kind = F.when(F.col("t").startswith("!["), "END").when(F.col("t").rlike(caption), "FIG").when(F.col("t") == "视频", "VIDEO").when(F.col("t").isin("本章思维导图", "本章数字资源"), "MINDMAP").when(F.col("t").startswith("数字人"), "NUMHUMAN").when(F.col("t").startswith("#"), "FRONT")
    told = rows.withColumn("kind", kind).withColumn("n", F.row_number().over(own())).select("book", "line_no", "t", "kind", "n")
    first = told.withColumn("found", F.last(F.when(F.col("kind").isNotNull(), F.struct("n", "kind", "t")), True).over(back().rowsBetween(W.unboundedPreceding, -1))).select("book", F.col("line_no").alias("last"), F.col("n").alias("at"), "found")
    out = runs.join(first, ["book", "last"])
    ok = (F.col("found.n") - F.col("at") <= ahead) & (F.col("found.kind") != "END")
    return out.select("book", "line_no", "images", F.when(F.coalesce(ok, F.lit(False)), F.col("found.kind")).otherwise("FRONT").alias("kind"), F.when(F.coalesce(ok, F.lit(False)) & (F.col("found.kind") == "FIG"), F.col("found.t")).alias("caption"))


def caption_map(lines: DataFrame) -> DataFrame:
    """(book, caption, images): the names of each run's images by the caption right after it, letter suffix kept."""
    c = T.strip(F.col("line"))
    full = lines.where(c != "").withColumn("t", c)
    part = F.col("t").startswith("![") | F.col("t").rlike("^[A-Z]$")
    rows = full.withColumn("grp", F.sum((~part).cast("int")).over(own()))
    names = F.regexp_extract("t", "images/([0-9a-f]+)\\.(?:jpg|jpeg|png)", 1)
    runs = rows.where(F.col("t").startswith("![")).groupBy("book", "grp").agg(F.array_sort(F.collect_list(F.struct("line_no", names.alias("name")))).alias("found"))
    key = F.regexp_extract("t", "^图\\s*([0-9]+-[0-9]+[A-Z]?)\\s*[　 \\u2003\\u2002\\t]+", 1)
    caps = rows.where(~part & (key != "")).select("book", (F.col("grp") - 1).alias("grp"), key.alias("caption"))
    return runs.join(caps, ["book", "grp"]).select("book", "caption", F.transform("found", lambda x: x["name"]).alias("images"))

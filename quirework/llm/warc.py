"""WARC derivatives: metadata and plain-text conversion records from response records.

A response is a row (key, target_uri, date, status, http_headers, payload). Each gives three linked records: the
response itself, a metadata record that refers to it, and a conversion record, which refers to it and holds its text.
Everything is built from SQL functions; files are written and read by Spark's own text source, because a record's end,
two line ends, is also what separates records.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm.common import prepare, renamed, slices

CRLF = "\r\n"
#: Character references that text extraction resolves, the ampersand last.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&"))
#: Elements whose end ends a line of text.
BLOCKS = "address|article|aside|blockquote|br|dd|div|dl|dt|figcaption|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul"


def plain_text(html: Column) -> Column:
    """The text of a page: without comments, scripts, styles and tags; a line for each block; single spaces."""
    out = F.regexp_replace(html, r"(?s)<!--.*?-->", " ")
    out = F.regexp_replace(out, r"(?is)<script\b.*?</script\s*>", " ")
    out = F.regexp_replace(out, r"(?is)<style\b.*?</style\s*>", " ")
    out = F.regexp_replace(out, r"[ \t\r\n]+", " ")
    out = F.regexp_replace(out, rf"(?i)</?(?:{BLOCKS})(?:[ /][^>]*)?>", "\n")
    out = F.regexp_replace(out, r"<[^>]*>", "")
    for name, char in ENTITIES:
        out = F.replace(out, F.lit(name), F.lit(char))
    out = F.regexp_replace(out, r" *\n[ \n]*", "\n")
    return F.regexp_replace(out, r"^[ \n]+|[ \n]+$", "")


def sha1_base32(body: Column) -> Column:
    """A WARC digest: sha1 in base 32, each 5 hex digits as 4 of base 32."""
    digest = F.sha1(body)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.concat(F.lit("sha1:"), F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"))


def record_id(kind: str, *of: Column) -> Column:
    """A name-based identifier: the same record has the same in each run."""
    h = F.md5(F.concat_ws("\n", F.lit(kind), *[F.coalesce(c.cast("string"), F.lit("")) for c in of]))
    return F.concat(F.lit("<urn:uuid:"), *[x for i, (a, n) in enumerate(((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) for x in ([F.lit("-")] if i else []) + [F.substring(h, a, n)]], F.lit(">"))


def responses(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Pages as response rows (key, target_uri, date, status, http_headers, payload)."""
    rows = renamed(pages, {"key": key, "target_uri": url, "payload": html})
    length = F.octet_length(F.coalesce("payload", F.lit(""))).cast("string")
    return rows.select("key", "target_uri", F.lit(date).alias("date"), F.lit(200).alias("status"), F.concat(F.lit("Content-Type: text/html; charset=utf-8\r\nContent-Length: "), length).alias("http_headers"), "payload")


def derive(rows: DataFrame) -> DataFrame:
    """One row for each record: key, type, record_id, refers_to, warc_headers (lines), block.

    Of a response row come a response, a metadata and a conversion record. The latter two have WARC-Refers-To with the
    response's id, WARC-Refers-To-Target-URI and -Date, and the digest of what they were made from; the metadata's
    block has fields of the source: its status, its own headers under a "source-" prefix, its payload digest, the
    id of the conversion, and sizes. Block and payload digests are sha1 in base 32. A null or empty payload has an
    empty conversion; a null address or key counts as empty in ids and gives no header. Repeated rows give repeated
    records with the same ids. Other columns are not looked at.
    """
    body = F.coalesce("payload", F.lit(""))
    made = rows.select("key", "target_uri", "date", "status", "http_headers", body.alias("payload"), plain_text(body).alias("text"))
    made = made.withColumn("source_digest", sha1_base32(F.col("payload").cast("binary"))).withColumn("text_digest", sha1_base32(F.col("text").cast("binary")))
    ids = {k: record_id(k, F.col("key"), F.col("target_uri"), F.col("source_digest")) for k in ("response", "metadata", "conversion")}
    made = made.select("*", *[v.alias(f"{k}_id") for k, v in ids.items()])
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value.cast("string"))
    http = F.concat(F.lit("HTTP/1.1 "), F.col("status").cast("string"), F.lit(CRLF), F.coalesce("http_headers", F.lit("")), F.lit(CRLF + CRLF), F.col("payload"))
    source = F.regexp_replace(F.coalesce("http_headers", F.lit("")), r"(?m)^(?=[^\r\n])", "source-")
    fields = F.concat_ws(CRLF, line("source-status", F.col("status")), F.nullif(source, F.lit("")), line("source-payload-digest", F.col("source_digest")), line("conversion-record", F.col("conversion_id")), line("conversion-digest", F.col("text_digest")), line("source-length", F.octet_length("payload")), line("text-length", F.octet_length("text")), line("text-lines", F.when(F.col("text") == "", 0).otherwise(F.regexp_count("text", F.lit("\n")) + 1)))
    kinds = F.array(
        F.struct(F.lit("response").alias("type"), F.col("response_id").alias("record_id"), F.lit(None).cast("string").alias("refers_to"), F.lit("application/http; msgtype=response").alias("content"), F.col("source_digest").alias("payload_digest"), http.alias("block")),
        F.struct(F.lit("metadata").alias("type"), F.col("metadata_id").alias("record_id"), F.col("response_id").alias("refers_to"), F.lit("application/warc-fields").alias("content"), F.lit(None).cast("string").alias("payload_digest"), fields.alias("block")),
        F.struct(F.lit("conversion").alias("type"), F.col("conversion_id").alias("record_id"), F.col("response_id").alias("refers_to"), F.lit("text/plain; charset=utf-8").alias("content"), F.col("text_digest").alias("payload_digest"), F.col("text").alias("block")),
    )
    each = made.select("key", "target_uri", "date", F.explode(kinds).alias("r")).select("key", "target_uri", "date", "r.*").withColumn("block_digest", sha1_base32(F.col("block").cast("binary")))
    derived = F.col("refers_to").isNotNull()
    head = F.concat_ws(
        CRLF,
        F.lit("WARC/1.1"),
        line("WARC-Type", F.col("type")),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", F.col("date")),
        F.when(F.col("target_uri") != "", line("WARC-Target-URI", F.col("target_uri"))),
        F.when(derived, line("WARC-Refers-To", F.col("refers_to"))),
        F.when(derived & (F.col("target_uri") != ""), line("WARC-Refers-To-Target-URI", F.col("target_uri"))),
        F.when(derived, line("WARC-Refers-To-Date", F.col("date"))),
        line("WARC-Block-Digest", F.col("block_digest")),
        line("WARC-Payload-Digest", F.col("payload_digest")),
        line("Content-Type", F.col("content")),
        line("Content-Length", F.octet_length("block")),
    )
    return each.select("key", "type", "record_id", "refers_to", "target_uri", "block_digest", "payload_digest", head.alias("warc_headers"), "block")


def write(records: DataFrame, path: str) -> None:
    """Writes records as WARC files, one a partition. Spark's committer makes each file whole or not there."""
    records.select(F.concat("warc_headers", F.lit(CRLF + CRLF), "block").alias("value")).write.option("lineSep", CRLF + CRLF).text(path)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    made = lambda heads, blocks: pa.RecordBatch.from_arrays([pa.array(heads, pa.string()), pa.array(blocks, pa.string())], ["warc_headers", "block"])
    for batch in slices(batches, 1):
        for raw in batch.column(0).to_pylist():
            heads, blocks, at = [], [], 0
            while at < len(raw):
                end = raw.index(b"\r\n\r\n", at)
                head = raw[at:end].decode()
                size = next(int(x.split(":", 1)[1]) for x in head.split(CRLF) if x.lower().startswith("content-length:"))
                heads.append(head)
                blocks.append(raw[end + 4 : end + 4 + size].decode("utf-8", "replace"))
                at = end + 4 + size + 4
                if len(heads) == 500:
                    yield made(heads, blocks)
                    heads, blocks = [], []
            yield made(heads, blocks)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(type, record_id, refers_to, target_uri, warc_headers, block) of the records of uncompressed WARC files of under
    2 GB each; blocks go by Content-Length."""
    prepare(spark)
    rows = spark.read.format("binaryFile").load(path).select("content").mapInArrow(_parse, "warc_headers string, block string")
    field = lambda name: F.nullif(F.regexp_extract("warc_headers", rf"(?im)^{name}: ([^\r\n]*)", 1), F.lit(""))
    return rows.select(field("WARC-Type").alias("type"), field("WARC-Record-ID").alias("record_id"), field("WARC-Refers-To").alias("refers_to"), field("WARC-Target-URI").alias("target_uri"), "warc_headers", "block")

"""The operators' queries over the driver's tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm import chunking, decontaminate, langid, mixing, pst, secretscan, simhash, tokenbin, voronoi, warc
from quirework.llm.common import scratch_path, table

ORACLE: dict[str, str] = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontaminate.scan(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), window=10, min_match=10)
    return marked.select(
        "doc_id",
        F.col("decon_words").alias("n_words"),
        F.col("decon_hit").alias("n_hit"),
        F.size("decon_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("decon_items"), ","), 256).alias("items_sha256"),
        (F.col("decon_hit") > 0).alias("contaminated"),
    )


ORACLE["op1_decontaminate"] = r"""
with docs as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
items as (select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark where text is not null and item_id is not null),
cut as (select item_id, w, least(len(w), 10) as k from items where len(w) > 0),
starts as (select item_id, w, k, unnest(range(1, len(w) - k + 2)) as i from cut),
windows as (select distinct item_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') as s from starts),
sizes as (select distinct k from windows),
places as (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from docs, sizes where len(w) >= k),
grams as (select doc_id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') as s from places),
hits as (select g.doc_id, g.k, g.i, x.item_id from grams g join windows x on g.k = x.k and g.s = x.s),
spots as (select doc_id, unnest(range(i, i + k)) as p from (select distinct doc_id, k, i from hits)),
hit as (select doc_id, count(distinct p) as n from spots group by doc_id),
own as (select doc_id, count(*) as n, string_agg(item, ',' order by item) as names from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(hit.n, 0) as bigint) as n_hit, cast(coalesce(own.n, 0) as bigint) as n_items,
  sha256(coalesce(own.names, '')) as items_sha256, coalesce(hit.n, 0) > 0 as contaminated
from docs d left join hit on d.doc_id = hit.doc_id left join own on d.doc_id = own.doc_id"""


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = langid.train(read(spark, sf_dir, "documents"))
    pages = read(spark, sf_dir, "pages")
    rows = pages.select("page_id", "url", warc.plain_text(F.col("html")).alias("text"), F.regexp_extract("html", r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z][A-Za-z0-9_-]*)", 1).alias("declared"))
    host, domain, suffix = langid.host_parts(F.col("url"))
    found = langid.identify(rows, model, F.col("text"), F.col("declared"), host, domain, suffix)
    return found.select("page_id", F.col("lid_host").alias("host"), F.col("lid_declared").alias("declared"), F.col("lid_text").alias("text_lang"), F.col("lid_lang").alias("lang"), F.round("lid_confidence", 6).alias("confidence"), F.col("lid_accepted").alias("accepted"))


def op4_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.derive(warc.responses(read(spark, sf_dir, "pages")))
    return records.select(F.col("key").alias("page_id"), "type", "record_id", "refers_to", "target_uri", "block_digest", "payload_digest", F.octet_length("block").cast("long").alias("length"), F.sha2("warc_headers", 256).alias("headers_sha256"))


def _warc_sql() -> str:
    text = "coalesce(html, '')"
    for pattern, to in ((r"(?s)<!--.*?-->", "' '"), (r"(?is)<script\b.*?</script\s*>", "' '"), (r"(?is)<style\b.*?</style\s*>", "' '"), (r"[ \t\r\n]+", "' '"), (rf"(?i)</?(?:{warc.BLOCKS})(?:[ /][^>]*)?>", "chr(10)"), (r"<[^>]*>", "''")):
        text = f"regexp_replace({text}, '{pattern}', {to}, 'g')"
    for name, char in warc.ENTITIES:
        text = f"replace({text}, '{name}', chr({ord(char)}))"
    text = f"regexp_replace(regexp_replace({text}, ' *\\n[ \\n]*', chr(10), 'g'), '^[ \\n]+|[ \\n]+$', '', 'g')"

    def digest(x: str) -> str:
        digits = ", ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + cast((v >> {5 * k}) & 31 as integer), 1)" for k in (3, 2, 1, 0))
        groups = ", ".join(f"cast('0x' || substr(sha1({x}), {5 * i + 1}, 5) as bigint)" for i in range(8))
        return f"'sha1:' || array_to_string(list_transform([{groups}], lambda v: concat({digits})), '')"

    def name(kind: str) -> str:
        h = f"md5('{kind}' || chr(10) || coalesce(cast(page_id as varchar), '') || chr(10) || coalesce(url, '') || chr(10) || sd)"
        return f"'<urn:uuid:' || substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' || substr({h}, 17, 4) || '-' || substr({h}, 21, 12) || '>'"

    nl, size = "chr(13) || chr(10)", "octet_length(encode({}))"
    return f"""
with t as (select page_id, url, coalesce(html, '') as html, {text} as txt from pages),
d as (select *, {digest('html')} as sd, {digest('txt')} as td from t),
i as (select *, {name('response')} as rid, {name('metadata')} as mid, {name('conversion')} as cid,
  'Content-Type: text/html; charset=utf-8' || {nl} || 'Content-Length: ' || {size.format('html')} as http,
  case when txt = '' then 0 else len(txt) - len(replace(txt, chr(10), '')) + 1 end as n from d),
r as (select page_id, url, 'response' as type, rid as record_id, null as refers_to, 'application/http; msgtype=response' as content, sd as payload_digest, 'HTTP/1.1 200' || {nl} || http || {nl} || {nl} || html as block from i
  union all select page_id, url, 'metadata', mid, rid, 'application/warc-fields', null, 'source-status: 200' || {nl} || 'source-' || replace(http, {nl}, {nl} || 'source-') || {nl} || 'source-payload-digest: ' || sd || {nl} || 'conversion-record: ' || cid || {nl} || 'conversion-digest: ' || td || {nl} || 'source-length: ' || {size.format('html')} || {nl} || 'text-length: ' || {size.format('txt')} || {nl} || 'text-lines: ' || n from i
  union all select page_id, url, 'conversion', cid, rid, 'text/plain; charset=utf-8', td, txt from i),
b as (select *, {digest('block')} as bd, {size.format('block')} as length from r)
select page_id, type, record_id, refers_to, url as target_uri, bd as block_digest, payload_digest, cast(length as bigint) as length,
  sha256('WARC/1.1' || {nl} || 'WARC-Type: ' || type || {nl} || 'WARC-Record-ID: ' || record_id || {nl} || 'WARC-Date: 1970-01-01T00:00:00Z' || {nl} || case when url <> '' then 'WARC-Target-URI: ' || url || {nl} else '' end
  || case when refers_to is null then '' else 'WARC-Refers-To: ' || refers_to || {nl} || case when url <> '' then 'WARC-Refers-To-Target-URI: ' || url || {nl} else '' end || 'WARC-Refers-To-Date: 1970-01-01T00:00:00Z' || {nl} end
  || 'WARC-Block-Digest: ' || bd || {nl} || case when payload_digest is null then '' else 'WARC-Payload-Digest: ' || payload_digest || {nl} end || 'Content-Type: ' || content || {nl} || 'Content-Length: ' || length) as headers_sha256
from b"""


ORACLE["op4_warc_derivatives"] = _warc_sql()


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.passages(read(spark, sf_dir, "documents"), min_words=50)


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi.top_k(read(spark, sf_dir, "embeddings"), k=5, every=50, factor=256)


ORACLE["op6_top_k"] = """
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e from embeddings where embedding is not null),
flat as (select vec_id, unnest(e) as x, unnest(range(1, len(e) + 1)) as i from v),
s as (select q.vec_id as query_id, d.vec_id, cast(sum(q.x * d.x) as bigint) as score from flat q join flat d on q.i = d.i and q.vec_id <> d.vec_id where q.vec_id % 50 = 0 group by 1, 2),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 5"""


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = mixing.sized(read(spark, sf_dir, "documents"))
    aims = table(mixing.targets(sizes, mixing.cycled(sizes, (5, 2, 1)), share=1.5, cap=2.0), "mix-aims")
    return mixing.taken(sizes, aims, mixing.draw(sizes, aims)).select("doc_id", "size", "source_size", "target", "taken", F.array_join("shards", ",").alias("shards"))


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    tokenbin.write(read(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return tokenbin.documents(spark, path)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    lexicon = secretscan.lexicon(docs)
    forest = secretscan.train(secretscan.labelled_findings(spark, lexicon), lexicon)
    found = secretscan.scan(docs, forest, lexicon)
    return found.select("doc_id", "place", F.length("candidate").alias("length"), F.sha2("candidate", 256).alias("candidate_sha256"), F.round("score", 6).alias("score"), "secret")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pst.score(read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k[:2] == "op" and k[2:3].isdigit()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)

"""Language identification by Bayesian evidence fusion.

log P(l | all) = TEMPER * log P(text | l) + log P(declared | l) + log P(suffix | l) + log P(l | host) + const.

The text's likelihood is of its byte trigrams, hashed, under models counted from labelled texts, one for each label there
is. A language's distribution is mixed, in a fixed share, with that of all labelled texts, and that with one that is alike
for all trigrams; so what a model gives to trigrams that it has not seen does not depend on how much it has seen. Once each text has its
likelihoods, what texts alone say is counted by declared language, by address suffix and by host; a host's
distribution is smoothed towards its domain's, and that towards the distribution of all. One more class, "und", gives
all trigrams alike and a low probability, above what languages give to trigrams that no label has: what fits no language
falls there.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirework.llm.common import bytes_of, prepare, renamed, slices, table

BUCKETS = 1 << 16
#: Neighbouring trigrams share bytes, so their evidence counts for less than its sum.
TEMPER = 0.3
#: Share of all labelled texts in a language's distribution, and of the flat distribution in that of all texts.
SHARED, FLAT = 0.1, 0.01
#: Probability of any trigram of no language, as a share of the flat one; above SHARED * FLAT.
ALIEN = 0.05
#: Pseudo-counts of each level's parent.
PARENT = 10.0
#: Languages whose models are broadcast together, 64 MB; more take more passes.
TOGETHER = 256


def trigrams(raw: bytes) -> np.ndarray:
    """Buckets of the byte trigrams of a lower-cased text with single spaces."""
    data = np.frombuffer(b" ".join([b"", *raw.lower().split(), b""]), np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.empty(0, np.uint32)
    return (data[:-2] << 16 | data[1:-1] << 8 | data[2:]) * np.uint32(2654435761) >> np.uint32(16)


def tag(declared: Column) -> Column:
    """The primary part of a language tag, lower case; null without one."""
    return F.nullif(F.lower(F.regexp_extract(declared, r"^\s*([A-Za-z]{2,3})(?:$|[-_;,\s])", 1)), F.lit(""))


class Model:
    """Trigram counts of all languages, as a table (lang, bucket, n), and of all labelled texts."""

    def __init__(self, languages: list[str], counts: DataFrame | None, totals: dict[int, int], whole: np.ndarray):
        self.languages, self.counts, self.totals = languages, counts, totals
        self.common = (1 - FLAT) * whole / max(1, whole.sum()) + FLAT / BUCKETS

    def parts(self) -> Iterator[np.ndarray]:
        """log P(trigram | language) of the languages in order, TOGETHER at a time; of no language last."""
        for first in range(0, len(self.languages), TOGETHER):
            some = range(first, min(first + TOGETHER, len(self.languages)))
            counts = np.zeros((len(some), BUCKETS))
            got = self.counts.where(F.col("lang").between(some[0], some[-1])).toArrow()
            counts[got["lang"].to_numpy() - first, got["bucket"].to_numpy()] = got["n"].to_numpy()
            own = counts / np.array([[self.totals[i]] for i in some])
            yield np.log((1 - SHARED) * own + SHARED * self.common).astype(np.float32).T.copy()
        yield np.full((BUCKETS, 1), np.log(ALIEN / BUCKETS), np.float32)


def likelihoods(logs: np.ndarray, raw: bytes) -> tuple[int, np.ndarray]:
    """(trigrams of a text, log P(text | language) by the columns of logs)."""
    found = trigrams(raw)
    total = np.zeros(logs.shape[1])
    step = max(1, (1 << 22) // logs.shape[1])
    for at in range(0, len(found), step):
        total += logs[found[at : at + step]].sum(axis=0, dtype=np.float64)
    return len(found), total


def train(labelled: DataFrame, text: str = "text", label: str = "lang") -> Model:
    """Counts trigrams by label over all rows of a known label, however few it has. Null labels and texts teach nothing, nor do
    labels whose texts have no trigram."""
    prepare(labelled.sparkSession)
    rows = renamed(labelled, {"body": text, "label": label}).select("body", tag(F.col("label")).alias("label")).where("label is not null and body is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def handed() -> Iterator[pa.RecordBatch]:
            for name, own in sums.items():
                some = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(own[some])], ["label", "bucket", "n"])
            sums.clear()

        for batch in slices(batches):
            for raw, name in zip(bytes_of(batch, "body"), batch.column(1).to_pylist(), strict=True):
                sums[name] = sums.get(name, 0) + np.bincount(trigrams(raw), minlength=BUCKETS)
            if len(sums) > TOGETHER // 4:
                yield from handed()
        yield from handed()

    counts = table(rows.mapInArrow(count, "label string, bucket int, n bigint").groupBy("label", "bucket").agg(F.sum("n").alias("n")), "lid-counts")
    found = sorted(map(tuple, counts.groupBy("label").agg(F.sum("n")).collect()))
    whole = np.zeros(BUCKETS)
    got = counts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    whole[got["bucket"].to_numpy()] = got["n"].to_numpy()
    names = labelled.sparkSession.createDataFrame([(i, x) for i, (x, _) in enumerate(found)], "lang int, label string")
    return Model([x for x, _ in found], counts.join(F.broadcast(names), "label").select("lang", "bucket", "n"), {i: n for i, (_, n) in enumerate(found)}, whole)


def host_parts(url: Column) -> tuple[Column, Column, Column]:
    """(host, domain, suffix) of an address: all of the host's name, its last two labels, its last."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)", 1))
    return host, F.regexp_extract(host, r"([^.]*(?:\.[^.]*)?)$", 1), F.regexp_extract(host, r"([^.]*)$", 1)


def _logs(count: Column, total: Column, parent: Column) -> Column:
    return F.log((count + F.lit(PARENT) * parent) / (total + F.lit(PARENT)))


def identify(rows: DataFrame, model: Model, text: Column, declared: Column, host: Column, domain: Column, suffix: Column, min_confidence: float = 0.5) -> DataFrame:
    """rows, each once and with all columns, with lid_lang, lid_confidence, lid_text (what the text alone says),
    lid_declared, lid_host and lid_accepted.

    Rejected: rows whose best class is "und" or of a confidence under min_confidence, and rows without a trigram
    (null, empty or blank texts), whose lid_lang is "und". Null or unknown declared languages are evidence of their own
    kind ("none", "other"); a null host is the host "". Columns of rows under the added names are replaced. Ties go to
    the language that sorts first. A model of no language rejects all.
    """
    spark = rows.sparkSession
    prepare(spark)
    names, n = model.languages, len(model.languages)
    added = ["lid_lang", "lid_confidence", "lid_text", "lid_declared", "lid_host", "lid_accepted"]
    base = rows.select(*[rows[f"`{c}`"] for c in rows.columns if c not in added], F.coalesce(text, F.lit("")).alias("lid__body"), tag(declared).alias("lid__tag"), F.coalesce(host, F.lit("")).alias("lid_host"), F.coalesce(domain, F.lit("")).alias("lid__domain"), F.coalesce(suffix, F.lit("")).alias("lid__suffix"))

    def scores(shared, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                found = [likelihoods(shared.value, raw) for raw in bytes_of(batch, "lid__body")]
                given = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
                before = given.pop("lid__ll").to_pylist()
                if last:
                    del given["lid__body"]
                given["lid__n"] = pa.array([k for k, _ in found], pa.int64())
                given["lid__ll"] = pa.array([[*old, *new.tolist()] for old, (_, new) in zip(before, found, strict=True)], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(list(given.values()), list(given))

        return run

    scored = base.withColumn("lid__n", F.lit(0).cast("long")).withColumn("lid__ll", F.array().cast("array<double>"))
    parts = list(model.parts())
    parts[-2:] = [np.concatenate(parts[-2:], axis=1)]
    for i, logs in enumerate(parts):
        last = i == len(parts) - 1
        fields = [f for f in scored.schema.fields if f.name not in ("lid__n", "lid__ll") and not (last and f.name == "lid__body")]
        schema = T.StructType([*fields, T.StructField("lid__n", T.LongType()), T.StructField("lid__ll", T.ArrayType(T.DoubleType()))])
        scored = scored.mapInArrow(scores(spark.sparkContext.broadcast(logs), last), schema)
        if not last:
            scored = table(scored, "lid-scored")
    known = F.when(F.col("lid__tag").isNull(), F.lit("none")).when(F.col("lid__tag").isin(names), F.col("lid__tag")).otherwise(F.lit("other")) if names else F.lit("other")
    guess = F.when(F.col("lid__n") > 0, F.array_position("lid__ll", F.array_max("lid__ll")) - 1).otherwise(F.lit(n)).cast("int")
    scored = table(scored.withColumn("lid_declared", known).withColumn("lid__guess", guess).drop("lid__tag"), "lid-text")
    counts = [F.sum(F.when(F.col("lid__guess") == i, 1).otherwise(0)).alias(f"c{i}") for i in range(n)]
    by_host = table(scored.groupBy("lid__suffix", "lid__domain", "lid_host").agg(F.count("*").alias("rows"), *counts), "lid-hosts")
    sums = [F.sum(f"c{i}").alias(f"c{i}") for i in range(n)]
    whole = by_host.agg(*sums, F.count("*")).first()
    totals = [float(whole[i] or 0) for i in range(n)]
    all_of = sum(totals)
    share = [(t + 1) / (all_of + n) for t in totals]
    total = lambda p="": reduce(lambda a, b: a + b, [F.col(f"{p}c{i}") for i in range(n)], F.lit(0))
    kinds = {(r[0], r[1]): r[2] for r in scored.groupBy("lid_declared", "lid__guess").count().collect()}
    told = {}
    for d in [*names, "none", "other"]:
        overall = (sum(kinds.get((d, i), 0) for i in range(n)) + 1) / (all_of + n + 2)
        told[d] = [float(np.log((kinds.get((d, i), 0) + PARENT * overall) / (totals[i] + PARENT))) for i in range(n)] + [float(np.log(overall))]
    suffixes = by_host.groupBy("lid__suffix").agg(F.count("*").alias("hosts"), *sums).withColumn("t", total())
    suffixes = suffixes.select("lid__suffix", F.array(*[F.log((F.col(f"c{i}") + F.lit(PARENT) * (F.col("t") + 1) / F.lit(all_of + 1)) / F.lit(totals[i] + PARENT)) for i in range(n)], F.log((F.col("t") + 1) / F.lit(all_of + 1))).alias("sx"))
    domains = by_host.groupBy(F.col("lid__domain").alias("dom")).agg(F.count("*").alias("hosts"), *[F.sum(f"c{i}").alias(f"d_c{i}") for i in range(n)]).withColumn("d_t", total("d_"))
    hosts = by_host.withColumn("t", total()).join(domains, by_host["lid__domain"] == F.col("dom"))
    of_domain = [(F.col(f"d_c{i}") + F.lit(PARENT * share[i])) / (F.col("d_t") + F.lit(PARENT)) for i in range(n)]
    prior = F.array(*[_logs(F.col(f"c{i}"), F.col("t"), of_domain[i]) for i in range(n)], F.lit(float(np.log(1e-3))))
    hosts = table(hosts.join(suffixes, "lid__suffix").select("lid__suffix", F.col("lid_host"), "lid__domain", F.zip_with(prior, F.col("sx"), lambda a, b: a + b).alias("lid__prior")), "lid-priors")
    keys = ["lid_host", "lid__domain", "lid__suffix"]
    tags = spark.createDataFrame(list(told.items()), "lid_declared string, lid__told array<double>")  # one row a language
    joined = scored.join(hosts, keys).join(F.broadcast(tags), "lid_declared")
    joined = joined.withColumn("lid__post", F.zip_with(F.zip_with(F.transform("lid__ll", lambda x: x * F.lit(TEMPER)), "lid__prior", lambda a, b: a + b), "lid__told", lambda a, b: a + b))
    joined = joined.withColumn("lid__top", F.array_max("lid__post")).withColumn("lid__best", F.array_position("lid__post", F.col("lid__top")).cast("int"))
    label = F.array(*map(F.lit, [*names, "und"]))
    some = F.col("lid__n") > 0
    confidence = F.lit(1.0) / F.aggregate("lid__post", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("lid__top")))
    out = joined.withColumn("lid_lang", F.when(some, F.element_at(label, F.col("lid__best"))).otherwise("und")).withColumn("lid_confidence", F.when(some, confidence).otherwise(0.0)).withColumn("lid_text", F.element_at(label, F.col("lid__guess") + 1))
    out = out.withColumn("lid_accepted", (F.col("lid_lang") != "und") & (F.col("lid_confidence") >= min_confidence))
    return out.select(*[F.col(f"`{c}`") for c in rows.columns if c not in added], *added)

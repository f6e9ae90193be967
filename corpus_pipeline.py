"""The corpus pipeline: language ID, near-dedup, decontamination, mixing, token output, one after another.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; it is written as Parquet and read again as the next one's
docs. All but the last return the columns of documents. A stage first deletes the scratch tables of those before it:
their results are written by then.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm import decontaminate, langid, mixing, simhash, tokenbin
from quirework.llm.common import forget, release, scratch_path, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what is of a language: the text, the declared language and the source are the evidence."""
    forget()
    source = F.col("source")
    found = langid.identify(docs, langid.train(docs), F.col("text"), F.col("lang"), source, source, F.lit(""))
    return found.where("lid_accepted").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: shingles of 5 words, similarity of 0.8 or more."""
    release(spark)
    return simhash.deduplicate(docs, shingle=5, similarity=0.8)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages of benchmark items, and documents of which more than half is such."""
    release(spark)
    clean = decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), max_coverage=0.5)
    return clean.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws documents so that sources come near their target weights; a document may stand there twice."""
    release(spark)
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token file and gives what it holds of each document."""
    release(spark)
    path = scratch_path(spark, "tokens")
    tokenbin.write(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return tokenbin.documents(spark, path)


STAGES = [("language ID", language), ("SimHash near-dedup", near_duplicates), ("benchmark decontamination", decontaminated), ("mixing sources", mixed), ("token output", tokens)]

#: Language models and tokenizers are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), "stage-" + name.split()[0].lower(), kept=True)
    return STAGES[-1][1](spark, docs, sf_dir)

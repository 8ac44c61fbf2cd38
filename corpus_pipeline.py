"""A corpus pipeline: each stage takes (spark, docs, sf_dir) and returns the documents that the next one works on.

Language ID drops texts that are no language; near copies leave one document of each class; long passages that occur
earlier are cut out; sources are mixed to target weights; what is left is encoded, and decoded to check it. Each stage is written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewise.llm import bpe, langid, mixing, probminhash, suffix
from tidewise.llm.arrays import stored
from tidewise.llm.queries import VOCABULARY, WEIGHTS, domain, language_model

#: Tokens of the mixture, as a multiple of what the earlier stages leave.
MIX_BUDGET = 0.8


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose text is in a known language; the lang column stays as it came."""
    found = langid.detect(docs, language_model(docs))
    return found.where(~F.col("rejected")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return probminhash.drop_near_duplicates(docs).select(*docs.columns)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated passages out of the texts; bytes of a character that was cut apart go with the passage."""
    cut = suffix.remove_repeats(docs, as_text=True)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    kept = cut.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long"))
    return kept.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each leaf's token prefix: the document at the cut keeps its first take_tokens words (ids occur once by now)."""
    mixed = mixing.mix(docs, domain(), MIX_BUDGET, WEIGHTS)
    short = mixing.word_count() > F.col("take_tokens")
    kept = mixed.withColumn("text", F.when(short, mixing.first_words(F.col("text"), F.col("take_tokens"))).otherwise(F.col("text")))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and the hash of what they decode to; a text that does not come back from its ids is an error."""
    coded = bpe.encode(docs, VOCABULARY, keep=["doc_id", "lang", "source", "text"], decoded=True)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    hashed = F.when(same, F.sha2("decoded", 256)).otherwise(F.raise_error(F.lit("decoding does not give the text")).cast("string"))
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids", "ends", hashed.alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("mixing", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Language models, signatures and suffix sorting are not SQL; tests compare with a plain version instead.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}

"""The registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, langid, mixing, oracle, packing, phrases, probminhash, quality, repair, suffix, topk, toxicity, urls

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")

#: The rules of the URL filter (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: Target weights of the mixture; names that are not listed weigh 1.
WEIGHTS = {"lang": {"en": 4.0, "de": 2.0, "fr": 2.0, "es": 2.0}}
BUDGET, EPOCHS, SEED = 0.5, 2, 17


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def held_out(id_column: str = "doc_id"):
    """The rows that nothing is learnt from: null ids are among the learnt."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 5 == 0, F.lit(False))


def domain():
    """A source's domain, of four: the first digits of its hash."""
    return F.concat(F.lit("domain"), (F.conv(F.substring(F.md5("source"), 1, 4), 16, 10).cast("int") % 4).cast("string"))


@query
def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.top_k(_read(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20, transform=lambda x: F.floor(x * 64))
    return found.withColumn("score", F.col("score").cast("long"))


ORACLE["op1_topk"] = oracle.TOPK_SQL


@query
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    mixed = mixing.mix(docs, domain(), BUDGET, WEIGHTS, EPOCHS, SEED)
    return mixed.select("doc_id", "domain", "lang", "source", "epoch", "take_tokens")


ORACLE["op2_mixing"] = oracle.mixing_sql(BUDGET, WEIGHTS, EPOCHS, SEED)


@query
def op3_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.near_duplicates(_read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "class_id")


@query
def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_read(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20)


def language_model(docs: DataFrame) -> langid.Model | None:
    return langid.fit(docs.where(~held_out()))


@query
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    found = langid.detect(docs.select("doc_id", "text"), language_model(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


@query
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, VOCABULARY, keep=["doc_id"], decoded=True).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query
def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = _read(spark, sf_dir, "pages").select("page_id", "url"), _read(spark, sf_dir, "labels")
    # A page's url ends in the id of the document it shows.
    document = F.regexp_extract(urls.parts(F.col("url"))[1], "/([0-9]{1,18})[^/]*/?$", 1)
    shown = pages.withColumn("shown", document).select("url", F.when(F.col("shown") != "", F.col("shown").cast("long")).alias("doc_id"))
    good = ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int")
    known = shown.join(labels.select("doc_id", good.alias("good")), "doc_id").select("url", "good")
    judged = urls.judge(pages, known, RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "template", F.round("purity", 6).alias("purity"))


ORACLE["op7_urls"] = oracle.urls_sql(RULES)


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix.remove_repeats(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packing.pack(_read(spark, sf_dir, "documents"), VOCABULARY)
    return rows.select(
        "shard", "row", "n_tokens", "doc_ids", "doc_starts", "cumulative",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("positions", 256).alias("positions_sha256"),
    )


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _read(spark, sf_dir, "labels").where("toxic is not null").select("doc_id", "toxic")
    found = toxicity.score(docs, toxicity.fit(docs, labels.where(~held_out())))
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_read(spark, sf_dir, "documents"))


ORACLE["op11_phrases"] = oracle.phrases_sql(phrases.LEAST, phrases.ABSORB, phrases.TOP)


@query
def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _read(spark, sf_dir, "labels").where("quality is not null").select("doc_id", "quality")
    found = quality.score(docs, quality.fit(docs, labels.where(~held_out())))
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query
def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations: by a hash of id and turn a row is dropped, emptied, loses its stops, is doubled or made the user's."""
    rows = _read(spark, sf_dir, "conversations")
    space = F.lit(" ")
    named = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    damage = F.crc32(named) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    text = F.when(damage == 1, "").when(damage == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    copies = F.when(damage == 0, 0).when(damage == 3, 2).otherwise(1)
    damaged = rows.select("conv_id", "turn", F.when(damage == 4, "user").otherwise(role).alias("role"), text.alias("text"), copies.alias("copies"))
    return repair.repair_digests(repair.turns(damaged, copies="copies"))

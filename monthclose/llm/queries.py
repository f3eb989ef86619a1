"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthclose.llm import chat, decontam, htmltext, langid, lmscore, merkle, mtree, neardup, packing, phrases, rangecoder, secrets, toxicity
from monthclose.llm.common import documents, remainder, small_batches
from monthclose.sources.files import work_dir


def op1_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    network, counts, rows = lmscore.learn(documents(spark, sf))
    return lmscore.score(rows, network, counts)


def op2_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    small_batches(spark)
    sample = langid.training_sample(docs, remainder("doc_id", 4) != 2, "doc_id", "text", "lang")
    found = langid.identify(docs, langid.learn(sample))
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op3_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf))


def op4_exact_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return mtree.top_k(spark.read.parquet(f"{sf}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


def op5_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontam.overlaps(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


def toxic_lexicon(spark: SparkSession, sf: str, docs: DataFrame) -> toxicity.Lexicon:
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return toxicity.learn(toxicity.training_sample(docs, labels, lambda c: remainder(c, 5) != 0))


def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    scored = toxicity.score(docs, toxic_lexicon(spark, sf, docs))
    return scored.select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op7_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return htmltext.extract(spark.read.parquet(f"{sf}/pages.parquet"), ["page_id", "url"])


def op8_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.scan(documents(spark, sf))


def tokenizer() -> str:
    """The public vocabulary file; it lies beside an installed package, on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op9_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(documents(spark, sf), tokenizer())


def op10_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    """All conversations, and conversation -7, whose texts are full of control strings."""
    own = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.digests(chat.windows(own.unionByName(extra)))


def op11_phrase_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.mine(documents(spark, sf)).drop("id")


def op12_token_files(spark: SparkSession, sf: str) -> DataFrame:
    """The files go to the shared work folder."""
    import public_tokenizers

    path = f"{work_dir(spark, 'tokens')}/t"
    rangecoder.write(documents(spark, sf), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return rangecoder.read(spark, path)


def op13_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Every third document by the checksum of its id is held against the manifest with its text in lower case."""
    own = F.col("doc_id").isNotNull() & (remainder("doc_id", 3) == 0)
    claimed = F.when(own, merkle.leaf(instead={"text": merkle.lowered(F.col("text"))}))
    return merkle.verified(merkle.manifest(merkle.leaves(documents(spark, sf), claimed=claimed)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_language_id": op2_language_id,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_exact_top_k": op4_exact_top_k,
    "op5_decontamination": op5_decontamination,
    "op6_toxicity": op6_toxicity,
    "op7_html_extraction": op7_html_extraction,
    "op8_secret_scan": op8_secret_scan,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_token_files": op12_token_files,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE: dict[str, str] = {
    "op3_near_duplicates": neardup.sql(),
    "op4_exact_top_k": mtree.sql(),
    "op5_decontamination": decontam.sql(),
    "op10_chat_formatting": chat.sql(
        "VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')"),
    "op11_phrase_collocations": phrases.sql(),
    "op13_merkle_manifest": merkle.sql(),
}

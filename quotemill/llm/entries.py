"""Queries of the operators for training data, over the whole tables, with SQL twins where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from quotemill.llm import chat_snapshots, fill_in_middle, license_rules, warc_normalise
from quotemill.llm.cgk_decontaminate import contamination
from quotemill.llm.exact_whitening import whiten
from quotemill.llm.language_hierarchy import identify, train_languages
from quotemill.llm.multiprobe_lsh import nearest
from quotemill.llm.pfair_mix import TARGET_WEIGHTS, interleave
from quotemill.llm.signature_tree_join import jaccard_groups
from quotemill.llm.suffix_tree_lm import score_texts
from quotemill.llm.token_transducer import count_tokens
from quotemill.llm.toxicity_chain import TOXIC, label_categories, score_toxicity, train_chain


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _remainder(n: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % n == 2


def op1_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal logged conversations, rendered."""
    return chat_snapshots.render(chat_snapshots.collapse(_read(spark, sf_dir, "conversations")))


def op2_multiprobe_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every 20th vector."""
    return nearest(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every document in the mixture."""
    documents = _read(spark, sf_dir, "documents").select("doc_id", "source")
    return interleave(documents, TARGET_WEIGHTS)


def op4_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of the categories for every document, and whether it is toxic."""
    documents = _read(spark, sf_dir, "documents").select("doc_id", "text")
    chain = train_chain(documents, _read(spark, sf_dir, "labels"), label_categories())
    scored = score_toxicity(documents, chain).drop("text")
    return scored.withColumn("toxic", F.col("p_toxic") > TOXIC)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose 4-word shingle sets have a Jaccard similarity of 0.85 or more."""
    return jaccard_groups(_read(spark, sf_dir, "documents"), size=4, percent=85)


def op6_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document."""
    return license_rules.scan_licenses(_read(spark, sf_dir, "documents"))


def op7_warc_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, archived, normalised and read back."""
    return warc_normalise.archive_round_trip(_read(spark, sf_dir, "pages"))


def op8_language_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    documents = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    documents = documents.withColumn("held_out", F.coalesce(_remainder(4), F.lit(False)))
    model = train_languages(documents.where("not held_out"))
    return identify(documents.select("doc_id", "held_out", "text"), model).drop("text")


def op9_cgk_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the benchmark items they hold."""
    return contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op10_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document by a suffix tree learned from those that are not held out."""
    return score_texts(_read(spark, sf_dir, "documents"), _remainder(7))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in its fill-in-middle form and rebuilt from it, as digests."""
    return fill_in_middle.round_trip(_read(spark, sf_dir, "documents"))


def op12_token_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by a public vocabulary."""
    return count_tokens(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_exact_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the first four whitened components."""
    return whiten(_read(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_snapshots,
        op2_multiprobe_lsh,
        op3_pfair_mix,
        op4_toxicity_chain,
        op5_jaccard_join,
        op6_license_rules,
        op7_warc_normalise,
        op8_language_hierarchy,
        op9_cgk_decontaminate,
        op10_suffix_tree_lm,
        op11_fill_in_middle,
        op12_token_transducer,
        op13_exact_whitening,
        pipeline,
    )
}

ORACLES: dict[str, str] = {
    "op1_chat_snapshots": chat_snapshots.ORACLE,
    "op6_license_rules": license_rules.oracle_sql(),
    "op7_warc_normalise": warc_normalise.ORACLE,
    "op11_fill_in_middle": fill_in_middle.ORACLE,
}

"""From raw documents to a training mixture, in stages that each read what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.llm.cgk_decontaminate import decontaminate
from quotemill.llm.language_hierarchy import UNKNOWN, identify, train_languages
from quotemill.llm.pfair_mix import TARGET_WEIGHTS, interleave
from quotemill.llm.signature_tree_join import jaccard_groups
from quotemill.llm.store import Store
from quotemill.llm.toxicity_chain import TOXIC, label_categories, score_toxicity, train_chain

# A language is not recognised below this score.
LEAST_SCORE = 0.3


def _set_apart(docs: DataFrame, *read: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with all columns but those that a stage reads renamed, and what undoes it.

    So a document's own column never meets one that the stage makes.
    """
    names = {c: c if c in read else f"__stage_{k}" for k, c in enumerate(docs.columns)}
    return docs.withColumnsRenamed(names), lambda df: df.select(*[F.col(n).alias(c) for c, n in names.items()])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain doesn't find toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    apart, back = _set_apart(docs, "doc_id", "text")
    scored = score_toxicity(apart, train_chain(docs.select("doc_id", "text"), labels, label_categories()))
    return back(scored.where(F.col("p_toxic") <= TOXIC))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised. Where nothing could be learned, all stay."""
    model = train_languages(docs)
    if not model.languages:
        return docs
    apart, back = _set_apart(docs, "doc_id", "text")
    found = identify(apart, model)
    return back(found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id.

    A document is an id with its text: rows that share an id, or have none, but differ
    in their texts are documents of their own, and rows equal in both are copies. Of
    documents with one id in a group the one with the smallest hash stays, and a null
    id comes last.
    """
    store = Store(spark, "groups")
    key = F.xxhash64("doc_id", "text")
    groups = jaccard_groups(docs.select(key.alias("key"), "text"), id_col="key", size=5, percent=80)
    ids = docs.select(key.alias("_k"), F.col("doc_id").alias("id")).distinct()
    groups = groups.select("key", "component_id").distinct().join(ids, F.col("key") == F.col("_k"))
    groups = store.put(groups.select("key", "component_id", "id"), "groups")
    first = groups.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "key")).alias("m"))
    first = first.select(F.col("component_id").alias("_c"), F.col("m.key").alias("_first"))
    others = groups.join(first, F.col("component_id") == F.col("_c")).where("key <> _first").select("key").distinct()
    others = store.put(others, "others").withColumnRenamed("key", "__stage_other")
    keyed = docs.withColumn("__stage_key", key)
    stay = keyed.join(others, F.col("__stage_key") == F.col("__stage_other"), "left_anti")
    return stay.dropDuplicates(["__stage_key"]).select(*docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, with its place in the mixture of sources."""
    return interleave(docs, TARGET_WEIGHTS)


STAGES = [
    ("toxicity", toxicity),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("mixture", mixture),
]

# Learned models and randomised searches are not for SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over the table documents, each written and read again."""
    store = Store(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store.put(stage(spark, docs, sf_dir), name)
    return docs

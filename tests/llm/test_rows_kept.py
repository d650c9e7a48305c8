"""No document is lost: repeated and null ids, and columns named like an operator's own."""

import collections

import pytest

import corpus_pipeline
from quotemill.llm.cgk_decontaminate import decontaminate
from quotemill.llm.pfair_mix import interleave
from quotemill.llm.suffix_tree_lm import score_texts
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ITEM = "seven quick foxes jumped over the very lazy dogs of my old uncle in the garden while it rained hard"


@pytest.fixture(scope="module", autouse=True)
def checkpoint_folder(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir("file://" + str(tmp_path_factory.mktemp("shared")))


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)


def prose(seed, n=60):
    return " ".join(f"w{(seed * 7919 + k * 104729) % 100003}" for k in range(n))


def test_decontaminate_judges_each_row(spark):
    rows = [(None, ITEM), (None, prose(1)), (7, f"{prose(2)} {ITEM}"), (7, prose(3)), (8, None), (9, ""), (7, prose(3))]
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    docs = docs_of(spark, rows).withColumn("_bad", F.lit(1)).withColumn("item_id", F.lit(2))
    kept = decontaminate(docs, bench)
    assert kept.columns == docs.columns
    got = collections.Counter((r.doc_id, r.text) for r in kept.collect())
    assert got == collections.Counter([(None, prose(1)), (7, prose(3)), (7, prose(3)), (8, None), (9, "")])
    assert decontaminate(docs.limit(0), bench).collect() == []
    assert decontaminate(docs, bench.limit(0)).count() == len(rows)


def test_near_duplicates_keeps_unrelated_texts_of_one_id(spark):
    near = prose(1) + " one"
    rows = [(1, prose(1)), (2, near), (2, prose(5)), (3, prose(6)), (3, prose(7)), (3, prose(7)), (None, prose(8)),
            (None, prose(8)), (None, prose(9)), (None, near), (4, ""), (5, ""), (6, None), (6, None)]
    kept = corpus_pipeline.near_duplicates(spark, docs_of(spark, rows).withColumn("key", F.lit(0)), "")
    got = sorted((r.doc_id or 0, r.text or "") for r in kept.collect())
    want = [(1, prose(1)), (2, prose(5)), (3, prose(6)), (3, prose(7)), (0, prose(8)), (0, prose(9)), (4, ""), (5, ""), (6, "")]
    assert got == sorted(want)


def test_scores_of_every_row(spark):
    rows = [(1, "a b c"), (1, "a b c"), (1, "a b"), (None, "a b"), (None, "a b"), (None, None), (2, ""), (2, "")]
    rows += [(3, "copies of this")] * 2500
    got = score_texts(docs_of(spark, rows), F.col("doc_id") == 2).collect()
    assert len(got) == len(rows)
    assert sum(r.doc_id == 3 for r in got) == 2500
    assert len({r.score for r in got if r.doc_id == 3}) == 1
    assert sum(r.held_out for r in got) == 2


def test_interleave_leaves_columns_of_like_names_alone(spark):
    rows = [(k, f"t{k}") for k in range(50)]
    docs = docs_of(spark, rows)
    for k, name in enumerate(("_n", "_s", "_h", "_row", "_bucket", "_slots", "_first", "_start", "_period")):
        docs = docs.withColumn(name, F.col("doc_id") + k)
    got = interleave(docs)
    assert got.columns == [*docs.columns, "block", "slot", "position"]
    assert all(r["_n"] == r.doc_id and r["_row"] == r.doc_id + 3 for r in got.collect())


def test_stages_return_the_documents_own_columns(spark):
    """Columns named like a stage's scores keep their values."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    named = docs.select("*", *[F.lit(-5).alias(c) for c in ("score", "lang_pred", "p_toxic", "p_low_quality")])
    for stage in (corpus_pipeline.toxicity, corpus_pipeline.language_id):
        got = stage(spark, named, sf)
        assert got.columns == named.columns
        assert {r.score for r in got.collect()} == {-5}

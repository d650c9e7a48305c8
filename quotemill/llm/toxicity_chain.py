"""Toxicity by a classifier chain over categories.

Method. Categories are predicted one after the other. Each has a linear
(logistic) model of which words and word beginnings a text holds, and of the probabilities of all
earlier categories. Those are out-of-fold predictions in training, so that a
later model learns from probabilities as good as it will meet.

Words are runs of letters, lower-cased, of the whole text. Training takes a
bounded sample of labelled rows; prediction covers every row and needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.llm.linear import Rows, fit, sigmoid
from quotemill.llm.words import NO_LETTER, slices, stems

# A document is toxic above this probability.
TOXIC = 0.5
# Labelled rows to learn from: at most so many of either value of the last category.
SAMPLE_ROWS = 6000
# Words that the models may use: the most telling of the sample, with at least this chi-square and,
# so that the words of one group of near copies don't count as telling, this squared correlation.
FEATURES, LEAST_CHI2, LEAST_PHI2 = 4096, 30.0, 0.01
FOLDS = 3
# Bytes of a word's beginning.
STEM = 4


def _word_sets(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple]:
    for batch in batches:
        for part in slices(batch.column(column), between=NO_LETTER):
            yield batch, part


def _held(part) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and of the beginnings in a slice, and the row of each."""
    row = np.repeat(np.arange(part.hi - part.lo), np.diff(part.first))
    return np.append(part.words, stems(part, STEM)), np.append(row, row)


class Chain:
    """Models in order: weights of words, of earlier probabilities, and intercept of each."""

    def __init__(self, words: np.ndarray, categories: Sequence[str]):
        self.words, self.categories, self.models = words, list(categories), []

    def train(self, rows: Rows, labels: np.ndarray, folds: np.ndarray) -> Chain:
        n, d = len(labels), len(self.words)
        earlier = np.zeros((n, 0))
        for k in range(len(self.categories)):
            y = np.where(labels[:, k] > 0, 1.0, -1.0)
            full = self._with(rows, earlier)

            def model(use, y=y, full=full, k=k):
                return fit(full, y, d + k, loss="logistic", l2=3e-4, use=use)

            out = np.zeros(n)
            if k + 1 < len(self.categories):
                for fold in range(FOLDS):
                    w, b = model(folds != fold)
                    out[folds == fold] = sigmoid(full.dot(w) + b)[folds == fold]
            self.models.append(model(np.ones(n, dtype=bool)))
            earlier = np.concatenate([earlier, out[:, None]], axis=1)
        return self

    def _with(self, rows: Rows, earlier: np.ndarray) -> Rows:
        """Rows with the earlier probabilities as further features."""
        out = Rows([])
        n, k = earlier.shape
        out.counts = rows.counts + k
        out.indices = np.append(rows.indices, np.tile(np.arange(k), n) + len(self.words)).astype(np.int64)
        out.values = np.append(rows.values, earlier.ravel())
        out.rows = np.append(rows.rows, np.repeat(np.arange(n), k))
        return out

    def features(self, part) -> Rows:
        """Which of the words each row of a slice holds."""
        out = Rows([])
        n = part.hi - part.lo
        if len(self.words) and len(part.words):
            words, row = _held(part)
            at = np.searchsorted(self.words, words)
            at[at == len(self.words)] = 0
            hit = np.flatnonzero(self.words[at] == words)
            pairs = np.unique(row[hit] * len(self.words) + at[hit])
            out.rows, out.indices = pairs // len(self.words), pairs % len(self.words)
        else:
            out.rows = out.indices = np.zeros(0, dtype=np.int64)
        out.values = np.ones(len(out.rows))
        out.counts = np.bincount(out.rows, minlength=n)
        return out

    def predict(self, rows: Rows) -> np.ndarray:
        earlier = np.zeros((len(rows.counts), 0))
        for w, b in self.models:
            d = len(self.words)
            margin = rows.dot(w[:d]) + earlier @ w[d:] + b
            earlier = np.concatenate([earlier, sigmoid(margin)[:, None]], axis=1)
        return earlier


def train_chain(
    docs: DataFrame,
    labels: DataFrame,
    categories: dict[str, F.Column],
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> Chain:
    """The chain learned from a sample of labelled rows.

    ``categories`` maps each category, in order, to a boolean expression over
    ``labels``. Label rows with a null id or a null category are left out; of
    several rows of one id, a category holds if it holds in any.
    """
    names = list(categories)
    told = labels.select(F.col(id_col).alias("_id"), *[c.cast("int").alias(n) for n, c in categories.items()])
    told = told.dropna().groupBy("_id").agg(*[F.max(n).alias(n) for n in names])
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("text")).where("text is not null")
    order = F.xxhash64("_id")
    chosen = None
    for value in (0, 1):
        part = told.where(F.col(names[-1]) == value).orderBy(order, "_id").limit(sample_rows)
        chosen = part if chosen is None else chosen.union(part)
    # At most 2 * sample_rows ids, so the documents stay where they are.
    sample = texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select("_id", *names, "text")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, part in _word_sets(batches):
            own = stems(part, STEM)
            held = [
                np.unique(np.append(part.words[a:b], own[a:b])).view(np.int64)
                for a, b in zip(part.first[:-1], part.first[1:], strict=True)
            ]
            columns = [batch.column(c).slice(part.lo, part.hi - part.lo) for c in ("_id", *names)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(held, type=pa.list_(pa.int64()))], names=["_id", *names, "words"]
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sample.schema if f.name != "text")
    held = sample.mapInArrow(words, f"{kinds}, words array<long>")
    held = held.dropDuplicates(["words"])  # copies count once
    sizes = held.agg(F.count("*").alias("n"), *[F.sum(n).alias(n) for n in names]).first()
    n = sizes["n"]
    if not n:
        return Chain(np.zeros(0, dtype=np.uint64), names).train(Rows([]), np.zeros((0, len(names))), np.zeros(0))
    counts = held.select(*names, F.explode("words").alias("word")).groupBy("word").agg(
        F.count("*").alias("df"), *[F.sum(x).alias(x) for x in names]
    )

    def chi2(name: str) -> F.Column:
        a, df, total = F.col(name).cast("double"), F.col("df").cast("double"), float(sizes[name])
        delta = a * n - df * total
        return delta * delta * n / (df * (n - df) * total * (n - total)) if 0 < total < n else F.lit(0.0)

    telling = counts.where((F.col("df") >= 5) & (F.col("df") < n)).select(
        "word", F.greatest(*[chi2(x) for x in names], F.lit(0.0)).alias("chi2")
    )
    telling = telling.where(F.col("chi2") >= max(LEAST_CHI2, LEAST_PHI2 * n)).orderBy(F.desc("chi2"), "word").limit(FEATURES)
    vocabulary = np.sort(np.array([r["word"] for r in telling.collect()], dtype=np.int64).view(np.uint64))
    known = F.array_intersect("words", F.lit(vocabulary.view(np.int64).tolist()).cast("array<long>"))
    rows = held.select(F.col("_id").cast("string").alias("_id"), *names, known.alias("words")).toArrow()
    chain = Chain(vocabulary, names)
    indices = [np.searchsorted(vocabulary, np.array(x, dtype=np.int64).view(np.uint64)) for x in rows["words"].to_pylist()]
    given = np.stack([rows[x].to_numpy() for x in names], axis=1)
    folds = np.array([sum(x.encode()) % FOLDS for x in rows["_id"].to_pylist()])
    return chain.train(Rows(indices), given, folds)


def score_toxicity(docs: DataFrame, chain: Chain, *, text_col: str = "text") -> DataFrame:
    """``docs`` with a column p_<category> for each category of the chain.

    A null or empty text gets what the chain says of a text without known words.
    A column of that name in ``docs`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    new = [f"p_{c}" for c in chain.categories]
    docs = docs.drop(*new)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = shared.value
        for batch, part in _word_sets(batches, text_col):
            p = chain.predict(chain.features(part))
            own = batch.slice(part.lo, part.hi - part.lo)
            yield pa.RecordBatch.from_arrays(
                [*own.columns, *[pa.array(p[:, k]) for k in range(len(new))]], names=[*own.schema.names, *new]
            )

    schema = T.StructType([*docs.schema.fields, *[T.StructField(name, T.DoubleType()) for name in new]])
    return docs.mapInArrow(predict, schema)


def label_categories() -> dict[str, F.Column]:
    """The categories of the table ``labels``, in the order of the chain."""
    return {"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1}

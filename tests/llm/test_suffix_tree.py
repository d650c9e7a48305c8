"""Scores of the suffix tree against a tree made word by word, at any depth and any bound of what is broadcast."""

import collections
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quotemill.llm import words
from quotemill.llm.store import Store
from quotemill.llm.suffix_tree_lm import _packed, _unpacked, score_texts


@pytest.fixture(scope="module", autouse=True)
def checkpoint_folder(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir("file://" + str(tmp_path_factory.mktemp("shared")))


def tree_scores(rows, held, kappa=5.0, divergence=0.01):
    """log10 probability of each text, and the longest context used."""
    texts = [(held(key), [*(text or "").split(), None]) for key, text in rows]
    count = collections.Counter(x for h, t in texts if not h for x in t)
    size = sum(count.values()) + len(count) + 1
    follow = collections.defaultdict(collections.Counter)
    for h, t in texts:
        if not h:
            for i in range(len(t)):
                for k in range(1, i + 1):
                    follow[tuple(t[i - k : i])][t[i]] += 1

    def share(s):
        return (len(follow[s]) + kappa) / (sum(follow[s].values()) + kappa)

    def p(s, x):
        if not s:
            return (count[x] + 1) / size
        return max(follow[s][x] - 1, 0) / (sum(follow[s].values()) + kappa) + share(s) * p(s[1:], x)

    known = {(): True}

    def state(s):
        if s not in known:
            known[s] = False
            if s in follow and state(s[1:]):
                pairs = [(p(s, x), p(s[1:], x)) for x in follow[s]]
                d = sum(a * math.log(a / b) for a, b in pairs)
                d += (1 - sum(b for _, b in pairs)) * share(s) * math.log(share(s))
                known[s] = d >= divergence
        return known[s]

    scores, longest = [], 0
    for _, t in texts:
        total = 0.0
        for i in range(len(t)):
            k = 0
            while k < i and state(tuple(t[i - k - 1 : i])):
                k += 1
            longest = max(longest, k)
            total += math.log10(p(tuple(t[i - k : i]), t[i]))
        scores.append(total)
    return scores, longest


def corpus(seed):
    draw = random.Random(seed)
    shared = draw.choices("abcdefgh", k=40)
    rows = []
    for k in range(60):
        text = draw.choices("abcdefghijklmnop", k=draw.randrange(30))
        at = draw.randrange(20)
        text += shared[at : at + 20] if k % 3 == 0 else []
        text += [f"rare{k // 2}"] if k % 7 == 0 else []
        rows.append((k, " ".join(text)))
    return [*rows, (60, None), (61, ""), (62, rows[3][1]), (62, rows[3][1])]


def test_states_of_any_depth(spark):
    rows = corpus(5)
    want, longest = tree_scores(rows, lambda key: key % 5 == 2)
    assert longest > 3
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = score_texts(df, F.col("doc_id") % 5 == 2).collect()
    found = sorted((r.doc_id, r.score) for r in got)
    for (key, score), (expected, value) in zip(found, sorted((k, w) for (k, _), w in zip(rows, want, strict=True)), strict=True):
        assert key == expected and abs(score - value) < 1e-9


def test_bounds_of_the_broadcast_change_no_score(spark):
    rows = corpus(6)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want, _ = tree_scores(rows, lambda key: key % 5 == 2)
    for p_head, p_min in ((0.02, 0.05), (1.0, 1.0)):
        got = score_texts(df, F.col("doc_id") % 5 == 2, p_head=p_head, p_min=p_min).collect()
        by_id = {r.doc_id: r.score for r in got}
        assert len(got) == len(rows)
        assert all(abs(by_id[key] - w) < 1e-9 for (key, _), w in zip(rows, want, strict=True))


def test_texts_without_words(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (None, " ")], "doc_id long, text string")
    got = score_texts(df, F.col("doc_id") == 2).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in got] == [(1, 1, 2)] * 3
    assert all(abs(r.score - math.log10(3 / 4)) < 1e-9 for r in got)
    assert score_texts(df.where("false"), F.col("doc_id") == 2).collect() == []


def test_contexts_with_more_tokens_than_a_bucket_takes(spark):
    rows = corpus(7) + [(100 + k, "so it goes on and on and on") for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want, _ = tree_scores(rows, lambda key: key % 5 == 2)
    # Three levels or more of contexts are too large for a bucket, and for the others there are many buckets.
    for p_head, most, bucket_size in ((1e-6, 20, 50), (0.1, 20, 50), (1e-6, 5, 1 << 20)):
        got = score_texts(df, F.col("doc_id") % 5 == 2, p_head=p_head, p_min=1.0, most=most, bucket_size=bucket_size).collect()
        by_id = {r.doc_id: r.score for r in got}
        assert len(got) == len(rows)
        assert all(abs(by_id[key] - w) < 1e-9 for (key, _), w in zip(rows, want, strict=True))


def test_several_levels_in_one_pass(spark, monkeypatch):
    """A tree as deep as this took three tables or more a level."""
    rows = corpus(5)
    _, longest = tree_scores(rows, lambda key: key % 5 == 2)
    tables, put = [], Store.put
    monkeypatch.setattr(Store, "put", lambda self, df, name: tables.append(name) or put(self, df, name))
    score_texts(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") % 5 == 2).collect()
    assert longest >= 6 and len(tables) <= 12


def test_tokens_of_chunks_are_not_shuffled(spark, monkeypatch):
    """Tables by chunk were joined with the chunks' tokens on either side of a shuffle."""
    rows = corpus(7) + [(100 + k, "so it goes on and on and on") for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    tables, moved, put = [], [], Store.put

    def seen(self, df, name):
        nodes = [df._jdf.queryExecution().executedPlan()]
        while nodes:
            node = nodes.pop()
            if node.nodeName().startswith("AdaptiveSparkPlan"):
                node = node.executedPlan()
            if node.nodeName().startswith("Exchange"):
                output = node.output()
                moved.extend(output.apply(k).name() for k in range(output.size()))
            children = node.children()
            nodes += [children.apply(k) for k in range(children.size())]
        tables.append(name)
        return put(self, df, name)

    monkeypatch.setattr(Store, "put", seen)
    score_texts(df, F.col("doc_id") % 5 == 2, p_head=0.1, p_min=1.0, most=20, bucket_size=50).collect()
    assert {"hot", "grown", "sums"} <= set(tables) and "payload" in moved
    assert "tokens" not in moved
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(("rows_", "counted_", "hot_"))]


def test_packed_columns():
    draw = np.random.default_rng(3)
    for n in (0, 1, 511, 512, 5000):
        columns = [
            draw.integers(0, 1 << 20, n).astype(np.int32), np.full(n, -3, dtype=np.int32), np.zeros(n, dtype=np.int32),
            draw.random(n) < 0.5, draw.normal(size=n), draw.integers(-9, 1 << 60, n), draw.integers(0, 256, n // 3).astype(np.uint8),
        ]
        for got, column in zip(_unpacked(_packed(*columns)), columns, strict=True):
            assert got.dtype == column.dtype and np.array_equal(got, column)


def test_words_of_any_length():
    """Hashes as a sum over the bytes of each word, made word by word."""
    draw = random.Random(4)
    texts = ["", " ", "x" * 20_000, "Ab " + "y" * 48 + " " + "z" * 49, "é" * 40, None]
    texts += [" ".join("q" * draw.randrange(60) for _ in range(draw.randrange(9))) for _ in range(50)]
    got = [w for part in words.slices(pa.array(texts), limit=400) for w in part.words.tolist()]
    want = []
    for text in texts:
        for word in (text or "").encode().split():
            terms = [int(words._OF_BYTE[b]) * int(words._OF_POSITION[k % (1 << 14)]) for k, b in enumerate(word)]
            want.append(int(words.mix(np.array([(sum(terms) + len(word)) % (1 << 64)], dtype=np.uint64))[0]))
    assert got == want

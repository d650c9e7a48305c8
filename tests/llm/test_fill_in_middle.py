"""Fill-in-middle: against plain string slicing, exact inversion, odd inputs."""

import hashlib
import random
import re

import numpy as np
import pytest

from quotemill.llm import fill_in_middle as fim

DOCS = "doc_id long, text string, n long, form string, output string"


def brute(doc_id, text, fim_percent=100, spm_percent=50):
    """By slicing lists of lines, with no buffer and no rotation."""
    text = text or ""
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim_percent:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < spm_percent:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def some_texts(seed, count):
    rng = random.Random(seed)
    pieces = ["a", "é", "語", "😀", " ", "\n", "\n\n", "\r\n", "<", ">", "<P", "S>", "M", "word", "\x85", " "]
    return ["".join(rng.choices(pieces, k=rng.randint(0, 40))) for _ in range(count)]


def odd_rows():
    rows = [(None, "a\nb\nc\n"), (1, None), (2, ""), (3, "\n"), (3, "\n"), (3, "x\ny"), (4, "has <S> inside\nb"),
            (5, "no newline"), (6, "<\n<\n>P>\n<P\n"), (7, "long " * 200_000 + "\n" + "z" * 70_001 + "\nend")]
    return rows + list(enumerate(some_texts(1, 300), start=100))


def test_equals_plain_slicing(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(i, t, -1, "clash", "clash") for i, t in rows], DOCS)
    got = fim.fill_in_middle(df).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((brute(i, t) for i, t in rows), key=repr)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


@pytest.mark.parametrize(("share", "spm"), [(0, 50), (60, 0), (60, 100)])
def test_shares_are_parameters(spark, share, spm):
    rows = odd_rows()
    df = spark.createDataFrame([(i, t, -1, "", "") for i, t in rows], DOCS)
    got = fim.fill_in_middle(df, fim_percent=share, spm_percent=spm).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((brute(i, t, share, spm) for i, t in rows), key=repr)


def test_restores_every_text_and_keeps_other_columns(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(i, t, -1, "", "") for i, t in rows], DOCS)
    made = fim.fill_in_middle(df)
    back = fim.restore(made)
    assert back.columns == made.columns
    assert sorted((repr(r.doc_id), r.output) for r in back.collect()) == sorted((repr(i), t or "") for i, t in rows)


def test_digests(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(i, t, -1, "", "") for i, t in rows], DOCS)
    got = fim.round_trip(df).collect()
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    want = [(*brute(i, t)[:5], sha(brute(i, t)[5]), sha(t)) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    df = spark.createDataFrame([], DOCS)
    assert fim.round_trip(df).collect() == []
    assert fim.round_trip(df).columns[:5] == ["doc_id", "n", "form", "prefix_chars", "middle_chars"]


def test_small_batches_give_the_same_rows(spark):
    """Record batches of seven rows."""
    df = spark.createDataFrame([(i, t, -1, "", "") for i, t in odd_rows()], DOCS).coalesce(1)
    whole = sorted(map(tuple, fim.fill_in_middle(df).collect()), key=repr)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert sorted(map(tuple, fim.fill_in_middle(df).collect()), key=repr) == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("block", [1, 2, 3, 64])
def test_rotation_is_in_place(monkeypatch, block):
    monkeypatch.setattr(fim, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(200):
        buffer = bytearray(rng.randbytes(rng.randint(0, 50)))
        lo, cut, hi = sorted(rng.randint(0, len(buffer)) for _ in range(3))
        want = buffer[:lo] + buffer[cut:hi] + buffer[lo:cut] + buffer[hi:]
        view = np.frombuffer(buffer, dtype=np.uint8)
        fim.exchange(buffer, lo, cut, hi)
        assert buffer == want
        assert bytes(view) == bytes(want)

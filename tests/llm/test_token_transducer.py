"""Token counts against the library of the vocabulary, and the parts of the transducers by themselves."""

import json
import os
import random

import numpy as np
import pyarrow as pa
import pytest

from quotemill.llm import entries
from quotemill.llm import token_transducer as tt

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, n_tokens long, t string"


@pytest.fixture(scope="module")
def library():
    made = tokenizers.Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in made.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.fixture(scope="module")
def vocabulary():
    return tt.read_vocabulary(PATH)


@pytest.fixture(scope="module")
def transducer(vocabulary):
    return tt.Transducer(vocabulary)


def counts(transducer, texts):
    return transducer.count(pa.array(texts, pa.string()))[1].tolist()


def mixed_texts(seed, count, longest):
    rng = random.Random(seed)
    parts = ["'", "s", "t", "re", "ve", "ll", "m", "d", "r", "v", "l", "e", "'S", " ", "  ", "\n", "\t", "\r\n", "\x85"]
    parts += ["a", "aaa", "1", "23", "é", "語", "😀", "!", "--", "=", " ", "　", "the", "ing", "\x00", "०"]
    parts += ["<|endoftext|>", "<|endof", "|>"]
    return ["".join(rng.choices(parts, k=rng.randint(0, longest))) for _ in range(count)]


def test_random_texts(transducer, library):
    texts = mixed_texts(1, 4000, 60)
    assert counts(transducer, texts) == library(texts)


def test_any_code_point(transducer, library):
    """Beside a letter, a number and a mark, so that its class shows."""
    rng = random.Random(2)
    points = [rng.choice((rng.randrange(0x3000), rng.randrange(0xD800), rng.randrange(0xE000, 0x110000))) for _ in range(6000)]
    texts = [f"a{chr(c)}a 1{chr(c)}1 !{chr(c)}! {chr(c)} {chr(c)}" for c in points]
    assert counts(transducer, texts) == library(texts)


def test_runs_and_long_pieces(transducer, library):
    rng = random.Random(3)
    texts = ["a" * k for k in range(300)] + [" " * k + "x" for k in range(300)] + ["-=" * k for k in range(200)]
    texts += ["".join(rng.choices("abcdefghij", k=n)) for n in (257, 512, 513, 5000, 60_000)]
    texts += ["z" * 200_000, "\n" * 5000, "ab" * 40_000]
    assert counts(transducer, texts) == library(texts)


@pytest.mark.parametrize("size", [16, 64, 300])
def test_blocks_of_long_texts(transducer, library, monkeypatch, size):
    """Texts longer than a block are read in blocks that end where a piece starts."""
    monkeypatch.setattr(tt, "SLICE_BYTES", size)
    texts = [*mixed_texts(size, 150, 900), "q" * 3000, "x \n\n" * 1000, "語" * 900]
    assert counts(transducer, texts) == library(texts)


def test_restart_changes_nothing(vocabulary, library, monkeypatch):
    monkeypatch.setattr(tt, "SLICE_BYTES", 1000)
    monkeypatch.setattr(tt, "MOST_TRANSITIONS", 200)
    texts = mixed_texts(4, 500, 60)
    assert counts(tt.Transducer(vocabulary), texts) == library(texts)


def test_scan_equals_reading_in_order(monkeypatch):
    """Marks by chunk maps and prefix scan are those of one reader from the first symbol on."""
    rng = np.random.default_rng(5)
    for width in (1, 2, 7, 256):
        monkeypatch.setattr(tt, "CHUNK", width)
        for n in (1, 2, 13, 300):
            symbols = rng.integers(0, 12, n).astype(np.uint8)
            state, want = tt.START, np.zeros(n, dtype=bool)
            for k, symbol in enumerate(symbols.tolist()):
                state, marks = tt._split_step(state, symbol)
                want[k] |= bool(marks & tt.CURRENT)
                if marks & tt.PREVIOUS:
                    want[k - 1] = True
            assert (tt.split_marks(symbols) == want).all()


def test_gains_sum_to_prefix_counts(transducer, library):
    """After every byte of a piece the emitted tokens are the count of the prefix."""
    word = "internationalisation"
    data = np.frombuffer(word.encode(), dtype=np.uint8)
    states, total, seen = np.zeros(1, dtype=np.int64), 0, []
    for k in range(len(data)):
        states, gain = transducer.read(data, np.array([k]), np.array([1]), states)
        total += int(gain[0])
        seen.append(total)
    assert seen == library([word[: k + 1] for k in range(len(word))])


def test_odd_rows(spark, library):
    rows = [(1, None), (2, ""), (None, "no id"), (3, "same"), (3, "same"), (3, "other text"), (4, "<|endoftext|>"),
            (5, "a<|endoftext|><|endoftext|> b"), (6, "word " * 120_000), (7, "w" * 700_000), (8, "token " * 511 + "a"),
            (9, "token " * 512 + "a")]
    df = spark.createDataFrame([(i, t, -1, "clash") for i, t in rows], DOCS)
    got = tt.count_tokens(df, PATH).collect()
    n = library([t for _, t in rows])
    want = [(i, len((t or "").encode()), k, k > 512) for (i, t), k in zip(rows, n, strict=True)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert {r.over_limit for r in got} == {True, False}


def test_limit_and_empty_table(spark):
    df = spark.createDataFrame([(1, "one two three", 0, "")], DOCS)
    assert tt.count_tokens(df, PATH, limit=2).first().over_limit
    assert not tt.count_tokens(df, PATH, limit=3).first().over_limit
    assert tt.count_tokens(df.limit(0), PATH).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_query_on_the_whole_table(spark, library):
    got = {r.doc_id: tuple(r)[1:] for r in entries.op12_token_transducer(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    n = library([r.text for r in rows])
    assert got == {r.doc_id: (len((r.text or "").encode()), k, k > 512) for r, k in zip(rows, n, strict=True)}


def test_other_vocabularies_are_an_error(tmp_path):
    with pytest.raises(ValueError, match="byte-level"):
        tt.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    content = json.load(open(PATH, encoding="utf-8"))
    content["added_tokens"][0]["lstrip"] = True
    path = tmp_path / "changed.json"
    path.write_text(json.dumps(content), encoding="utf-8")
    with pytest.raises(ValueError, match="added tokens"):
        tt.read_vocabulary(str(path))

"""The operators for training data against brute force, and on odd inputs."""

import collections
import gzip
import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quotemill.llm import entries
from quotemill.llm.chat_snapshots import collapse, render
from quotemill.llm.cgk_decontaminate import contamination, decontaminate, distance_limit, word_distance
from quotemill.llm.components import components
from quotemill.llm.language_hierarchy import identify, train_languages
from quotemill.llm.license_rules import SENTENCES, scan_licenses
from quotemill.llm.multiprobe_lsh import nearest
from quotemill.llm.pfair_mix import interleave, period, phases
from quotemill.llm.signature_tree_join import jaccard_groups
from quotemill.llm.store import Store
from quotemill.llm.suffix_tree_lm import END, Tree, score_texts
from quotemill.llm.toxicity_chain import label_categories, score_toxicity, train_chain
from quotemill.llm.warc_normalise import normalise, read_back, record, write_archives

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module", autouse=True)
def checkpoint_folder(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir("file://" + str(tmp_path_factory.mktemp("shared")))


def read(spark, table):
    return spark.read.parquet(f"{SF}/{table}.parquet")


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)


def words(text):
    return (text or "").encode().lower().split()


def brute_groups(rows, size, percent):
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), key), key)
    return {(key, len(sets[i]), least[find(i)]) for i, (key, _) in enumerate(rows)}


def near_copies(seed):
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    rows = []
    for group in range(12):
        base = draw.choices(vocabulary, k=draw.choice([3, 8, 40, 150, 600]))
        for _ in range(draw.choice([1, 2, 5, 40])):
            copy = list(base)
            for _ in range(draw.choice([0, 0, 1, 2, len(base) // 40])):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            rows.append((len(rows) * 7 % 1009 + 1009 * group, " ".join(copy)))
    passage = " ".join(draw.choices(vocabulary, k=30))
    rows += [(20000 + k, passage + " " + " ".join(draw.choices(vocabulary, k=20))) for k in range(40)]
    return rows


@pytest.mark.parametrize("size, percent", [(4, 85), (5, 80)])
def test_groups_equal_brute_force(spark, size, percent):
    rows = near_copies(size)
    got = jaccard_groups(docs_of(spark, rows), size=size, percent=percent).collect()
    assert {tuple(r) for r in got} == brute_groups(rows, size, percent)
    assert len(got) == len(rows)


def test_groups_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one  TWO"), (6, "one"), (None, "one two"), (4, "One two")]
    got = sorted((tuple(r) for r in jaccard_groups(docs_of(spark, rows)).collect()), key=str)
    assert got == sorted(
        [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (4, 1, 4), (5, 1, 4), (6, 1, 6), (None, 1, None)], key=str
    )
    assert jaccard_groups(docs_of(spark, [])).count() == 0


@needs_tables
def test_groups_of_the_table(spark):
    rows = [tuple(r) for r in read(spark, "documents").select("doc_id", "text").collect()]
    got = entries.QUERIES["op5_jaccard_join"](spark, SF).collect()
    assert {tuple(r) for r in got} == brute_groups(rows, 4, 85)


def test_components_of_chain_and_star(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 100 + k) for k in range(1, 50)] + [(7, 7)]
    got = components(Store(spark, "t"), spark.createDataFrame(edges, "a long, b long")).collect()
    assert {tuple(r) for r in got} == {(k, 0) for k in range(61)} | {(100 + k, 100) for k in range(50)}


@needs_tables
def test_neighbours_reach_their_recall_and_are_exact(spark):
    rows = read(spark, "embeddings").collect()
    ids = np.array([r.vec_id for r in rows])
    matrix = np.array([r.embedding for r in rows], dtype=np.float64)
    found = collections.defaultdict(list)
    for r in entries.QUERIES["op2_multiprobe_lsh"](spark, SF).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    hits = total = 0
    for at in np.flatnonzero(ids % 20 == 0):
        scores = matrix @ matrix[at]
        order = [k for k in np.lexsort((ids, -scores)) if k != at][:20]
        got = found[ids[at]]
        assert [s for _, s in got] == sorted((s for _, s in got), reverse=True)
        assert all(abs(s - scores[np.flatnonzero(ids == v)[0]]) < 1e-12 for v, s in got)
        hits += len({v for v, _ in got} & set(ids[order]))
        total += len(order)
    assert hits / total >= 0.9


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0])]
    rows += [(7, [None, 1.0]), (8, [1.0]), (None, [1.0, 0.0]), (9, [3.0, 0.0]), (2, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    options = {"k": 3, "tables": 8, "probes": 200}
    got = nearest(df, F.col("vec_id") == 0, **options).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 9, 3.0), (0, 2, 1, 1.0), (0, 3, 2, 1.0)]
    assert nearest(df.where("false"), F.lit(True)).count() == 0


def test_a_repeated_id_displaces_no_neighbour(spark):
    draw = np.random.default_rng(2)
    other = [(k, [1.0, *(0.01 * draw.normal(size=3)).tolist()]) for k in range(60)]
    hot = [(1000, [1.5, *(0.01 * draw.normal(size=3)).tolist()]) for _ in range(200)]
    df = spark.createDataFrame([*other, *hot], "vec_id long, embedding array<double>")
    score = {k: float(np.dot(v, other[0][1])) for k, v in other[1:]}
    score[1000] = max(float(np.dot(v, other[0][1])) for _, v in hot)
    expected = sorted(score, key=lambda k: (-score[k], k))[:20]
    # One bucket holds all.
    options = {"tables": 1, "hashes": 1, "width": 1000.0, "probes": 3}
    got = nearest(df, F.col("vec_id") == 0, **options).orderBy("rank").collect()
    assert [r.vec_id for r in got] == expected


def exact_neighbours(rows, key, k):
    score = {i: float(np.dot(v, dict(rows)[key])) for i, v in rows if i != key}
    return sorted(score, key=lambda i: (-score[i], i))[:k]


def test_few_candidates_are_all_returned(spark):
    draw = np.random.default_rng(3)
    rows = [(k, draw.normal(size=32).tolist()) for k in range(15)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in nearest(df, F.col("vec_id") < 3, probes=1, tables=1).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert dict(got) == {q: exact_neighbours(rows, q, 20) for q in range(3)}


def test_one_long_vector_costs_no_recall(spark):
    draw = np.random.default_rng(4)
    rows = []
    for k in range(600):
        v = draw.normal(size=64)
        rows.append((k, (v / np.linalg.norm(v) * (5 if k == 599 else 1)).tolist()))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collections.defaultdict(set)
    for r in nearest(df, F.col("vec_id") % 20 == 0).collect():
        got[r.query_id].add(r.vec_id)
    assert all(len(x) == 20 for x in got.values()) and len(got) == 30
    assert sum(len(got[q] & set(exact_neighbours(rows, q, 20))) for q in got) >= 0.9 * 600


def test_a_period_stays_within_one_block():
    weights = {0: 4, 1: 2, 2: 2, 3: 1, 4: 7, 5: 1}
    total, sent = sum(weights.values()), collections.Counter()
    for slot, source in enumerate(period(weights), 1):
        sent[source] += 1
        assert all(abs(sent[s] - w * slot / total) < 1 for s, w in weights.items())
    assert sent == weights


def test_mixture_holds_all_rows_and_its_weights(spark):
    rows = [(k, "x", "en", "abc"[min(2, k % 7)] if k % 11 else None, 0) for k in range(3000)]
    rows += rows[:5] + [(None, None, None, "a", 1)]
    weights = {"a": 3, "b": 2, None: 1, "c": 1}
    out = interleave(spark.createDataFrame(rows, DOCS), weights, block_rows=8)
    got = out.orderBy("position").collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(rows, key=str)
    assert len({r.position for r in got}) == len(rows)
    assert sorted({r.slot for r in got}) == list(range(max(r.slot for r in got) + 1))
    at = {r.slot: r.source for r in got}
    left = collections.Counter(at.values())
    sent = collections.Counter()
    for slot in range(len(at)):
        sent[at[slot]] += 1
        if any(sent[s] == left[s] for s in left):
            break
        assert all(abs(sent[s] - w * (slot + 1) / 7) < 1 for s, w in weights.items())
    assert slot > 50
    assert interleave(spark.createDataFrame([], DOCS)).count() == 0


def test_phases_place_each_block_once():
    blocks = {0: 17, 1: 5, 2: 40}
    seen, slots = collections.Counter(), set()
    for source, first, n, start, length, own in phases({0: 2, 1: 3, 2: 1}, blocks):
        for k in range(n):
            slots.add(start + k // len(own) * length + own[k % len(own)])
            seen[source, first + k] += 1
    assert slots == set(range(62)) and len(seen) == 62


@needs_tables
def test_chain_finds_labelled_toxic_texts(spark):
    docs = read(spark, "documents")
    rows = [(r.doc_id * 100 + k, f"{r.text} {extra}") for r in docs.limit(60).collect() for k, extra in enumerate(["", "you vile scum"])]
    labels = spark.createDataFrame([(i, 1, i % 100) for i, _ in rows] + [(None, 1, 1), (5, None, 1)], "doc_id long, quality int, toxic int")
    df = docs_of(spark, [*rows, (9999, None), (9998, "")])
    got = {r.doc_id: r.p_toxic for r in score_toxicity(df, train_chain(df, labels, label_categories())).collect()}
    assert len(got) == len(rows) + 2
    assert all((got[i] > 0.5) == bool(i % 100) for i, _ in rows)
    assert got[9999] == got[9998] < 0.5
    untrained = train_chain(df, labels.where("false"), label_categories())
    assert {r.p_toxic > 0.5 for r in score_toxicity(df, untrained).collect()} == {False}


@needs_tables
def test_held_out_language(spark):
    got = entries.QUERIES["op8_language_hierarchy"](spark, "/root/testdata/sf0.01").where("held_out")
    langs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    right = got.join(langs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.97


def test_language_of_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "the one"), (5, "x" * 600_000)]
    df = docs_of(spark, rows)
    got = {r.doc_id: (r.lang_pred, r.score) for r in identify(df, train_languages(df)).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[4][0] == got[5][0] == "en" and all(0 <= s <= 1 for _, s in got.values())
    assert {r.lang_pred for r in identify(df, train_languages(df.where("false"))).collect()} == {"und"}


@needs_tables
def test_unlearned_languages_and_junk_are_rejected(spark):
    foreign = [
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja "
        "omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i "
        "sumieniem i powinni postępować wobec innych w duchu braterstwa.",
        "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
        "xqzv kkjw 8832 zzqx wvvq jjxk qqpz xxkw zvbq ## kwqj ",
        "a8#f kq 99 zx;; 77 vvq " * 40,
    ]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    planted = spark.createDataFrame([(-1 - k, t, None, "s", 0) for k, t in enumerate(foreign)], DOCS)
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs.union(planted), SF).select("doc_id").collect()}
    assert not {k for k in kept if k < 0}
    assert len(kept) >= 0.99 * docs.count()


def test_licences(spark):
    full = ". ".join(SENTENCES[k] for k in ("mit-grant", "mit-notice", "mit-asis")) + "."
    rows = [
        (1, f"Hello.\n{full.upper()}\nAll rights reserved."),
        (2, "Released under the MIT License.\nLicensed under CC BY-NC 4.0."),
        (3, "See the GNU General Public License for more details."),
        (4, None),
        (5, "The MIT licence of 2.0."),
    ]
    got = {r.doc_id: tuple(r)[1:] for r in scan_licenses(docs_of(spark, [*rows, (None, "")])).collect()}
    assert got == {
        1: (4, "MIT|All-Rights-Reserved", 0),
        2: (2, "MIT|CC-BY-NC-4.0", 0),
        3: (1, "", 1),
        4: (0, "", 0),
        5: (0, "", 0),
        None: (0, "", 0),
    }


MIT_NOTICE = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
GPL_NOTICE = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.

    You should have received a copy of the GNU General Public License
    along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""
APACHE_NOTICE = """   Copyright 2020 Some One

   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software
   distributed under the License is distributed on an "AS IS" BASIS,
   WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
   See the License for the specific language governing permissions and
   limitations under the License.
"""


def test_wrapped_licence_notices(spark):
    def comment(text):
        return "/*\n" + "".join(f" * {line}\n" for line in text.splitlines()) + " */\nint main;\n"

    def unwrapped(text):
        return "\n".join(" ".join(paragraph.split()) for paragraph in text.split("\n\n"))

    notices = {"MIT": (MIT_NOTICE, 3), "GPL-3.0-or-later": (GPL_NOTICE, 3), "Apache-2.0": (APACHE_NOTICE, 5)}
    rows, expected = [], {}
    for name, (text, n) in notices.items():
        for form in (text, comment(text), text.replace("\n", "\r\n"), unwrapped(text)):
            expected[len(rows)] = (n, name, 0)
            rows.append((len(rows), form))
    others = [
        "All\n\nrights reserved.",
        "All. Rights reserved.",
        "Not all rights reserved.",
        "All rights reserved by us.",
        "Released under\nthe MIT License\nLicensed under CC\n  BY 4.0\nand more",
    ]
    rows += [(100 + k, text) for k, text in enumerate(others)]
    expected |= {100 + k: (0, "", 0) for k in range(4)} | {104: (2, "MIT|CC-BY-4.0", 0)}
    assert {r.doc_id: tuple(r)[1:] for r in scan_licenses(docs_of(spark, rows)).collect()} == expected


def test_archives_round_trip(spark):
    long = "é" * 600
    rows = [(1, "u", long), (2, None, long), (3, "a\nb", "short"), (4, "u", "short"), (5, "u", None), (None, "u", long)]
    pages = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, archive int")
    store = Store(spark, "warc-test")
    written = write_archives(pages, store)
    normal = normalise(written, store)
    got = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in read_back(normal).collect()}
    assert got == {
        (1, "revisit", 2, 1200),
        (2, "response", None, 1200),
        (None, "revisit", 2, 1200),
        (3, "response", None, 5),
        (4, "response", None, 5),
        (5, "response", None, 0),
    }
    files = normal.collect()
    assert all(r["index"] == r["archive"] + ".idx" for r in files)

    def local(path):
        return path.removeprefix("file://")

    whole = sorted(gzip.open(local(r.archive)).read() for r in files)
    assert whole == sorted(gzip.open(local(r.archive)).read() for r in written.collect())
    assert write_archives(pages.where("false"), store).count() == 0


def test_a_damaged_archive_is_named(spark, tmp_path):
    path = tmp_path / "broken.warc.gz"
    path.write_bytes(gzip.compress(record(1, "u", b"x" * 5000, None))[:-40])
    archives = spark.createDataFrame([(f"file://{path}",)], "archive string")
    with pytest.raises(Exception, match="broken.warc.gz is no whole WARC archive"):
        normalise(archives, Store(spark, "warc-test"))


def test_distance_against_the_textbook():
    draw = random.Random(3)
    for _ in range(50):
        a = [draw.randrange(5) for _ in range(draw.randrange(1, 12))]
        b = [draw.randrange(5) for _ in range(draw.randrange(0, 20))]
        row = [0] * (len(b) + 1)
        for k, x in enumerate(a, 1):
            new = [k]
            for j, y in enumerate(b, 1):
                new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
            row = new
        assert word_distance(np.array(a), np.array(b, dtype=np.int64)) == min(row)
    assert distance_limit(36, 10) == 3 and distance_limit(5, 10) == 0


def test_edited_items_are_found_and_clean_texts_are_left(spark):
    draw = random.Random(5)
    vocabulary = [f"v{k}" for k in range(400)]
    items = [draw.choices(vocabulary, k=draw.randrange(15, 50)) for _ in range(40)]
    rows, edited = [], set()
    for k in range(200):
        text = draw.choices(vocabulary, k=150)
        if k < 160:
            item = list(items[k % 40])
            for _ in range(distance_limit(len(item), 10)):
                at = draw.randrange(len(item))
                item[at : at + 1] = draw.choice([[], ["new"], ["new", item[at]]])
            text[70:70] = item
            edited.add((k, k % 40))
        rows.append((k, " ".join(text)))
    bench = spark.createDataFrame([(k, " ".join(x).upper()) for k, x in enumerate(items)] + [(None, "a b c"), (99, None)], "item_id long, text string")
    docs = docs_of(spark, [*rows, (500, None), (501, ""), (None, " ".join(items[0]))])
    got = {(r.doc_id, r.item_id) for r in contamination(docs, bench).collect()}
    assert (None, 0) in got
    assert len(edited & got) / len(edited) >= 0.95 and not (got - edited - {(None, 0)})
    kept = decontaminate(docs, bench)
    assert {r.doc_id for r in kept.collect()} == {k for k, _ in rows} - {k for k, _ in got} | {500, 501}
    assert contamination(docs, bench.where("false")).count() == 0


@pytest.mark.parametrize("length", [60, 120, 300, 1000])
@pytest.mark.parametrize("kind", ["insert", "delete", "mixed"])
def test_long_edited_items_are_found(spark, length, kind):
    draw = random.Random(f"{length} {kind}")
    vocabulary = [f"v{k}" for k in range(2000)]
    items = [draw.choices(vocabulary, k=length) for _ in range(30)]
    rows = []
    for k, item in enumerate(items):
        text = list(item)
        places = sorted(draw.sample(range(length), distance_limit(length, 10)), reverse=True)
        for at in places:
            text[at : at + 1] = {"insert": ["new", text[at]], "delete": []}.get(kind, draw.choice([[], ["new"], ["new", text[at]]]))
        around = [draw.choices(vocabulary, k=draw.randrange(40)) for _ in range(2)]
        rows.append((k, " ".join([*around[0], *text, *around[1]])))
        # Half of an item is not the item.
        rows.append((1000 + k, " ".join(item[: length // 2])))
    bench = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.distance for r in contamination(docs_of(spark, rows), bench).collect()}
    assert set(got) <= {(k, k) for k in range(30)} and len(got) >= 0.95 * 30
    assert all(d <= distance_limit(length, 10) for d in got.values())


def test_language_model(spark):
    draw = random.Random(1)
    rows = [(k, " ".join(draw.choice(["a b c", "a b D", "x y"]) for _ in range(draw.randrange(1, 30)))) for k in range(80)]
    rows += [(100, None), (101, ""), (102, "never seen a B"), (102, "never seen a B"), (None, "a b c")]
    held = F.col("doc_id") % 4 == 2
    got = score_texts(docs_of(spark, rows), held, p_head=0.02, p_min=0.03).collect()
    training = collections.Counter()
    for key, text in rows:
        if key is None or key % 4 != 2:
            training.update([*words(text), None])
    n, v = sum(training.values()), len(training)
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        tokens = [*words(texts[r.doc_id]), None]
        base = sum(math.log10((training[t] + 1) / (n + v + 1)) for t in tokens)
        assert (r.n_tokens, r.train_tokens) == (len(tokens), n)
        assert r.n_known == sum(training[t] > 0 for t in tokens)
        assert abs(r.base_score - base) < 1e-9
    assert sum(r.score for r in got) > 0.7 * sum(r.base_score for r in got)
    untrained = score_texts(docs_of(spark, rows), F.lit(True)).collect()
    assert {r.n_known for r in untrained} == {0}


def test_every_state_sums_to_one():
    """Over all symbols and one unseen word, after any two words."""
    draw = random.Random(4)
    names = np.sort(np.append(np.arange(1, 7, dtype=np.uint64) * 1000, END))
    words_ = [int(x) for x in names if x != END]
    texts = [[draw.choice(words_[: draw.randrange(1, 7)]) for _ in range(draw.randrange(1, 9))] for _ in range(300)]
    counts, pairs, triples = (collections.Counter() for _ in range(3))
    for text in texts:
        full = [*text, int(END)]
        counts.update(full)
    heads = np.array(sorted(counts), dtype=np.uint64)
    n = np.array([counts[int(h)] for h in heads])
    tree = Tree(heads, n, int(n.sum()), len(heads), 0.001)
    streams = [np.array([*t, int(END)], dtype=np.uint64) for t in texts]
    for s in streams:
        keys = tree.bigrams(tree.ids(s), np.array([0, len(s)]))
        pairs.update(keys[keys >= 0].tolist())
    tree.grow_pairs(np.array(list(pairs)), np.array(list(pairs.values())))
    for s in streams:
        ids, first = tree.ids(s), np.array([0, len(s)])
        keys = tree.trigrams(tree.bigrams(ids, first), ids, first)
        triples.update(keys[keys >= 0].tolist())
    tree.fit(np.array(list(triples)), np.array(list(triples.values())), 0.005, 2.0)
    assert tree.kept1.any() and tree.kept2.any()
    unseen = math.log10(1 / (tree.total + tree.distinct + 1))
    for a in words_:
        for b in words_:
            total = 0.0
            for last in [*heads.tolist(), 5]:
                tokens = np.array([a, b, last], dtype=np.uint64)
                _, score = tree.log_probabilities(tree.ids(tokens), np.array([0, 3]))
                total += 10 ** (score[2] + (unseen if last == 5 else 0))
            assert abs(total - 1) < 1e-9


def test_snapshots(spark):
    def turns(key, texts):
        return [(key, k, "user" if k % 2 == 0 else "assistant", t, 9) for k, t in enumerate(texts)]

    long = [f"t{k}" for k in range(700)]
    rows = turns(1, ["a", "b"]) + turns(2, ["a", "b", "c"]) + turns(3, ["a", "b", "c"]) + turns(4, ["a", "x"]) + turns(5, ["a"])
    rows += turns(6, long) + turns(7, long[:512]) + turns(8, long[:511] + ["other"]) + turns(9, [None, ""]) + [(None, 0, "user", "a", 1)]
    rows += [(10, 0, None, "q", 1), (10, None, "user", "first", 1), (10, 0, None, "q", 2)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, pos int")
    kept = collapse(df)
    assert {r.conv_id for r in kept.select("conv_id").distinct().collect()} == {2, 4, 6, 8, 9, 10}
    shown = {(r.conv_id, r.segment): (r.n_turns, r.rendered) for r in render(kept).collect()}
    assert shown[4, 0] == (2, "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nx<|im_end|>\n")
    assert [shown[6, k][0] for k in range(3)] == [256, 256, 188]
    assert shown[10, 0][1] == "<|im_start|>user\nfirst<|im_end|>\n<|im_start|>user\nq<|im_end|>\n"
    assert collapse(df.where("false")).count() == 0


@needs_tables
@pytest.mark.parametrize("name", sorted(entries.ORACLES))
def test_sql_twin(spark, name):
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    result = db.execute(entries.ORACLES[name])
    names = [d[0] for d in result.description]
    df = entries.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    key = str
    assert sorted(map(tuple, df.select(names).collect()), key=key) == sorted(result.fetchall(), key=key)


@needs_tables
def test_pipeline(spark):
    documents = {r.doc_id: r.text for r in read(spark, "documents").collect()}
    out = corpus_pipeline.run(spark, SF)
    kept = {r.doc_id for r in out.collect()}
    assert out.count() == len(kept) and kept <= set(documents)
    items = [r.text for r in read(spark, "benchmark").collect()]
    assert not any(item in documents[k] for k in kept for item in items)
    groups = collections.defaultdict(set)
    for key, _, group in brute_groups([(k, documents[k]) for k in sorted(kept)], 5, 80):
        groups[group].add(key)
    assert all(len(g) == 1 for g in groups.values())
    assert len(kept) > 0.6 * len(documents)


@needs_tables
@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES])
def test_stages_take_empty_and_odd_tables(spark, stage):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (None, "", "en", "s", 0), (3, "a plain text", "en", "s", 1)]
    run = dict(corpus_pipeline.STAGES)[stage]
    docs = spark.createDataFrame(rows, DOCS)
    out = run(spark, docs, SF)
    assert set(DOCS.replace(" long", "").replace(" string", "").split(", ")) <= set(out.columns)
    assert {3} <= {r.doc_id for r in out.collect()}
    assert run(spark, docs.where("false"), SF).count() == 0

"""Word language model: a probabilistic suffix tree, learned and applied as Spark jobs.

Method. States are contexts: the words before a token, as many as the tree asks
for. A context is tried if its suffix (without its first word) is a state, and is
a state if its next-word distribution diverges from that of its suffix by at
least ``divergence`` nats. Of each next word's count a state gives one away; these
and ``kappa`` pseudo-counts are shared out as its suffix does. At the root stands
the add-one estimate of single words. Each distribution sums to one. A text is
scored from the longest state that is a suffix of what was read.

No count is too small and no context too long to be tried. A next word that was
seen once has nothing left after the one given away, so its probability is just
its share, and a context seen once is equal to its suffix, with a divergence of
zero: leaving both out of the tables changes no result.

At scale. The suffix of a context ends with the same word, so all contexts that end with a word form a subtree, which
needs nothing of the others. Each token is sent, with the three words before it, to the bucket of the word before
it, where three levels of its subtree are counted, tested and applied. Tokens that are still in a state are sent
there again with the next six words, and so on until none is left, so a context's length has no bound. What states
and next words add to log10 of the texts' probabilities is summed by document. Buckets are made of words of similar
frequency. A context with more than ``most`` tokens is not left to one bucket: its next words are counted
and tested by aggregation and joins, what is known after it is joined to the parts of the corpus that need it, and
the contexts that extend it have buckets of their own. The most frequent words, at most 1 / p_head of them, are
broadcast as numbers; others are sent as hashes with their counts. The result is the same at any of these bounds.
"""

from __future__ import annotations

import collections
import contextlib
import ctypes
import functools
import itertools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.llm.store import Store
from quotemill.llm.words import Slice, mix, slices

P_HEAD, P_MIN, DIVERGENCE, KAPPA = 1e-6, 1e-5, 0.01, 5.0
# Tokens of a context that is still learned in one bucket, and of a bucket without its last context.
MOST, BUCKET_SIZE = 1 << 20, 3 << 18
# Stands for the end of a text; no word hashes to it but by chance.
END = np.uint64(0x9E6C63D0676A9A99)
_COUNTED = 1 << 22
# Tokens of a chunk, and levels that the first pass learns; later ones learn twice as many each, 16 at most.
_CHUNK = 1 << 20
_FIRST_LEVELS = 3
# Buckets that a task takes if they are many.
_TOGETHER = 4
_CONTEXT = np.uint64(0xD6E8FEB86659FD93)


def _tokens(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Words of a slice with an end after each row, and where each row's tokens start."""
    n_rows = part.hi - part.lo
    first = part.first + np.arange(n_rows + 1)
    tokens = np.empty(len(part.words) + n_rows, dtype=np.uint64)
    ends = first[1:] - 1
    mask = np.ones(len(tokens), dtype=bool)
    mask[ends] = False
    tokens[mask] = part.words
    tokens[ends] = END
    return tokens, first


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Position of each wanted value in sorted keys, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return np.where(keys[at] == wanted, at, -1)


def _counted(docs: DataFrame, keys_of) -> DataFrame:
    """(key, n): how often each key occurs that ``keys_of`` gives for the tokens of a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def summed():
            values, n = np.unique(np.concatenate(held), return_counts=True)
            for a in range(0, len(values), 1 << 17):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values[a : a + (1 << 17)].view(np.int64)), pa.array(n[a : a + (1 << 17)])],
                    names=["key", "n"],
                )

        for batch in batches:
            for part in slices(batch.column(0)):
                held.append(keys_of(*_tokens(part)))
                size += len(held[-1])
                if size >= _COUNTED:
                    yield from summed()
                    held, size = [], 0
        if held:
            yield from summed()
        held = []
        _trimmed()

    return docs.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


class Tree:
    """Frequent words with their root probabilities; also a tree of two levels over them, in memory."""

    def __init__(self, heads: np.ndarray, counts: np.ndarray, total: int, distinct: int, p_min: float):
        order = np.argsort(heads)
        self.heads, self.counts = heads[order], counts[order]
        self.total, self.distinct = total, distinct
        self.least = p_min * total
        self.root = (self.counts + 1) / (total + distinct + 1)
        # Frequent words are symbols of contexts, numbered by their place among the heads.
        self.often = self.counts >= self.least
        self.end = int(_find(self.heads, np.array([END]))[0])
        self.pairs = self.triples = np.zeros(0, dtype=np.int64)
        self.p2 = self.p3 = np.zeros(0)
        self.f1 = np.zeros(len(self.heads))
        self.f2 = np.zeros(0)
        self.kept1 = np.zeros(len(self.heads), dtype=bool)
        self.kept2 = np.zeros(0, dtype=bool)

    def ids(self, tokens: np.ndarray) -> np.ndarray:
        return _find(self.heads, tokens)

    def _context(self, ids: np.ndarray) -> np.ndarray:
        """Ids that can stand in a context, others -1."""
        usable = (ids >= 0) & (ids != self.end)
        usable[usable] = self.often[ids[usable]]
        return np.where(usable, ids, -1)

    def bigrams(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Key of (context word, next word) of each token, or -1."""
        before = np.empty(len(ids), dtype=np.int64)
        before[1:] = self._context(ids)[:-1]
        before[first[:-1]] = -1
        usable = (before >= 0) & (ids >= 0)
        usable[usable] = self.often[ids[usable]]
        return np.where(usable, before * len(self.heads) + ids, -1)

    def trigrams(self, pairs: np.ndarray, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Key of (pair that ends before, next word) of each token, or -1; pairs by their place in the table."""
        at = _find(self.pairs, pairs)
        before = np.full(len(ids), -1)
        before[1:] = at[:-1]
        before[first[:-1]] = -1
        usable = (before >= 0) & (at >= 0)
        return np.where(usable, before * len(self.heads) + ids, -1)

    def grow_pairs(self, keys: np.ndarray, n: np.ndarray) -> None:
        order = np.argsort(keys)
        self.pairs, self.n2 = keys[order], n[order].astype(np.float64)

    def fit(self, keys: np.ndarray, n: np.ndarray, divergence: float, kappa: float) -> None:
        """Smooth both levels, and retain the states that diverge from their suffix."""

        def added(at: np.ndarray, amounts: np.ndarray, size: int) -> np.ndarray:
            return np.bincount(at, amounts, minlength=size).astype(np.float64)

        order = np.argsort(keys)
        self.triples, n3 = keys[order], n[order].astype(np.float64)
        size = len(self.heads)
        # Level 1: the state is a word, its suffix the root.
        state, word = self.pairs // size, self.pairs % size
        c1 = self.counts.astype(np.float64)
        seen = added(state, self.n2, size)
        f1 = (c1 - seen + kappa) / (c1 + kappa)
        p2 = self.n2 / (c1[state] + kappa) + f1[state] * self.root[word]
        d1 = added(state, p2 * np.log(p2 / self.root[word]), size)
        rest = np.clip(1 - added(state, self.root[word], size), 0, None)
        d1 += rest * f1 * np.log(f1)
        # Level 2: the state is a pair, its suffix the pair's second word.
        pair, word3 = self.triples // size, self.triples % size
        seen = added(pair, n3, len(self.pairs))
        f2 = (self.n2 - seen + kappa) / (self.n2 + kappa)
        suffix = word[pair]
        below = _find(self.pairs, suffix * size + word3)
        given = np.where(below >= 0, p2[below], f1[suffix] * self.root[word3]) if len(p2) else np.zeros(0)
        p3 = n3 / (self.n2[pair] + kappa) + f2[pair] * given
        d2 = added(pair, p3 * np.log(p3 / given), len(self.pairs))
        rest = np.clip(1 - added(pair, given, len(self.pairs)), 0, None)
        d2 += rest * f2 * np.log(f2)
        self.kept2 = (d2 >= divergence) & (np.bincount(pair, minlength=len(self.pairs)) > 0)
        self.kept1 = (d1 >= divergence) & (np.bincount(state, minlength=size) > 0)
        self.kept1[word[self.kept2]] = True
        self.f1, self.f2 = np.log10(f1), np.log10(f2)
        self.p2, self.p3 = np.log10(p2), np.log10(p3)

    def log_probabilities(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each token, log10 of its root probability (0 if it is no head), and of its probability given what
        stands before it; for a token that is no head, without the root's part."""
        if not len(self.heads):
            return np.zeros(len(ids)), np.zeros(len(ids))
        head = ids >= 0
        root = np.where(head, np.log10(self.root[ids]), 0.0)
        score = root.copy()
        context = np.full(len(ids), -1)
        context[1:] = self._context(ids)[:-1]
        context[first[:-1]] = -1
        keys = self.bigrams(ids, first)
        own = _find(self.pairs, keys)
        state = (context >= 0) & self.kept1[context]
        score[state] += self.f1[context[state]]
        hit = state & (own >= 0)
        score[hit] = self.p2[own[hit]]
        pair = np.full(len(ids), -1)
        pair[1:] = own[:-1]
        pair[first[:-1]] = -1
        if len(self.pairs):
            state = (pair >= 0) & self.kept2[pair]
            state &= context >= 0
            score[state] += self.f2[pair[state]]
            own3 = _find(self.triples, self.trigrams(keys, ids, first))
            hit = state & (own3 >= 0)
            score[hit] = self.p3[own3[hit]]
        return root, score


def _bounded(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    table = df.toArrow()
    return table["key"].to_numpy().astype(np.int64), table["n"].to_numpy().astype(np.int64)


def _longer(context: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix(context * _CONTEXT + words)


def _next(context: np.ndarray, up: np.ndarray) -> np.ndarray:
    """Key of a next word after a context, from that after the context's suffix; after no word it is the word."""
    return context ^ (up << np.uint64(21) | up >> np.uint64(43))


def _next_key() -> Column:
    """The same of columns ``ctx`` and ``up``; with an ``up`` of 0 the key of the context itself."""
    turned = F.shiftleft("up", 21).bitwiseOR(F.shiftrightunsigned("up", 43))
    return F.col("ctx").bitwiseXOR(turned)


def _trimmed() -> None:
    """Gives memory that is free in this process back to the system; workers live on and share an executor's memory."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


@contextlib.contextmanager
def _freed(spark):
    """Within, a query's shuffle files are removed when it ends; its results are in the store by then."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _tested(store: Store, rows: DataFrame, above: DataFrame | None, divergence: float, kappa: float) -> DataFrame:
    """The states of a level and what is known after them: (key, is_state, value, logp, n).

    ``rows`` are counts of `_candidates`; ``above`` gives the log probability of next words after the suffixes,
    as (up, logq). It lacks those of contexts that extend no state, so they go here. Without it rows have a ``logq``.
    """
    e = rows.where("up != 0")
    e = e if above is None else e.drop("logq").join(above, "up")
    c = rows.where("up = 0").select("ctx", F.col("n").alias("c"))
    share = (F.col("c") - F.col("given") + kappa) / (F.col("c") + kappa)
    shares = e.groupBy("ctx").agg(F.sum(F.col("n") - 1).alias("given")).join(c, "ctx")
    e = e.join(shares.select("ctx", "c", share.alias("f")), "ctx")
    p = (F.col("n") - 1) / (F.col("c") + kappa) + F.col("f") * F.exp("logq")
    e = store.put(e.select("ctx", "up", "n", "c", "f", "logq", F.log(p).alias("logp")), "smoothed")
    gained = F.sum(F.exp("logp") * (F.col("logp") - F.col("logq")))
    left = F.greatest(F.lit(0.0), 1 - F.sum(F.exp("logq")))
    states = (
        e.groupBy("ctx", "c", "f")
        .agg((gained + left * F.col("f") * F.log("f")).alias("d"))
        .where(F.col("d") >= divergence)
    )
    states = states.select("ctx", "c", "f")
    known = e.join(states.select("ctx"), "ctx", "left_semi")
    ln10 = float(np.log(10))
    level = states.select(
        F.col("ctx").alias("key"), F.lit(True).alias("is_state"), (F.log("f") / ln10).alias("value"),
        F.lit(None).cast("double").alias("logp"), F.col("c").alias("n"),
    ).unionAll(
        known.select(_next_key(), F.lit(False), (F.col("logp") - F.col("logq") - F.log("f")) / ln10, "logp", "n")
    )
    level = store.put(level, "level")
    store.drop(e)
    return level


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Where each run of equal values, none below 0, begins and ends."""
    edges = np.flatnonzero(np.diff(values, prepend=-1)).tolist()
    return list(itertools.pairwise([*edges, len(values)])) if edges else []


_KINDS = [np.dtype(kind) for kind in (np.bool_, np.uint8, np.int32, np.int64, np.float64)]
_HEAD, _SIZE = struct.Struct("<BBI"), struct.Struct("<I")
# Bytes from which a plane is compressed by itself: each has its own distribution.
_ALONE = 1 << 9


def _packed(*columns: np.ndarray) -> bytes:
    """Columns compressed as planes, the lowest bytes of a column, its second ones and so on; planes above the highest
    byte that is not zero are left out."""
    head, streams, small = [bytes([len(columns)])], [], []
    for c in columns:
        kind = _KINDS.index(c.dtype)
        if c.dtype.kind == "f":
            planes = list(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), 8).T)
        else:
            c = c.view(f"u{c.dtype.itemsize}")
            n_planes = (int(c.max()).bit_length() + 7) // 8 if len(c) else 0
            planes = [(c >> (8 * k) if k else c).astype(np.uint8) for k in range(n_planes)]
        head.append(_HEAD.pack(kind, len(planes), len(c)))
        (streams if len(c) >= _ALONE else small).extend(p.tobytes() for p in planes)
    for raw in [*streams, b"".join(small)]:
        data = pa.compress(raw, codec="zstd", asbytes=True) if raw else raw
        data = data if len(data) < len(raw) else raw
        head += [_SIZE.pack(len(data)), data]
    return b"".join(head)


def _unpacked(data: bytes | pa.Buffer) -> list[np.ndarray]:
    """The columns that `_packed` was given."""
    buffer, data = pa.py_buffer(data), memoryview(data)
    heads = [_HEAD.unpack_from(data, 1 + _HEAD.size * k) for k in range(data[0])]
    at = 1 + _HEAD.size * len(heads)

    def stream(n: int) -> np.ndarray:
        nonlocal at
        (size,) = _SIZE.unpack_from(data, at)
        part = buffer.slice(at + _SIZE.size, size)
        at += _SIZE.size + size
        return np.frombuffer(part if size == n else pa.decompress(part, n, codec="zstd", asbytes=True), np.uint8)

    planes = [[stream(n) for _ in range(n_planes)] if n >= _ALONE else None for _, n_planes, n in heads]
    small, taken = stream(sum(n_planes * n for _, n_planes, n in heads if n < _ALONE)), 0
    out = []
    for (kind, n_planes, n), own in zip(heads, planes, strict=True):
        kind = _KINDS[kind]
        if own is None:
            own = list(small[taken : taken + n_planes * n].reshape(n_planes, n))
            taken += n_planes * n
        if kind.kind == "f":
            out.append(np.stack(own, axis=1).view(kind).reshape(n))
            continue
        c = own[0].astype(f"u{kind.itemsize}") if n_planes else np.zeros(n, dtype=f"u{kind.itemsize}")
        for k in range(1, n_planes):
            c |= own[k].astype(c.dtype) << c.dtype.type(8 * k)
        out.append(c.view(kind))
    return out


class Words:
    """Words by number, in the order of their counts, 1 for the most frequent; 0 for what a context or next word need not
    tell, as it is seen less than twice. The first ones are broadcast; of the others it knows how many have each count."""

    def __init__(self, tree: Tree, sizes: list[tuple[int, int]], hot: np.ndarray, bucket_size: int):
        self.heads = tree.heads
        order = np.argsort(-tree.counts, kind="stable")
        self.number = np.empty(len(order), dtype=np.int32)
        self.number[order] = np.arange(1, len(order) + 1)
        self.keys = np.concatenate([np.zeros(1, dtype=np.uint64), tree.heads[order]])
        self.head_counts = np.concatenate([[0], tree.counts[order]]).astype(np.int64)
        self.first = len(self.head_counts)
        others = sorted(((n, size) for n, size in sizes), reverse=True)
        self.values = np.array([n for n, _ in others], dtype=np.int64)
        self.starts = self.first + np.cumsum([0, *(size for _, size in others)])[:-1]
        self.size = tree.total + tree.distinct + 1
        # Words of similar frequency share a bucket of about so many tokens.
        is_hot = np.isin(self.keys, hot)
        own = np.where(is_hot, 0, self.head_counts)
        self.n_buckets = max(1, -(-int(tree.total - self.head_counts[is_hot].sum()) // bucket_size))
        before = np.cumsum(own) - own
        self.bucket = (before * self.n_buckets // max(1, int(own.sum()))).clip(0, self.n_buckets - 1).astype(np.int32)

    def counts(self, ids: np.ndarray) -> np.ndarray:
        out = self.head_counts[np.minimum(ids, self.first - 1)]
        far = np.flatnonzero(ids >= self.first)
        out[far] = self.values[np.searchsorted(self.starts, ids[far], side="right") - 1] if len(far) else 0
        return out

    def buckets(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids < self.first, self.bucket[np.minimum(ids, self.first - 1)], ids % self.n_buckets)

    def ids(self, tokens: np.ndarray) -> np.ndarray:
        values, inverse = np.unique(tokens, return_inverse=True)
        at = _find(self.heads, values)
        found = np.where(at >= 0, self.number[at] if len(self.number) else 0, 0)
        return found.astype(np.int32)[inverse]


def _chunks(docs: DataFrame, shared) -> DataFrame:
    """Two kinds of rows. Documents (doc >= 0) with the sum of their broadcast words' root probabilities, and their
    other words with their numbers; and chunks (doc < 0) of whole documents' tokens as word numbers."""
    id_type = docs.schema["id"].dataType.simpleString()
    schema = (
        f"id {id_type}, held boolean, chunk long, doc int, n_tokens long, known long, root double, "
        "words array<long>, times array<int>, tokens binary, rare array<long>"
    )

    def lists(values: np.ndarray, sizes: np.ndarray, kind) -> pa.Array:
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, task, n_chunks = shared.value, TaskContext.get().partitionId(), 0
        unknown, roots = -np.log10(words.size), np.log10((words.head_counts + 1) / words.size)
        held, size, n_docs = [], 0, 0

        def closed():
            ids, lengths, train, rare = (np.concatenate(x) for x in zip(*held, strict=True))
            names, place = np.unique(rare, return_inverse=True)
            if len(words.values):
                ids = ids.copy()
                ids[ids < 0] = words.first + place.astype(np.int32)
            else:
                # Every word seen twice is broadcast.
                ids, names = np.maximum(ids, 0), names[:0]
            return [(task << 32) + n_chunks, len(ids), len(lengths), _packed(ids, lengths, train), names.view(np.int64)]

        def chunk(number, n, known, tokens, rare):
            return pa.RecordBatch.from_pydict(
                {"id": pa.nulls(1, id_kind), "held": [None], "chunk": [number], "doc": pa.array([-1], pa.int32()), "n_tokens": [n],
                 "known": [known], "root": [0.0], "words": pa.array([None], pa.list_(pa.int64())),
                 "times": pa.array([None], pa.list_(pa.int32())), "tokens": [tokens], "rare": pa.array([rare], pa.list_(pa.int64()))},
                schema=out_schema,
            )

        id_kind = out_schema = None
        for batch in batches:
            id_kind = batch.schema.field("id").type
            out_schema = pa.schema(
                [("id", id_kind), ("held", pa.bool_()), ("chunk", pa.int64()), ("doc", pa.int32()), ("n_tokens", pa.int64()),
                 ("known", pa.int64()), ("root", pa.float64()), ("words", pa.list_(pa.int64())), ("times", pa.list_(pa.int32())),
                 ("tokens", pa.binary()), ("rare", pa.list_(pa.int64()))]
            )
            for part in slices(batch.column("text")):
                tokens, first = _tokens(part)
                n_rows, lengths = part.hi - part.lo, np.diff(first)
                row = np.repeat(np.arange(n_rows), lengths)
                ids = words.ids(tokens)
                known = np.bincount(row, ids > 0, minlength=n_rows).astype(np.int64)
                root = np.bincount(row, np.where(ids > 0, roots[ids], unknown), minlength=n_rows)
                far = ids == 0
                values, rows = tokens[far], row[far]
                order = np.lexsort((values, rows))
                values, rows = values[order], rows[order]
                opens = np.ones(len(rows), dtype=bool)
                opens[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
                begin = np.flatnonzero(opens)
                times = np.diff(np.append(begin, len(rows))).astype(np.int32)
                sizes = np.bincount(rows[begin], minlength=n_rows)
                doc = np.arange(n_docs, n_docs + n_rows, dtype=np.int32)
                given = [batch.column(c).slice(part.lo, n_rows) for c in ("id", "held")]
                none = [pa.nulls(n_rows, pa.binary()), pa.nulls(n_rows, pa.list_(pa.int64()))]
                columns = [
                    pa.array(np.full(n_rows, (task << 32) + n_chunks)), pa.array(doc), pa.array(lengths), pa.array(known), pa.array(root),
                    lists(values[begin].view(np.int64), sizes, pa.int64()), lists(times, sizes, pa.int32()),
                ]
                yield pa.RecordBatch.from_arrays([*given, *columns, *none], schema=out_schema)
                train = ~given[1].to_numpy(zero_copy_only=False).astype(bool)
                ids[far] = -1
                held.append((ids, lengths.astype(np.int32), train, tokens[far]))
                size, n_docs = size + len(tokens), n_docs + n_rows
                if size >= _CHUNK:
                    yield chunk(*closed())
                    held, size, n_docs, n_chunks = [], 0, 0, n_chunks + 1
        if held:
            yield chunk(*closed())
        held = []
        _trimmed()

    return docs.mapInArrow(run, schema)


def _numbered(store: Store, counts: DataFrame, words: Words) -> DataFrame:
    """(key, number) of the words that are not broadcast, by falling count."""
    placed = store.put(counts.orderBy(F.desc("n")).select("key", F.monotonically_increasing_id().alias("at")), "numbers")
    part = F.shiftright("at", 33)
    sizes = placed.groupBy(part.alias("part")).count().orderBy("part").collect()
    starts = words.first + np.cumsum([0, *(r["count"] for r in sizes)])
    starts = [(r["part"], int(start)) for r, start in zip(sizes, starts, strict=False)]
    starts = placed.sparkSession.createDataFrame(starts, "part long, start long")
    placed = placed.join(F.broadcast(starts), part == F.col("part"))
    return placed.select("key", (F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).cast("int").alias("number"))


class Chunk:
    """A chunk's tokens: word numbers, the place of each in its document, the document, and whether it is learned."""

    def __init__(self, row: dict, words: Words):
        self.number, self.words = row["chunk"], words
        self.ids, lengths, train = _unpacked(row["tokens"])
        self.doc = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        self.train = np.repeat(train, lengths)
        starts = np.cumsum(lengths) - lengths
        self.age = np.arange(len(self.ids), dtype=np.int32) - np.repeat(starts.astype(np.int32), lengths)
        # Tokens at or above the first number tell the place in the chunk's list of words that are not broadcast.
        self.places, self.rare, self.given = self.ids, np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int32)
        if len(row["rare"]):
            self.rare = row["rare"].to_numpy().view(np.uint64)
            self.given = np.zeros(len(self.rare), dtype=np.int32)
            if row["counted"] is not None:
                key, given = (row["counted"].field(c).to_numpy() for c in ("key", "number"))
                self.given[_find(self.rare, key.view(np.uint64))] = given
            self.ids = self.places.copy()
            far = np.flatnonzero(self.places >= words.first)
            self.ids[far] = self.given[self.places[far] - words.first]

    def keys(self, at: np.ndarray) -> np.ndarray:
        """Hash of each of these tokens, 0 if it is seen less than twice."""
        place = self.places[at]
        keys = self.words.keys[np.minimum(place, self.words.first - 1)]
        far = np.flatnonzero(place >= self.words.first)
        if len(far):
            place = place[far] - self.words.first
            keys[far] = np.where(self.given[place] > 0, self.rare[place], np.uint64(0))
        return keys

    def before(self, at: np.ndarray, distance: np.ndarray | int) -> np.ndarray:
        """The word so far before each of these tokens, 0 where the text begins after it."""
        return np.where(self.age[at] >= distance, self.ids[np.maximum(at - distance, 0)], np.int32(0))

    def all_before(self, distance: int) -> np.ndarray:
        """The same for every token."""
        out = np.zeros_like(self.ids)
        out[distance:] = self.ids[: max(0, len(out) - distance)]
        out *= self.age >= distance
        return out

    def messages(self, kind: int, bucket: np.ndarray, n_parts: int, at: np.ndarray, columns: list[np.ndarray], q: np.ndarray | None = None) -> list[dict]:
        """A message for each part with the tokens that its buckets take: the buckets, how many tokens and documents each
        has; the documents, how many tokens each has and whether it is learned; these columns, and of ``q`` what is not
        missing. Tokens are in the order of `_routes`."""
        doc, part, out = self.doc[at], bucket % n_parts, []
        opens = np.ones(len(at), dtype=bool)
        opens[1:] = bucket[1:] != bucket[:-1]
        own = np.flatnonzero(opens)
        opens[1:] |= doc[1:] != doc[:-1]
        begin = np.flatnonzero(opens)
        doc, train, times = doc[begin], self.train[at[begin]], np.diff(np.append(begin, len(at))).astype(np.int32)
        step, place = np.diff(doc, prepend=np.int32(0)), np.searchsorted(begin, own)
        step[place] = doc[place]
        sizes = np.diff(np.append(own, len(at))).astype(np.int32)
        n_docs = np.diff(np.append(place, len(begin))).astype(np.int32)
        for a, b in _runs(part):
            first, last = np.searchsorted(own, [a, b])
            lo, hi = np.searchsorted(begin, [a, b])
            given = [bucket[own[first:last]], sizes[first:last], n_docs[first:last], step[lo:hi], times[lo:hi], train[lo:hi]]
            given += [c[a:b] for c in columns]
            if q is not None:
                given.append(q[a:b][~np.isnan(q[a:b])])
            out.append({"kind": kind, "part": int(part[a]), "chunk": self.number, "payload": _packed(*given)})
        return out


# What messages to buckets hold: tokens after words, tokens after hot contexts, what hot states add to documents;
# and what buckets tell: what they add to documents, which tokens are left in a state, and their states.
_PLAIN, _AFTER_HOT, _HOT_SUMS, _SUMS, _LEFT, _STATES = range(6)
_MESSAGE = "kind int, part int, chunk long, payload binary"


def _sent_rows(rows: list[dict]) -> pa.RecordBatch:
    schema = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("chunk", pa.int64()), ("payload", pa.binary())])
    return pa.RecordBatch.from_pylist(rows, schema=schema)


class Hot:
    """Contexts with more tokens than a bucket takes, level by level: their keys, of the states their value, and of
    what is known after those the most frequent: keys, their places by count, values and log probabilities by place."""

    def __init__(self, n_first: int):
        # Words are numbered by falling counts, so those that are such contexts have the first numbers.
        self.n_first = n_first
        self.keys, self.states, self.values, self.tables, self.starts, self.n_buckets = [], [], [], [], [0], 0

    def known(self, level: int, keys: np.ndarray, own: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of next words their values; their numbers in all tables together, or -1 if they are known from ``own``, which
        is what `_known` gives, and 0 if they are not known; and of those in ``own`` the log probabilities."""
        value, number, q = np.zeros(len(keys)), np.zeros(len(keys), dtype=np.int32), np.full(len(keys), np.nan)
        names, places, values, _ = self.tables[level].value
        at = np.where(keys != 0, _find(names, keys), -1)
        new = np.flatnonzero(at >= 0)
        value[new], number[new] = values[places[at[new]]], self.starts[level] + 1 + places[at[new]]
        names, values, logps = own
        if len(names):
            at = np.where((keys != 0) & (number == 0), _find(names, keys), -1)
            new = np.flatnonzero(at >= 0)
            value[new], number[new], q[new] = values[at[new]], -1, logps[at[new]]
        return value, number, q

    def walk(self, chunk: Chunk, known=None) -> Iterator[tuple]:
        """For each level the tokens whose context so far is a state, at first those after a word that is hot: their
        places, contexts, keys of next words after the suffix, which of them are hot, and the states above: number, next
        word and log probability known there."""
        if not self.keys:
            return
        word = chunk.all_before(1)
        at = np.flatnonzero((word > 0) & (word <= self.n_first))
        root, x, q = np.zeros(len(at), dtype=np.int32), chunk.ids[at], np.full(len(at), np.nan)
        context, up = np.zeros(len(at), dtype=np.uint64), chunk.keys(at)
        for level in range(len(self.keys) + 1):
            if level:
                usable = chunk.before(at, level + 1) > 0
                at, context, up, root, x, q = (c[usable] for c in (at, context, up, root, x, q))
            context = _longer(context, chunk.keys(at - level - 1))
            hot = _find(self.keys[level], context) >= 0 if level < len(self.keys) else np.zeros(len(at), dtype=bool)
            yield at, context, up, hot, root, x, q
            if level >= len(self.states):
                return
            own = np.where(hot, _find(self.states[level], context), -1)
            state = own >= 0
            at, context, up, own = (c[state] for c in (at, context, up, own))
            root = (own + sum(len(s) for s in self.states[:level])).astype(np.int32)
            up = np.where(up != 0, _next(context, up), np.uint64(0))
            x, q = np.zeros(len(at), dtype=np.int32), np.full(len(at), np.nan)
            if known is not None:
                _, x, q = self.known(level, up, known)
                x = np.where(x < 0, self.starts[-1] + chunk.ids[at], x).astype(np.int32)


def _known(row: dict) -> tuple[np.ndarray, ...]:
    """What a chunk was given of the tables of hot states: sorted keys, values and log probabilities."""
    if row["hot"] is None:
        return np.zeros(0, dtype=np.uint64), np.zeros(0), np.zeros(0)
    key, value, logp = (row["hot"].field(c).to_numpy() for c in ("key", "value", "logp"))
    order = np.argsort(key.view(np.uint64))
    return key.view(np.uint64)[order], value[order], logp[order]


def _over_chunks(chunks: DataFrame, words, made, schema: str) -> DataFrame:
    """The batches that ``made`` gives for each chunk and its row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                # Lists stay Arrow arrays.
                row = {name: batch.column(name)[k] for name in batch.schema.names}
                row = {name: x.values if isinstance(x, pa.ListScalar) else x.as_py() for name, x in row.items()}
                yield from made(Chunk(row, words.value), row)
        _trimmed()

    return chunks.mapInArrow(run, schema)


def _least(counted: DataFrame, limit: float) -> tuple[int, list[tuple[int, int]]]:
    """The least ``n``, of 2 or more, that at most ``limit`` rows reach, and how many rows have each one below."""
    sizes = sorted((tuple(r) for r in counted.where("n > 1").groupBy("n").count().collect()), reverse=True)
    total = np.cumsum([size for _, size in sizes])
    near = int(np.searchsorted(total, limit, side="right"))
    if near == len(sizes):
        return 2, []
    return sizes[near][0] + 1, sizes[near:]


def _hot_levels(store: Store, chunks: DataFrame, counts: DataFrame, words: Words, shared, most: int, bucket_size: int, kappa: float, divergence: float, n_known: float, n_parts: int):
    """States among contexts that more than ``most`` tokens follow, and the chunks with what is known after them."""
    end = int(END.view(np.int64))
    above = None
    found = _bounded(counts.where(F.col("n") > most))[0]
    hot = Hot(len(found))
    found = found[found != end].view(np.uint64)
    keys = np.sort(_longer(np.zeros(len(found), dtype=np.uint64), found))
    asked, spread, former = [], 0, None

    def asking(chunk: Chunk, row: dict) -> Iterator[pa.RecordBatch]:
        at, context, up, is_hot, *_ = next(itertools.islice(hot.walk(chunk), level, None))
        inside = np.where(is_hot & (up != 0), _find(hot.states[level], context), -1) >= 0
        keys = np.unique(_next(context[inside], up[inside]))
        keys = keys[_find(hot.tables[level].value[0], keys) < 0]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), chunk.number)), pa.array(keys.view(np.int64))], names=["chunk", "key"])

    def counting(chunk: Chunk, row: dict) -> Iterator[pa.RecordBatch]:
        at, context, up, is_hot, *_ = next(itertools.islice(hot.walk(chunk), level, None))
        learned = chunk.train[at] & is_hot
        at, context, up = at[learned], context[learned], up[learned]
        known = np.flatnonzero(up != 0)
        # A context is not more frequent than its first word.
        before = chunk.before(at, level + 2)
        wide = np.flatnonzero((before > 0) & (before <= hot.n_first))
        longer = _longer(context[wide], chunk.keys(at[wide] - level - 2))
        # After a hot word the next word's count gives its probability after the suffix.
        of = np.zeros(len(at), dtype=np.int64) if level else shared.value.counts(chunk.ids[at])
        columns = []
        for kind, ctx, key, of in ((0, context, np.zeros_like(context), of), (0, context[known], up[known], of[known]), (1, context[wide], longer, of[wide])):
            _, one, n = np.unique(_next(ctx, key), return_index=True, return_counts=True)
            columns.append((np.full(len(one), kind, dtype=np.int32), ctx[one].view(np.int64), key[one].view(np.int64), n, of[one]))
        arrays = [pa.array(np.concatenate(c)) for c in zip(*columns, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=["kind", "ctx", "up", "n", "of"])

    while len(keys) and (not hot.states or len(hot.states[-1])):
        level = len(hot.keys)
        hot.keys.append(keys)
        rows = _over_chunks(chunks, shared, counting, "kind int, ctx long, up long, n long, of long")
        rows = rows.groupBy("kind", "ctx", "up").agg(F.sum("n").alias("n"), F.max("of").alias("of")).where("n > 1")
        rows = rows.select("kind", "ctx", "up", "n", F.log((F.col("of") + 1) / F.lit(float(words.size))).alias("logq"))
        rows = store.put(rows, "hot")
        table = _tested(store, rows.where("kind = 0"), above, divergence, kappa)
        longer = rows.where((F.col("kind") == 1) & (F.col("n") > most)).select("ctx", "up").toArrow()
        store.drop(rows)
        states = table.where("is_state").select("key", "value", "n").toArrow()
        own = states["key"].to_numpy().view(np.uint64)
        order = np.argsort(own)
        hot.states.append(own[order])
        hot.values.append(states["value"].to_numpy()[order])
        spread = max(spread, int(states["n"].to_numpy().sum()))
        given = table.where("not is_state").select("key", "value", "logp", "n")
        least, n_rest = _least(given, n_known)
        # Frequent pairs have low numbers.
        near = given.where(F.col("n") >= least).select("key", "value", "logp", "n").toArrow().sort_by([("n", "descending")])
        names = near["key"].to_numpy().view(np.uint64)
        order = np.argsort(names)
        near = (names[order], order.astype(np.int32), near["value"].to_numpy(), near["logp"].to_numpy())
        hot.tables.append(chunks.sparkSession.sparkContext.broadcast(near))
        hot.starts.append(hot.starts[-1] + len(names))
        if n_rest:
            ask = _over_chunks(chunks, shared, asking, "chunk long, key long")
            asked.append(store.put(ask.join(given.where(F.col("n") < least).drop("n"), "key"), "asked"))
        if former is not None:
            store.drop(former)
        former = table
        above = given.select(F.col("key").alias("up"), F.col("logp").alias("logq"))
        suffix, longer = (longer[c].to_numpy().view(np.uint64) for c in ("ctx", "up"))
        keys = np.sort(longer[_find(hot.states[-1], suffix) >= 0])
    hot.n_buckets = -(-spread // bucket_size)
    if asked:
        parts = functools.reduce(DataFrame.unionAll, asked).groupBy("chunk")
        parts = store.put_by(parts.agg(F.collect_list(F.struct("key", "value", "logp")).alias("hot")), "hot", "chunk", n_parts)
        chunks = chunks.drop("hot").join(parts, "chunk", "left")
        for table in asked:
            store.drop(table)
    return hot, chunks


def _hot_sums(chunk: Chunk, hot: Hot, known: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Documents and what hot states and known next words after them add to them."""
    more = np.zeros(int(chunk.doc[-1]) + 1)
    for level, (at, context, up, is_hot, *_) in zip(range(len(hot.states)), hot.walk(chunk)):
        own = np.where(is_hot, _find(hot.states[level], context), -1)
        more += np.bincount(chunk.doc[at[own >= 0]], hot.values[level][own[own >= 0]], minlength=len(more))
        inside = (own >= 0) & (up != 0)
        value, _, _ = hot.known(level, _next(context[inside], up[inside]), known)
        more += np.bincount(chunk.doc[at[inside]], value, minlength=len(more))
    docs = np.flatnonzero(more)
    return docs.astype(np.int32), more[docs]


def _routes(chunk: Chunk, words: Words, hot: Hot, n_parts: int, known=None) -> Iterator[tuple]:
    """Buckets and places of the tokens sent first to those of a word, then to those of a context: in the order of parts,
    in a part of buckets, and in a bucket of places. Of the latter also level, and number, next word and log probability
    of the state."""
    n_buckets = words.n_buckets + hot.n_buckets

    def rank(bucket: np.ndarray) -> np.ndarray:
        ranks = bucket % n_parts * (n_buckets // n_parts + 1) + bucket // n_parts
        return ranks.astype(np.uint16) if n_buckets + n_parts < 1 << 16 else ranks

    word = chunk.all_before(1)
    at = np.flatnonzero(word > (hot.n_first if hot.keys else 0)).astype(np.int32)
    bucket = words.buckets(word[at])
    by = np.argsort(rank(bucket), kind="stable")
    yield bucket[by], at[by], None
    parts = []
    for level, (at, context, _, is_hot, root, x, q) in enumerate(hot.walk(chunk, known)):
        at, context, root, x, q = (c[~is_hot] for c in (at, context, root, x, q))
        bucket = words.n_buckets + (context % np.uint64(max(1, hot.n_buckets))).astype(np.int32)
        parts.append((bucket, at.astype(np.int32), np.full(len(at), level, dtype=np.int32), root, x, q))
    if parts:
        bucket, at, *more = (np.concatenate(c) for c in zip(*parts, strict=True))
        by = np.lexsort((at, rank(bucket)))
        yield bucket[by], at[by], tuple(c[by] for c in more)


def _first_messages(chunks: DataFrame, shared, hot: Hot, n_parts: int, n_words: int) -> DataFrame:
    """Each token to the bucket of the word before it, or of its shortest context that is not hot; and what hot states
    add to the documents."""

    def made(chunk: Chunk, row: dict) -> Iterator[pa.RecordBatch]:
        known = _known(row)
        if hot.states:
            payload = _packed(*_hot_sums(chunk, hot, known))
            yield _sent_rows([{"kind": _HOT_SUMS, "part": (chunk.number >> 32) % n_parts, "chunk": chunk.number, "payload": payload}])
        for bucket, at, state in _routes(chunk, shared.value, hot, n_parts, known):
            if state is None:
                columns = [chunk.ids[at], *(chunk.all_before(1 + k)[at] for k in range(n_words))]
                yield _sent_rows(chunk.messages(_PLAIN, bucket, n_parts, at, columns))
            else:
                level, root, x, q = state
                columns = [x, root, *(chunk.before(at, level + 1 + k) for k in range(n_words))]
                yield _sent_rows(chunk.messages(_AFTER_HOT, bucket, n_parts, at, columns, q))

    return _over_chunks(chunks, shared, made, _MESSAGE)


def _next_messages(chunks: DataFrame, shared, hot: Hot, n_parts: int, left: DataFrame, depth: int, n_words: int) -> DataFrame:
    """For the tokens that are ``left`` in a state the next words of their contexts, to the same buckets."""
    each = left.where(F.col("kind") == _LEFT).groupBy("chunk").agg(F.collect_list("payload").alias("left"))

    def made(chunk: Chunk, row: dict) -> Iterator[pa.RecordBatch]:
        bits = {}
        for payload in row["left"].to_pylist():
            buckets, sizes, given = _unpacked(payload)
            bits |= zip(buckets.tolist(), np.split(given, np.cumsum(sizes)[:-1]), strict=True)
        for bucket, at, state in _routes(chunk, shared.value, hot, n_parts):
            going = np.zeros(len(at), dtype=bool)
            for a, b in _runs(bucket):
                if int(bucket[a]) in bits:
                    going[a:b] = np.unpackbits(bits[int(bucket[a])], count=b - a)
            bucket, at = bucket[going], at[going]
            done = depth if state is None else depth + state[0][going]
            columns = [chunk.before(at, done + 1 + k) for k in range(n_words)]
            yield _sent_rows(chunk.messages(_PLAIN if state is None else _AFTER_HOT, bucket, n_parts, at, columns))

    sent = _over_chunks(chunks.join(each, "chunk"), shared, made, _MESSAGE)
    return sent.unionAll(left.where(F.col("kind") == _STATES).select(*sent.columns))


def _grouped(root: np.ndarray | None, word: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of tokens by state, word and next word; in it where a pair of context and next word opens, and whether
    a context opens there."""

    def width(c) -> int:
        return int(c.max()).bit_length() if c is not None and len(c) else 0

    if width(root) + width(word) + width(x) > 63:
        # There are fewer values than tokens.
        word, x = (np.unique(c, return_inverse=True)[1] for c in (word, x))
    key = np.zeros(len(word), dtype=np.int64) if root is None else root.astype(np.int64)
    n_bits = width(x)
    key <<= width(word)
    key |= word
    key <<= n_bits
    key |= x
    order = np.argsort(key).astype(np.int32)
    key = key[order]
    opens = np.ones(len(key), dtype=bool)
    opens[1:] = key[1:] != key[:-1]
    pairs = np.flatnonzero(opens)
    context = key[pairs] >> n_bits
    opens = np.ones(len(pairs), dtype=bool)
    opens[1:] = context[1:] != context[:-1]
    return order, pairs, opens


def _grown(sent: DataFrame, shared, hot: Hot, n_parts: int, first: bool, divergence: float, kappa: float) -> DataFrame:
    """Learns the levels below the states that tokens are in whose words were sent, and applies them, each bucket by itself.

    Tells what they add to the documents of each chunk; which of the tokens that a chunk sent first are in a state of
    the last level; and to the buckets these states and what is known after them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of each bucket what its chunks sent, and the states it had; what is added to documents, and what is left of chunks.
        taken, held, sums, left = collections.defaultdict(dict), {}, [], collections.defaultdict(list)
        for batch in batches:
            for kind, chunk, payload in zip(batch["kind"].to_pylist(), batch["chunk"].to_pylist(), batch["payload"], strict=True):
                columns = _unpacked(payload.as_buffer())
                if kind == _STATES:
                    held[int(columns.pop()[0])] = columns
                elif kind == _HOT_SUMS:
                    sums.append((np.full(len(columns[0]), chunk), *columns))
                else:
                    split(taken, chunk, columns, first and kind == _AFTER_HOT)
            # Only copies of what was sent are held.
            columns = payload = batch = None
        for bucket in sorted(taken):
            yield from grown(bucket, taken.pop(bucket), held.pop(bucket, None), sums, left)
            _trimmed()
        for chunk, parts in left.items():
            buckets, bits = zip(*parts, strict=True)
            sizes = np.array([len(b) for b in bits], dtype=np.int32)
            yield told(_LEFT, chunk, np.array(buckets, dtype=np.int32), sizes, np.concatenate(bits))
        if not sums:
            return
        chunk, doc, more = (np.concatenate(c) for c in zip(*sums, strict=True))
        names, which = np.unique(chunk, return_inverse=True)
        keys, which = np.unique(which << 32 | doc, return_inverse=True)
        more = np.bincount(which, more, minlength=len(keys))
        which, doc = keys >> 32, keys.astype(np.int32)
        for a, b in _runs(which):
            yield told(_SUMS, int(names[which[a]]), np.diff(doc[a:b], prepend=np.int32(0)), more[a:b])
        del chunk, doc, more, which, keys
        _trimmed()

    def split(taken: dict, chunk: int, columns: list[np.ndarray], after_hot: bool) -> None:
        buckets, sizes, n_docs, step, times, train, *columns = columns
        q = columns.pop() if after_hot else None
        far = np.append(0, np.cumsum(columns[0] > hot.starts[-1])) if after_hot else None
        a = lo = 0
        for bucket, b, hi in zip(buckets.tolist(), np.cumsum(sizes).tolist(), np.cumsum(n_docs).tolist(), strict=True):
            own = [np.cumsum(step[lo:hi], dtype=np.int32), *(c.copy() for c in (times[lo:hi], train[lo:hi], *(c[a:b] for c in columns)))]
            taken[bucket][chunk] = own if q is None else [*own, q[far[a] : far[b]]]
            a, lo = b, hi

    def grown(bucket: int, taken: dict, held: list | None, sums_of: list, left: dict) -> Iterator[pa.RecordBatch]:
        words, after_hot = shared.value, first and bucket >= shared.value.n_buckets
        q = root = None
        if first:
            names = sorted(taken)
            sizes = np.array([len(taken[c][3]) for c in names])
            place = np.arange(sizes.sum(), dtype=np.int32)
        else:
            names, sizes, bits, root, x, n_known, logp = held
            names, starts = names.tolist(), np.cumsum(n_known, dtype=np.int32) - n_known
            x[x > 0] += starts[root[x > 0]]
            place = np.flatnonzero(np.unpackbits(bits, count=int(sizes.sum()))).astype(np.int32)
        which = np.repeat(np.arange(len(names), dtype=np.int32), sizes)[place]
        parts = [taken.pop(c) for c in names if c in taken]
        doc, times, train, *before = (np.concatenate([part.pop(0) for part in parts]) for _ in parts[0][:])
        doc, train = np.repeat(doc, times), np.repeat(train, times)
        if first:
            given = before.pop() if after_hot else None
            x = before.pop(0)
        if after_hot:
            # Words after a hot context have numbers of the tables, or come with their log probability.
            root = before.pop(0)
            tables = np.concatenate([table.value[3] for table in hot.tables])
            q = np.full(len(x), np.nan)
            near, far = (x > 0) & (x <= len(tables)), x > len(tables)
            q[near], q[far] = tables[x[near] - 1], given
        more, at = np.zeros(len(place)), np.arange(len(place), dtype=np.int32)
        for level in range(len(before)):
            word = before.pop(0)
            word = word[at] if level else word
            usable = np.flatnonzero(word > 0)
            if len(usable) < len(word):
                at, word, x = at[usable], word[usable], x[usable]
                root = root if root is None else root[usable]
            order, pairs, opens = _grouped(root, word, x)
            sums = np.concatenate([np.zeros(1, dtype=np.int32), np.cumsum(train[at[order]], dtype=np.int32)])
            lengths = np.diff(np.append(pairs, len(order)))
            n, one = np.diff(sums[np.append(pairs, len(order))]), order[pairs]
            context = np.cumsum(opens) - 1
            c = np.add.reduceat(n, np.flatnonzero(opens)) if len(n) else n
            # Only pairs that were learned twice are known, and only contexts with such pairs can be states.
            known = np.flatnonzero((n > 1) & (x[one] > 0))
            tried, state = np.unique(context[known], return_inverse=True)
            n, c, one = n[known].astype(np.float64), c[tried].astype(np.float64), one[known]
            if level or not first:
                logq = logp[x[one] - 1]
            else:
                logq = np.log((words.counts(x[one]) + 1) / words.size) if q is None else q[at[one]]
            size = len(c)
            share = (c - np.bincount(state, n - 1, minlength=size) + kappa) / (c + kappa)
            logp = np.log((n - 1) / (c[state] + kappa) + share[state] * np.exp(logq))
            gained = np.bincount(state, np.exp(logp) * (logp - logq), minlength=size)
            rest = np.maximum(0.0, 1 - np.bincount(state, np.exp(logq), minlength=size))
            kept = gained + rest * share * np.log(share) >= divergence
            # From here on a state is its number among those kept, and a next word the number of its pair, 0 if it is not known.
            states = np.full(len(opens), -1, dtype=np.int32)
            states[tried[kept]] = np.arange(int(kept.sum()))
            states = states[context]
            numbers, values, own = np.zeros(len(pairs), dtype=np.int32), np.zeros(len(pairs)), kept[state]
            numbers[known[own]] = np.arange(1, int(own.sum()) + 1)
            logp, logq = logp[own], logq[own]
            inside = np.flatnonzero(states >= 0)
            shares = np.log10(share[kept])
            values[inside] = shares[states[inside]]
            values[known[own]] += (logp - logq) / np.log(10) - shares[states[known[own]]]
            at = at[order[np.repeat(states >= 0, lengths)]]
            del order, word
            lengths = lengths[inside]
            root, x = np.repeat(states[inside], lengths), np.repeat(numbers[inside], lengths)
            more[at] += np.repeat(values[inside], lengths)
        opens = np.ones(len(place), dtype=bool)
        opens[1:] = (which[1:] != which[:-1]) | (doc[1:] != doc[:-1])
        begin = np.flatnonzero(opens)
        sums = np.add.reduceat(more, begin)
        begin, sums = begin[sums != 0], sums[sums != 0]
        sums_of.append((np.array(names)[which[begin]], doc[begin], sums))
        if not len(at):
            return
        order = np.argsort(at)
        at, root, x = at[order], root[order], x[order]
        mask = np.zeros(int(sizes.sum()), dtype=bool)
        mask[place[at]] = True
        # Pairs of a state are numbered one after another.
        n_known = np.bincount(states[known[own]], minlength=int(kept.sum())).astype(np.int32)
        x[x > 0] -= (np.cumsum(n_known, dtype=np.int32) - n_known)[root[x > 0]]
        columns = [np.array(names), sizes, np.packbits(mask), root, x, n_known, logp, np.array([bucket])]
        yield told(_STATES, -1, *columns, part=bucket % n_parts)
        ends = np.cumsum(sizes)
        for k in np.unique(which[at]).tolist():
            left[names[k]].append((bucket, np.packbits(mask[ends[k] - sizes[k] : ends[k]])))

    def told(kind: int, chunk: int, *columns: np.ndarray, part: int = -1) -> pa.RecordBatch:
        return _sent_rows([{"kind": kind, "part": part, "chunk": chunk, "payload": _packed(*columns)}])

    return sent.repartitionById(n_parts, "part").mapInArrow(run, _MESSAGE)


def _summed(grown: DataFrame) -> DataFrame:
    """(chunk, doc, more): what all buckets add to each document."""
    each = grown.where(F.col("kind") == _SUMS).groupBy("chunk").agg(F.collect_list("payload").alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, given in zip(batch.column("chunk").to_pylist(), batch.column("parts"), strict=True):
                parts = [_unpacked(payload) for payload in given.as_py()]
                docs, more = np.concatenate([np.cumsum(docs) for docs, _ in parts]), np.concatenate([more for _, more in parts])
                sums = np.bincount(docs, more)
                docs = np.flatnonzero(sums)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(docs), chunk)), pa.array(docs.astype(np.int32)), pa.array(sums[docs])], names=["chunk", "doc", "more"]
                )

    return each.mapInArrow(run, "chunk long, doc int, more double")


def _tree_sums(
    store: Store, chunks: DataFrame, counts: DataFrame, words: Words, shared, most: int, bucket_size: int, divergence: float, kappa: float, n_known: float, n_parts: int
) -> DataFrame:
    """(chunk, doc, more), several rows a document: what all states, to any depth, add to the root."""
    hot, chunks = _hot_levels(store, chunks, counts, words, shared, most, bucket_size, kappa, divergence, n_known, n_parts)
    n_buckets, n_words, depth = words.n_buckets + hot.n_buckets, _FIRST_LEVELS, 0
    # Buckets of a part share messages, and sum up what they add to a document.
    n_parts = min(n_buckets, max(2 * chunks.sparkSession.sparkContext.defaultParallelism, -(-n_buckets // _TOGETHER)))
    sums, left = [], None
    while not depth or left.where(F.col("kind") == _LEFT).limit(1).count():
        if depth:
            sent = _next_messages(chunks, shared, hot, n_parts, left, depth, n_words)
        else:
            sent = _first_messages(chunks, shared, hot, n_parts, n_words)
        grown = store.put(_grown(sent, shared, hot, n_parts, not depth, divergence, kappa), "grown")
        if depth:
            store.drop(left)
        sums.append(store.put(_summed(grown), "sums"))
        left, depth, n_words = grown, depth + n_words, min(16, 2 * n_words)
    store.drop(left)
    for table in hot.tables:
        table.destroy()
    return functools.reduce(DataFrame.unionAll, sums)


def score_texts(
    docs: DataFrame,
    held_out: F.Column,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    p_head: float = P_HEAD,
    p_min: float = P_MIN,
    divergence: float = DIVERGENCE,
    kappa: float = KAPPA,
    most: int = MOST,
    bucket_size: int = BUCKET_SIZE,
) -> DataFrame:
    """Scores of all texts by a model learned from the rows that are not held out.

    Returns id, held_out, n_tokens, n_known, train_tokens, base_score (add-one
    estimate of single words) and score (the suffix tree), both log10. A null
    text counts as empty, so it consists of the end alone; a null ``held_out``
    counts as false. Every row is returned, also where ids and texts repeat or ids
    are null. ``p_head`` says only what is broadcast; ``p_min``, once a least
    probability of contexts, changes nothing. Without training rows every token is unknown. Extra columns are
    ignored; an empty input gives no rows.
    """
    if not 0 < p_head <= p_min:
        raise ValueError("p_head must be positive and not above p_min")
    spark = docs.sparkSession
    store = Store(spark, "suffixes", {"grown": ("kind",)})
    docs = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held"),
    )
    with _freed(spark):
        counts = store.put(_counted(docs.where(~F.col("held")).select("text"), lambda tokens, first: tokens), "words")
        total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
        # At most 1 / p_head words are broadcast.
        least, sizes = _least(counts, 1 / p_head)
        heads, n = _bounded(counts.where(F.col("n") >= least))
        tree = Tree(heads.view(np.uint64), n, total, distinct, p_min)
        hot = _bounded(counts.where(F.col("n") > most))[0].view(np.uint64)
        words = Words(tree, sizes, hot, bucket_size)
        shared = spark.sparkContext.broadcast(words)
        # Tables by chunk are joined where they lie, so that the chunks' tokens are not shuffled.
        n_parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (2 * _CHUNK)))
        try:
            rows = store.put_by(_chunks(docs, shared), "rows", "chunk", n_parts)
            texts = store.path_of(rows).where("doc >= 0")
            chunks = rows.where("doc < 0").select("chunk", "n_tokens", "tokens", "rare")
            chunks = chunks.withColumn("hot", F.lit(None).cast("array<struct<key:long,value:double,logp:double>>"))
            if sizes:
                # Each chunk gets the numbers of its words that are not broadcast.
                asked = chunks.select("chunk", F.explode("rare").alias("key")).join(_numbered(store, counts.where((F.col("n") > 1) & (F.col("n") < least)), words), "key")
                asked = asked.groupBy("chunk").agg(F.collect_list(F.struct("key", "number")).alias("counted"))
                chunks = chunks.join(store.put_by(asked, "counted", "chunk", n_parts), "chunk", "left")
            else:
                chunks = chunks.withColumn("counted", F.lit(None).cast("array<struct<key:long,number:int>>"))
            more = _tree_sums(store, chunks, counts, words, shared, most, bucket_size, divergence, kappa, 2 / p_head, n_parts)
        finally:
            store.forget()
        shared.destroy()
    rare = texts.select("chunk", "doc", F.explode(F.arrays_zip("words", "times")).alias("w"))
    rare = rare.select("chunk", "doc", F.col("w.words").alias("key"), F.col("w.times").alias("times"))
    # Words that are not broadcast count as unknown in the rows; this is what the known ones have above that.
    parts = rare.join(counts.where(F.col("n") < least), "key").select(
        "chunk", "doc", (F.col("times") * F.log10(F.col("n") + 1)).alias("_root"), F.col("times").cast("long").alias("_known"), F.lit(0.0).alias("_more")
    )
    parts = parts.unionAll(more.select("chunk", "doc", F.lit(0.0), F.lit(0).cast("long"), "more"))
    sums = parts.groupBy("chunk", "doc").agg(*[F.sum(c).alias(c) for c in ("_root", "_known", "_more")])
    joined = texts.select("id", "held", "chunk", "doc", "n_tokens", "known", "root").join(sums, ["chunk", "doc"], "left")
    root, known, more = (F.coalesce(F.col(c), F.lit(0)) for c in ("_root", "_known", "_more"))
    return joined.select(
        F.col("id").alias(id_col),
        F.col("held").alias("held_out"),
        "n_tokens",
        (F.col("known") + known).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("root") + root).alias("base_score"),
        (F.col("root") + root + more).alias("score"),
    )

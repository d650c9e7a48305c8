"""Benchmark passages in documents, by CGK embedding of windows and bit-sampling LSH.

Method. Items of more than SEGMENT words are cut into equal segments; a shorter
item is one segment. A document window as long as a segment (in words) and the
segment are walked by the same random functions: at each of 3 L steps the current word
is emitted and the walk advances or stays, by a random bit drawn for that step
and word. Edit distance becomes Hamming distance, and windows at a small one
agree on all sampled steps in some table. Of what collides the whole item is
verified by its exact word edit distance. The walks need not be more for long
items: some segment has at most its own share of the item's edits.

Windows are those that share a run of ``gram`` words with a segment, placed where
that run puts the segment. With k edits one of k + 1 stretches of a segment stays
untouched (see `distance_limit`), so at 10 % no such window is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.store import batches_of
from quotemill.llm.words import chain, mix, slices

WALKS, TABLES_PER_WALK, SAMPLES = 12, 4, 4
GRAM = 3
# Longer items are cut into segments of at most so many words.
SEGMENT = 48
# All benchmark items of one call, which are broadcast. More are an error: call once per block of items.
ITEM_BYTES = 64 << 20


def distance_limit(n_words: int, percent: int) -> int:
    """Word edits allowed for an item: ``percent`` of its words, fewer if these could leave no run of GRAM words.

    With k edits some run of at least (n - k) / (k + 1) words, rounded up, stays whole.
    """
    k = n_words * percent // 100
    while k and -(-(n_words - k) // (k + 1)) < GRAM:
        k -= 1
    return k


def _walks(windows: np.ndarray, lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Bucket keys of each window (row; padded with 0), one array for each table.

    A key says the table, the length, and the words emitted at the sampled steps.
    """
    steps = 3 * windows.shape[1]
    rows = np.arange(len(windows))
    padded = np.concatenate([windows, np.zeros((len(windows), 1), dtype=np.uint64)], axis=1)
    for walk in range(WALKS):
        seeds = mix(np.arange(steps, dtype=np.uint64) + np.uint64((walk + 1) << 32))
        at = np.zeros(len(windows), dtype=np.int64)
        emitted = np.empty((steps, len(windows)), dtype=np.uint64)
        for step in range(steps):
            word = padded[rows, at]
            emitted[step] = word
            bit = (mix(word + seeds[step]) >> np.uint64(63)).astype(np.int64)
            at = np.minimum(at + bit, lengths)
        draws = mix(np.arange(TABLES_PER_WALK * SAMPLES, dtype=np.uint64) + np.uint64((walk + 1) << 48))
        for table in range(TABLES_PER_WALK):
            key = mix(lengths.astype(np.uint64) + np.uint64((walk * TABLES_PER_WALK + table) << 32))
            for draw in draws[table * SAMPLES : (table + 1) * SAMPLES]:
                # The same share of the walk whatever the length, over the steps that a walk uses on average.
                step = (int(draw >> np.uint64(40)) * 2 * lengths) >> 24
                key = mix(key + emitted[step, rows])
            yield key


def word_distance(item: np.ndarray, region: np.ndarray) -> int:
    """Least word edit distance between ``item`` and any stretch of ``region``."""
    above = np.zeros(len(region) + 1, dtype=np.int64)
    index = np.arange(len(region) + 1)
    for k, word in enumerate(item):
        row = np.empty_like(above)
        row[0] = k + 1
        row[1:] = np.minimum(above[:-1] + (region != word), above[1:] + 1)
        # Deletions within the row: the least of what stands left of a place plus the way to it.
        above = np.minimum.accumulate(row - index) + index
    return int(above.min())


def _joined(spans: set[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans with those that overlap made one."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo < out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


class Benchmark:
    """Items as word hashes, with the index of their segments' runs and bucket keys."""

    def __init__(self, ids: list[int], texts: pa.Array, percent: int):
        words = []
        for part in slices(texts):
            words += [part.words[part.first[k] : part.first[k + 1]] for k in range(part.hi - part.lo)]
        kept = [k for k, w in enumerate(words) if len(w) and ids[k] is not None]
        self.ids = [ids[k] for k in kept]
        self.words = [words[k] for k in kept]
        self.lengths = np.array([len(w) for w in self.words], dtype=np.int64)
        self.limits = [distance_limit(len(w), percent) for w in self.words]
        # Segments: their item, their first word within it, and their words.
        self.item_of, self.offsets, segments = [], [], []
        for k, w in enumerate(self.words):
            n = -(-len(w) // SEGMENT)
            cuts = [len(w) * x // n for x in range(n + 1)]
            self.item_of += [k] * n
            self.offsets += cuts[:-1]
            segments += [w[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        sizes = np.array([len(x) for x in segments], dtype=np.int64)
        self.width = int(sizes.max(initial=0))
        self.grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in sorted({min(GRAM, int(n)) for n in sizes}):
            chosen = [k for k, w in enumerate(segments) if min(GRAM, len(w)) == size]
            runs = [chain(segments[k], size) for k in chosen]
            keys = np.concatenate(runs)
            places = np.concatenate([np.arange(len(r)) for r in runs])
            lengths = np.concatenate([np.full(len(r), sizes[k]) for k, r in zip(chosen, runs, strict=True)])
            entry = np.unique(np.stack([keys.view(np.int64), places, lengths]), axis=1)
            order = np.argsort(entry[0].view(np.uint64), kind="stable")
            entry = entry[:, order]
            self.grams[size] = (entry[0].view(np.uint64), entry[1], entry[2])
        if self.words:
            stacked = np.zeros((len(segments), self.width), dtype=np.uint64)
            for k, w in enumerate(segments):
                stacked[k, : len(w)] = w
            keys = list(_walks(stacked, sizes))
            owners = np.tile(np.arange(len(segments)), len(keys))
            keys = np.concatenate(keys)
            order = np.argsort(keys, kind="stable")
            self.keys, self.segments = keys[order], owners[order]

    def windows(self, part) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, first word, length) of the windows of a slice that share a run with a segment."""
        found = []
        for size, (keys, places, lengths) in self.grams.items():
            runs = chain(part.words, size)
            low = np.searchsorted(keys, runs)
            hit = np.flatnonzero(keys[np.minimum(low, len(keys) - 1)] == runs)
            if not len(hit):
                continue
            rows = np.searchsorted(part.first, hit, side="right") - 1
            inside = hit + size <= part.first[rows + 1]
            hit, rows = hit[inside], rows[inside]
            n = np.searchsorted(keys, runs[hit], side="right") - low[hit]
            entry = np.repeat(low[hit], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            start = np.repeat(hit, n) - places[entry]
            # A window that would begin before the text or end after it is shifted inside.
            rows = np.repeat(rows, n)
            start = np.minimum(start, part.first[rows + 1] - lengths[entry])
            start = np.maximum(start, part.first[rows])
            found.append(np.stack([rows, start, lengths[entry]]))
        if not found:
            none = np.zeros(0, dtype=np.int64)
            return none, none, none
        return tuple(np.unique(np.concatenate(found, axis=1), axis=1))

    def matches(self, part) -> dict[tuple[int, int], int]:
        """(row, item) to the least distance found, of verified candidates only."""
        rows, starts, lengths = self.windows(part)
        regions: dict[tuple[int, int], set[tuple[int, int]]] = {}
        for a in range(0, len(rows), 1 << 14):
            r, s, n = rows[a : a + (1 << 14)], starts[a : a + (1 << 14)], lengths[a : a + (1 << 14)]
            offsets = np.arange(self.width)
            inside = (offsets < n[:, None]) & (s[:, None] + offsets < part.first[r + 1][:, None])
            place = np.minimum(s[:, None] + offsets, len(part.words) - 1)
            stacked = np.where(inside, part.words[place], np.uint64(0))
            for keys in _walks(stacked, n):
                low = np.searchsorted(self.keys, keys)
                hit = np.flatnonzero(self.keys[np.minimum(low, len(self.keys) - 1)] == keys)
                for w in hit.tolist():
                    k, row = int(low[w]), int(r[w])
                    while k < len(self.keys) and self.keys[k] == keys[w]:
                        # Where the whole item can lie if its segment begins at the window.
                        segment = int(self.segments[k])
                        item = self.item_of[segment]
                        begin = int(s[w]) - self.offsets[segment]
                        lo = max(int(part.first[row]), begin - self.limits[item])
                        hi = min(int(part.first[row + 1]), begin + int(self.lengths[item]) + self.limits[item])
                        regions.setdefault((row, item), set()).add((lo, hi))
                        k += 1
        best: dict[tuple[int, int], int] = {}
        for (row, item), found in sorted(regions.items()):
            words, limit = self.words[item], self.limits[item]
            for lo, hi in _joined(found):
                region = part.words[lo:hi]
                # Each word of the item that the region lacks costs an edit.
                if np.count_nonzero(~np.isin(words, region)) > limit:
                    continue
                distance = word_distance(words, region)
                if distance <= min(limit, best.get((row, item), limit)):
                    best[row, item] = distance
        return best


def _shared_benchmark(items: DataFrame, item_col: str, item_text: str, percent: int):
    """The searchable benchmark on all executors; more than ITEM_BYTES of text are an error."""
    chosen = items.select(F.col(item_col).cast("long").alias("i"), F.col(item_text).alias("t"))
    total = chosen.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    if total > ITEM_BYTES:
        raise ValueError(f"{total} bytes of benchmark items; search in blocks of at most {ITEM_BYTES}")
    table = chosen.dropDuplicates().toArrow().sort_by("i")
    return items.sparkSession.sparkContext.broadcast(Benchmark(table["i"].to_pylist(), table["t"], percent))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    percent: int = 10,
) -> DataFrame:
    """(doc_id, item_id, distance): documents that hold a benchmark item within ``percent`` of its words.

    Distance is the word edit distance between the item and the nearest stretch
    found; A-Z are lower-cased. Null or empty texts and items match nothing;
    items with a null id take no part. Rows that repeat an id are searched one
    by one, and of equal (id, item) pairs the smallest distance is returned.
    Rows with a null id are searched too and returned with it. Other columns are
    ignored. ``items`` is broadcast: over ITEM_BYTES of text are an error.
    """
    index = _shared_benchmark(items, item_col, item_text, percent)
    schema = pa.schema([("doc", pa.int64()), ("item", pa.int64()), ("distance", pa.int32())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench = index.value

        def found() -> Iterator[dict[str, list]]:
            for batch in batches:
                if not bench.words:
                    continue
                for part in slices(batch.column(1)):
                    hits = bench.matches(part)
                    yield {
                        "doc": [batch.column(0)[part.lo + row].as_py() for row, _ in hits],
                        "item": [bench.ids[item] for _, item in hits],
                        "distance": list(hits.values()),
                    }

        yield from batches_of(found(), schema)

    pairs = docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(
        search, "doc long, item long, distance int"
    )
    return (
        pairs.groupBy("doc", "item")
        .agg(F.min("distance").alias("distance"))
        .select(F.col("doc").alias(id_col), F.col("item").alias(item_col), "distance")
    )


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    *,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    percent: int = 10,
) -> DataFrame:
    """Documents in which `contamination` finds no item, with all their columns.

    Every row is judged by its own text in the task that reads it: rows that share an
    id, or have none, go or stay one by one, and nothing is shuffled.
    """
    index = _shared_benchmark(items, item_col, item_text, percent)
    at = docs.columns.index(text_col)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench = index.value
        for batch in batches:
            stays = np.ones(batch.num_rows, dtype=bool)
            if bench.words:
                for part in slices(batch.column(at)):
                    stays[[part.lo + row for row, _ in bench.matches(part)]] = False
            yield batch.filter(pa.array(stays))

    return docs.mapInArrow(clean, docs.schema)

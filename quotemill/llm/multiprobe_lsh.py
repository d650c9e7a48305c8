"""Approximate nearest neighbours by multiprobe p-stable hashing.

Method. A table hashes a vector by ``hashes`` functions floor((a x + b) / width)
with Gaussian a. A vector is stored in one bucket of each table. A query visits
its own bucket and those next to it in the order in which they are likely to
hold a near vector: by the sum of squared distances from the query's place to
the boundaries crossed. Candidates of all tables merge, and are ranked by their
exact inner product. Inner products become distances by one more component that
brings every stored vector to the same norm: the largest of its range of norms,
which spans a factor of two at most. A range has buckets of its own, and queries
visit those of all ranges. A query with fewer than ``k`` candidates is compared
with all vectors.

At scale. Only vectors in visited buckets are compared, inside the task that
holds the bucket; what leaves a task are the best ``k`` of each query. Buckets
over BLOCK vectors are cut into blocks by a hash of id and vector, and their
queries go to every block, so a very common vector or id spreads over tasks.
Rows of one id are one candidate before the best are taken in a block.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.store import Store, batches_of, runs
from quotemill.llm.words import mix

BLOCK = 4096
_QUERIES = 20_000


class Tables:
    """The random functions of all tables."""

    def __init__(self, dim: int, scales: list[float], tables: int, hashes: int, width: float, seed: int = 7):
        draws = np.random.default_rng(seed)
        self.scales, self.width = np.sort(np.array(scales, dtype=np.float64)), width
        self.directions = draws.normal(size=(tables, dim + 1, hashes))
        self.offsets = draws.uniform(0, width, size=(tables, 1, hashes))

    def places(self, vectors: np.ndarray, stored: bool) -> np.ndarray:
        """Place of each vector in each table, in units of the width: (table, row, hash)."""
        norm = np.linalg.norm(vectors, axis=1)
        if stored:
            scale = self.scales[self.ranges(vectors)]
            unit = vectors / scale[:, None]
            extra = np.sqrt(np.clip(1 - (norm / scale) ** 2, 0, None))
        else:
            unit, extra = vectors / norm[:, None], np.zeros(len(norm))
        full = np.concatenate([unit, extra[:, None]], axis=1)
        return (full @ self.directions + self.offsets) / self.width

    def ranges(self, vectors: np.ndarray) -> np.ndarray:
        """Number of the range of each vector: the least whose scale reaches its norm."""
        norm = np.linalg.norm(vectors, axis=1) * (1 - 1e-9)
        return np.minimum(np.searchsorted(self.scales, norm), len(self.scales) - 1)

    @staticmethod
    def of_range(keys: np.ndarray, ranges: np.ndarray) -> np.ndarray:
        """Keys that tell ranges apart, too."""
        return mix(keys.view(np.uint64) ^ mix(ranges.astype(np.uint64) + np.uint64(1 << 50))).view(np.int64)

    @staticmethod
    def keys(table: int, cells: np.ndarray) -> np.ndarray:
        key = np.full(cells.shape[:-1], table + 1, dtype=np.uint64)
        for k in range(cells.shape[-1]):
            key = mix(key + cells[..., k].astype(np.int64).view(np.uint64) + np.uint64(k << 40))
        return key.view(np.int64)


def visits(hashes: int, count: int) -> np.ndarray:
    """The first ``count`` moves (0, -1 or 1 per function), likeliest first, for a query of average place.

    Moves are sets of boundaries ranked from the nearest to the farthest; the
    squared distance expected of the j-th nearest of 2m boundaries stands for
    the query's own. Column j is the j-th nearest boundary of the query.
    """
    j = np.arange(1, hashes + 1)
    near = j * (j + 1) / (4 * (hashes + 1) * (hashes + 2))
    far = 1 - j[::-1] / (hashes + 1) + j[::-1] * (j[::-1] + 1) / (4 * (hashes + 1) * (hashes + 2))
    score = np.concatenate([near, far])
    out: list[tuple[int, ...]] = [()]
    heap = [(score[0], (0,))]
    while heap and len(out) < count:
        total, chosen = heapq.heappop(heap)
        # The j-th nearest and the j-th farthest boundary are those of one function.
        if len({min(x, 2 * hashes - 1 - x) for x in chosen}) == len(chosen):
            out.append(chosen)
        last = chosen[-1]
        if last + 1 < 2 * hashes:
            heapq.heappush(heap, (total - score[last] + score[last + 1], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (total + score[last + 1], (*chosen, last + 1)))
    sets = np.zeros((len(out), 2 * hashes), dtype=bool)
    for row, chosen in enumerate(out):
        sets[row, list(chosen)] = True
    return sets


def range_scales(norms: list[float]) -> list[float]:
    """The largest norm of each range: a range begins where a norm is less than half of the last one's largest."""
    scales: list[float] = []
    for norm in sorted(norms, reverse=True):
        if not scales or norm < scales[-1] / 2:
            scales.append(norm)
    return scales


def _probed(places: np.ndarray, sets: np.ndarray) -> np.ndarray:
    """Cells to visit of each row: (row, visit, hash)."""
    base = np.floor(places)
    part = places - base
    hashes = places.shape[1]
    boundary = np.concatenate([part, 1 - part], axis=1)
    order = np.argsort(boundary, axis=1, kind="stable")
    moved = np.zeros((len(places), len(sets), hashes))
    rows = np.arange(len(places))
    for rank in range(2 * hashes):
        function, up = order[:, rank] % hashes, order[:, rank] >= hashes
        moved[rows[:, None], np.flatnonzero(sets[:, rank])[None, :], function[:, None]] += np.where(up, 1, -1)[:, None]
    return base[:, None, :] + moved


def _usable(batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray]:
    ids, vectors = [], []
    for key, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        if key is not None and vector is not None and len(vector) == dim and None not in vector:
            ids.append(key)
            vectors.append(vector)
    matrix = np.array(vectors, dtype=np.float64).reshape(len(ids), dim)
    fine = np.isfinite(matrix).all(axis=1) & (matrix != 0).any(axis=1)
    return np.array(ids, dtype=np.int64)[fine], matrix[fine]


class _Best:
    """The best k of each query met so far, and their exact order."""

    def __init__(self, k: int):
        self.k, self.found = k, {}

    def add(self, queries, q_ids, ids, matrix) -> None:
        """``ids`` in order: rows of equal id stand together."""
        products = queries @ matrix.T
        products[q_ids[:, None] == ids[None, :]] = -np.inf
        # The k-th best of different ids.
        first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        each = products if len(first) == len(ids) else np.maximum.reduceat(products, first, axis=1)
        k = min(self.k, each.shape[1])
        least = np.partition(each, -k, axis=1)[:, -k]
        for row, key in enumerate(q_ids.tolist()):
            best = self.found.get(key)
            at = least[row]
            if best is not None and len(best[0]) == self.k:
                at = max(at, best[0][-1])
            # Products of a matrix differ in the last bits from place to place; sums row by row don't.
            near = np.flatnonzero((products[row] >= at - 1e-9 * (1 + abs(at))) & (products[row] > -np.inf))
            if not len(near):
                continue
            score, own = (matrix[near] * queries[row]).sum(axis=1), ids[near]
            if best is not None:
                score, own = np.append(best[0], score), np.append(best[1], own)
            order = np.lexsort((own, -score))
            order = order[np.sort(np.unique(own[order], return_index=True)[1])][: self.k]
            self.found[key] = (score[order], own[order])

    def rows(self) -> Iterator[dict[str, list]]:
        for key, (score, own) in self.found.items():
            yield {"query": [key], "vec": [own], "score": [score]}
        self.found = {}


def nearest(
    vectors: DataFrame,
    is_query: F.Column,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    tables: int = 4,
    hashes: int = 6,
    width: float = 2.0,
    probes: int = 96,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products found for each query row.

    Queries are rows of ``vectors``; a query is compared with all rows found but
    those of its own id. Ties go to the smaller id. Vectors that are null, zero,
    hold null or non-finite components, have a null id, or have another length
    than most take no part. Rows that repeat an id are one candidate, with the
    best score of them. Every query gets ``k`` rows if there are so many other ids,
    and all of them if not. Other columns are ignored; empty input, empty result.
    """
    spark = vectors.sparkSession
    store = Store(spark, "neighbours")
    kind = vectors.schema[vector_col].dataType.elementType.simpleString()
    packed = "<f4" if kind == "float" else "<f8"
    vectors = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), is_query.alias("is_query")
    )
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    finite = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    # Norms in classes by a sixteenth of a power of two: few rows whatever the number of vectors.
    classes = (
        vectors.where(F.col("id").isNotNull() & finite & (F.size("vector") > 0) & (squares > 0))
        .groupBy(F.size("vector").alias("dim"), F.floor(F.log2(squares) * 8).alias("class"))
        .agg(F.count("*").alias("n"), F.max(F.sqrt(squares)).alias("norm"))
        .collect()
    )
    rows_of: dict[int, int] = {}
    for c in classes:
        rows_of[c["dim"]] = rows_of.get(c["dim"], 0) + c["n"]
    dim = min(rows_of, key=lambda d: (-rows_of[d], d), default=1)
    scales = range_scales([c["norm"] for c in classes if c["dim"] == dim]) or [1.0]
    functions = spark.sparkContext.broadcast(Tables(dim, scales, tables, hashes, width))
    sets = visits(hashes, probes)
    schema = pa.schema([("bucket", pa.int64()), ("id", pa.int64()), ("vector", pa.binary())])

    def hashed(stored: bool | None):
        """Rows of all buckets of the vectors, if stored, or of a query; with None, of one bucket for all."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for a in range(0, whole.num_rows, 256):
                    ids, matrix = _usable(whole.slice(a, 256), dim)
                    if not len(ids):
                        continue
                    blobs = [row.tobytes() for row in matrix.astype(packed)]
                    if stored is None:
                        columns = [pa.array(np.zeros(len(ids), dtype=np.int64)), pa.array(ids), pa.array(blobs, pa.binary())]
                        yield pa.RecordBatch.from_arrays(columns, schema=schema)
                        continue
                    for table, places in enumerate(functions.value.places(matrix, stored)):
                        cells = np.floor(places)[:, None, :] if stored else _probed(places, sets)
                        keys = Tables.keys(table, cells)
                        if stored:
                            keys = Tables.of_range(keys, functions.value.ranges(matrix)[:, None])
                        else:
                            every = np.arange(len(functions.value.scales))
                            keys = Tables.of_range(keys[:, :, None], every).reshape(len(ids), -1)
                        n = keys.shape[1]
                        repeated = pa.array([b for b in blobs for _ in range(n)], pa.binary())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys.ravel()), pa.array(np.repeat(ids, n)), repeated], schema=schema
                        )

        return run

    columns = "bucket long, id long, vector binary"
    rows = store.put(vectors.select("id", "vector").mapInArrow(hashed(True), columns), "stored")
    queries = vectors.where("is_query").select("id", "vector")
    asked = queries.mapInArrow(hashed(False), columns)
    large = rows.groupBy("bucket").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    large = large.withColumnRenamed("bucket", "_b")
    many = F.col("bucket") == F.col("_b")
    keys = ["bucket", "block"]

    def dealt(rows: DataFrame, asked: DataFrame) -> DataFrame:
        """Both with ``blocks``: a stored vector in one of its bucket's blocks, a query in all of them."""
        block = F.pmod(F.xxhash64("id", "vector"), "blocks").cast("int").alias("block")
        rows = rows.select("bucket", block, F.lit(0).alias("kind"), "id", "vector")
        block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
        asked = asked.select("bucket", block, F.lit(1).alias("kind"), "id", "vector")
        return rows.union(asked).repartition(*keys).sortWithinPartitions(*keys, "kind")

    found_schema = pa.schema(
        [("query", pa.int64()), ("vec", pa.list_(pa.int64())), ("score", pa.list_(pa.float64()))]
    )
    ranked_schema = pa.schema(
        [("query_id", pa.int64()), ("rank", pa.int32()), ("vec_id", pa.int64()), ("score", pa.float64())]
    )

    def unpack(batch: pa.RecordBatch) -> np.ndarray:
        data = b"".join(batch.column("vector").to_pylist())
        return np.frombuffer(data, dtype=packed).reshape(batch.num_rows, dim).astype(np.float64)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        best, held, in_order, current = _Best(k), [], False, None
        for batch in batches:
            own = [batch.column(c).to_numpy() for c in ("bucket", "block", "kind")]
            change = np.zeros(max(0, batch.num_rows - 1), dtype=bool)
            for c in own:
                change |= c[1:] != c[:-1]
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if (own[0][a], own[1][a]) != current:
                    current, held, in_order = (own[0][a], own[1][a]), [], False
                if own[2][a] == 0:
                    held.append((part.column("id").to_numpy(), unpack(part)))
                elif held:
                    if not in_order:
                        ids, matrix = (np.concatenate([x[c] for x in held]) for c in (0, 1))
                        order = np.argsort(ids, kind="stable")
                        held, in_order = [(ids[order], matrix[order])], True
                    for c in range(0, part.num_rows, 512):
                        some = part.slice(c, 512)
                        best.add(unpack(some), some.column("id").to_numpy(), *held[0])
                    if len(best.found) > _QUERIES:
                        yield from best.rows()
        yield from best.rows()

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        for table in runs(batches, ["query"]):
            own, score = (table[c].combine_chunks().flatten().to_numpy() for c in ("vec", "score"))
            order = np.lexsort((own, -score))
            order = order[np.sort(np.unique(own[order], return_index=True)[1])][:k]
            n = len(order)
            query = table["query"][0].as_py()
            yield {
                "query_id": [query] * n,
                "rank": list(range(1, n + 1)),
                "vec_id": own[order].tolist(),
                "score": score[order].tolist(),
            }

    def ranked(parted: DataFrame) -> DataFrame:
        # A row per query and task, with the best k of it.
        parts = parted.mapInArrow(
            lambda batches: batches_of(compared(batches), found_schema),
            "query long, vec array<long>, score array<double>",
        )
        parts = parts.repartition("query").sortWithinPartitions("query")
        return parts.mapInArrow(
            lambda batches: batches_of(merged(batches), ranked_schema),
            "query_id long, rank int, vec_id long, score double",
        )

    found = store.put(ranked(dealt(rows.join(large, many), asked.join(large, many))), "found")
    full = found.where(F.col("rank") == k).select("query_id")
    short = queries.join(full, F.col("id") == F.col("query_id"), "left_anti").mapInArrow(hashed(None), columns)
    short = store.put(short, "short")
    if short.isEmpty():
        return found
    blocks = F.lit(-(-rows_of[dim] // BLOCK)).alias("blocks")
    everything = vectors.select("id", "vector").mapInArrow(hashed(None), columns)
    more = ranked(dealt(everything.select("*", blocks), short.select("*", blocks)))
    return found.join(full, "query_id", "left_semi").select(more.columns).union(more)

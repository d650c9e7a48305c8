"""Whitening of integer-scaled embeddings by the exact characteristic polynomial of their scatter.

1. Vectors become integers, ``floor(scale * c)``; the fit list holds each once.
2. Every task sums products of its vectors exactly; the sums of all tasks give the
   integer scatter ``M = n * sum(x x') - S S'``, which is n^2 times the covariance.
3. The characteristic polynomial of M is computed modulo many primes, a task for
   each: reduction to Hessenberg form by similarity, then its recurrence. Chinese
   remaindering gives the integer coefficients, exactly.
4. All roots are real. So the number of roots above a point, with multiplicity, is
   the number of sign changes of the polynomial shifted there (Descartes' rule is
   exact then), and bisection isolates the largest roots to `ROOT_BITS` bits.
5. Inverse iteration in fixed-point arithmetic of `BITS` bits finds the null space of
   ``M - root``: unit components, right to the last bits of a double.

Everything that grows with the rows is a Spark job; the driver holds d x d numbers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.llm.store import Store

# Leading bits to which a root is known; closer roots count as one of higher multiplicity.
ROOT_BITS = 160
# Fraction bits of the fixed-point arithmetic of the inverse iteration.
BITS = 2 * ROOT_BITS + 64
# Integers are split into limbs of this many bits, whose products are summed exactly in doubles
# over so many rows: 2 * 20 + 12 < 53.
LIMB, ROWS = 20, 1 << 12
# Words of a sum on its way through Spark: 5 of 40 bits hold any sum over 2^60 rows.
WORD, WORDS = 40, 5
MOST_DIMENSIONS = 1024


class Whitening(NamedTuple):
    """What was fitted: count, sums, trace of M, its largest eigenvalues and unit eigenvectors by rows."""

    n: int
    sums: list[int]
    trace: float
    roots: list[float]
    components: np.ndarray
    fitted: DataFrame


# --- vectors ---------------------------------------------------------------------


def scaled(vector: str, scale: int = 256) -> Column:
    """The vector in integers; null for a null or empty vector or one with a null, NaN or infinite entry.

    Entries beyond the range of a long become its ends.
    """
    entry = F.col(vector).cast("array<double>")
    finite = F.forall(entry, lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
    return F.when(finite & (F.size(entry) > 0), F.transform(entry, lambda c: F.floor(c * float(scale)).cast("bigint")))


def usual_length(df: DataFrame, column: str) -> int:
    """The commonest length of the arrays, of equally common ones the smallest; 0 without rows."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.size(column).alias("size")).count()
    first = counts.orderBy(F.desc("count"), "size").first()
    return first["size"] if first else 0


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    flat = column.flatten() if isinstance(column, pa.ListArray) else pc.list_flatten(column)
    return flat.to_numpy(zero_copy_only=False).reshape(-1, d)


# --- the scatter --------------------------------------------------------------------


def limbs(x: np.ndarray) -> list[np.ndarray]:
    """Signed parts of LIMB bits as doubles: x is the sum of part k times 2 ** (LIMB * k)."""
    parts, rest = [], x.astype(np.int64)
    while True:
        low = rest & ((1 << LIMB) - 1)
        rest = rest >> LIMB
        if ((rest == 0) | (rest == -1)).all():
            # What is left is a sign alone.
            parts.append((low + (rest << LIMB)).astype(np.float64))
            return parts
        parts.append(low.astype(np.float64))


def products(x: np.ndarray) -> np.ndarray:
    """Exact sums of products of all pairs of columns, as Python integers."""
    d = x.shape[1]
    total = np.zeros((d, d), dtype=object)
    for lo in range(0, len(x), ROWS):
        parts = limbs(x[lo : lo + ROWS])
        for i, a in enumerate(parts):
            for j, b in enumerate(parts):
                exact = (a.T @ b).astype(np.int64).astype(object)
                total += exact * (1 << (LIMB * (i + j)))
    return total


def _scatter_task(d: int):
    """Of a task's vectors the sums of products of columns i <= j, a column of ones among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d + 1, d + 1), dtype=object)
        for batch in batches:
            x = _matrix(batch.column(0), d)
            total += products(np.hstack([np.ones((len(x), 1), dtype=np.int64), x]))
        i, j = np.triu_indices(d + 1)
        words, rest = [], total[i, j]
        for _ in range(WORDS - 1):
            words.append(rest & ((1 << WORD) - 1))
            rest = rest >> WORD
        columns = [pa.array(c.astype(np.int64)) for c in (i, j, *words, rest)]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", *[f"w{k}" for k in range(WORDS)]])

    return run


def scatter(vectors: DataFrame, d: int) -> tuple[int, list[int], list[list[int]]]:
    """Row count, sums of columns and M of a table of integer vectors, all exact."""
    words = [f"w{k}" for k in range(WORDS)]
    schema = ", ".join(f"{c} bigint" for c in ("i", "j", *words))
    parts = vectors.mapInArrow(_scatter_task(d), schema)
    total = [[0] * (d + 1) for _ in range(d + 1)]
    for row in parts.groupBy("i", "j").agg(*[F.sum(w).alias(w) for w in words]).collect():
        value = sum(row[w] << (WORD * k) for k, w in enumerate(words))
        total[row.i][row.j] = total[row.j][row.i] = value
    n, sums = total[0][0], total[0][1:]
    m = [[n * total[i + 1][j + 1] - sums[i] * sums[j] for j in range(d)] for i in range(d)]
    return n, sums, m


# --- the polynomial -----------------------------------------------------------------


def _is_prime(n: int) -> bool:
    """Miller and Rabin's test; these bases are enough below 3.2e9."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_for(m: list[list[int]]) -> list[int]:
    """Primes below 2^31 whose product exceeds twice every coefficient of the polynomial of M.

    M has no negative eigenvalue, so by Maclaurin's inequality its k-th coefficient
    is at most (d over k) * (trace / d) ** k.
    """
    d, trace = len(m), sum(m[i][i] for i in range(len(m)))
    largest = max(math.comb(d, k) * (trace // d + 1) ** k for k in range(d + 1))
    found, product, p = [], 1, (1 << 31) - 1
    while product <= 2 * largest:
        if _is_prime(p):
            found.append(p)
            product *= p
        p -= 2
    return found


def polynomial_modulo(m: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x - M) modulo p, from the constant to the leading one.

    Similarity transformations bring M to upper Hessenberg form; the polynomials of
    its leading blocks follow from each other. Products of two residues fit a long.
    """
    h = m % p
    d = len(h)
    for k in range(1, d - 1):
        rows = np.flatnonzero(h[k:, k - 1])
        if not len(rows):
            continue
        at = k + int(rows[0])
        if at != k:
            h[[at, k]] = h[[k, at]]
            h[:, [at, k]] = h[:, [k, at]]
        factors = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1 :] = (h[k + 1 :] - factors[:, None] * h[k] % p) % p
        h[:, k] = (h[:, k] + (h[:, k + 1 :] * factors % p).sum(axis=1)) % p
    blocks = np.zeros((d + 1, d + 1), dtype=np.int64)
    blocks[0, 0] = 1
    for k in range(1, d + 1):
        new = np.roll(blocks[k - 1], 1)
        new = (new - h[k - 1, k - 1] * blocks[k - 1]) % p
        below = 1
        for i in range(k - 1, 0, -1):
            below = below * int(h[i, i - 1]) % p
            if not below:
                break
            new = (new - int(h[i - 1, k - 1]) * below % p * blocks[i - 1]) % p
        blocks[k] = new
    return blocks[d]


def characteristic_polynomial(spark: SparkSession, m: list[list[int]]) -> list[int]:
    """Integer coefficients of det(x - M) from the constant to the leading one; a task a prime."""
    d = len(m)
    primes = primes_for(m)
    flat = [v for row in m for v in row]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column(0).to_pylist():
                residues = np.array([v % p for v in flat], dtype=np.int64).reshape(d, d)
                c = polynomial_modulo(residues, p)
                yield pa.RecordBatch.from_pydict({"p": [p], "c": [c.tolist()]})

    tasks = min(len(primes), 2 * spark.sparkContext.defaultParallelism)
    dealt = spark.createDataFrame([(p,) for p in primes], "p bigint").repartition(tasks)
    found = {r.p: r.c for r in dealt.mapInArrow(run, "p bigint, c array<bigint>").collect()}
    values, product = [0] * (d + 1), 1
    for p in primes:
        inverse = pow(product % p, -1, p)
        values = [v + product * ((c - v) * inverse % p) for v, c in zip(values, found[p], strict=True)]
        product *= p
    return [v - product if 2 * v > product else v for v in values]


# --- roots ----------------------------------------------------------------------


def roots_above(coefficients: list[int], at: int, bits: int) -> int:
    """How many roots, with multiplicity, exceed ``at / 2 ** bits``; all roots must be real."""
    d = len(coefficients) - 1
    shifted = [c << (bits * (d - k)) for k, c in enumerate(coefficients)]
    for lo in range(d):
        for k in range(d - 1, lo - 1, -1):
            shifted[k] += at * shifted[k + 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def _sign_at(coefficients: list[int], at: int, bits: int) -> int:
    """Sign of the polynomial at ``at / 2 ** bits``."""
    value, d = 0, len(coefficients) - 1
    for k in range(d, -1, -1):
        value = value * at + (coefficients[k] << (bits * (d - k)))
    return (value > 0) - (value < 0)


def largest_roots(coefficients: list[int], count: int, bound: int) -> list[tuple[int, int]]:
    """The ``count`` largest roots, falling, as (a, b): the root lies in ]a, a + 1] / 2 ** b.

    ``bound`` is no less than any root. Equal roots are repeated. A root of zero is (0, 0).
    Intervals are halved by counting roots; once one holds a single root, by the sign.
    """
    found: list[tuple[int, int]] = []
    positive = roots_above(coefficients, 0, 0)
    while len(found) < min(count, positive):
        rank = len(found) + 1
        # The root of this rank is in ]lo, lo + 2 ** width] / 2 ** bits.
        width = max(1, bound.bit_length())
        lo, bits, above_lo, above_hi = 0, 0, positive, 0
        while lo.bit_length() - width < ROOT_BITS or width:
            if not width:
                lo, bits, width = lo << 1, bits + 1, 1
            middle = lo + (1 << (width - 1))
            if above_lo - above_hi == 1:
                # From the right of all roots the sign changes once at each.
                sign = _sign_at(coefficients, middle, bits)
                above = above_hi + (sign != 0 and (sign < 0) != (above_hi % 2 == 1))
            else:
                above = roots_above(coefficients, middle, bits)
            if above >= rank:
                lo, above_lo = middle, above
            else:
                above_hi = above
            width -= 1
        found += [(lo, bits)] * min(above_lo - above_hi, count - len(found))
    return found + [(0, 0)] * (min(count, len(coefficients) - 1) - len(found))


# --- components --------------------------------------------------------------------


def _factor(a: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Triangular form of a fixed-point matrix, in place, and the row steps that give it."""
    d, steps = len(a), []
    for k in range(d):
        at = k + int(np.argmax(np.abs(a[k:, k])))
        if at != k:
            a[[at, k]] = a[[k, at]]
        if not a[k, k]:
            a[k, k] = 1  # The least value, instead of an exactly singular pivot.
        factors = np.array([(v << BITS) // int(a[k, k]) for v in a[k + 1 :, k]], dtype=object)
        if len(factors):
            a[k + 1 :, k:] -= (factors[:, None] * a[k, k:]) >> BITS
        steps.append((at, factors))
    return steps


def _solve(a: np.ndarray, steps: list[tuple[int, np.ndarray]], b: np.ndarray) -> np.ndarray:
    b = b.copy()
    for k, (at, factors) in enumerate(steps):
        b[[at, k]] = b[[k, at]]
        if len(factors):
            b[k + 1 :] -= (factors * b[k]) >> BITS
    for k in range(len(b) - 1, -1, -1):
        rest = b[k] - ((a[k, k + 1 :] * b[k + 1 :]).sum() >> BITS if k + 1 < len(b) else 0)
        b[k] = (rest << BITS) // int(a[k, k])
    return b


def _unit(v: np.ndarray) -> np.ndarray:
    """The vector at length one, in fixed point."""
    largest = max(abs(x) for x in v)
    excess = largest.bit_length() - 2 * BITS
    if excess > 0:
        v = np.array([x >> excess for x in v], dtype=object)
    length = math.isqrt(sum(int(x) * int(x) for x in v))
    return np.array([(int(x) << BITS) // length for x in v], dtype=object)


def null_space(m: list[list[int]], trace: int, root: tuple[int, int], count: int) -> list[np.ndarray]:
    """``count`` orthogonal unit vectors of the eigenspace of a root, in fixed point.

    Starts are fixed; each is freed from the vectors found before and solved for twice
    with ``M / trace - root / trace``, whose smallest pivot blows the eigenspace up by
    2 ** ROOT_BITS.
    """
    d = len(m)
    a = np.array([[(v << BITS) // trace for v in row] for row in m], dtype=object)
    low, bits = root
    shift = ((2 * low + 1) << BITS) // (trace << (bits + 1)) if low else 0
    for k in range(d):
        a[k, k] -= shift
    steps = _factor(a)
    found: list[np.ndarray] = []
    for start in range(count):
        # Fixed starting values without structure.
        v = np.array([(((k + 1) * 2654435761 + start * 40503) % 1000003 + 1) << BITS for k in range(d)], dtype=object)
        for _ in range(3):
            for _ in range(2):
                for u in found:
                    v = v - ((u * ((u * v).sum() >> BITS)) >> BITS)
                v = _unit(v)
            v = _unit(_solve(a, steps, v))
        for u in found:
            v = v - ((u * ((u * v).sum() >> BITS)) >> BITS)
        found.append(_unit(v))
    return found


def _as_double(numerator: int, bits: int) -> float:
    """The double nearest to ``numerator / 2 ** bits``."""
    return numerator / (1 << bits)


# --- the operator ------------------------------------------------------------------


def fit(df: DataFrame, vector: str, components: int, store: Store, scale: int = 256) -> Whitening | None:
    """Fit a whitening to the distinct vectors of ``df``, kept in the store; None without any.

    Vectors that `scaled` leaves null, or of another length than most, take no part.
    Copies are combined before they are shuffled; a component without variance has
    root zero.
    """
    spark = df.sparkSession
    x = df.select(scaled(vector, scale).alias("x"))
    d = usual_length(x, "x")
    if not d:
        return None
    if d > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {d} entries, at most {MOST_DIMENSIONS} are supported")
    fitted = store.put(x.where(F.size("x") == d).distinct(), "fit")
    n, sums, m = scatter(fitted, d)
    trace = sum(m[k][k] for k in range(d))
    k = min(components, d)
    if not trace:
        return Whitening(n, sums, 0.0, [0.0] * k, np.eye(d)[:k], fitted)
    roots = largest_roots(characteristic_polynomial(spark, m), k, trace)
    vectors: list[np.ndarray] = []
    for root in dict.fromkeys(roots):
        vectors += null_space(m, trace, root, roots.count(root))
    rows = []
    for v in vectors:
        top = max(v, key=abs)
        rows.append([_as_double(int(x if top > 0 else -x), BITS) for x in v])
    values = [_as_double(2 * a + 1, b + 1) if a else 0.0 for a, b in roots]
    return Whitening(n, sums, float(trace), values, np.array(rows), fitted)


def _project(model: Whitening):
    """Of integer vectors (second column) the deviation and the whitened values of every component."""
    d = len(model.sums)
    sums = np.array(model.sums, dtype=object)
    k = len(model.roots)
    # (x - S / n) . c / sqrt(e) with e = root / n^2 is (n x - S) . c / sqrt(root).
    weights = np.array([c / math.sqrt(r) if r else c * np.nan for c, r in zip(model.components, model.roots, strict=True)])
    largest = max((abs(s) for s in model.sums), default=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), d)
            reach = model.n * max(abs(int(x.max())), abs(int(x.min()))) + largest if len(x) else 0
            if d * reach * reach < 1 << 63:
                y = x * model.n - sums.astype(np.int64)
                deviation = (y * y).sum(axis=1).tolist()
            else:
                y = x.astype(object) * model.n - sums
                deviation = [v if v < 1 << 63 else None for v in (y * y).sum(axis=1).tolist()]
            white = y.astype(np.float64) @ weights.T
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(deviation, pa.int64()),
                    pa.FixedSizeListArray.from_arrays(pa.array(white.reshape(-1)), k).cast(pa.list_(pa.float64())),
                ],
                names=["id", "deviation", "whitened"],
            )

    return run


def project(rows: DataFrame, model: Whitening) -> DataFrame:
    """id, deviation and whitened values (NaN without variance) of rows (id, x)."""
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(_project(model._replace(fitted=None)), f"id {kind}, deviation bigint, whitened array<double>")


def identity_error(model: Whitening) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance minus the identity; None without variance.

    Means first, then centred products. Components without variance take no part.
    """
    axes = [k for k, root in enumerate(model.roots) if root]
    if not axes:
        return None
    white = project(model.fitted.select(F.lit(0).alias("id"), "x"), model).select(
        *[F.get("whitened", F.lit(k)).alias(f"w{k}") for k in axes]
    )
    means = white.agg(*[F.avg(f"w{k}") for k in axes]).first()
    centred = white.select(*[(F.col(f"w{k}") - F.lit(m)).alias(f"w{k}") for k, m in zip(axes, means, strict=True)])
    pairs = [(i, j) for i in axes for j in axes if i <= j]
    found = centred.agg(*[F.avg(F.col(f"w{i}") * F.col(f"w{j}")) for i, j in pairs]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs, strict=True))


def whiten(
    df: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", components: int = 4, scale: int = 256
) -> DataFrame:
    """Every vector on the first principal components, whitened; a row for each component.

    Columns: ``vec_id``, component (from 1, by falling variance), n (distinct vectors),
    deviation (sum of squares of n * x - S, exact; null beyond a long), whitened (null for a
    component without variance), explained (share of the variance; null where all vectors
    are equal) and identity_error.

    Left out are vectors that are null, empty or hold null, NaN or infinite entries, and
    vectors of another length than most (of equally common lengths the smallest counts).
    Rows that repeat an id, a null id among them, are separate rows; repeated vectors
    count once in the fit. Equal variances give some orthogonal components of their
    space, the same for all rows; of each component the entry largest by size is positive.
    Other columns of ``df`` are not read.
    """
    spark = df.sparkSession
    kind = df.schema[vec_id].dataType.simpleString()
    schema = (
        f"`{vec_id}` {kind}, component int, n bigint, deviation bigint, whitened double, "
        "explained double, identity_error double"
    )
    store = Store(spark, "whitening")
    model = fit(df, vector, components, store, scale)
    if model is None:
        return spark.createDataFrame([], schema)
    error = identity_error(model)
    store.drop(model.fitted)
    rows = df.select(F.col(vec_id).alias("id"), scaled(vector, scale).alias("x"))
    rows = project(rows.where(F.size("x") == len(model.sums)), model)
    explained = F.array(*[F.lit(r / model.trace if model.trace else None).cast("double") for r in model.roots])
    parts = rows.select("id", "deviation", F.posexplode("whitened").alias("at", "w"))
    return parts.select(
        F.col("id").alias(vec_id),
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        F.nanvl("w", F.lit(None).cast("double")).alias("whitened"),
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )

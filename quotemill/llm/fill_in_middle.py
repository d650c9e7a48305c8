"""Fill-in-middle rows by in-place block rotation, and their exact inverse.

A text is cut between lines into prefix, middle and suffix. Sentinels are
inserted at the cuts of one bytearray, which then reads
``<P>prefix<M>middle<S>suffix``; two neighbouring blocks change places by three
reversals, within that buffer:

* psm: ``<P>prefix`` stays, ``<M>middle`` and ``<S>suffix`` are exchanged;
* spm: ``<P>prefix<M>middle`` and ``<S>suffix`` are exchanged.

The inverse finds the sentinels, turns the blocks back and deletes the sentinels.
No sentinel can overlap another one or text around it into a false one, as each
has its only ``<`` first and its only ``>`` last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The sentinels.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
# Bytes of output after which a record batch is handed on.
BATCH_BYTES = 1 << 24
# Bytes that a reversal exchanges at once.
BLOCK = 1 << 16

SCHEMA = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def reverse(data: np.ndarray, lo: int, hi: int) -> None:
    """Reverse bytes lo..hi where they are, a block from either end at a time."""
    while hi - lo > 1:
        size = min(BLOCK, (hi - lo) // 2)
        left = data[lo : lo + size].copy()
        data[lo : lo + size] = data[hi - size : hi][::-1]
        data[hi - size : hi] = left[::-1]
        lo, hi = lo + size, hi - size


def exchange(buffer: bytearray, lo: int, cut: int, hi: int) -> None:
    """Let the blocks lo..cut and cut..hi change places by three reversals."""
    data = np.frombuffer(buffer, dtype=np.uint8)
    reverse(data, lo, cut)
    reverse(data, cut, hi)
    reverse(data, lo, hi)


def line_ends(text: bytes) -> np.ndarray:
    """Byte after each line; a line ends after its newline or with the text."""
    ends = np.flatnonzero(np.frombuffer(text, dtype=np.uint8) == 10) + 1
    return ends if not text or text.endswith(b"\n") else np.append(ends, len(text))


def code_points(data: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80))


def transform(text: bytes, first: int, second: int, spm: bool) -> bytearray:
    """The text with its blocks ..first, first..second and second.. put in the asked order."""
    buffer = bytearray(text)
    buffer[second:second] = SUFFIX
    buffer[first:first] = MIDDLE
    buffer[0:0] = PREFIX
    middle = first + len(PREFIX)
    suffix = second + len(PREFIX) + len(MIDDLE)
    exchange(buffer, 0 if spm else middle, suffix, len(buffer))
    return buffer


def invert(output: bytes, form: str) -> bytes:
    """The text that `transform` was given."""
    if form == "plain":
        return bytes(output)
    buffer = bytearray(output)
    if form == "spm":
        exchange(buffer, 0, buffer.index(PREFIX), len(buffer))
    else:
        suffix = buffer.index(SUFFIX)
        exchange(buffer, suffix, buffer.index(MIDDLE, suffix), len(buffer))
    middle = buffer.index(MIDDLE)
    suffix = buffer.index(SUFFIX, middle)
    for at in (suffix, middle, 0):
        del buffer[at : at + len(PREFIX)]
    return bytes(buffer)


def _strings(values: list[bytes]) -> pa.Array:
    """Bytes as Arrow strings, as they are."""
    return pa.array(values, pa.binary()).view(pa.string())


def _row(text: bytes, draws: list[int], fim_percent: int, spm_percent: int) -> tuple:
    ends = line_ends(text)
    n = len(ends)
    plain = not text or draws[2] % 100 >= fim_percent or any(s in text for s in (PREFIX, SUFFIX, MIDDLE))
    if plain:
        return n, "plain", None, None, text
    first, second = sorted(d % (n + 1) for d in draws[:2])
    a, b = (int(ends[k - 1]) if k else 0 for k in (first, second))
    spm = draws[3] % 100 < spm_percent
    form = "spm" if spm else "psm"
    return n, form, code_points(text[:a]), code_points(text[a:b]), bytes(transform(text, a, b, spm))


def _draws(doc_id: str, seed: str) -> Column:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)])


def fill_in_middle(
    df: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    seed: str = "7",
    fim_percent: int = 100,
    spm_percent: int = 50,
) -> DataFrame:
    """Every text in its fill-in-middle form: ``doc_id``, n, form, prefix_chars, middle_chars, output.

    Cuts lie between the n lines; where they lie, and the form, follows from a
    digest of seed and id alone. A null text counts as empty and a null id as
    empty text in the digest. Empty texts and those that hold a sentinel stay as
    they are, with form "plain" and null lengths. Rows that repeat an id are
    separate rows cut by the same draws; equal draws leave the middle empty.
    Other columns of ``df`` are not read. A text is one buffer of its own size,
    so a batch needs its texts' bytes twice, whatever their number of lines.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(1).cast(pa.large_binary()), b"")
            lo, held, rows = 0, 0, []
            for k in range(batch.num_rows):
                row = _row(texts[k].as_py(), batch.column(2)[k].as_py(), fim_percent, spm_percent)
                rows.append(row)
                held += len(row[-1])
                if held >= BATCH_BYTES or k + 1 == batch.num_rows:
                    n, form, prefix, middle, output = zip(*rows, strict=True)
                    columns = [pa.array(n, pa.int64()), pa.array(form, pa.string())]
                    columns += [pa.array(c, pa.int64()) for c in (prefix, middle)]
                    names = [doc_id, "n", "form", "prefix_chars", "middle_chars", "output"]
                    ids = batch.column(0).slice(lo, len(rows))
                    yield pa.RecordBatch.from_arrays([ids, *columns, _strings(list(output))], names=names)
                    lo, held, rows = k + 1, 0, []

    source = df.select(doc_id, F.col(text).alias("t"), _draws(doc_id, seed).alias("d"))
    id_type = source.schema[0].dataType.simpleString()
    return source.mapInArrow(run, f"`{doc_id}` {id_type}, {SCHEMA}")


def restore(df: DataFrame, *, output: str = "output", form: str = "form") -> DataFrame:
    """The rows of ``df`` with the exact text in place of ``output``; a null output stays null."""
    at, kind = df.columns.index(output), df.columns.index(form)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(at).cast(pa.large_binary())
            lo, held, rows = 0, 0, []
            for k in range(batch.num_rows):
                value = values[k].as_py()
                rows.append(value if value is None else invert(value, batch.column(kind)[k].as_py()))
                held += len(value or b"")
                if held >= BATCH_BYTES or k + 1 == batch.num_rows:
                    part = batch.slice(lo, len(rows))
                    yield part.set_column(at, batch.schema.field(at), _strings(rows))
                    lo, held, rows = k + 1, 0, []

    return df.mapInArrow(run, df.schema)


def round_trip(documents: DataFrame) -> DataFrame:
    """Digests of every output and of the text rebuilt from it."""
    made = fill_in_middle(documents).withColumn("output_sha256", F.sha2("output", 256))
    back = restore(made).withColumn("restored_sha256", F.sha2("output", 256))
    return back.drop("output")


ORACLE = r"""
WITH hashed AS (
    SELECT doc_id, coalesce(text, '') AS t,
           sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
), cut AS (
    SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u,
           CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1,
           CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
           CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3,
           CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
    FROM hashed
), placed AS (
    SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n,
           least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a,
           greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100
                THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
    FROM cut
), parts AS (
    SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS p,
           array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s
    FROM placed
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""

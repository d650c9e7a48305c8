"""CSV, JSON and Parquet scans of landed files."""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import csv as arrow_csv
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.functions.parsing import nan_to_null, null_tokens

PRICE_FILE_PATTERN = "*precios*.csv"
# Holds a CSV row that does not have the header's number of cells.
_DAMAGED = "_damaged_row"
# A cell put after the last one of a damaged row, to see which place that has.
_LAST = "\u0001"
# Bytes of a file that are read for its header, and at once when it is read to its end.
HEADER_BYTES = 1 << 16
BLOCK_BYTES = 1 << 22

_REPORT = "file string, length bigint, header array<string>, rows bigint, error string"


def list_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    pattern: str | None = None,
    name_contains: str | None = None,
) -> DataFrame:
    """Files below the paths with their length, by name alone: none is opened."""
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    df = reader.load(paths if isinstance(paths, str) else list(paths)).select(F.col("path").alias("file"), "length")
    if name_contains:
        name = F.lower(F.regexp_extract("file", "[^/]*$", 0))
        df = df.where(name.contains(name_contains.lower()))
    return df


def read_csv_text(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    columns: Sequence[str] | None = None,
    pattern: str | None = None,
    name_contains: str | None = None,
    skip_unreadable: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Scan CSV files with a header; every cell is text, null spellings are null.

    Types are never inferred, so no extra pass over the data happens: only the
    first header line is read, and not even that when ``columns`` is given.
    A file whose header differs from the others fails the job instead of being
    read by position; use `read_csv_layouts` for files of several layouts.

    ``pattern`` is a file-name glob, ``name_contains`` a case-insensitive part
    of the file name. Both act while files are listed, before they are opened.

    Short rows are padded with nulls. A row with more cells than the header fails
    the job, as its cells belong to no column.

    Quotes inside a quoted cell are doubled. Cells that contain line breaks need
    ``multi_line``, at the price of reading each file in one task.
    """
    reader = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("ignoreCorruptFiles", skip_unreadable)
        # Every row is taken apart whole, else surplus cells go unseen.
        .option("columnPruning", False)
        .option("columnNameOfCorruptRecord", _DAMAGED)
    )
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    listed = paths if isinstance(paths, str) else list(paths)
    if name_contains:
        files = list_files(spark, paths, pattern=pattern, name_contains=name_contains)
        listed = sorted(row["file"] for row in files.collect())
        if not listed:
            raise FileNotFoundError(f"no file name contains {name_contains!r}: {paths}")
    if columns is None:
        columns = reader.csv(listed).columns
    fields = [T.StructField(c, T.StringType()) for c in [*columns, _DAMAGED]]
    df = reader.schema(T.StructType(fields)).csv(listed)
    # The parser itself tells a row with a cell too many from a short one: in a short
    # row an appended cell takes one of the places that the header has, or the next.
    cells = ", ".join(f"c{k} string" for k in range(len(columns) + 1))
    parsed = F.from_csv(F.concat(F.col(_DAMAGED), F.lit("," + _LAST)), cells, {"escape": '"'})
    places = F.array(*[parsed[f"c{k}"] for k in range(len(columns) + 1)])
    surplus = F.when(F.col(_DAMAGED).isNotNull(), ~F.coalesce(F.array_contains(F.array_compact(places), _LAST), F.lit(False)))
    surplus = F.coalesce(surplus, F.lit(False))
    # The message names a cell, too: Spark refuses to read the damaged rows' column alone.
    told = [F.col(_DAMAGED), F.lit("; first cell: "), F.coalesce(F.col(f"`{columns[0]}`"), F.lit(""))]
    message = F.concat(F.lit("CSV row with more cells than its header: "), *told)
    fits = F.when(surplus, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return null_tokens(df.where(fits).drop(_DAMAGED))


def _look_at(file: str, whole: bool, multi_line: bool) -> tuple[list[str] | None, int | None, str | None]:
    """Header, data rows (if read whole) and what is wrong with a CSV file, compressed or not."""
    header = None
    try:
        store, path = fs.FileSystem.from_uri(file)
        with store.open_input_stream(path, buffer_size=HEADER_BYTES) as stream:
            head = stream.read(HEADER_BYTES)
        if not head.strip():
            return None, 0, "empty"
        first = head.lstrip(b"\r\n").splitlines()[0]
        header = next(csv.reader([first.decode("utf-8")]))
        if not whole:
            return header, None, None
        short = 0

        def odd(row: arrow_csv.InvalidRow) -> str:
            nonlocal short
            if row.actual_columns > row.expected_columns:
                return "error"
            short += 1
            return "skip"

        with store.open_input_stream(path, buffer_size=BLOCK_BYTES) as stream:
            reader = arrow_csv.open_csv(
                stream,
                read_options=arrow_csv.ReadOptions(use_threads=False, block_size=BLOCK_BYTES),
                parse_options=arrow_csv.ParseOptions(newlines_in_values=multi_line, invalid_row_handler=odd),
                convert_options=arrow_csv.ConvertOptions(column_types={c: pa.string() for c in header}),
            )
            count = sum(batch.num_rows for batch in reader)
        return header, count + short, None
    except (OSError, pa.ArrowInvalid, UnicodeError, csv.Error) as error:
        return header, None, str(error).splitlines()[0][:500] or type(error).__name__


def check_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    pattern: str | None = None,
    name_contains: str | None = None,
    whole: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """A row for each CSV file: file, length, header, rows, error.

    Only the first bytes are read, of many files at once, and rows is null. With
    ``whole`` each file is read to its end, in blocks: ``error`` then names a
    compressed file that breaks off, text that is not UTF-8 and rows with more
    cells than the header. A file is read in one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                header, count, error = _look_at(row["file"], whole, multi_line)
                found = {**row, "header": header, "rows": count, "error": error}
                yield pa.RecordBatch.from_pylist([found], schema=schema)

    schema = pa.schema(
        [("file", pa.string()), ("length", pa.int64()), ("header", pa.list_(pa.string())), ("rows", pa.int64()), ("error", pa.string())]
    )
    files = list_files(spark, paths, pattern=pattern, name_contains=name_contains)
    return files.repartition(4 * spark.sparkContext.defaultParallelism).mapInArrow(run, _REPORT)


def read_csv_folder(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    pattern: str | None = None,
    name_contains: str | None = None,
    skip_unreadable: bool = False,
    multi_line: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Rows of all CSV files, whatever their headers, and the report of `check_files`.

    Files are grouped by their header and each group is one scan; groups are
    aligned by column name, and a column that a file lacks is null. The name
    filter acts first, so a file of another kind beside them is not opened.

    A file that cannot be read is an error that names it. With
    ``skip_unreadable`` every file is first read to its end, and a bad one gives no
    row at all; the report names it. A blank file is in the report only, and
    Spark does not list files of no bytes.

    The report has a row for each file, which the file system lists on the driver
    anyway.
    """
    found = check_files(
        spark, paths, pattern=pattern, name_contains=name_contains, whole=skip_unreadable, multi_line=multi_line
    ).collect()
    report = spark.createDataFrame(sorted(found, key=lambda row: row["file"]), _REPORT)
    bad = [row for row in found if row["error"] not in (None, "empty")]
    if bad and not skip_unreadable:
        raise ValueError("CSV files cannot be read: " + "; ".join(f"{row['file']}: {row['error']}" for row in bad))
    layouts: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for row in sorted(found, key=lambda row: row["file"]):
        if row["error"] is None:
            layouts[tuple(row["header"])].append(row["file"])
    if not layouts:
        raise FileNotFoundError(f"no readable CSV file: {paths}")
    frames = [read_csv_text(spark, files, columns=header, multi_line=multi_line) for header, files in layouts.items()]
    return _aligned(frames), report


def _aligned(frames: Sequence[DataFrame]) -> DataFrame:
    combined = frames[0]
    for frame in frames[1:]:
        combined = combined.unionByName(frame, allowMissingColumns=True)
    return combined


def read_csv_layouts(
    spark: SparkSession, layouts: Sequence[str | Sequence[str]], **options
) -> DataFrame:
    """Scan groups of CSV files, one header layout per group, aligned by name."""
    frames = [read_csv_text(spark, paths, **options) for paths in layouts]
    if not frames:
        raise ValueError("no CSV layouts given")
    return _aligned(frames)


def read_parquet(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None, *, staged: bool = False
) -> DataFrame:
    """Scan Parquet; NaN, which Parquet keeps apart from null, becomes null.

    Files ``staged`` by `quotemill.sinks.files.write_parquet` hold no NaN: they are
    read as they are, so that filters on numbers reach the scan and skip row groups.
    """
    df = spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
    df = df.select(*columns) if columns else df
    return df if staged else nan_to_null(df)


def parse_json_records(df: DataFrame, column: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows with a JSON text taken apart: (readable rows, rejected rows as they are).

    A readable row has the record's fields in place of the text. A text is rejected
    that is no JSON object, or holds a value that is not of its field's type. A null
    text gives null fields; an absent field is null.
    """
    damaged = "_damaged_record"
    read = T.StructType([*schema.fields, T.StructField(damaged, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": damaged}
    parsed = df.withColumn("_record", F.from_json(F.col(f"`{column}`"), read, options))
    # An array, a bare value or a blank text gives no record.
    object_ = F.coalesce(F.ltrim(F.col(f"`{column}`")).startswith("{"), F.col(f"`{column}`").isNull())
    fits = object_ & F.col(f"_record.{damaged}").isNull()
    others = [F.col(f"`{c}`") for c in df.columns if c != column]
    fields = [F.col("_record").getField(f.name).alias(f.name) for f in schema.fields]
    return parsed.where(fits).select(*others, *fields), parsed.where(~fits).drop("_record")


def read_json_records(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    *,
    json_lines: bool = False,
) -> DataFrame:
    """Scan JSON records: one array per file, or one record per line.

    A record that is no JSON, or holds a value that is not of its type, fails
    the job when it is read.

    An array file cannot be split between tasks, so land large feeds as lines.
    """
    reader = spark.read.schema(schema).option("multiLine", not json_lines)
    return reader.option("mode", "FAILFAST").json(
        paths if isinstance(paths, str) else list(paths)
    )


def with_file_name(df: DataFrame, column: str = "file_name") -> DataFrame:
    """Add the name of the file each row was scanned from."""
    return df.withColumn(column, F.col("_metadata.file_name"))


def files_without_rows(df: DataFrame) -> DataFrame:
    """Input files that gave no row: unreadable ones that were skipped, or empty.

    The list of files is file-system metadata, which Spark keeps on the driver.
    """
    spark = df.sparkSession
    listed = spark.createDataFrame([(f,) for f in df.inputFiles()], "file string")
    seen = df.select(F.input_file_name().alias("file")).distinct()
    return listed.join(seen, "file", "left_anti")


def path_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"

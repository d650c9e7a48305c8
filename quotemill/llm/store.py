"""Interim tables in the folder that all executors share, and Arrow runs of sorted partitions."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or the one set on the context.

    Where neither is set, a local session gets a temporary folder, as in tests.
    On a cluster that is an error: a machine-local folder would lose interim
    tables together with the executor that wrote them.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="checkpoint-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


class Store:
    """Interim tables of one run, below one new folder. A table survives lost executors.

    ``apart`` tells by which columns the tables of a name are kept in folders of their own.
    """

    def __init__(self, spark: SparkSession, name: str, apart: dict[str, tuple[str, ...]] | None = None):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self._n, self._apart = 0, apart or {}
        self._tables: dict[str, str] = {}

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """The rows of ``df``, written once as Parquet and read again without lineage."""
        self._n += 1
        path = f"{self.folder}/{self._n:02d}-{name}"
        df.write.partitionBy(*self._apart.get(name, ())).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def put_by(self, df: DataFrame, name: str, column: str, n: int) -> DataFrame:
        """The same in ``n`` parts by ``column``: joins on it read these tables where they lie. They are in the session's
        catalog until `forget`; their files stay."""
        self._n += 1
        path, table = f"{self.folder}/{self._n:02d}-{name}", f"{name}_{uuid.uuid4().hex}"
        df.write.format("parquet").bucketBy(n, column).option("path", path).saveAsTable(table)
        self._tables[table] = path
        return self.spark.table(table)

    def path_of(self, df: DataFrame) -> DataFrame:
        """The files of a table that `put_by` made, without the catalog."""
        folders = {name.rsplit("/", 1)[0] for name in df.inputFiles()}
        return self.spark.read.schema(df.schema).parquet(*folders)

    def forget(self) -> None:
        """Take the tables that `put_by` made out of the catalog."""
        for table in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self._tables.clear()

    def drop(self, df: DataFrame) -> None:
        """Delete a table made by `put` that nothing reads any more."""
        run = f"/{self.folder.rsplit('/', 1)[1]}/"
        for head, _, rest in {name.partition(run) for name in df.inputFiles()}:
            path = f"{head}{run}{rest.split('/')[0]}"
            if rest and path.startswith(("file:", "hdfs:")):
                target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                conf = self.spark.sparkContext._jsc.hadoopConfiguration()
                target.getFileSystem(conf).delete(target, True)



def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of each group of consecutive equal keys (integers, never null)."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def batches_of(rows: Iterator[dict[str, list]], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Column chunks gathered into record batches of about ``size`` rows."""
    kept: dict[str, list] = {name: [] for name in schema.names}
    for chunk in rows:
        for name in schema.names:
            kept[name].extend(chunk[name])
        if len(kept[schema.names[0]]) >= size:
            yield pa.RecordBatch.from_pydict(kept, schema=schema)
            kept = {name: [] for name in schema.names}
    if kept[schema.names[0]]:
        yield pa.RecordBatch.from_pydict(kept, schema=schema)

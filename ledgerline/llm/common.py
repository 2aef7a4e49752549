"""Shared helpers of the training-data operators.

``save`` cuts lineage with a written table in the folder that the cluster names in
``spark.checkpoint.dir``, so a lost executor costs a re-read, never a recomputation of a non-repeatable step.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_PRIVATE: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a private one only in a one-process local session that names none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("spark.checkpoint.dir is not set: the cluster must name a shared folder")
    if not _PRIVATE:
        _PRIVATE.append("file://" + tempfile.mkdtemp(prefix="ledgerline-llm-"))
    return _PRIVATE[0]


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once an application, so that their workers can import it."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        _SHIPPED.add(app)
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        target = os.path.join(tempfile.mkdtemp(prefix="ledgerline-package-"), "ledgerline_package")
        spark.sparkContext.addPyFile(
            shutil.make_archive(target, "zip", os.path.dirname(package), os.path.basename(package))
        )


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def save(df: DataFrame, name: str, file_rows: int = 0) -> DataFrame:
    """Write ``df`` once to the shared folder, at most ``file_rows`` rows a file (0: any number), and return the written
    table."""
    path = new_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    (writer.option("maxRecordsPerFile", file_rows) if file_rows else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table written by ``save`` once nothing reads it any more."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if path.startswith(shared_dir(spark)) or path.replace("file:///", "file:/").startswith(
            shared_dir(spark).replace("file:///", "file:/")
        ):
            jvm = spark.sparkContext._jvm
            hadoop = jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def crc_mod(column: str, n: int) -> Column:
    """``crc32`` of the column as text, modulo ``n``; null for null."""
    return F.crc32(F.col(column).cast("string")) % n


class Memo(dict):
    """A bounded memo of two generations: a missing key is looked for in the older one, else made by ``make``.
    When ``limit`` keys are held, the older generation is forgotten, so frequent keys stay."""

    def __init__(self, make: Callable, limit: int = 300_000):
        super().__init__()
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that what Python holds at once follows ``rows`` and not Spark's batch size."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def pieces(batches: Iterator[pa.RecordBatch], column: int, nbytes: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the strings of ``column`` take about ``nbytes`` (one row at least)."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes, dtype=np.int64) // nbytes
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(int(a), int(b - a))


def list_array(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """One Arrow list per numpy array."""
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    values = np.concatenate(parts) if parts else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))

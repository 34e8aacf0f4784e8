"""Shared plumbing of the training-data operators: tables, scratch storage, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one vectorised step handles at most, unless a single text is longer.
CHUNK_BYTES = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder; elsewhere that is an error, since executors
    would not see it.
    """
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.glyphweave.scratch", None)
    if root:
        return root.rstrip("/")
    if not conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="glyphweave-")
    spark.conf.set("spark.glyphweave.scratch", root)
    return root


class Scratch:
    """Tables written to the shared folder to cut lineage; each can be read again after any executor is lost."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{scratch_root(spark)}/glyphweave/{name}-{uuid.uuid4().hex}"
        self.paths: dict[str, str] = {}
        self.tables: dict[str, DataFrame] = {}

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as Parquet and return the table that reads it back."""
        n = sum(k.split("#")[0] == name for k in self.paths)
        self.paths[f"{name}#{n}"] = path = f"{self.root}/{name}-{n}"
        df.write.parquet(path)
        self.tables[name] = self.spark.read.schema(df.schema).parquet(path)
        return self.tables[name]

    def read(self, name: str) -> DataFrame:
        """What was last saved under ``name``."""
        return self.tables[name]

    def drop(self, *names: str) -> None:
        """Delete all that was saved under these names; no plan may read it any more."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for key in [k for k, path in self.paths.items() if path and k.split("#")[0] in names]:
            path = jvm.org.apache.hadoop.fs.Path(self.paths[key])
            path.getFileSystem(conf).delete(path, True)
            self.paths[key] = ""


def text_batches(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of rows of about ``limit`` bytes of UTF-8.

    Yields first row, row after the last, the run's bytes, and offsets into them (one more than rows). Null
    counts as empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), len(column))
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end

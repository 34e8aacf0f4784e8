"""Last-write-wins upserts from a stream, by batches that are safe to repeat."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from ..operators.assembly import last_write_wins


def upsert_stream(rows: DataFrame, path: str, checkpoint: str, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataStreamWriter:
    """A writer that keeps, under ``path``, one folder per batch with the last row of each key in it.

    A batch that is repeated after a failure overwrites its own folder. Read the state with ``latest``.
    """

    def write(batch: DataFrame, number: int) -> None:
        columns = list(dict.fromkeys([*order, *values]))
        reduced = last_write_wins(batch, keys, order, columns)
        reduced.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)


def latest(state: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The last values of each key over all batches."""
    return last_write_wins(state, keys, order, values)

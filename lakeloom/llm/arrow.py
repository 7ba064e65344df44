"""Arrow batches of bounded size between Spark and Python."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Bytes of one batch, unless a single row has more.  Batches of long texts then hold few rows.
BATCH_BYTES = 4 << 20

Columns = dict[str, object]


def bound_batches(spark: SparkSession) -> None:
    """Limit the bytes of a batch; the setting is read when a result is computed, so it stays set."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[Columns]], schema: str) -> DataFrame:
    """``mapInArrow`` for functions that yield columns by name, with batches that fit a worker's memory."""
    bound_batches(df.sparkSession)
    names = [part.split()[0] for part in schema.split(",")]
    types = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
             "binary": pa.binary(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()),
             "array<string>": pa.list_(pa.string())}
    kinds = [types[part.split()[1]] for part in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in fn(batches):
            arrays = [
                columns[n] if isinstance(columns[n], pa.Array) else pa.array(columns[n], t)
                for n, t in zip(names, kinds)
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.mapInArrow(run, schema)


def utf8(column: pa.Array) -> list[bytes]:
    """The values of a text column as bytes; NULL is empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]

"""Layered storage: ``{root}/{layer}/{table}.{format}``, Parquet unless told otherwise."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakeloom.session import delete_path, replace_path
from lakeloom.sources.csv_text import read_text_csv

# Fixed layer names.
RAW = "raw"
SILVER = "stg"
GOLD_BI = "mart_bi"
GOLD_ML = "mart_ml"
DEFAULT_LAYER = "main"


def layer_name(layer: str | None, default: str = DEFAULT_LAYER) -> str:
    """A named layer is used as it is, without any prefix; no name gives the default."""
    return default if layer is None else layer.strip()


@dataclass(frozen=True)
class Lake:
    """Where sources lie and where layers go.

    ``sources`` maps a logical name to a path below ``{root}/source``; a name
    not listed lies at ``{root}/source/{name}.csv``.  Two environments differ
    only in their ``root``.  ``format`` is the suffix and the storage format of
    all tables, one that Spark can write and read.
    """

    root: str
    sources: Mapping[str, str] = field(default_factory=dict)
    format: str = "parquet"

    def source_path(self, name: str) -> str:
        return f"{self.root}/source/{self.sources.get(name, name + '.csv')}"

    def table_path(self, layer: str | None, table: str, partitioned: bool = False) -> str:
        """Path of a table; a partitioned table is a folder without the suffix."""
        suffix = "" if partitioned else f".{self.format}"
        return f"{self.root}/{layer_name(layer)}/{table}{suffix}"

    def read_source(self, spark: SparkSession, name: str, multiline: bool | None = None) -> DataFrame:
        return read_text_csv(spark, self.source_path(name), multiline)

    def mirror(self, spark: SparkSession, name: str, table: str, multiline: bool | None = None) -> None:
        """Copy a source one to one into the raw layer, columns and rows as they are."""
        self.write(self.read_source(spark, name, multiline), RAW, table)

    def write(
        self,
        df: DataFrame,
        layer: str | None,
        table: str,
        schema: T.StructType | str | None = None,
        partition_by: Sequence[str] = (),
        rebalance: bool = False,
    ) -> str:
        """Replace a table.  ``schema`` has to equal the frame's names and types.

        The new table is written beside the old one and takes its place when it is whole, so a write that fails
        leaves the old table as it was, and a frame that reads the table may replace it.

        Each task writes a file per partition value it meets.  Where tasks meet
        many, ``rebalance`` shuffles the rows by the partition columns first: a
        partition then gets few files, yet one that holds most of the rows is
        still split over many tasks at run time.
        """
        if schema is not None:
            require_schema(df, schema)
        path = self.table_path(layer, table, bool(partition_by))
        beside = f"{path.rpartition('/')[0]}/_new-{uuid.uuid4().hex}"
        if rebalance and partition_by:
            df = df.hint("rebalance", *partition_by)
        try:
            df.write.format(self.format).partitionBy(*partition_by).save(beside)
        except BaseException:
            delete_path(df.sparkSession, beside)
            raise
        replace_path(df.sparkSession, beside, path)
        return path

    def read(
        self,
        spark: SparkSession,
        layer: str | None,
        table: str,
        schema: T.StructType | str | None = None,
        partitioned: bool = False,
    ) -> DataFrame:
        """Read a table; ``schema`` also fixes the types of partition columns."""
        reader = spark.read if schema is None else spark.read.schema(schema)
        df = reader.format(self.format).load(self.table_path(layer, table, partitioned))
        # Partition columns come last from storage; keep the declared order.
        return df if schema is None else df.select(*[f"`{name}`" for name in _struct(schema).names])


def _struct(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def require_schema(df: DataFrame, schema: T.StructType | str) -> None:
    """Fail unless names, order and types agree; nullability is not compared."""
    schema = _struct(schema)
    actual = [(f.name, f.dataType.simpleString()) for f in df.schema]
    wanted = [(f.name, f.dataType.simpleString()) for f in schema]
    if actual != wanted:
        differing = [f"{a} is not {w}" for a, w in zip(actual, wanted) if a != w]
        if len(actual) != len(wanted):
            differing.append(f"{len(actual)} columns, {len(wanted)} wanted")
        raise TypeError("schema differs: " + "; ".join(differing))


def sql_over_files(spark: SparkSession, query: str, **paths: str) -> DataFrame:
    """Run SQL straight over Parquet paths: ``{name}`` in ``query`` stands for a path; other braces stay."""
    for name, path in paths.items():
        query = query.replace("{" + name + "}", "parquet.`" + path.replace("`", "``") + "`")
    return spark.sql(query)

"""All-text CSV: every column a string, no inference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.session import discard, materialize

# One complete quoted field, doubled quotes inside it, up to the next separator
# or the end of the line.  Possessive, so long fields need no backtracking.
_QUOTED_FIELD = r'(^|{sep})"[^"]*+(?:""[^"]*+)*+"(?={sep}|$)'


# A file with line breaks in its fields is read in ranges from this size on, and by one task below it.
RANGED_BYTES = 256 << 20


def _quotes_enclose_fields(text: str, separator: str) -> Column:
    """Whether all quotes of a text belong to complete quoted fields."""
    pattern = _QUOTED_FIELD.format(sep="\\" + separator)
    return ~F.contains(F.regexp_replace(text, pattern, "$1"), F.lit('"'))


def records_are_lines(spark: SparkSession, path: str, separator: str = ",") -> bool:
    """Whether no record of the file spans two lines, checked on every line.

    A line whose quotes all belong to complete quoted fields ends outside of
    quotes, so the next line starts a record; if that holds for all lines, each
    line is a record.  The check reads the file as plain lines, which Spark can
    split, and stops early at the first line that fails.
    """
    lines = spark.read.text(path)
    quoted = lines.where(F.contains("value", F.lit('"')))
    return quoted.where(~_quotes_enclose_fields("value", separator)).isEmpty()


def records_by_quotes(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, nth, record): the records of CSV files, each up to its line feed, found in parallel and written once.

    A line starts a record if an even number of quotes stands before it in its file.  Quotes are counted within the
    blocks that Spark splits a file into, and summed up over the blocks before, one number for each.  A block's lines before
    its first record go to the last record of the nearest block before that has one.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = materialize(
        lines.select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"), "value", quotes.alias("quotes"),
        ),
        "lines",
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy("file", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file", "block").orderBy("line")
    blocks = lines.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"))
    before = materialize(
        blocks.select("file", "block", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)).alias("before")), "blocks"
    )
    inside = F.coalesce(F.sum("quotes").over(above), F.lit(0))
    starts = ((F.col("inside") + F.col("before")) % 2 == 0).cast("long")
    counted = lines.withColumn("inside", inside).join(before, ["file", "block"]).withColumn("starts", starts)
    numbered = counted.withColumn("nth", F.sum("starts").over(upto)).select("file", "block", "line", "value", "nth")
    numbered = materialize(numbered, "numbered")
    last = numbered.groupBy("file", "block").agg(F.max("nth").alias("nth"))
    last = last.withColumn("own", F.when(F.col("nth") > 0, F.struct("block", "nth")))
    owners = last.select("file", "block", F.last("own", ignorenulls=True).over(earlier).alias("owner"))
    owners = materialize(owners, "owners")
    rest = numbered.where("nth = 0").join(owners, ["file", "block"]).select(
        "file", F.col("owner.block").alias("block"), F.col("owner.nth").alias("nth"), F.col("block").alias("at"), "line", "value"
    )
    own = numbered.where("nth > 0").select("file", "block", "nth", F.col("block").alias("at"), "line", "value")
    parts = F.sort_array(F.collect_list(F.struct("at", "line", "value")))
    records = own.unionByName(rest).groupBy("file", "block", "nth").agg(parts.alias("parts"))
    records = materialize(records.select("file", "block", "nth", F.array_join("parts.value", "\n").alias("record")), "records")
    discard(lines, before, numbered, owners)
    return records


def _read_in_ranges(spark: SparkSession, path: str, schema: T.StructType, separator: str) -> DataFrame | None:
    """The rows of CSV files with line breaks in fields, read by many tasks; None if quotes stand in other fields, too."""
    records = records_by_quotes(spark, path)
    header = (F.col("block") == 0) & (F.col("nth") == 1)
    returns = {row[0] for row in records.where(header).select(F.col("record").endswith("\r")).distinct().collect()}
    records = records.withColumn("record", F.regexp_replace("record", "\r$", ""))
    if len(returns) != 1 or not records.where(~_quotes_enclose_fields("record", separator)).isEmpty():
        return None
    if returns == {True}:  # line ends of the file's own kind become line feeds in fields, too
        records = records.withColumn("record", F.replace("record", F.lit("\r\n"), F.lit("\n")))
    options = {"sep": separator, "quote": '"', "escape": '"', "multiLine": "true", "mode": "FAILFAST"}
    rows = records.where(~header & (F.col("record") != ""))
    fields = ", ".join("`" + name.replace("`", "``") + "` string" for name in schema.names)
    return rows.select(F.from_csv("record", fields, options).alias("r")).select("r.*")


def read_text_csv(
    spark: SparkSession,
    path: str,
    multiline: bool | None = None,
    separator: str = ",",
    ranged_bytes: int = RANGED_BYTES,
) -> DataFrame:
    """Read a UTF-8 CSV with a header, all columns as strings, empty fields as NULL.

    Quotes inside a quoted field are doubled.  A record with too few or too
    many fields fails the read, as does a folder of files whose headers differ.
    ``multiline`` tells whether a quoted field may hold a line break: one task
    reads such a file.  ``None`` finds out first with one parallel pass over
    the lines and reads the file split whenever that is right.  Where it is not
    and a file has ``ranged_bytes`` or more, its records are found by counting
    quotes and read by many tasks, unless quotes stand in unquoted fields.
    """
    ranged = False
    if multiline is None:
        multiline = not records_are_lines(spark, path, separator)
        ranged = multiline and _largest_file(spark, path) >= ranged_bytes
    reader = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("sep", separator)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("mode", "FAILFAST")
    )
    df = reader.csv(path)
    if len(df.inputFiles()) > 1:
        # Fields go by position, so every file has to have the first one's header.
        headers = file_headers(spark, path)
        if len(headers) > 1:
            raise ValueError(f"files under {path} have different headers: {sorted(headers)[:3]}")
    if ranged:
        found = _read_in_ranges(spark, path, df.schema, separator)
        return df if found is None else found
    return df


def _largest_file(spark: SparkSession, path: str) -> int:
    files = spark.read.format("binaryFile").load(path)
    return files.agg(F.max("length")).first()[0] or 0


def _first_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line): the first line of each file.  Its number is found first, which needs no line's text and no sort."""
    first_blocks = spark.read.text(path).where(F.col("_metadata.file_block_start") == 0)
    lines = first_blocks.select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"),
        F.monotonically_increasing_id().alias("number"),
    )
    firsts = lines.groupBy("file").agg(F.min("number").alias("number")).select("number")  # one row per file
    return lines.join(F.broadcast(firsts), "number", "left_semi").select("line")


def file_headers(spark: SparkSession, path: str) -> list[str]:
    """The distinct first lines of the files under ``path``, two of them at most.

    Only the first block of a file is looked at.  Files without a line have no header.
    """
    header = F.regexp_replace("line", "^\ufeff|\r$", "")
    return [row[0] for row in _first_lines(spark, path).select(header.alias("header")).distinct().limit(2).collect()]


def write_text_csv(df: DataFrame, path: str) -> None:
    """Write all columns as text in the dialect ``read_text_csv`` reads."""
    text = df.select(*[F.col(f"`{name}`").cast("string").alias(name) for name in df.columns])
    (
        text.write.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )

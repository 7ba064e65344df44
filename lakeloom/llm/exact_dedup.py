"""Exact duplicates of texts, white space ignored, by 128-bit content hash and byte comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.bitmap import maybe_in, without
from lakeloom.session import materialize

# The characters deleted before texts are compared: U+0020 and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """The text without white space; NULL counts as empty."""
    text = F.coalesce(text, F.lit(""))
    for space in SPACES:
        text = F.replace(text, F.lit(space), F.lit(""))
    return text


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are, white space deleted; NULL is empty, and empty texts form a group like any
    other.  The longest original text stays, then the smallest id.  Rows that repeat an id with an equal text count
    in ``group_size`` and are kept if that id is.  A NULL id orders before all others.  Other columns are ignored,
    whatever their names; an empty table gives no rows.

    Groups are counted by hash with map-side combining, which shuffles no text.  The rows of hashes that occur more
    than once are then written with their text and compared with the text of one leader per hash, so that two texts
    with one hash end in different groups; a bitmap of those hashes keeps most other texts out of that shuffle.  Joins
    on a hash have a bare scan on either side, so that adaptive execution can split the partition of a hot hash.
    """
    text = F.col(f"`{text_col}`")
    texts = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        normalised(text).alias("norm"),
        F.length(F.coalesce(text, F.lit(""))).alias("n"),
    ).select("*", F.unhex(F.md5("norm")).alias("hash"), F.sha2("norm", 256).alias("text_sha256"))
    best = F.min(F.struct((-F.col("n")).alias("short"), "doc_id"))

    hashes = materialize(texts.drop("norm"), "hashes")
    groups = hashes.groupBy("hash").agg(F.count("*").alias("rows"), best.alias("best"))
    repeated = materialize(groups.where("rows > 1").select("hash", F.col("best.doc_id").alias("leader")), "repeated")
    members = maybe_in(texts, repeated, "hash").join(repeated.hint("merge"), "hash")
    members = materialize(members, "members")
    is_leader = F.col("doc_id").eqNullSafe(F.col("leader"))
    leaders = materialize(members.where(is_leader).groupBy("hash").agg(F.min("norm").alias("same")), "leaders")
    # NULL in "other" stands for the leader's text; a text that only shares the hash stands for itself.
    other = F.when(F.col("norm") != F.col("same"), F.col("norm")).alias("other")
    compared = materialize(
        members.join(leaders, "hash").select("doc_id", "n", "hash", "text_sha256", other), "compared"
    )
    classes = materialize(
        compared.groupBy("hash", F.col("other").alias("class"))
        .agg(F.count("*").alias("group_size"), best.alias("best"))
        .select("hash", "class", "group_size", F.col("best.doc_id").alias("keep_id")),
        "classes",
    )
    grouped = compared.join(classes, "hash").where(F.col("other").eqNullSafe(F.col("class")))
    alone = hashes.join(repeated.select("hash"), "hash", "left_anti").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), "text_sha256"
    )
    rows = alone.unionByName(grouped.select("doc_id", "keep_id", "group_size", "text_sha256"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")
    return rows.select("doc_id", "keep_id", "group_size", kept, "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with all their columns.

    Rows are looked up by id and digest, so ids need not be unique; of rows that repeat an id with an equal text, the
    one of the longest text stays.
    """
    report = materialize(exact_dedup(docs, id_col, text_col), "report")
    key = [F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__digest")]
    text = F.col(f"`{text_col}`")
    own = docs.withColumn("__own", F.sha2(normalised(text), 256))
    dropped = materialize(report.where("not kept").select(*key).distinct(), "dropped")
    kept = without(own, dropped, __id=id_col, __digest="__own")
    again = report.where("kept").groupBy(*key).count().where("count > 1").drop("count")
    again = materialize(again, "again")
    columns = [F.col(f"`{name}`") for name in docs.columns]
    if again.isEmpty():
        return kept.select(*columns)
    same = F.col("__same").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__digest"))
    # Grouped before they are joined, so that no task gets all rows of a key.
    longest = F.max_by(F.struct(*columns), F.struct(F.length(text), text)).alias("__row")
    doubtful = maybe_in(kept.withColumn("__digest", F.col("__own")), again, "__digest")
    once = doubtful.groupBy(F.col(f"`{id_col}`").alias("__same"), "__own").agg(longest)
    once = once.join(again, same, "left_semi").select("__row.*")
    alone = without(kept, again, __digest="__own", __id=id_col).select(*columns)
    return alone.unionByName(once)

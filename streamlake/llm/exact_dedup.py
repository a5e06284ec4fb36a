"""Exact deduplication by 128-bit content hash with a byte comparison.

Rows are grouped by the MD5 of the normalised text.  Only groups of two or
more rows look at their texts, and those are grouped by the bytes themselves
(partial aggregation: of a hot group each task sends one copy), so texts
whose hashes collide end in different groups.  Which rows are in such groups,
and which go, the scans learn by position (``marks``): no other text moves.

Defined results: a null text is an empty text; the row with the smallest
non-null id stays (of equal ids the first by position); rows that repeat both
id and text are copies of which one stays; an empty table gives an empty
result; other columns are ignored by ``mark`` and carried through by
``drop_copies``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import marks
from .common import normalise_space, write_table


def content_hash(text: Column) -> Column:
    """128-bit hash as 16 bytes."""
    return F.unhex(F.md5(text))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           hash_fn: Callable[[Column], Column] = content_hash) -> tuple[DataFrame, DataFrame]:
    """Two written tables: ``file, at, id, h, sha`` of every row of ``docs``
    (from ``marks.scan``), and of every text that stands on several rows ``h,
    sha, keep`` (id, file, at of the row that stays) and ``group_size``."""
    norm = normalise_space(F.col(f"row.{text_col}")).alias("norm")
    members = write_table(
        marks.placed(docs).select("file", "at", F.col(f"row.{id_col}").alias("id"), norm)
        .select("file", "at", "id", hash_fn(F.col("norm")).alias("h"), F.unhex(F.sha2("norm", 256)).alias("sha")),
        "dedup-members")
    shared = write_table(members.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h"),
                         "dedup-hashes")  # a table of its own: Spark can split a hot hash in the join
    several = marks.only(docs, members.select("file", "at", "h").join(shared, "h"), "dedup-shared")
    # bytes inside the groups: one row per hash and text
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "file", "at"))
    texts = (several.select("file", "at", F.col(f"row.{id_col}").alias("id"), norm)
             .select("file", "at", "id", hash_fn(F.col("norm")).alias("h"), "norm")
             .groupBy("h", "norm").agg(first.alias("keep"), F.count(F.lit(1)).alias("group_size")))
    verified = (texts.filter("group_size > 1").select("h", F.unhex(F.sha2("norm", 256)).alias("sha"), "keep", "group_size")
                .groupBy("h", "sha")
                .agg(F.min("keep").alias("keep"), F.sum("group_size").alias("group_size"),
                     F.count(F.lit(1)).alias("texts"))
                .select("h", "sha", "keep",
                        F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts share both digests")))
                        .otherwise(F.col("group_size")).cast("long").alias("group_size")))
    return members, write_table(verified, "dedup-groups")


def mark(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         hash_fn: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    members, several = groups(marks.scan(docs, "dedup-rows"), id_col, text_col, hash_fn)
    alone = F.col("group_size").isNull()
    return members.join(several, ["h", "sha"], "left").select(
        F.col("id").alias(id_col), F.when(alone, F.col("id")).otherwise(F.col("keep.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (alone | ((F.col("file") == F.col("keep.file")) & (F.col("at") == F.col("keep.at")))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    docs = marks.scan(docs, "dedup-rows")
    members, several = groups(docs, id_col, text_col)
    gone = (members.select("file", "at", "h", "sha").join(several.select("h", "sha", "keep"), ["h", "sha"])
            .filter("file != keep.file or at != keep.at"))
    return marks.without(docs, gone, "dedup-gone")

"""Exact duplicates by skew-safe combining.

Texts are compared without their white space. Equal ones are brought together in three
steps, and each of them groups by the whole content beside its digest, so a digest that two
contents share joins nothing:

1. every task combines the equal texts of its own share before anything is shuffled;
2. what is left meets by digest, content and a salt, so the copies of one text, however
   many tasks hold some, are merged by as many tasks as there are salts;
3. the winners of the salts, at most ``SALTS`` for a text, are combined for good.

No step gathers a group: each keeps one winner and a count. The rows of a group learn its
winner by a join on the digest, whose small side is stored, so that Spark broadcasts it or
may split a digest with very many rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starkit.llm.common import stored

# Tasks that merge the copies of one text.
SALTS = 16
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """A text without its white space; a null text is empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), WHITE_SPACE, "")


def _sha256(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def _better() -> Column:
    """Greatest for the row that stays: the most code points, then the smallest id; rows
    without id come last."""
    order = F.bitwise_not("doc_id").alias("order")  # falls as the id rises, without overflow
    return F.struct("points", F.col("doc_id").isNotNull().alias("named"), order)


def content_groups(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """``(digest, content, best, group_size)`` for each distinct content of
    ``rows(doc_id, points, digest, content)``; ``best`` is the greatest ``_better``."""
    # By task, so that a task's own copies have one salt and are combined where they are.
    salted = rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    by_salt = salted.groupBy("digest", "content", "salt").agg(
        F.max(_better()).alias("best"), F.count(F.lit(1)).alias("rows")
    )
    return by_salt.groupBy("digest", "content").agg(
        F.max("best").alias("best"), F.sum("rows").alias("group_size")
    )


def duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digest=_sha256,
) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_digest)`` of every row.

    ``keep_id`` is the id of the one row that stays of all with the same text but for white
    space: the one with the most code points, then the smallest id. A null text counts as
    empty, so null, empty and blank texts are one group. A row without id stays only if
    no equally long row of its group has one; ``keep_id`` is null then. Of repeated rows,
    with one id and equally long texts, one stays. An empty table gives no rows. Other
    columns are not read.
    """
    text = F.col(text_col).cast("string")
    read = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.char_length(text), F.lit(0)).alias("points"),
        normalised(text).alias("content"),
    ).withColumn("digest", digest(F.col("content")))
    # Stored with a number, which tells repeated rows apart from here on.
    members = stored(
        read.select("doc_id", "points", "digest").withColumn("row", F.monotonically_increasing_id()),
        "members",
    )
    winners = content_groups(read, salts)
    best = [
        F.col("best.points").alias("best_points"),
        F.bitwise_not("best.order").alias("keep_id"),
        "group_size",
    ]
    winners = stored(winners.select("digest", *best), "winners")
    shared = winners.groupBy("digest").count().filter("count > 1").select("digest")
    if shared.isEmpty():
        joined = members.join(winners, "digest")
    else:
        joined = _by_content(read, content_groups(read, salts).select("digest", "content", *best))
    is_best = (F.col("points") == F.col("best_points")) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    joined = joined.withColumn("kept", is_best)
    if joined.filter("kept").count() > winners.count():
        joined = _first_of_repeats(stored(joined, "joined"))
    return joined.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_digest"))


def _by_content(read: DataFrame, winners: DataFrame) -> DataFrame:
    """The join for the case that two contents share a digest: by content as well."""
    numbered = stored(read.withColumn("row", F.monotonically_increasing_id()), "contents")
    return numbered.join(stored(winners, "whole-winners"), ["digest", "content"])


def _first_of_repeats(joined: DataFrame) -> DataFrame:
    """``kept`` for one row where several share id, length and text: the first stored."""
    group = ["digest", "keep_id", "best_points", "group_size"]
    group += ["content"] if "content" in joined.columns else []
    first = joined.filter("kept").groupBy(*group).agg(F.min("row").alias("first_row"))
    first = stored(first.select("first_row"), "first-rows")
    found = joined.join(first, joined["row"] == first["first_row"], "left")
    return found.withColumn("kept", F.col("first_row").isNotNull())

"""Exact duplicates by progressive refinement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import column, lower_ascii, stored, text_or_empty
from starloom.names import quoted

#: Characters of the second step's hash.
PREFIX_CHARS = 256


def text_digest(text: Column) -> Column:
    """SHA-256 of the normalised text, in lower-case hex digits."""
    return F.sha2(lower_ascii(text).cast("binary"), 256)


def _refined(text: Column) -> list[Column]:
    """The first two steps: the length, and a hash of the first characters."""
    start = lower_ascii(F.substring(text, 1, PREFIX_CHARS))
    return [F.octet_length(text).alias("length"), F.xxhash64(start).alias("prefix")]


def _contested(rows: DataFrame) -> DataFrame:
    """``length, prefix, contested`` of the groups that more than one row has.

    Only what shares its length is grouped by prefix. Rows are counted before they are shuffled,
    so that a hot group is a row per task.
    """
    counts = rows.groupBy("length", "prefix").agg(F.count("*").alias("size"))
    lengths = counts.groupBy("length").agg(F.sum("size").alias("size")).where("size > 1")
    prefixes = (
        counts.join(lengths.select("length"), "length", "left_semi")
        .where("size > 1")
        .select("length", "prefix", F.lit(True).alias("contested"))
    )
    return stored(prefixes, "prefixes")


def exact_dedup(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    digest_all: bool = False,
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Rows are grouped by the length of their text, those of shared lengths by a hash of the
    first characters too, and only rows of groups that are left are hashed in full.
    ``text_sha256`` is null for the others unless ``digest_all`` asks for it.

    Texts are equal when they agree after lower-casing A-Z. The largest id of a group is kept.
    A null text is an empty one. Null ids lose against any other; if a group has no other, its
    rows have a null ``keep_id`` and are kept. Rows repeated with their id count as often as
    they occur and share a decision. An empty table gives an empty result; other columns of
    the input are not looked at.
    """
    text = text_or_empty(text_column)
    rows = df.select(column(id_column).alias("doc_id"), text.alias("text"), *_refined(text))
    prefixes = _contested(rows)
    contested = F.coalesce("contested", F.lit(False))
    # Each join's other side has a row per key and is a table, so Spark may split a hot group.
    hashed = stored(
        rows.join(prefixes, ["length", "prefix"], "left").select(
            "doc_id",
            contested.alias("contested"),
            F.when(contested | F.lit(digest_all), text_digest(F.col("text"))).alias("digest"),
        ),
        "hashed",
    )
    groups = (
        hashed.where("contested")
        .groupBy(F.col("digest").alias("same"))
        .agg(F.max("doc_id").alias("largest"), F.count("*").alias("size"))
        .where("size > 1")
    )
    groups = stored(groups, "groups")
    grouped = hashed.join(groups, hashed.digest == groups.same, "left")
    keep = F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("largest"))
    return grouped.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def keep_one_copy(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``df`` without exact copies, as :func:`exact_dedup` decides.

    Rows of a length and start of their own are passed on as they are; only the others are
    hashed, once. Of rows repeated with their id and text one stays, and one of a group without
    ids. Null texts count as empty. Texts may be of any length and columns have any names; an
    empty table stays empty.
    """
    text = text_or_empty(text_column)
    whole = F.struct(*[F.col(quoted(name)) for name in df.columns]).alias("row")
    rows = df.select(whole, column(id_column).alias("doc_id"), text.alias("text"), *_refined(text))
    prefixes = _contested(rows.select("length", "prefix"))
    groups = ["length", "prefix"]
    alone = rows.join(prefixes, groups, "left_anti").select("row")
    contested = rows.join(prefixes, groups, "left_semi").select(
        "row", "doc_id", text_digest(F.col("text")).alias("digest")
    )
    contested = stored(contested, "contested")
    # A row per id and digest, so that no text is grouped.
    copies = contested.groupBy("digest", "doc_id").agg(F.count("*").alias("size"))
    last = F.max(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "size"))
    decided = copies.groupBy("digest").agg(last.alias("last"), F.sum("size").alias("all"))
    decided = stored(decided.where(F.col("all") > 1), "decided")
    settled = contested.join(decided, "digest", "left").where(
        F.col("last").isNull() | F.col("doc_id").eqNullSafe(F.col("last.doc_id"))
    )
    repeated = F.coalesce(F.col("last.size") > 1, F.lit(False))
    # Whole rows are compared only where one id has one text several times.
    once = settled.where(repeated).groupBy("digest").agg(F.first("row").alias("row"))
    kept = alone.unionByName(settled.where(~repeated).select("row")).unionByName(once.select("row"))
    return kept.select("row.*")

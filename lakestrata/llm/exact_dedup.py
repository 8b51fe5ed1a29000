"""Exact duplicates by progressive refinement: length, then a hash of the start, then a hash of the whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.text import quoted
from lakestrata.session import work_folder

PREFIX_CHARS = 64


def duplicate_groups(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_all: bool = False, carry: bool = False
) -> DataFrame:
    """One row per row of `df`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are compared as they are; null counts as empty, so null and empty texts
    are one group. The largest id of a group stays (null ids count as smallest),
    and of rows that repeat that id with the same text only the last read is
    `kept`. `carry` adds the whole source row as the struct `row`. Lengths and prefix hashes are counted
    before any shuffle; the whole text is hashed only where both agree with another
    row's. `hash_all` fills text_sha256 for the others too. Counts combine before
    their shuffle, and the joins are plain ones whose large partitions adaptive
    execution splits, so a group may hold any share of the rows. The hashes are
    written to the shared folder once. An empty table
    gives no rows; other columns are not read.
    """
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    carried = [F.struct(*(F.col(quoted(c)) for c in df.columns)).alias("row")] if carry else []
    kept_columns = ["row"] if carry else []
    rows = df.select(
        F.col(quoted(id_col)).alias("doc_id"),
        text.alias("text"),
        F.octet_length(text).alias("length"),
        F.xxhash64(F.substring(text, 1, PREFIX_CHARS)).alias("prefix"),
        F.monotonically_increasing_id().alias("place"),
        *carried,
    )
    # Lengths that occur once need no second look; the others are told apart by the start of the text.
    starts = rows.groupBy("length", "prefix").agg(F.count(F.lit(1)).alias("n"))
    lengths = starts.groupBy("length").agg(F.sum("n").alias("of_length")).where("of_length > 1")
    alike = (
        starts.where("n > 1")
        .join(lengths, "length", "left_semi")
        .select("length", "prefix", F.lit(True).alias("alike"))
    )
    digest = F.sha2(F.col("text").cast("binary"), 256)
    hashed = rows.join(alike, ["length", "prefix"], "left").select(
        "doc_id",
        "place",
        *kept_columns,
        "length",
        "prefix",
        "alike",
        (digest if hash_all else F.when(F.col("alike"), digest)).alias("text_sha256"),
    )
    key = ["length", "prefix", "text_sha256"]
    # Both sides of the last join read one table, so that equal rows have one place.
    path = work_folder(df.sparkSession, "exact-dedup")
    hashed.write.parquet(path)
    found = df.sparkSession.read.parquet(path)
    groups = (
        df.sparkSession.read.parquet(path)
        .where("alike")
        .groupBy(*key)
        .agg(F.max(F.struct("doc_id", "place")).alias("keep"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    joined = found.join(groups, key, "left")
    grouped = F.col("n").isNotNull()
    return joined.select(
        "doc_id",
        F.when(grouped, F.col("keep.doc_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (~grouped | (F.col("place") == F.col("keep.place"))).alias("kept"),
        "text_sha256",
        *kept_columns,
    )

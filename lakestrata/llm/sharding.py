"""Shards by a Feistel permutation over global row numbers, in built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.functions.text import quoted

#: Rows are numbered within so many hashed buckets, and each bucket starts after those before it.
BUCKETS = 4096
ROUNDS = 4
#: Steps of the walk before the bound that always suffices is used.
SHORT_WALK = 8


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _feistel(x: Column, left_size: Column, right_size: Column, seed: int) -> Column:
    """A bijection of 0 .. left_size * right_size - 1: each round adds a hash of one half to the other."""
    left, right = _div(x, right_size), x % right_size
    for i in range(ROUNDS):
        if i % 2:
            right = F.pmod(right + F.pmod(F.xxhash64(F.lit(seed), F.lit(i), left), right_size), right_size)
        else:
            left = F.pmod(left + F.pmod(F.xxhash64(F.lit(seed), F.lit(i), right), left_size), left_size)
    return left * right_size + right


def permuted(number: Column, rows: Column, seed: int) -> Column:
    """The place (long) of row `number` in a reproducible shuffle of 0 .. rows - 1.

    The Feistel network permutes the smallest near-square range that holds all
    rows; fewer than its square root of values lie outside. A row that lands
    there walks on along its cycle until it is inside, at most as many steps as
    there are values outside. It is a pure function of its arguments, so a place
    can be computed without the table.
    """
    rows = rows.cast("long")
    left_size = F.ceil(F.sqrt(rows.cast("double"))).cast("long")
    right_size = _div(rows + left_size - 1, left_size)

    def walk(x: Column, steps: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1).cast("long"), steps),
            x,
            lambda at, _: F.when(at < rows, at).otherwise(_feistel(at, left_size, right_size, seed)),
        )

    first = _feistel(number.cast("long"), left_size, right_size, seed)
    short = walk(first, F.lit(SHORT_WALK).cast("long"))
    far = walk(first, left_size * right_size - rows)
    return F.when(first < rows, first).otherwise(F.when(short < rows, short).otherwise(far))


def shard_rows(
    df: DataFrame, shards: int = 16, seed: int = 7, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All rows in `shards` shards by the law `rows`: counts differ by one at most.

    Returns doc_id, size (UTF-8 bytes plus one), text_crc32, row_number (0 ..),
    law, shard, slot (0 .. without gaps within a shard) and grown_shard (null, as
    this law does not keep rows where they are when a shard is added).

    Rows are numbered in the order of hash bucket, id, size and checksum, so the
    result depends on the rows alone and not on how they are stored. Equal rows
    are counted before the shuffle and spread out again after it; they take
    neighbouring numbers. A null text is empty (size 1, checksum 0); null ids are
    rows like any other, and rows of one id are numbered by size and checksum.
    An empty table gives no rows; other columns are not read.
    """
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    source = df.select(
        F.col(quoted(id_col)).alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    ).withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)).cast("int"))
    key = ["bucket", "doc_id", "size", "text_crc32"]
    before = Window.partitionBy("bucket").orderBy("doc_id", "size", "text_crc32")
    counted = (
        source.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("first", F.sum("copies").over(before) - F.col("copies"))
    )
    # One row a bucket: a table of proven size.
    sizes = source.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    offsets = sizes.select(
        "bucket",
        (F.sum("n").over(Window.orderBy("bucket")) - F.col("n")).alias("offset"),
        F.sum("n").over(Window.partitionBy()).alias("rows"),
    )
    numbered = (
        counted.join(F.broadcast(offsets), "bucket")
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        .withColumn("row_number", F.col("offset") + F.col("first") + F.col("copy"))
        .withColumn("place", permuted(F.col("row_number"), F.col("rows"), seed))
    )
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        "row_number",
        F.lit("rows").alias("law"),
        (F.col("place") % shards).cast("int").alias("shard"),
        _div(F.col("place"), F.lit(shards).cast("long")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

"""Joins of aggregated entities to other tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions.text import quoted

#: The smallest share of the rows that may make a key hot: at most 100,000 keys then are.
LEAST_SHARE = 1e-5


def default_share(df: DataFrame) -> float:
    """Half of what an even task of a shuffle holds, but no less than `LEAST_SHARE`."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(LEAST_SHARE, 0.5 / partitions)


def hot_keys(df: DataFrame, key: str, share: float | None = None) -> DataFrame:
    """Keys with more than `share` of all rows, one row per key; by default `default_share(df)`.

    `__copies` says over how many tasks the key's rows should go, so that none gets
    more than about `share` of the table. Each key holds more than `share` of the
    rows, so there are fewer than 1 / share of them, 100,000 at most, whatever the
    size of the table: safe to broadcast.
    """
    share = default_share(df) if share is None else share
    if not LEAST_SHARE <= share <= 1:
        raise ValueError(f"a hot share of {share} is not between {LEAST_SHARE} and 1")
    counts = df.groupBy(F.col(quoted(key)).alias("__hot_key")).agg(F.count(F.lit(1)).alias("n"))
    limit = counts.agg(F.sum("n") * share).scalar()
    return counts.where(F.col("n") > limit).select(
        "__hot_key", F.ceil(F.col("n") / limit).cast("int").alias("__copies")
    )


def _unhashable(kind: T.DataType) -> bool:
    """Whether Spark's hashes refuse the type: maps and variants, also inside others."""
    return any(name in kind.simpleString() for name in ("map<", "variant"))


def join_entities(
    entities: DataFrame,
    other: DataFrame,
    entity_key: str,
    other_key: str,
    *,
    spread_hot_keys: bool = False,
    hot_share: float | None = None,
) -> DataFrame:
    """Inner equi-join on differently named keys; all columns of both sides are kept.

    `entities` has one row per key. `other` may repeat keys (rows fan out); a
    null key matches nothing. Whether one side is broadcast is left to Spark,
    which checks the measured size against its threshold.

    With `spread_hot_keys=True` the rows of a key that holds more than `hot_share`
    of `other` go to several tasks, and the one entity row they meet is copied to
    each of these. The task is picked by a hash of the row and the id of its input
    partition: unlike a random salt it is the same when a lost task runs again.
    The row spreads a key that lies in one partition, the partition rows that are
    all equal.
    """
    if not spread_hot_keys:
        return entities.join(other, entities[quoted(entity_key)] == other[quoted(other_key)], "inner")

    present = other.where(F.col(quoted(other_key)).isNotNull())
    row = [present[quoted(f.name)] for f in present.schema if not _unhashable(f.dataType)]
    hot = F.broadcast(hot_keys(present, other_key, hot_share))
    spread = present.join(hot, F.col(quoted(other_key)) == F.col("__hot_key"), "left").select(
        *[present[quoted(c)] for c in present.columns],
        F.when(F.col("__copies").isNull(), 0)
        .otherwise(F.pmod(F.xxhash64(F.spark_partition_id(), *row), F.col("__copies")).cast("int"))
        .alias("__other_slot"),
    )
    copied = entities.join(hot, F.col(quoted(entity_key)) == F.col("__hot_key"), "left").select(
        *[entities[quoted(c)] for c in entities.columns],
        F.explode(
            F.when(F.col("__copies").isNull(), F.array(F.lit(0))).otherwise(
                F.sequence(F.lit(0), F.col("__copies") - 1)
            )
        ).alias("__entity_slot"),
    )
    return copied.join(
        spread,
        (copied[quoted(entity_key)] == spread[quoted(other_key)]) & (F.col("__entity_slot") == F.col("__other_slot")),
        "inner",
    ).drop("__entity_slot", "__other_slot")

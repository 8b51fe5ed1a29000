"""Partitioned files planned by size: how many bytes each value has decides which task writes it."""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions.text import quoted

#: What opening, closing and naming a file is worth, in bytes written.
FILE_BYTES = 4 << 20
#: Partition values, at most, whose sizes the driver plans with; a dataset of more folders is not planned.
MOST_VALUES = 200_000

_FIXED = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4}


def _width(name: str, kind: T.DataType) -> Column:
    """Bytes of a value before compression; nested values by their text."""
    value = F.col(quoted(name))
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 4
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0))
    return F.lit(_FIXED.get(type(kind), 8))


def row_bytes(df: DataFrame, leave_out: str) -> Column:
    """About how many bytes a row has without the partition column, which is in no file."""
    widths = [_width(f.name, f.dataType).cast("long") for f in df.schema if f.name != leave_out]
    return sum(widths, F.lit(0).cast("long"))


@dataclass(frozen=True)
class Share:
    """The tasks that write a partition value: `tasks` of them from `first` on."""

    value: object
    first: int
    tasks: int


def pack_values(sizes: list[tuple[object, int]], target: int) -> tuple[list[Share], int]:
    """Deal values with their bytes to tasks of about `target` bytes; the shares and the number of tasks.

    A value beyond the target gets as many tasks of its own as it fills; the others,
    the largest first, go to the task with the least room that still holds them.
    """
    shares, used = [], 0
    room: list[tuple[int, int]] = []  # left bytes and task, ascending
    for value, size in sorted(sizes, key=lambda s: -s[1]):
        size += FILE_BYTES
        if size > target:
            tasks = -(-size // target)
            shares.append(Share(value, used, tasks))
            used += tasks
            continue
        at = bisect_left(room, (size, -1))
        if at < len(room):
            left, task = room.pop(at)
        else:
            left, task, used = target, used, used + 1
        shares.append(Share(value, task, 1))
        insort(room, (left - size, task))
    return shares, used


def deal_by_size(df: DataFrame, partition_by: str, target: int) -> DataFrame:
    """`df` with its rows in the tasks that `pack_values` plans, ready for a write by `partition_by`.

    A first pass sums the bytes of each value, one row a value, which the driver packs; the
    plan goes to the rows as a broadcast of as many rows. No file is larger than about
    `target` (before compression), and a value has one file a task it was given: as
    many files as values, and one more for each further `target` of a large one.
    A large value is split by a hash of the row and its input partition, so that equal rows
    part as well. With more than `MOST_VALUES` values `df` is returned as it is.
    """
    if target <= FILE_BYTES:
        raise ValueError(f"files of less than {FILE_BYTES} bytes cost more to open than to write")
    spark, column = df.sparkSession, F.col(quoted(partition_by))
    sums = df.groupBy(column.alias("value")).agg(F.sum(row_bytes(df, partition_by)).alias("bytes"))
    sizes = [(r.value, r.bytes) for r in sums.limit(MOST_VALUES + 1).collect()]
    if not sizes or len(sizes) > MOST_VALUES:
        return df
    shares, tasks = pack_values(sizes, target)
    kind = df.schema[partition_by].dataType
    schema = T.StructType(
        [T.StructField("__value", kind), T.StructField("__first", T.IntegerType()), T.StructField("__tasks", T.IntegerType())]
    )
    plan = spark.createDataFrame([(s.value, s.first, s.tasks) for s in shares], schema)
    plain = [F.col(quoted(f.name)) for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    slot = F.pmod(F.xxhash64(F.spark_partition_id(), *plain), F.col("__tasks")).cast("int")
    dealt = df.join(F.broadcast(plan), column.eqNullSafe(F.col("__value")), "left").select(
        *[F.col(quoted(c)) for c in df.columns],
        # A value that came after the sums were taken goes to the first task.
        F.coalesce(F.col("__first") + slot, F.lit(0)).alias("__task"),
    )
    return dealt.repartitionById(tasks, F.col("__task")).drop("__task")

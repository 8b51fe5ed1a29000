"""Packing of token pieces into sequences by minimum bin slack."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.functions.text import quoted
from lakestrata.llm.common import BATCH_BYTES, by_bytes, small_batches
from lakestrata.llm.library_ids import library_encoder
from lakestrata.session import work_folder


def fullest(counts: dict[int, int], size: int) -> dict[int, int]:
    """How often to take each length so that their sum is the largest one up to `size`.

    Bit s of a set says that sum s can be reached with the lengths so far, longest
    first; the sets are walked back from the largest sum.
    """
    mask, reach, steps = (1 << (size + 1)) - 1, 1, []
    for length in sorted((n for n in counts if n <= size), reverse=True):
        for _ in range(min(counts[length], size // length)):
            wider = (reach | reach << length) & mask
            if wider == reach:
                break
            steps.append((length, reach))
            reach = wider
        if reach >> size & 1:
            break
    total, taken = reach.bit_length() - 1, Counter()
    for length, reach in reversed(steps):
        if not reach >> total & 1:
            taken[length] += 1
            total -= length
    return dict(taken)


def minimum_bin_slack(histogram: dict[int, int], size: int) -> list[tuple[dict[int, int], int]]:
    """Fillings of bins of `size` that use up a histogram of lengths, and how many bins get each.

    Each filling holds the longest length left and the combination that leaves
    the least slack beside it, which is then removed as often as it can be. The
    number of fillings depends on the number of different lengths only.
    """
    left = {n: c for n, c in histogram.items() if c}
    plan = []
    while left:
        longest = max(left)
        rest = {n: c - (n == longest) for n, c in left.items() if n != longest or c > 1}
        filling = Counter(fullest(rest, size - longest))
        filling[longest] += 1
        times = min(left[n] // u for n, u in filling.items())
        for n, u in filling.items():
            left[n] -= u * times
            if not left[n]:
                del left[n]
        plan.append((dict(filling), times))
    return plan


def _intervals(plan: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows length, first rank, first sequence, pieces a sequence, offset of the first; by length and rank."""
    used: Counter[int] = Counter()
    sequence, rows = 0, []
    for filling, times in plan:
        offset = 0
        for length in sorted(filling, reverse=True):
            each = filling[length]
            rows.append((length, used[length], sequence, each, offset))
            used[length] += each * times
            offset += each * length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack_documents(
    df: DataFrame, tokenizer_path: str, end_id: int, size: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All texts as pieces in as few sequences of at most `size` tokens as it can.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id and offset per
    piece. A text is its ids and `end_id`; one longer than `size` is cut from its
    end, so only its first piece may be shorter. Null texts are empty and give
    one piece of the end id. Ids may be null or repeat; each row is packed.

    Pieces are written to the shared folder once, numbered among those of their
    length and input partition. Only the histogram of lengths (`size` rows at
    most) reaches the driver, which finds the fillings; pieces of one length are
    alike, so a piece's rank in it gives its sequence. No group is gathered: ranks
    come from counts per partition. An empty table gives no rows; other columns
    are not read.
    """
    spark = df.sparkSession
    small_batches(spark)
    with open(tokenizer_path, "rb") as file:
        held = spark.sparkContext.broadcast(file.read())  # one vocabulary file
    source = df.select(
        F.col(quoted(id_col)).alias("doc_id"), F.coalesce(F.col(quoted(text_col)), F.lit("")).alias("text")
    )
    kind = source.schema["doc_id"].dataType.simpleString()
    end = pack("<I", end_id)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = library_encoder(held.value)
        part = TaskContext.get().partitionId()
        seen: Counter[int] = Counter()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            rows, owner = [], []
            for first, last in by_bytes(texts, 2 * BATCH_BYTES):
                for i, ids in enumerate(encode(texts[first:last]), first):
                    ids += end
                    n = len(ids) // 4
                    starts = [0, *range((n - 1) % size + 1, n, size)]
                    for piece, (a, b) in enumerate(zip(starts, [*starts[1:], n], strict=True)):
                        owner.append(i)
                        rows.append((piece, a, b - a, zlib.crc32(ids[4 * a : 4 * b]), seen[b - a]))
                        seen[b - a] += 1
            columns = zip(*rows, strict=True) if rows else [()] * 5
            arrays = [pa.array(c, pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(rows), pa.int64()), batch.column(0).take(pa.array(owner, pa.int64())), *arrays],
                ["part", "doc_id", "piece", "start", "length", "ids_crc32", "local_rank"],
            )

    schema = f"part long, doc_id {kind}, piece long, start long, length long, ids_crc32 long, local_rank long"
    path = work_folder(spark, "pieces")
    source.mapInArrow(cut, schema).write.parquet(path)
    pieces = spark.read.parquet(path)

    counts = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = _intervals(minimum_bin_slack(histogram, size))
    starts = table[:, 0] << 48 | table[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = table[np.searchsorted(starts, length << 48 | rank, "right") - 1]
            over = rank - at[:, 1]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                    pa.array(at[:, 2] + over // at[:, 3]),
                    pa.array(at[:, 4] + over % at[:, 3] * length),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    before = counts.select(
        "length",
        "part",
        (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"),
    )
    ranked = pieces.join(before, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("local_rank")).alias("rank")
    )
    placed = ranked.mapInArrow(
        place,
        f"doc_id {kind}, piece long, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
    return placed.withColumn("piece", F.col("piece").cast("int"))

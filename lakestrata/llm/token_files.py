"""Token ids in files of patched frame-of-reference blocks."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from struct import pack, unpack_from

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestrata.functions.text import quoted
from lakestrata.llm.common import BATCH_BYTES, by_bytes, small_batches
from lakestrata.llm.library_ids import library_encoder

BLOCK = 1024
#: The share of a block's values that its bit width must hold; the others are exceptions.
PERCENTILE = 0.9
#: A segment, one row of a file, ends after the document that brings it to so many ids.
SEGMENT_IDS = 1 << 18
_HEAD = "<IBH"  # minimum, width, number of exceptions


def pack_block(values: np.ndarray) -> bytes:
    """One block of up to 65,536 unsigned 32-bit values.

    Minimum, bit width, number of exceptions; then the differences from the
    minimum, cut to that many bits; then places (16 bits) and whole differences
    (32 bits) of the exceptions.
    """
    low = int(values.min())
    rest = values - np.uint32(low)
    at = int(PERCENTILE * (len(rest) - 1))
    width = int(np.partition(rest, at)[at]).bit_length()
    size = 16 if width <= 16 else 32
    bits = np.unpackbits(rest.astype(f">u{size // 8}").view(np.uint8).reshape(len(rest), -1), axis=1)[:, size - width :]
    places = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.empty(0, int)
    return b"".join(
        (
            pack(_HEAD, low, width, len(places)),
            np.packbits(bits).tobytes(),
            places.astype("<u2").tobytes(),
            rest[places].astype("<u4").tobytes(),
        )
    )


def unpack_block(data: bytes, at: int, n: int) -> np.ndarray:
    """The `n` values of the block that starts at byte `at`."""
    low, width, exceptions = unpack_from(_HEAD, data, at)
    at += 7
    size = (n * width + 7) // 8
    whole = 16 if width <= 16 else 32
    bits = np.zeros((n, whole), np.uint8)
    bits[:, whole - width :] = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=n * width).reshape(n, width)
    rest = np.packbits(bits, axis=1).view(f">u{whole // 8}").ravel().astype("<u4")
    at += size
    places = np.frombuffer(data, "<u2", exceptions, at)
    rest[places] = np.frombuffer(data, "<u4", exceptions, at + 2 * exceptions)
    return rest + np.uint32(low)


def pack_ids(ids: np.ndarray) -> bytes:
    """A segment: number of ids, the byte where each block starts, the blocks."""
    blocks = [pack_block(ids[i : i + BLOCK]) for i in range(0, len(ids), BLOCK)]
    starts = np.cumsum([4 + 4 * len(blocks)] + [len(b) for b in blocks[:-1]]) if blocks else np.empty(0)
    return pack("<I", len(ids)) + starts.astype("<u4").tobytes() + b"".join(blocks)


def unpack_ids(data: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids `start` to `stop` of a segment; only the blocks that hold them are read."""
    (n,) = unpack_from("<I", data)
    stop = n if stop is None else min(stop, n)
    if start >= stop:
        return np.empty(0, "<u4")
    index = np.frombuffer(data, "<u4", (n + BLOCK - 1) // BLOCK, 4)
    first = start // BLOCK
    found = [
        unpack_block(data, int(index[b]), min(BLOCK, n - b * BLOCK)) for b in range(first, (stop - 1) // BLOCK + 1)
    ]
    return np.concatenate(found)[start - first * BLOCK : stop - first * BLOCK]


def write_token_files(
    df: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Write the ids of all texts, `end_id` after each, in ascending id order.

    Spark's writer puts one file a range of ids under `path`, committed as a
    whole, so a lost task leaves nothing behind. A row of a file is a segment of
    whole documents: file, segment, start (ids of the file before it), n_ids, the
    ids and lengths of its documents, and the packed blocks. Null texts are
    empty, documents of the end id alone. Null ids come first; rows of one id are
    in the order of a hash of their text. An empty table gives no segments; other
    columns are not read.
    """
    small_batches(df.sparkSession)
    with open(tokenizer_path, "rb") as file:
        held = df.sparkSession.sparkContext.broadcast(file.read())  # one vocabulary file
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    # The place of a row makes equal rows different, so that no range is too large.
    order = ["doc_id", "tie", "place"]
    source = (
        df.select(F.col(quoted(id_col)).alias("doc_id"), text.alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .withColumn("place", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )
    kind = source.schema["doc_id"].dataType.simpleString()
    end = pack("<I", end_id)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = library_encoder(held.value)
        file = TaskContext.get().partitionId()
        number = before = held_bytes = 0
        names: list[pa.Array] = []
        packed: list[bytes] = []

        def segment() -> pa.RecordBatch:
            nonlocal number, before, held_bytes, names, packed
            ids = np.frombuffer(b"".join(packed), "<u4")
            row = {
                "file": pa.array([file], pa.int32()),
                "segment": pa.array([number], pa.int32()),
                "start": pa.array([before], pa.int64()),
                "n_ids": pa.array([len(ids)], pa.int64()),
                "doc_ids": pa.ListArray.from_arrays([0, len(packed)], pa.concat_arrays(names)),
                "lengths": pa.array([[len(p) // 4 for p in packed]], pa.list_(pa.int64())),
                "data": pa.array([pack_ids(ids)], pa.binary()),
            }
            number, before, held_bytes, names, packed = number + 1, before + len(ids), 0, [], []
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, stop in by_bytes(texts, 2 * BATCH_BYTES):
                taken = start
                for i, ids in enumerate(encode(texts[start:stop]), start):
                    packed.append(ids + end)
                    held_bytes += len(packed[-1])
                    if held_bytes >= 4 * SEGMENT_IDS:
                        names.append(batch.column(0).slice(taken, i + 1 - taken))
                        taken = i + 1
                        yield segment()
                if taken < stop:
                    names.append(batch.column(0).slice(taken, stop - taken))
        if packed:
            yield segment()

    schema = (
        f"file int, segment int, start long, n_ids long, doc_ids array<{kind}>, lengths array<long>, data binary"
    )
    source.mapInArrow(segments, schema).write.mode("errorifexists").parquet(path)


def read_token_files(spark: SparkSession, path: str, tokens: bool = False) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32 and, on request, the ids.

    start counts the ids of all documents before it, ids_crc32 is the checksum of
    its ids as little-endian unsigned 32-bit integers.
    """
    segments = spark.read.parquet(path)
    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                lengths = np.array(batch.column("lengths")[i].as_py(), np.int64)
                ids = unpack_ids(batch.column("data")[i].as_py())
                ends = np.cumsum(lengths)
                own = [ids[e - n : e] for e, n in zip(ends, lengths, strict=True)]
                row = {
                    "file": pa.array([batch.column("file")[i].as_py()] * len(own), pa.int32()),
                    "doc_id": batch.column("doc_ids")[i].values,
                    "start": pa.array(batch.column("start")[i].as_py() + ends - lengths, pa.int64()),
                    "n_tokens": pa.array(lengths, pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in own], pa.int64()),
                }
                if tokens:
                    row["ids"] = pa.array([x.astype(np.int64) for x in own], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(row)

    schema = f"file int, doc_id {kind}, start long, n_tokens long, ids_crc32 long" + (
        ", ids array<long>" if tokens else ""
    )
    found = segments.select("file", "start", "doc_ids", "lengths", "data").mapInArrow(documents, schema)
    # One row a file.
    files = segments.groupBy("file").agg(F.sum("n_ids").alias("n"))
    before = files.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("before"))
    return found.join(before, "file").select(
        "doc_id",
        (F.col("before") + F.col("start")).alias("start"),
        "n_tokens",
        "ids_crc32",
        *(["ids"] if tokens else []),
    )

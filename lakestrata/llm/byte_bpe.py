"""Byte-level BPE encoding and decoding by a rank queue with a hierarchical bitmap."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.text import quoted
from lakestrata.llm.common import WordIds, by_bytes

#: Unicode white space as tiktoken's patterns know it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def read_ranks(data: bytes) -> dict[bytes, int]:
    """The ranks of a file with a base64 token and its rank on each line."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


#: Bits of one word of the bitmap; two levels span every rank of a 16-bit vocabulary.
WORD_BITS = 8
LOW = (1 << WORD_BITS) - 1
_BITS = [1 << i for i in range(1 << 12)]


class BytePairs:
    """Encoding of single pre-tokens and decoding of ids for one table of ranks.

    The queue has a bucket of positions for each merge rank (`slots` holds the
    leftmost, `more` a heap of the others) and a bitmap of two levels: a bit of
    `words` says that its rank has positions, a bit of the top that its word is
    not zero. The first set bit of each gives the next rank. An entry whose
    position no longer waits for that rank is stale and skipped. The queue is
    empty again after each pre-token.
    """

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values()) + 1
        self.ranks = ranks
        self.words = [0] * ((size >> WORD_BITS) + 1)
        self.slots = [-1] * size
        self.tokens = [b""] * size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.of_bytes = [ranks.get(bytes(divmod(x, 256)), -1) for x in range(1 << 16)]

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one pre-token: always the pair of lowest rank merges, the leftmost first."""
        get = self.ranks.get
        if (whole := get(piece)) is not None:
            return [whole]
        n, of_bytes = len(piece), self.of_bytes
        words, slots, bits, top = self.words, self.slots, _BITS, 0
        more: dict[int, list[int]] = {}
        end = list(range(1, n + 2))  # where the symbol that starts here ends
        before = list(range(-1, n))  # start of the symbol before it
        waits = [of_bytes[a << 8 | b] for a, b in zip(piece, piece[1:], strict=False)]  # rank of the pair that starts here
        for i, rank in enumerate(waits):
            if rank >= 0:
                if slots[rank] < 0:
                    slots[rank] = i
                    at = rank >> WORD_BITS
                    words[at] |= bits[rank & LOW]
                    top |= bits[at]
                else:
                    more.setdefault(rank, []).append(i)
        waits.append(-1)
        while top:
            at = (top & -top).bit_length() - 1
            word = words[at]
            rank = (at << WORD_BITS) + (word & -word).bit_length() - 1
            i = slots[rank]
            if rank in more:
                slots[rank] = heappop(more[rank])
                if not more[rank]:
                    del more[rank]
            else:
                slots[rank] = -1
                words[at] = word = word & (word - 1)
                if not word:
                    top &= top - 1
            if waits[i] != rank:
                continue
            j = end[i]
            waits[j] = -1
            end[i] = k = end[j]
            before[k] = i
            for start, stop in ((i, end[k]), (before[i], k)):
                if start < 0 or stop > n:
                    if start >= 0:
                        waits[start] = -1
                    continue
                rank = get(piece[start:stop], -1)
                if rank >= 0 and waits[start] != rank:
                    held = slots[rank]
                    if held < 0:
                        slots[rank] = start
                        at = rank >> WORD_BITS
                        words[at] |= bits[rank & LOW]
                        top |= bits[at]
                    else:
                        slots[rank] = min(held, start)
                        heappush(more.setdefault(rank, []), max(held, start))
                waits[start] = rank
        out, i = [], 0
        while i < n:
            j = end[i]
            out.append(get(piece[i:j]))
            i = j
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def text_encoder(ranks: dict[bytes, int], pattern: str) -> tuple[WordIds, BytePairs]:
    """An encoder of whole texts to packed ids, each match of `pattern` on its own."""
    import regex

    pairs = BytePairs(ranks)
    found = regex.compile(pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]"))

    def encode(strings: list[str]) -> list[bytes]:
        out = []
        for string in strings:
            ids: list[int] = []
            for piece in found.findall(string):
                ids += pairs.encode(piece.encode())
            out.append(pack(f"<{len(ids)}I", *ids))
        return out

    return WordIds(encode, drops_space=False), pairs


_encoders: dict[tuple, tuple[WordIds, BytePairs]] = {}


def bpe_round_trip(
    df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = False
) -> DataFrame:
    """One row per row of `df`: doc_id, n_tokens, ids_sha256, decoded_sha256 and, on request, the ids.

    ids_sha256 is taken over the ids as little-endian unsigned 32-bit integers,
    decoded_sha256 over the bytes they decode to. Null texts are empty and have
    no ids; ids of rows may be null or repeat. A worker keeps the ids of a
    bounded number of words, so each is merged once; pre-tokens of any length
    take time in proportion to their length. Rows are independent: no shuffle.
    An empty table gives no rows; other columns are not read.
    """
    with open(ranks_path, "rb") as file:
        held = df.sparkSession.sparkContext.broadcast(file.read())  # one vocabulary file
    source = df.select(
        F.col(quoted(id_col)).alias("doc_id"), F.coalesce(F.col(quoted(text_col)), F.lit("")).alias("text")
    )
    id_type = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = held.value
        key = (hashlib.sha256(data).digest(), pattern)
        if key not in _encoders:
            _encoders.clear()
            _encoders[key] = text_encoder(read_ranks(data), pattern)
        encode, pairs = _encoders[key]
        for batch in batches:
            texts = batch.column(1).to_pylist()
            counts, of_ids, of_bytes, all_ids = [], [], [], []
            for start, end in by_bytes(texts):
                for packed in encode(texts[start:end]):
                    counts.append(len(packed) // 4)
                    of_ids.append(hashlib.sha256(packed).hexdigest())
                    decoded = pairs.decode(np.frombuffer(packed, "<u4").tolist())
                    of_bytes.append(hashlib.sha256(decoded).hexdigest())
                    if ids:
                        all_ids.append(np.frombuffer(packed, "<u4").astype(np.int32))
            arrays = [
                batch.column(0),
                pa.array(counts, pa.int64()),
                pa.array(of_ids, pa.string()),
                pa.array(of_bytes, pa.string()),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                arrays.append(pa.array(all_ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return source.mapInArrow(run, schema + (", ids array<int>" if ids else ""))

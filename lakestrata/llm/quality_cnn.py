"""Quality by a byte-level convolutional network in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.text import quoted
from lakestrata.llm.common import by_bytes, learning_labels, remainder, texts_of

#: The network is fitted to about so many labelled rows, of texts up to so many bytes.
FIT_ROWS, FIT_BYTES = 3000, 1 << 14
#: Bytes of a chunk, bytes from one chunk to the next, numbers of a byte, filters.
WIDTH, STRIDE, NUMBERS, FILTERS = 12, 6, 6, 24
#: Bytes between texts that lie in one buffer; also the farthest repetition that is marked.
GAP = 32
EPOCHS, BATCH = 12, 16


def repeated(data: np.ndarray) -> np.ndarray:
    """1 where the 4 bytes from here are those of 2 to 31 bytes before, else 0."""
    out = np.zeros(len(data), np.float32)
    if len(data) < 8:
        return out
    code = np.zeros(len(data), np.uint32)
    for i in range(4):
        code[:-3] |= data[i : len(data) - 3 + i].astype(np.uint32) << np.uint32(8 * i)
    same = np.zeros(len(data), bool)
    for back in range(2, GAP):
        same[back:] |= code[back:] == code[:-back]
    out[same & (data > 0) & (code > 0)] = 1
    return out


def _buffer(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts in one buffer with gaps; the byte where each chunk starts; each text's first chunk."""
    sizes = np.array([len(t) for t in texts])
    starts = np.concatenate([[0], np.cumsum(sizes + GAP)[:-1]]) + GAP
    data = np.frombuffer(bytes(GAP) + b"".join(t + bytes(GAP) for t in texts), np.uint8)
    chunks = np.maximum(1, -(-sizes // STRIDE))
    first = np.concatenate([[0], np.cumsum(chunks)[:-1]])
    at = np.repeat(starts, chunks) + (np.arange(chunks.sum()) - np.repeat(first, chunks)) * STRIDE
    return data, at, first


@dataclass
class ByteNetwork:
    """Each byte is some learned numbers and a mark of repetition; filters run over overlapping chunks.

    A text's largest and mean answers of each filter, over all of its chunks, are
    combined into one probability.
    """

    bytes_: np.ndarray  # 256 x NUMBERS
    filters: np.ndarray  # WIDTH * (NUMBERS + 1) x FILTERS
    offsets: np.ndarray  # FILTERS
    weights: np.ndarray  # 2 * FILTERS
    constant: np.ndarray  # 1

    @classmethod
    def start(cls, share: float, seed: int = 5) -> ByteNetwork:
        rng = np.random.default_rng(seed)
        size = WIDTH * (NUMBERS + 1)
        return cls(
            rng.normal(0, 0.5, (256, NUMBERS)).astype(np.float32),
            rng.normal(0, 1 / np.sqrt(size), (size, FILTERS)).astype(np.float32),
            np.zeros(FILTERS, np.float32),
            rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
            np.array([np.log(share / (1 - share))], np.float32),
        )

    def _chunks(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        rows = np.empty((len(data), NUMBERS + 1), np.float32)
        rows[:, :NUMBERS] = self.bytes_[data]
        rows[:, NUMBERS] = repeated(data)
        seen = np.lib.stride_tricks.sliding_window_view(rows.ravel(), WIDTH * (NUMBERS + 1))
        return seen[at * (NUMBERS + 1)]

    def _forward(self, texts: list[bytes]):
        data, at, first = _buffer(texts)
        chunks = self._chunks(data, at)
        answers = np.maximum(chunks @ self.filters + self.offsets, 0)
        counts = np.diff(first, append=len(at))
        pooled = np.hstack([np.maximum.reduceat(answers, first), np.add.reduceat(answers, first) / counts[:, None]])
        z = pooled @ self.weights + self.constant[0]
        return data, at, first, counts, chunks, answers, pooled, 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """The probability of each whole text, the texts taken in parts of bounded bytes.

        A text longer than such a part is read in pieces that overlap by a chunk,
        and its pieces' answers are pooled.
        """
        out = np.empty(len(texts))
        most = 1 << 18
        for start, stop in by_bytes(texts, most):
            part = texts[start:stop]
            if stop - start > 1 or len(part[0]) <= 2 * most:
                out[start:stop] = self._forward(part)[-1]
                continue
            step = most // STRIDE * STRIDE
            top, total, n = np.zeros(FILTERS), np.zeros(FILTERS), 0
            for i in range(0, len(part[0]), step):
                # A piece starts as far back as repetitions are looked for and ends a chunk late.
                back = min(i, GAP)
                data = np.frombuffer(part[0][i - back : i + step + WIDTH] + bytes(GAP), np.uint8)
                here = min(step, len(part[0]) - i)
                at = back + np.arange(0, here, STRIDE)
                answers = np.maximum(self._chunks(data, at) @ self.filters + self.offsets, 0)
                top, total, n = np.maximum(top, answers.max(axis=0)), total + answers.sum(axis=0), n + len(at)
            z = np.concatenate([top, total / n]) @ self.weights + self.constant[0]
            out[start] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return out

    def _slopes(self, texts: list[bytes], y: np.ndarray) -> list[np.ndarray]:
        data, at, first, counts, chunks, answers, pooled, p = self._forward(texts)
        error = ((p - y) / len(y)).astype(np.float32)
        back = error[:, None] * self.weights
        slope = np.repeat(back[:, FILTERS:] / counts[:, None], counts, axis=0).astype(np.float32)
        for i, (a, n) in enumerate(zip(first, counts, strict=True)):
            slope[a + answers[a : a + n].argmax(axis=0), np.arange(FILTERS)] += back[i, :FILTERS]
        slope *= answers > 0
        to_bytes = (slope @ self.filters.T).reshape(len(at), WIDTH, NUMBERS + 1)
        of_bytes = np.zeros((256, NUMBERS), np.float32)
        for j in range(WIDTH):
            seen = data[at + j]
            for c in range(NUMBERS):
                of_bytes[:, c] += np.bincount(seen, to_bytes[:, j, c], 256)
        return [of_bytes, chunks.T @ slope, slope.sum(axis=0), pooled.T @ error, error.sum(keepdims=True)]

    def fit(self, texts: list[bytes], y: np.ndarray, epochs: int = EPOCHS, rate: float = 0.01, seed: int = 6) -> None:
        """Adam on small batches in a fixed random order."""
        rng = np.random.default_rng(seed)
        parts = [self.bytes_, self.filters, self.offsets, self.weights, self.constant]
        means, squares, step = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts], 0
        epochs = max(epochs, -(-600 * BATCH // max(1, len(texts))))
        for epoch in range(epochs):
            order = rng.permutation(len(texts))
            speed = rate * (1 - epoch / epochs)
            for i in range(0, len(order), BATCH):
                some = order[i : i + BATCH]
                step += 1
                for p, slope, m, s in zip(
                    parts, self._slopes([texts[j] for j in some], y[some]), means, squares, strict=True
                ):
                    m += 0.1 * (slope - m)
                    s += 0.01 * (slope**2 - s)
                    p -= speed * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)


def learn_quality(learning: DataFrame, labelled: int) -> ByteNetwork | None:
    """A network fitted to a sample of the learning texts; None if they are all of one class.

    The sample is chosen by a hash of the id and bounded in rows and bytes of a text.
    """
    share = min(1.0, 2 * FIT_ROWS / max(1, labelled))
    chosen = (
        learning.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 20)) < int(share * (1 << 20)))
        .where(F.octet_length("text") <= FIT_BYTES)
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(FIT_ROWS)
        .select("text", "label")
        .toArrow()
    )
    y = np.array(chosen.column("label").to_pylist(), np.float32)
    if len(set(y.tolist())) < 2:
        return None
    network = ByteNetwork.start(float(y.mean()))
    network.fit([t.encode() for t in chosen.column("text").to_pylist()], y)
    return network


def score_quality(
    documents: DataFrame,
    labels: DataFrame,
    threshold: float = 0.7,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: bool = False,
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (score >= threshold).

    Learns from the labelled rows whose crc32(id as text) mod 4 is not 2; only
    the bytes of the texts go into a score. The network is fitted on the driver to
    at most 3,000 of those rows and then reads every chunk of every text.

    Null texts are empty, a single chunk of zeros that gets a score as well.
    Documents without an id are held out. If the labels are all of one class,
    that class is every score; without labels it is 1, so nothing is rejected.
    Rows are independent, and repeated ones get equal scores, which are rounded to
    six decimals. An empty table gives
    no rows; other columns are read only for `carry`, which adds the source row as
    the struct `row`.
    """
    doc_id = F.col(quoted(id_col))
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    row = F.struct(*(F.col(quoted(c)) for c in documents.columns))
    source = documents.select(
        doc_id.alias("doc_id"),
        F.coalesce(remainder(doc_id, 4) == 2, F.lit(True)).alias("held_out"),
        row.alias("row") if carry else text.alias("text"),
    )
    learning = learning_labels(
        documents.select(doc_id.alias("doc_id"), text.alias("text")), labels, "quality", remainder(F.col("doc_id"), 4) == 2
    )
    network = learn_quality(learning, labels.count())
    only = None
    if network is None:
        found = learning.agg(F.max("label")).first()[0]
        only = 1.0 if found is None else float(found)
    known = documents.sparkSession.sparkContext.broadcast(network)  # some kilobytes
    kind = source.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "held_out", "score", "predicted", *(["row"] if carry else [])]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode() for t in texts_of(batch, text_col)]
            scores = known.value.scores(texts) if only is None else np.full(len(texts), only)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(np.round(scores, 6), pa.float64()),
                    pa.array((np.round(scores, 6) >= threshold).astype(np.int32)),
                    *([batch.column(2)] if carry else []),
                ],
                names,
            )

    schema = f"doc_id {kind}, held_out boolean, score double, predicted int"
    if carry:
        schema += ", row " + source.schema["row"].dataType.simpleString()
    return source.mapInArrow(score, schema)

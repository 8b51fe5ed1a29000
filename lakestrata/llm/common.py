"""What several operators share: reading a table, byte-bounded batches, ids of words kept per worker."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestrata.functions.text import quoted

BATCH_BYTES = 2 << 20
#: Rows of an Arrow batch of whole texts, where the session says nothing else.
BATCH_ROWS = 1000
#: Labels are broadcast up to so many rows (some 30 MB).
BROADCAST_LABELS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Let this session send Python `BATCH_ROWS` rows at a time, unless it was given a number.

    Spark's 10,000 rows would be tens of megabytes of text, which executor, worker and
    the worker's results each hold more than once.
    """
    number = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(number, None) is None:
        spark.conf.set(number, BATCH_ROWS)


def texts_of(batch: pa.RecordBatch, text_col: str) -> Iterator[str]:
    """The texts of a batch, from its column `text` or from the carried `row`; null texts are empty."""
    carried = batch.column("row").field(text_col) if "row" in batch.schema.names else batch.column("text")
    return (text.as_py() or "" for text in carried)


def by_bytes(texts: list[str], most: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of about `most` characters each; a longer text stands alone."""
    start = held = 0
    for i, text in enumerate(texts):
        if i > start and held + len(text) > most:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


_kept: dict[str, dict] = {}


def kept_by(operator: str) -> dict:
    """What a worker keeps between the tasks of an operator; what it kept for another one is let go.

    Workers are used again by the next step of a pipeline, which needs their memory for itself.
    """
    for other in [name for name in _kept if name != operator]:
        del _kept[other]
    return _kept.setdefault(operator, {})


#: White space other than the two characters that texts are cut at.
_OTHER_SPACE = re.compile(
    "[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
)
_BREAK = re.compile(r"(?<=[^ \n])(?=\n)")
_CHUNK = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_OTHER_ASCII = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f"
_TAIL = ".,!?;:|$%&*#"


class WordIds:
    """Ids of whole texts, put together from the ids of their words.

    A text is cut before a blank or line feed that follows another character,
    where no token of the vocabulary and no match of the splitting pattern goes
    across; a word is cut between a letter and the punctuation it ends in. Ids
    are kept as packed unsigned 32-bit integers: `most` parts, half as many words
    made of them, and what one batch adds.

    `encode` gives the packed ids of many strings. With `drops_space` the
    vocabulary ignores white space; without, a word carries the white space
    before it, and a text that holds any other white space is encoded whole.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], drops_space: bool, most: int = 1_000_000):
        self.encode, self.drops_space, self.most = encode, drops_space, most
        self.bare: dict[str, bytes] = {}  # strings as they are
        self.after: dict[str, bytes] = {}  # words that follow one blank
        self.made_bare: list[str] = []  # those of each that were put together from parts
        self.made_after: list[str] = []

    def _learn(self, kept: dict[str, bytes], lead: str, words: Iterable[str]) -> None:
        """Put the ids of words that `kept` lacks into it."""
        plain, tails, made = set(), set(), []
        for word in words:
            base = word.rstrip(_TAIL)
            if "\n" in word:
                parts = []
                for line in _BREAK.split(word):
                    base = line.rstrip(_TAIL)
                    if len(base) < len(line) and base[-1:].isalpha():
                        parts += (base, line[len(base) :])
                    else:
                        parts.append(line)
                if len(parts) > 1:
                    made.append((word, parts[0], parts[1:]))
                plain.add(parts[0])
                tails.update(parts[1:])
            elif len(base) < len(word) and base[-1:].isalpha():
                made.append((word, base, (word[len(base) :],)))
            else:
                plain.add(word)
        plain.update([base for _, base, _ in made])
        tails.update([others[0] for _, _, others in made])
        for known, before, wanted in ((kept, lead, plain), (self.bare, "", tails)):
            missing = list(wanted.difference(known))
            for start, end in by_bytes(missing, BATCH_BYTES // 8):
                part = missing[start:end]
                known.update(zip(part, self.encode([before + w for w in part] if before else part), strict=True))
        bare = self.bare.__getitem__
        for word, base, others in made:
            kept[word] = kept[base] + (bare(others[0]) if len(others) == 1 else b"".join(map(bare, others)))
        (self.made_after if kept is self.after else self.made_bare).extend([word for word, _, _ in made])

    def _find(self, kept: dict[str, bytes], lead: str, words: list[str]) -> list[bytes]:
        """The ids of each word; most words were met before, so one look at each suffices."""
        found = list(map(kept.get, words))
        if None in found:
            missing = [i for i, ids in enumerate(found) if ids is None]
            self._learn(kept, lead, {words[i] for i in missing})
            for i in missing:
                found[i] = kept[words[i]]
        return found

    def _forget(self) -> None:
        """Stay within the bounds: words made of others go first."""
        made = ((self.bare, self.made_bare), (self.after, self.made_after))
        composed = len(self.made_bare) + len(self.made_after)
        if len(self.bare) + len(self.after) - composed > self.most:
            for kept, words in made:
                kept.clear()
                words.clear()
        elif composed > self.most // 2:
            for kept, words in made:
                for word in words:
                    kept.pop(word, None)
                words.clear()

    def _split(self, kept: dict[str, bytes], lead: str, texts: pa.Array) -> list[bytes]:
        """The ids of the words between the blanks of each text, none of a null; each different word is looked up once."""
        split = pc.split_pattern(texts, " ")
        coded = split.flatten().dictionary_encode()
        parts = self._find(kept, lead, coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = np.frombuffer(b"".join(parts), "<u4")
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        words = coded.indices.to_numpy()
        own = sizes[words]
        stops = np.append(0, np.cumsum(own))
        shift = (np.cumsum(sizes) - sizes)[words] - stops[:-1]
        out = ids[np.arange(stops[-1]) + np.repeat(shift, own)]
        ends = stops[np.cumsum(pc.fill_null(pc.list_value_length(split), 0).to_numpy())].tolist()
        return [out[a:b].tobytes() for a, b in zip([0, *ends], ends)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The packed ids of each text."""
        self._forget()
        if self.drops_space:
            return self._split(self.bare, "", pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " "))
        out = [b""] * len(texts)
        first, ends, rest, whole = [], [], [], {}
        for i, text in enumerate(texts):
            if any(map(text.__contains__, _OTHER_ASCII)) if text.isascii() else _OTHER_SPACE.search(text):
                whole[i] = text
                continue
            if not text or text[0] == " " or text[-1] == " " or "  " in text:
                first += _CHUNK.findall(text)
                rest.append(None)
            else:
                word, _, others = text.partition(" ")
                first.append(word)
                rest.append(others or None)
            ends.append((i, len(first)))
        first, rest = self._find(self.bare, "", first), self._split(self.after, " ", pa.array(rest, pa.large_string()))
        a = 0
        for (i, b), others in zip(ends, rest, strict=True):
            out[i] = b"".join(first[a:b]) + others
            a = b
        if whole:
            for i, ids in zip(whole, self.encode(list(whole.values())), strict=True):
                out[i] = ids
        return out


def learning_labels(documents: DataFrame, labels: DataFrame, label: str, held_out: Column) -> DataFrame:
    """text, doc_id and label (0 or 1) of the labelled documents that are not held out.

    One label an id: the larger one, if they differ. Labels of up to
    `BROADCAST_LABELS` rows, counted first, are sent to the documents; beyond
    that both sides are shuffled.
    """
    known = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    if labels.count() <= BROADCAST_LABELS:
        known = F.broadcast(known)
    return documents.where(~F.coalesce(held_out, F.lit(True))).join(known, "doc_id").select("doc_id", "text", "label")


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; null ids have none."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


_POSITION_BITS = 33  # of monotonically_increasing_id; above them is the partition


def ranked(rows: DataFrame, group: str, order: list[str], folder: str) -> DataFrame:
    """`rows` with the `rank` (from 0) of each in its group by `order`, and the number of rows in the group as `of`.

    Rows are dealt to range partitions by group, order and the place they were read
    at, so that neither a large group nor equal rows meet in one task, written below
    `folder` with their new place, and counted by partition and group. Nulls come
    first; equal rows take neighbouring ranks in any order. `group` holds no nulls.
    """
    keys = [group, *order, "__place"]
    (
        rows.withColumn("__place", F.monotonically_increasing_id())
        .repartitionByRange(*(quoted(k) for k in keys))
        .sortWithinPartitions(*(quoted(k) for k in keys))
        .withColumn("__place", F.monotonically_increasing_id())
        .write.parquet(folder)
    )
    placed = rows.sparkSession.read.parquet(folder).withColumn("__part", F.shiftright("__place", _POSITION_BITS))
    # A row for each pair of a partition and a group in it: at most partitions + groups.
    counts = placed.groupBy(quoted(group), "__part").agg(
        F.min("__place").alias("__first"), F.count(F.lit(1)).alias("__n")
    )
    whole = Window.partitionBy(quoted(group))
    earlier = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        F.col(quoted(group)).alias("__group"),
        F.col("__part").alias("__own"),
        (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first")).alias("__shift"),
        F.sum("__n").over(whole).alias("of"),
    )
    joined = placed.join(before, (F.col(quoted(group)) == F.col("__group")) & (F.col("__part") == F.col("__own")))
    return joined.select(
        *[placed[quoted(c)] for c in rows.columns], (F.col("__place") + F.col("__shift")).alias("rank"), "of"
    )

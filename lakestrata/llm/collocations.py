"""Phrases whose words occur together: Misra-Gries summaries find what may be frequent, a second pass counts it."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.functions.text import quoted
from lakestrata.llm.common import small_batches
from lakestrata.llm.shingles import mix
from lakestrata.operators import join_entities
from lakestrata.session import work_folder

LONGEST = 4
#: Bytes of text that are split into words at once.
SLICE = 1 << 19
#: Phrases, repeated ones too, that a task holds before it writes a summary or counts.
FLUSH = 1 << 20
#: A hash partition of the phrases is to hold about the phrases of so much text.
PART_BYTES = 12 << 20
#: How far a summary's capacity exceeds mass / threshold: its error is below threshold / SLACK.
SLACK = 2
#: Bits of the filter for a phrase that survives, and for all of them together (64 MB).
BITS_EACH, BITS_ALL = 16, 1 << 29
_PROBES = 3
_PROBE_STEPS = np.array([0x8CB92BA72F3D8DD7, 0x589965CC75374CC3, 0x1D8E4E27C47D124F], np.uint64)
#: Tasks that rank a language's phrases before its best ones meet.
RANKERS = 256

_BREAK = re.compile(rb"[.,;:!?\n-\r \t]")
_KINDS = np.zeros(256, np.uint8)  # 1 blank, 2 end of a piece
_KINDS[[0x09, 0x20]] = 1
_KINDS[list(b".,;:!?\n\x0b\x0c\r")] = 2
_LONG = 64  # bytes; longer words are hashed one at a time
_POWERS = np.array(
    [[pow(base, i + 1, 1 << 64) for i in range(_LONG)] for base in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)], np.uint64
)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_HALF = np.uint64(32)
_LOW = np.uint64(0xFFFFFFFF)


def _long_hashes(word: bytes) -> tuple[int, int]:
    made = blake2b(word, digest_size=16).digest()
    return int.from_bytes(made[:8], "little"), int.from_bytes(made[8:], "little")


class Words:
    """The words of some texts: two hashes of each, where it stands, its piece and its text.

    `data` is in lower case; `ends` are the places of the texts' last bytes plus one.
    """

    def __init__(self, data: bytes, ends: list[int]):
        chars = np.frombuffer(data, np.uint8)
        kinds = _KINDS[chars]
        edges = np.flatnonzero(np.diff((kinds == 0).view(np.int8), prepend=0, append=0))
        self.data, self.starts, self.stops = data, edges[::2], edges[1::2]
        self.pieces = np.searchsorted(np.flatnonzero(kinds == 2), self.starts)
        self.texts = np.searchsorted(ends, self.starts, side="right")
        lengths = self.stops - self.starts
        long = np.flatnonzero(lengths > _LONG)
        short = np.minimum(lengths, _LONG)
        first = np.cumsum(short) - short
        place = np.arange(int(short.sum())) - np.repeat(first, short)
        held = chars[np.repeat(self.starts, short) + place].astype(np.uint64) + np.uint64(1)
        self.hashes = []
        for powers in _POWERS:
            summed = np.add.reduceat(held * powers[place], first) if len(first) else np.empty(0, np.uint64)
            self.hashes.append(mix(summed + lengths.astype(np.uint64) * _STEP))
        for i in long:
            for kept, value in zip(self.hashes, _long_hashes(data[self.starts[i] : self.stops[i]]), strict=True):
                kept[i] = value

    def runs(self, langs: np.ndarray, which: int, skip: int = 0) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For 1 to `LONGEST` words: number of words, index of the first word and hash of each run in one piece.

        `langs`: a hash for each text, which enters its runs'. Runs that end before
        word `skip` are left out.
        """
        words = self.hashes[which]
        made = mix(words + langs[self.texts])
        for n in range(1, LONGEST + 1):
            if n > 1:
                made = mix(made[: len(words) - n + 1] * _STEP + words[n - 1 :])
            inside = self.pieces[: len(made)] == self.pieces[n - 1 :]
            inside[: max(0, skip - n + 1)] = False
            at = np.flatnonzero(inside)
            yield n, at, made[at]


def slices(rows: Iterable[tuple[bytes, str]], size: int = SLICE) -> Iterator[tuple[bytes, list[int], list[str], int]]:
    """Texts and their languages put together to some `size` bytes: data, ends of the texts, languages, words to skip.

    A longer text is cut before a blank or mark; the next slice begins with the
    last words of the one before, as many as a run can reach back, and skips them.
    """
    held, ends, langs, total = [], [], [], 0
    for text, lang in rows:
        text = text.lower()  # of bytes: A-Z only
        if len(text) > size:
            at = stop = skip = 0
            while stop < len(text):
                cut = _BREAK.search(text, min(len(text), max(at + size, stop + 1)))
                stop = cut.start() if cut else len(text)
                yield text[at:stop], [stop - at], [lang], skip
                at, skip = _back(text, at, stop)
            continue
        held.append(text)
        total += len(text) + 1
        ends.append(total)
        langs.append(lang)
        if total >= size:
            yield b"\n".join(held) + b"\n", ends, langs, 0
            held, ends, langs, total = [], [], [], 0
    if held:
        yield b"\n".join(held) + b"\n", ends, langs, 0


def _back(text: bytes, least: int, stop: int) -> tuple[int, int]:
    """Where the last words before `stop`, one less than a run may have, begin, and how many they are."""
    window = 1 << 10
    while True:
        start = max(least, stop - window)
        found = [m.span() for m in re.finditer(rb"[^.,;:!?\n-\r \t]+", text[start:stop])]
        if start == least or len(found) >= LONGEST:
            kept = found[-(LONGEST - 1) :]
            return (start + kept[0][0], len(kept)) if kept else (stop, 0)
        window *= 8


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[bytes, str]]:
    for batch in batches:
        texts, langs = batch.column(0).cast(pa.binary()), batch.column(1)
        for text, lang in zip(texts, langs, strict=True):
            yield text.as_py(), lang.as_py()


def _lang_hashes(langs: list[str], which: int) -> np.ndarray:
    known = {lang: _long_hashes(lang.encode("utf-8", "surrogatepass"))[which] for lang in set(langs)}
    return np.array([known[lang] for lang in langs], np.uint64)


def cells(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Each hash as its partition, 0 to parts - 1, above a key of 32 bits."""
    return ((hashes >> _HALF) * np.uint64(parts) & ~_LOW) | (hashes & _LOW)


def planes(values: np.ndarray) -> bytes:
    """32-bit values byte by byte, all highest ones together, so that Spark's compression finds the zeros."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unplanes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


SUMMARY = "part int, kind int, mass long, keys binary, counts binary"


def summaries(found: list[np.ndarray], parts: int) -> Iterator[pa.RecordBatch]:
    """Phrases of a task (cells) as a summary for each partition: its mass, and keys with their counts.

    `found` is emptied. These summaries are exact: a task holds fewer phrases than a summary of the
    whole partition may have counters.
    """
    kinds = np.concatenate(found)
    found.clear()
    kinds.sort()
    heads = np.flatnonzero(np.append(True, kinds[1:] != kinds[:-1]))
    counts = np.diff(heads, append=len(kinds))
    kinds = kinds[heads]
    own = (kinds >> _HALF).astype(np.int64)
    present, first = np.unique(own, return_index=True)
    mass = np.add.reduceat(counts, first)
    ends = np.append(first[1:], len(kinds))
    keys = [planes(np.diff((kinds[a:b] & _LOW), prepend=np.uint64(0))) for a, b in zip(first, ends, strict=True)]
    held = [planes(np.minimum(counts[a:b], 0xFFFFFFFF)) for a, b in zip(first, ends, strict=True)]
    n = len(present)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([present, present]), pa.int32()),
            pa.array(np.repeat([0, 1], n), pa.int32()),
            pa.array(np.concatenate([mass, np.zeros(n, np.int64)]), pa.int64()),
            pa.array([None] * n + keys, pa.binary()),
            pa.array([None] * n + held, pa.binary()),
        ],
        ["part", "kind", "mass", "keys", "counts"],
    )


class MisraGries:
    """A mergeable summary of at most `capacity` counters; a count is at most `error` below the truth.

    Beyond the capacity the next largest count is taken off every counter, and
    what falls to zero goes. Each unit taken off takes more than `capacity` from the
    mass, so the error stays below mass / capacity, in whatever order summaries
    are merged.
    """

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.held = [np.empty(0, np.uint64)]  # key above a count of 32 bits
        self.waiting = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.held.append(keys.astype(np.uint64) << _HALF | counts.astype(np.uint64))
        self.waiting += len(keys)
        if self.waiting > max(self.capacity, 1 << 18):
            self.merge()

    def merge(self) -> None:
        packed = np.sort(np.concatenate(self.held))
        keys = packed >> _HALF
        first = np.flatnonzero(np.diff(keys, prepend=~np.uint64(0))) if len(keys) else np.empty(0, np.int64)
        counts = np.add.reduceat(packed & _LOW, first) if len(first) else np.empty(0, np.uint64)
        keys, counts = keys[first], np.minimum(counts, _LOW)
        if len(counts) > self.capacity:
            off = np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1]
            left = counts > off
            keys, counts = keys[left], counts[left] - off
            self.error += int(off)
        self.held, self.waiting = [keys << _HALF | counts], 0

    def at_least(self, threshold: int) -> np.ndarray:
        """Keys that may have occurred `threshold` times; none that has is missing."""
        self.merge()
        packed = self.held[0]
        return (packed >> _HALF)[(packed & _LOW).astype(np.int64) + self.error >= threshold]


def _spots(keys: np.ndarray, sizes: np.ndarray | int, probe: int) -> np.ndarray:
    """A place in 0 .. sizes - 1 for each key."""
    high = mix(keys.astype(np.uint64) + _PROBE_STEPS[probe]) >> _HALF
    return high * np.asarray(sizes, np.uint64) >> _HALF


def bloom(keys: np.ndarray, most_bits: int) -> np.ndarray:
    """A Bloom filter of the keys, in bytes."""
    size = max(8, min(BITS_EACH * len(keys), most_bits) // 8 * 8)
    bits = np.zeros(size, bool)
    for probe in range(_PROBES):
        bits[_spots(keys, size, probe)] = True
    return np.packbits(bits, bitorder="little")


class Filter:
    """The Bloom filters of all partitions, one behind the other."""

    def __init__(self, blooms: dict[int, bytes], parts: int):
        self.parts = parts
        sizes = np.array([len(blooms.get(p, b"")) for p in range(parts)], np.uint64)
        self.sizes, self.offsets = sizes * np.uint64(8), (np.cumsum(sizes) - sizes) * np.uint64(8)
        self.bytes = np.frombuffer(b"".join(blooms.get(p, b"") for p in range(parts)) + b"\0", np.uint8)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """Indices of the hashes that pass."""
        spread = cells(hashes, self.parts)
        part, keys = (spread >> _HALF).astype(np.int64), spread & _LOW
        left = np.flatnonzero(self.sizes[part] > 0)
        for probe in range(_PROBES):
            own = part[left]
            spot = self.offsets[own] + _spots(keys[left], self.sizes[own], probe)
            left = left[(self.bytes[spot >> np.uint64(3)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 > 0]
        return left


def _summarise(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for data, ends, langs, skip in slices(_rows(batches)):
            for _, _, hashes in Words(data, ends).runs(_lang_hashes(langs, 0), 0, skip):
                if len(hashes):
                    found.append(cells(hashes, parts))
                    held += len(hashes)
            if held > FLUSH:
                yield from summaries(found, parts)
                held = 0
        if found:
            yield from summaries(found, parts)

    return run


def _survivors(parts: int, threshold: int):
    """Merge the summaries of each partition, whose masses come first, and filter what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(part: int, summary: MisraGries) -> pa.RecordBatch:
            keys = summary.at_least(threshold)
            filled = bloom(keys, BITS_ALL // parts).tobytes() if len(keys) else b""
            arrays = [pa.array([part], pa.int32()), pa.array([len(keys)], pa.int64()), pa.array([filled], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, ["part", "survivors", "bloom"])

        at, mass, summary = None, 0, None
        for batch in batches:
            for part, kind, own, keys, counts in zip(*(batch.column(i) for i in range(5)), strict=True):
                if part.as_py() != at:
                    if summary is not None:
                        yield row(at, summary)
                    at, mass, summary = part.as_py(), 0, None
                if kind.as_py() == 0:
                    mass += own.as_py()
                    continue
                if summary is None:
                    summary = MisraGries(SLACK * mass // threshold + 1)
                summary.add(np.cumsum(unplanes(keys.as_py()), dtype=np.uint64), unplanes(counts.as_py()))
        if summary is not None:
            yield row(at, summary)

    return run


def _count(known):
    """Occurrences of the phrases that pass the filter, by their words; and all words of a language, as no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes, totals = known.value, Counter()
        held, size, base = [], 0, 0

        def counted() -> pa.RecordBatch:
            first, second, words, starts, stops, owners = (np.concatenate(c) for c in list(zip(*held, strict=True))[:6])
            data, langs = b"".join(h[6] for h in held if h[6]), [lang for h in held for lang in h[7]]
            order = np.argsort(first)
            if not len(order):
                return batch_of([], [], [], [])
            same = (np.diff(first[order]) == 0) & (np.diff(second[order]) == 0)
            heads = np.flatnonzero(np.append(True, ~same))
            counts = np.diff(heads, append=len(order))
            chosen = order[heads]
            phrases = [
                b" ".join(data[a:b].split()) for a, b in zip(starts[chosen].tolist(), stops[chosen].tolist(), strict=True)
            ]
            return batch_of([langs[i] for i in owners[chosen]], phrases, words[chosen], counts)

        def batch_of(langs, phrases, words, counts) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(langs, pa.string()),
                    pa.array(phrases, pa.binary()).cast(pa.string()),
                    pa.array(words, pa.int32()),
                    pa.array(counts, pa.int64()),
                ],
                ["lang", "phrase", "words", "f"],
            )

        texts = 0
        for data, ends, langs, skip in slices(_rows(batches)):
            words = Words(data, ends)
            for i, n in zip(*np.unique(words.texts[skip:], return_counts=True), strict=True):
                totals[langs[i]] += int(n)
            seconds = words.runs(_lang_hashes(langs, 1), 1, skip)
            kept = data, langs  # once for all numbers of words
            for (n, at, first), (_, _, second) in zip(words.runs(_lang_hashes(langs, 0), 0, skip), seconds, strict=True):
                left = passes(first)
                at = at[left]
                places = (words.starts[at] + base, words.stops[at + n - 1] + base, words.texts[at] + texts)
                columns = first[left], second[left], np.full(len(at), n, np.int8), *(x.astype(np.int32) for x in places)
                held.append((*columns, *kept))
                kept = b"", []
                size += len(at)
            base += len(data)
            texts += len(langs)
            # Slices are small, so places fit 32 bits.
            if size > FLUSH // 2 or base > 32 * SLICE:
                batch = counted()
                held, size, base, texts = [], 0, 0, 0
                yield batch
        if held:
            yield counted()
        if totals:
            yield batch_of(list(totals), [b""] * len(totals), [0] * len(totals), list(totals.values()))

    return run


def phrase_counts(rows: DataFrame, folder: str, threshold: int) -> DataFrame:
    """lang, phrase, words, f: every phrase of 1 to `LONGEST` words with f >= threshold, and all words as phrase ''.

    `rows` has text and lang, neither null.
    """
    spark = rows.sparkSession
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = size // PART_BYTES + 1
    (
        rows.mapInArrow(_summarise(parts), SUMMARY)
        .repartition("part")
        .sortWithinPartitions("part", "kind")
        .mapInArrow(_survivors(parts, threshold), "part int, survivors long, bloom binary")
        .write.parquet(f"{folder}/survivors")
    )
    # At most BITS_ALL bits, whatever the corpus; phrases that pass by chance are counted and found rare.
    blooms = {r.part: bytes(r.bloom) for r in spark.read.parquet(f"{folder}/survivors").toLocalIterator()}
    known = spark.sparkContext.broadcast(Filter(blooms, parts))
    (
        rows.mapInArrow(_count(known), "lang string, phrase string, words int, f long")
        .groupBy("lang", "phrase", "words")
        .agg(F.sum("f").alias("f"))
        .where((F.col("f") >= threshold) | (F.col("words") == 0))
        .write.parquet(f"{folder}/counts")
    )
    return spark.read.parquet(f"{folder}/counts")


def _exact(value: str) -> Column:
    return F.col(value).cast("decimal(20,0)")


def collocations(
    documents: DataFrame,
    text_col: str = "text",
    group_col: str = "lang",
    threshold: int = 30,
    top: int = 2000,
    cover: float = 80,
) -> DataFrame:
    """The phrases of 2 to 4 words that hold together best, for each language: lang, rank, phrase, a, l, r, n, score.

    Texts in lower case (A-Z) are cut into pieces at `.,;:!?` and line ends, pieces
    into words at blanks and tabs. `a` counts a phrase within pieces, `l` and `r`
    the parts of its worst cut, `n` all words of the language; the score is
    floor(2,000,000 a / (l + r)) there, in decimals. Phrases of at least `threshold`
    occurrences count; one that lies in a longer such phrase with `cover` percent of its
    occurrences is left out. The `top` best are returned, ties by a and phrase.

    First each task summarises its phrases by hash partition; the summaries
    are merged in Misra-Gries summaries whose capacity exceeds mass / threshold, so
    every phrase that is frequent enough survives. Then only phrases that pass a
    filter of the survivors (64 MB at most) are counted, exactly and by their
    words. A phrase's rows are counted before the shuffle; parts that many phrases
    share are spread over tasks for the joins.

    A null text is empty, a null language is `und`. Long texts are read in slices
    that overlap by three words; a text, word or language may be of any length. Repeated
    rows count each. Without frequent phrases (an empty table, too) there are no
    rows. Other columns are not read.
    """
    small_batches(documents.sparkSession)
    folder = work_folder(documents.sparkSession, "collocations")
    rows = documents.select(
        F.coalesce(F.col(quoted(text_col)), F.lit("")).alias("text"),
        F.coalesce(F.col(quoted(group_col)).cast("string"), F.lit("und")).alias("lang"),
    )
    counts = phrase_counts(rows, folder, threshold)
    key = F.concat_ws("\n", "lang", "phrase")
    candidates = counts.where("words > 1").withColumnRenamed("f", "a")

    # A phrase has one row for each of its cuts until the worst is chosen.
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang",
        "phrase",
        "words",
        "a",
        "k",
        F.concat_ws("\n", "lang", F.expr("substring_index(phrase, ' ', k)")).alias("first"),
        F.concat_ws("\n", "lang", F.expr("substring_index(phrase, ' ', k - words)")).alias("rest"),
    )
    parts = counts.where(f"words between 1 and {LONGEST - 1}").select(key.alias("part"), "f")
    found = join_entities(parts, cuts, "part", "first", spread_hot_keys=True).withColumnRenamed("f", "l").drop("part")
    found = join_entities(parts, found, "part", "rest", spread_hot_keys=True).withColumnRenamed("f", "r")
    score = F.call_function("div", F.lit(2_000_000).cast("decimal(7,0)") * _exact("a"), _exact("l") + _exact("r"))
    worst = (
        found.select("lang", "phrase", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
        .groupBy("lang", "phrase", "a")
        .agg(F.min("cut").alias("cut"))
    )

    words, size = F.split("phrase", " "), F.col("words")
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda n: F.transform(
                F.sequence(F.lit(1), size - n + 1), lambda i: F.array_join(F.slice(words, i, n), " ")
            ),
        )
    )
    covers = (
        candidates.where("words > 2")
        .select("lang", F.explode(inner).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    covered = F.lit(100).cast("decimal(3,0)") * _exact("longer") >= F.lit(cover).cast("decimal(6,3)") * _exact("a")
    kept = worst.join(covers, ["lang", "phrase"], "left").where(F.col("longer").isNull() | ~covered)

    order = [F.desc("cut.score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANKERS))
    best = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order)))
    best = best.where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    totals = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    return (
        best.where(F.col("rank") <= top)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    )

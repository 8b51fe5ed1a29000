"""Toxicity by class-conditional Kneser-Ney models with a shared backoff."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.text import quoted
from lakestrata.llm.common import kept_by, learning_labels, remainder, small_batches, texts_of
from lakestrata.llm.shingles import mix, word_hashes

#: Words are hashed to so many cells, which bounds the size of the model (three counts a cell).
CELL_BITS = 22
#: Words of one passage: an expression and what stands beside it.
PASSAGE = 3
#: Words that are rated as one, so that a long text is as good a hiding place as a short one.
BLOCK = 64
#: What chooses the block of a learning text that the last step is fitted to: its two passages.
EVIDENCE = np.array([1.0, 1.0, 0.0, 0.0])
#: What each class's counts lose to the shared backoff where nothing else is said, and what the learning texts choose from.
DISCOUNT = 3.0
DISCOUNTS = (1.0, 2.0, 3.0, 4.0, 5.0)
#: The least of these discounts is taken whose loss is at most so much above the best one's.
TOLERANCE = 0.02
#: Labelled rows, about, that the last step is fitted to, unless the caller says otherwise.
FIT_ROWS = 20_000
#: Pairs of words that a task holds before it hands them on.
_HELD_PAIRS = 1 << 18
_CONTEXT_BITS = 40


def _cells(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def word_pairs(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each word of a text, and each pair of a word and the one before it as one integer."""
    words = word_hashes(text)
    cells = _cells(words)
    before = np.zeros_like(words)
    before[1:] = words[:-1]
    context = (mix(before) >> np.uint64(64 - _CONTEXT_BITS)).astype(np.int64)
    return cells, cells << _CONTEXT_BITS | context


@dataclass
class KneserNey:
    """Continuation counts by cell: different words before it in toxic, ordinary and all learning texts.

    The probability of a word in a class is its discounted share of the class's
    counts plus the mass set free times its probability in all texts, which is
    discounted in the same way against a uniform one. The discount of a class is
    large enough that a word which it has seen a few times only by chance is left
    to the counts that the classes share: both then differ by a constant, the
    ratio of the masses, and more only where a class has real evidence. How large
    that is depends on the number of texts, so it is chosen by leaving each
    learning text out in turn.
    """

    toxic: np.ndarray
    ordinary: np.ndarray
    shared: np.ndarray
    discount: float = DISCOUNT

    def __post_init__(self) -> None:
        found = [int((self.shared == i).sum()) for i in (1, 2)]
        one = found[0] / max(1, found[0] + 2 * found[1])  # the Kneser-Ney estimate
        self.laws = [
            self._law(self.toxic, self.discount),
            self._law(self.ordinary, self.discount),
            self._law(self.shared, one),
        ]

    def with_discount(self, discount: float) -> KneserNey:
        return replace(self, discount=discount)

    @staticmethod
    def _law(counts: np.ndarray, discount: float) -> tuple[float, float, float]:
        """Sum of the counts, discount, share of the mass set free."""
        total = float(counts.sum())
        return total, discount, float(np.minimum(counts, discount).sum()) / total if total else 1.0

    @staticmethod
    def _share(counts: np.ndarray, law: tuple[float, float, float], lower: np.ndarray | float) -> np.ndarray:
        total, discount, free = law
        return np.maximum(counts - discount, 0) / max(total, 1.0) + max(free, 1e-6) * lower

    def log_shares(self, toxic: np.ndarray, ordinary: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-probabilities of words with these counts in a toxic and in an ordinary text."""
        base = self._share(shared, self.laws[2], 1.0 / (1 << CELL_BITS))
        return tuple(
            np.log(self._share(c, law, base)) for c, law in zip((toxic, ordinary), self.laws[:2], strict=True)
        )

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Both log-probabilities of every cell, made a part at a time."""
        made = np.empty(len(self.shared), np.float32), np.empty(len(self.shared), np.float32)
        for i in range(0, len(self.shared), 1 << 18):
            part = slice(i, i + (1 << 18))
            for table, found in zip(made, self.log_shares(self.toxic[part], self.ordinary[part], self.shared[part]), strict=True):
                table[part] = found
        return made

    def without(self, cells: np.ndarray, pairs: np.ndarray, toxic: bool) -> tuple[np.ndarray, np.ndarray]:
        """Log-probabilities of a learning text's words as if the model had not seen that text."""
        own = np.zeros(len(cells), np.int64)
        kinds, where = np.unique(cells, return_inverse=True)
        own = np.bincount(np.searchsorted(kinds, np.unique(pairs) >> _CONTEXT_BITS), minlength=len(kinds))[where]
        counts = [self.toxic[cells], self.ordinary[cells], self.shared[cells]]
        counts[0 if toxic else 1] = np.maximum(counts[0 if toxic else 1] - own, 0)
        counts[2] = np.maximum(counts[2] - own, 0)
        return self.log_shares(*counts)


def worst_block(toxic: np.ndarray, ordinary: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Features of the block of a text that `weights` (without a constant) rate highest.

    Blocks are of `BLOCK` words and overlap by half, so that what stands around a
    passage does not weigh it down, however long the text is; a shorter text is one
    block. Of a block: the two highest passages' differences that do not overlap,
    the whole block's, and its number of words (log). A difference is that of the
    log-likelihoods over the number of words.
    """
    if not len(toxic):
        return np.zeros(4)
    apart = (toxic - ordinary).astype(float)
    width = min(len(apart), BLOCK)
    held = np.pad(apart, (0, max(0, PASSAGE - width)))
    runs = np.lib.stride_tricks.sliding_window_view(held, PASSAGE).sum(axis=1) / PASSAGE
    size = max(1, width - PASSAGE + 1)
    passages = np.lib.stride_tricks.sliding_window_view(runs, size)
    words = np.lib.stride_tricks.sliding_window_view(apart, width)
    starts = np.append(np.arange(0, len(apart) - width, BLOCK // 2), len(apart) - width)
    found = []
    for i in range(0, len(starts), 1 << 14):
        here = passages[starts[i : i + (1 << 14)]]
        top = here.argmax(axis=1)
        best = here[np.arange(len(here)), top]
        here[np.abs(np.arange(size) - top[:, None]) < PASSAGE] = -np.inf
        second = here.max(axis=1)
        second[np.isneginf(second)] = 0
        mean = words[starts[i : i + (1 << 14)]].mean(axis=1)
        rows = np.column_stack([best, second, mean, np.full(len(here), np.log(width))])
        found.append(rows[(rows @ weights).argmax()])
    return max(found, key=lambda row: row @ weights)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 40) -> np.ndarray:
    """Weights of a logistic regression for the columns as they are; the last is the constant."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale <= 1e-6 * (1 + np.abs(mean))] = np.inf  # a column without differences gets no weight
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    weights = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
        slope = z.T @ (y - p) - ridge * weights
        bend = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(weights))
        step = np.linalg.solve(bend, slope)
        weights += step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
    own = weights[:-1] / scale
    return np.append(own, weights[-1] - own @ mean)


def _types(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each pair of words of the learning texts with the classes it is in (1 toxic, 2 ordinary), once a batch or so."""

    def rows(found: list[np.ndarray], mask: int) -> pa.RecordBatch:
        kinds = np.unique(np.concatenate(found))
        return pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.int64()), pa.array(np.full(len(kinds), mask, np.int32))], ["pair", "mask"]
        )

    kept_by("toxicity")
    held: dict[int, list[np.ndarray]] = {1: [], 2: []}
    sizes = {1: 0, 2: 0}
    for batch in batches:
        for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            mask = 1 if label else 2
            held[mask].append(np.unique(word_pairs(text.as_py())[1]))
            sizes[mask] += len(held[mask][-1])
            if sizes[mask] > _HELD_PAIRS:
                yield rows(held[mask], mask)
                held[mask], sizes[mask] = [], 0
    for mask, found in held.items():
        if found:
            yield rows(found, mask)


def learn_counts(learning: DataFrame) -> KneserNey:
    """The model of all learning texts; one row a cell, of a proven number, reaches the driver."""
    pairs = (
        learning.select("text", "label")
        .mapInArrow(_types, "pair long, mask int")
        .groupBy("pair")
        .agg(F.bit_or("mask").alias("mask"))
    )
    cells = (
        pairs.groupBy(F.shiftright("pair", _CONTEXT_BITS).cast("int").alias("cell"))
        .agg(
            F.sum(F.col("mask").bitwiseAND(1)).cast("int").alias("toxic"),
            F.sum(F.shiftright("mask", 1)).cast("int").alias("ordinary"),
            F.count(F.lit(1)).cast("int").alias("shared"),
        )
        .toArrow()
    )
    at = cells.column("cell").to_numpy()
    counts = {}
    for name in ("toxic", "ordinary", "shared"):
        counts[name] = np.zeros(1 << CELL_BITS, np.int32)
        counts[name][at] = cells.column(name).to_numpy()
    return KneserNey(**counts)


def score_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: bool = False,
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, toxic_ll, ordinary_ll.

    Learns from the labelled rows whose crc32(id as text) mod 5 is not 0; only
    texts go into a score. Words before a word are counted over all learning
    texts as Spark aggregates; the counts land in a fixed number of cells. A text
    is compared by its log-likelihoods in both classes block by block, each as a
    whole and in its most toxic passages; a logistic step, fitted to the worst blocks
    of about `fit_rows` learning texts each scored as if the model had not seen it, rates
    the blocks, and the highest is the text's score, whatever its length. The same
    texts choose the discount of the classes. Counts cover all learning texts; only this
    step is fitted to a sample, of which each class has half as far as it has texts.

    Null texts are empty; a text without words gets the score of no evidence, and
    log-likelihoods of 0. Documents without an id are held out. If the labels
    lack one of the classes every score is 0. Rows are independent, and repeated
    ones get equal scores. An empty table gives no rows; other columns are read
    only for `carry`, which adds the source row as the struct `row`.
    """
    spark = documents.sparkSession
    small_batches(spark)
    doc_id = F.col(quoted(id_col))
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    row = F.struct(*(F.col(quoted(c)) for c in documents.columns))
    source = documents.select(
        doc_id.alias("doc_id"),
        F.coalesce(remainder(doc_id, 5) == 0, F.lit(True)).alias("held_out"),
        row.alias("row") if carry else text.alias("text"),
    )
    learning = learning_labels(
        documents.select(doc_id.alias("doc_id"), text.alias("text")), labels, "toxic", remainder(F.col("doc_id"), 5) == 0
    )
    model = learn_counts(learning)
    weights = None
    if model.toxic.any() and model.ordinary.any():
        model, weights = _fit(learning, model, fit_rows)
        # What scoring reads, 32 MB; the counts stay behind.
        known = spark.sparkContext.broadcast(model.tables())
    del model
    kind = source.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_by("toxicity")
        tables = known.value if weights is not None else None
        for batch in batches:
            rows = []
            for text in texts_of(batch, text_col):
                if tables is None:
                    rows.append((0.0, 0.0, 0.0))
                    continue
                cells = _cells(word_hashes(text))
                a, b = tables[0][cells], tables[1][cells]
                z = weights[:-1] @ worst_block(a, b, weights[:-1]) + weights[-1]
                n = max(1, len(cells))
                rows.append((1 / (1 + np.exp(-np.clip(z, -30, 30))), a.sum(dtype=float) / n, b.sum(dtype=float) / n))
            scores, toxic, ordinary = (np.array(c, float) for c in zip(*rows, strict=True)) if rows else [np.empty(0)] * 3
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(scores),
                    pa.array((scores >= 0.5).astype(np.int32)),
                    pa.array(toxic),
                    pa.array(ordinary),
                    *([batch.column(2)] if carry else []),
                ],
                [*names],
            )

    names = ["doc_id", "held_out", "score", "predicted", "toxic_ll", "ordinary_ll", *(["row"] if carry else [])]
    schema = f"doc_id {kind}, held_out boolean, score double, predicted int, toxic_ll double, ordinary_ll double"
    if carry:
        schema += ", row " + source.schema["row"].dataType.simpleString()
    return source.mapInArrow(score, schema)


def log_loss(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> float:
    z = x @ weights[:-1] + weights[-1]
    return float((np.logaddexp(0, z) - y * z).mean())


def _fit(learning: DataFrame, model: KneserNey, fit_rows: int) -> tuple[KneserNey, np.ndarray]:
    """The discount and the logistic step, from the features of a sample of the learning texts.

    Each class is sampled by its own share, so a rare one is not missed; the driver gets 4
    numbers for each text and discount.
    """
    counts = {r.label: r.n for r in learning.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    least = min(counts.values())
    if least > fit_rows // 2:
        wanted = dict.fromkeys(counts, fit_rows // 2)
    else:
        wanted = {label: n if n == least else fit_rows - least for label, n in counts.items()}
    shares = {label: max(1, int(min(1.0, wanted[label] / n) * (1 << 20))) for label, n in counts.items()}
    known = learning.sparkSession.sparkContext.broadcast([model.with_discount(d) for d in DISCOUNTS])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_by("toxicity")
        models = known.value
        for batch in batches:
            rows = []
            for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                cells, pairs = word_pairs(text.as_py())
                found = [worst_block(*m.without(cells, pairs, bool(label)), EVIDENCE) for m in models]
                rows.append([*np.concatenate(found), float(label)])
            columns = zip(*rows, strict=True) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in columns], names)

    names = [f"x{i}" for i in range(4 * len(DISCOUNTS))] + ["y"]
    share = F.when(F.col("label") == 1, shares.get(1, 0)).otherwise(shares.get(0, 0))
    chosen = learning.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share).select("text", "label")
    table = chosen.mapInArrow(measure, ", ".join(f"{n} double" for n in names)).toArrow()
    data = np.column_stack([c.to_numpy() for c in table.columns])
    known.unpersist()
    y = data[:, -1]
    fitted = [fit_logistic(data[:, 4 * i : 4 * i + 4], y) for i in range(len(DISCOUNTS))]
    losses = [log_loss(data[:, 4 * i : 4 * i + 4], y, w) for i, w in enumerate(fitted)]
    best = next(i for i, loss in enumerate(losses) if loss <= (1 + TOLERANCE) * min(losses))
    # The sample holds the classes in other shares than the texts do; only the constant depends on that.
    fitted[best][-1] -= np.log(shares[1] / shares[0])
    return model.with_discount(DISCOUNTS[best]), fitted[best]

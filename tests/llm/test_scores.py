"""Toxicity and quality on held-out rows, and on texts of every odd kind."""

import os
import subprocess
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lakestrata.llm import quality_cnn, shingles, toxicity
from lakestrata.llm.quality_cnn import ByteNetwork, repeated, score_quality
from lakestrata.llm.shingles import word_hashes
from lakestrata.llm.toxicity import KneserNey, score_toxicity

SF = "/root/testdata/sf0.01"


def held_out(doc_id, modulus, rest):
    return zlib.crc32(str(doc_id).encode()) % modulus == rest


def labels_of(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def rank_quality(scores, labels):
    """The probability that a row of label 1 scores higher than one of label 0."""
    scores, labels = np.array(scores), np.array(labels)
    up, down = scores[labels == 1], scores[labels == 0]
    return ((up[:, None] > down) + 0.5 * (up[:, None] == down)).mean()


def check_scores(rows, n, modulus, rest, threshold):
    assert len(rows) == n
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold)
        assert r.held_out == held_out(r.doc_id, modulus, rest)


def test_toxicity_of_held_out_rows(spark):
    rows = entry.queries()["op3_toxicity"](spark, SF).collect()
    check_scores(rows, 1000, 5, 0, 0.5)
    labels = labels_of(spark)
    own = [(r.score, labels[r.doc_id].toxic) for r in rows if r.held_out and r.doc_id in labels]
    assert rank_quality(*zip(*own)) > 0.85
    assert np.mean([s < 0.5 for s, y in own if y == 0]) > 0.97


def test_quality_of_held_out_rows(spark):
    rows = entry.queries()["op10_quality"](spark, SF).collect()
    check_scores(rows, 1000, 4, 2, 0.7)
    labels = labels_of(spark)
    own = [(r.score, labels[r.doc_id].quality) for r in rows if r.held_out and r.doc_id in labels]
    assert rank_quality(*zip(*own)) > 0.95
    assert np.mean([s >= 0.7 for s, y in own if y == 1]) > 0.97


def learning_documents(spark):
    """Texts with a bad word or with shouting in every third, and labels for all."""
    rng = np.random.default_rng(5)
    words = [f"wo{i}" for i in range(300)]
    rows = []
    for i in range(600):
        own = rng.choice(words, 60).tolist()
        if i % 3 == 0:
            own[7], own[31] = "vile", "vile"
        text = " ".join(own)
        rows.append((i, text.upper().replace(" ", "!! ") if i % 4 == 0 else text))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    labels = documents.select(
        "doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"), (F.col("doc_id") % 4 != 0).cast("int").alias("quality")
    )
    return documents, labels


def test_a_word_of_one_class_is_found(spark):
    documents, labels = learning_documents(spark)
    rows = score_toxicity(documents, labels).collect()
    assert np.mean([r.predicted == int(r.doc_id % 3 == 0) for r in rows if r.held_out]) > 0.97
    toxic = next(r for r in rows if r.doc_id % 3 == 0 and r.held_out)
    clean = next(r for r in rows if r.doc_id % 3 and r.held_out)
    assert toxic.toxic_ll - toxic.ordinary_ll > clean.toxic_ll - clean.ordinary_ll


def test_toxic_words_in_a_long_text_are_found(spark):
    documents, labels = learning_documents(spark)
    rng = np.random.default_rng(7)
    own = [f"wo{i}" for i in rng.integers(0, 300, 100_000)]
    texts = {-1: own, -2: [*own[:60_000], "vile", *own[:20], "vile", *own[60_000:]], -3: own[:12_000]}
    texts[-4] = ["vile", *own[:20], "vile", *own[:12_000]]
    texts[-5] = [*own[:12_000], "vile", *own[:20], "vile"]
    more = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], documents.schema)
    found = {r.doc_id: r.predicted for r in score_toxicity(documents.union(more), labels).collect() if r.doc_id < 0}
    assert found == {-1: 0, -2: 1, -3: 0, -4: 1, -5: 1}


def test_worst_block_by_hand():
    rng = np.random.default_rng(9)
    weights = np.array([1.0, 2.0, 0.5, -1.0])
    for n in (1, 2, 3, 5, 63, 64, 65, 96, 97, 500):
        apart = rng.normal(size=n)
        width = min(n, toxicity.BLOCK)
        found = []
        for start in [*range(0, n - width, toxicity.BLOCK // 2), n - width]:
            block = apart[start : start + width]
            runs = [block[i : i + 3].sum() / 3 for i in range(max(1, width - 2))]
            top = int(np.argmax(runs))
            second = max((r for i, r in enumerate(runs) if abs(i - top) > 2), default=0.0)
            found.append([runs[top], second, block.mean(), np.log(width)])
        best = max(found, key=lambda row: np.dot(row, weights))
        assert toxicity.worst_block(apart, np.zeros(n), weights) == pytest.approx(best)
    assert toxicity.worst_block(np.empty(0), np.empty(0), weights).tolist() == [0, 0, 0, 0]


@pytest.mark.parametrize("score", [score_toxicity, score_quality])
def test_labels_of_held_out_rows_and_other_columns_do_not_count(spark, score, monkeypatch):
    monkeypatch.setattr(quality_cnn, "EPOCHS", 1)
    documents, labels = learning_documents(spark)
    documents = documents.limit(200)
    other = labels.withColumns(
        {
            "toxic": F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")),
            "quality": F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")),
        }
    )
    first = {r.doc_id: r.score for r in score(documents, labels).collect()}
    again = {r.doc_id: r.score for r in score(documents.withColumn("lang", F.lit("xx")), other).collect()}
    assert first == again


@pytest.mark.parametrize("score", [score_toxicity, score_quality])
def test_odd_texts(spark, odd_documents, odd_texts, no_documents, clashing, score, monkeypatch):
    monkeypatch.setattr(quality_cnn, "EPOCHS", 1)
    monkeypatch.setattr(quality_cnn, "FIT_ROWS", 100)
    _, labels = learning_documents(spark)
    labels = labels.union(labels.limit(3)).union(spark.createDataFrame([(None, 1, 1), (3, None, None)], labels.schema))
    rows = score(odd_documents, labels, carry=True).collect()
    assert len(rows) == len(odd_texts) + 2
    assert all(0 <= r.score <= 1 and clashing <= set(r.row.asDict()) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (0, 1, 2)}) == 1
    assert len({r.score for r in rows if r.doc_id in (7, 8, 9)}) == 1
    assert {r.held_out for r in rows if r.doc_id is None} == {True}
    assert score(no_documents, labels).collect() == []
    none = labels.limit(0)
    assert {r.predicted for r in score(odd_documents, none).collect()} == {0 if score is score_toxicity else 1}
    same = labels.withColumns({"toxic": F.lit(0), "quality": F.lit(1)})
    assert {r.predicted for r in score(odd_documents, same).collect()} == {0 if score is score_toxicity else 1}


def test_kneser_ney_by_hand():
    size = 1 << toxicity.CELL_BITS
    counts = [np.zeros(size, np.int32) for _ in range(3)]
    for array, values in zip(counts, ([10, 1, 0, 4], [100, 0, 9, 4], [105, 1, 9, 8])):
        array[:4] = values
    model = KneserNey(*counts)
    toxic, ordinary = (np.exp(t) for t in model.tables())
    assert abs(toxic.sum() - 1) < 1e-3 and abs(ordinary.sum() - 1) < 1e-3
    d = toxicity.DISCOUNT
    free = (d + 1 + 0 + d) / 15
    shared = [c / counts[2].sum() for c in counts[2][:4]]
    assert toxic[0] == pytest.approx((10 - d) / 15 + free * shared[0], rel=0.02)
    # Both classes leave what they have not seen often to the shared counts.
    ratio = toxic / ordinary
    assert ratio[1] == pytest.approx(ratio[9], rel=1e-4) and ratio[1] == pytest.approx(model.laws[0][2] / model.laws[1][2], rel=1e-4)


def test_pairs_without_the_own_text():
    cells, pairs = toxicity.word_pairs("a b a c a b")
    assert len(cells) == len(pairs) == 6 and len(set(pairs.tolist())) == 5
    counts = np.bincount(np.unique(pairs) >> 40, minlength=1 << toxicity.CELL_BITS).astype(np.int32)
    model = KneserNey(counts, np.zeros_like(counts), counts)
    toxic, ordinary = model.without(cells, pairs, True)
    assert toxic == pytest.approx(toxic[0]) and len(word_hashes("a b a c a b")) == 6


def test_repetition_marks():
    def slow(data):
        code = [data[i : i + 4] if i + 4 <= len(data) else b"" for i in range(len(data))]
        return [float(len(c) == 4 and any(code[i - d] == c for d in range(2, min(i, 31) + 1))) for i, c in enumerate(code)]

    for text in (b"so so so so then not", b"abcdefgh" * 5, b"aaaaaaaaaa", b"x", b"", bytes(range(1, 200)) * 2):
        assert repeated(np.frombuffer(text, np.uint8)).tolist() == slow(text) if len(text) >= 8 else True


def test_slopes_by_differences():
    network = ByteNetwork.start(0.6)
    for p in (network.bytes_, network.filters, network.weights):
        p += 0.01
    network = ByteNetwork(*(p.astype(np.float64) for p in vars(network).values()))
    texts, y = [b"one text here", b"ANOTHER!! text!! of bytes!!", b""], np.array([1, 0, 1.0])

    def loss():
        p = network._forward(texts)[-1]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    slopes = network._slopes(texts, y)
    rng = np.random.default_rng(1)
    for part, slope in zip(vars(network).values(), slopes, strict=True):
        for at in rng.integers(0, part.size, 6):
            old = part.flat[at]
            part.flat[at] = old + 1e-3
            up = loss()
            part.flat[at] = old - 1e-3
            down = loss()
            part.flat[at] = old
            assert np.ravel(slope)[at] == pytest.approx((up - down) / 2e-3, abs=2e-3)


def test_a_very_long_text_scores_as_in_one_piece():
    rng = np.random.default_rng(2)
    network = ByteNetwork.start(0.5)
    text = bytes(rng.integers(97, 105, 1_200_001).astype(np.uint8))
    whole = network._forward([text])[-1][0]
    assert network.scores([text, b"", b"short"])[0] == pytest.approx(whole, abs=1e-5)
    assert network.scores([b"short"])[0] == pytest.approx(network.scores([text[:50], b"short"])[1], abs=1e-6)


def test_a_small_sample_holds_both_classes(spark):
    """The last step is fitted to few rows of a rare class, and its constant to the classes' true shares."""
    documents, labels = learning_documents(spark)
    more = documents.select((F.col("doc_id") + 1000).alias("doc_id"), "text").where("doc_id % 3 <> 1")
    clean = more.select("doc_id", F.lit(0).alias("toxic"), F.lit(1).alias("quality"))
    rows = score_toxicity(documents.union(more), labels.union(clean), fit_rows=60).collect()
    own = [r for r in rows if r.held_out and r.doc_id < 1000]
    assert np.mean([r.predicted for r in own if r.doc_id % 3 == 0]) > 0.9
    assert np.mean([r.predicted for r in own if r.doc_id % 3]) < 0.03


def test_the_learning_texts_choose_the_discount():
    assert toxicity.log_loss(np.array([[2.0], [-1.0]]), np.array([1.0, 0.0]), np.array([1.0, 0.5])) == pytest.approx(
        (np.log1p(np.exp(-2.5)) + np.log1p(np.exp(-0.5))) / 2
    )
    counts = [np.array([5, 1, 0, 2]), np.array([1, 9, 4, 2]), np.array([6, 10, 4, 3])]
    model = KneserNey(*counts)
    less = model.with_discount(1.0)
    assert (model.discount, less.discount) == (toxicity.DISCOUNT, 1.0) and less.toxic is model.toxic
    a, b = less.log_shares(*counts)
    tables = less.tables()
    assert np.allclose(tables[0], a) and np.allclose(tables[1], b)


def test_words_do_not_depend_on_slices(monkeypatch):
    texts = ["", " \n ", "!!! ??", "é漢字 ab\ncd", "x" * 500, " . " * 90, " ".join(["the", "Σας", "ÉÀ", "漢字", "a_b", "9", "--"] * 40)]
    whole = [word_hashes(t) for t in texts]
    for size in (3, 17, 100):
        monkeypatch.setattr(shingles, "_SLICE", size)
        for text, found in zip(texts, whole, strict=True):
            assert word_hashes(text).tolist() == found.tolist()


def test_a_text_of_100_mb_under_a_memory_limit():
    """Hashing and rating it takes little more than the text and eight bytes a word."""
    code = """
import resource, numpy as np
from lakestrata.llm import toxicity as X
from lakestrata.llm.shingles import word_hashes
text = " ".join(["anerous", "is", "withintion", "of"] * 4_400_000)
X._cells(word_hashes("warm up"))
used = int(open("/proc/self/statm").read().split()[0]) * 4096
resource.setrlimit(resource.RLIMIT_AS, (used + (1 << 30),) * 2)
cells = X._cells(word_hashes(text))
table = np.zeros(1 << X.CELL_BITS, np.float32)
assert len(text) > 10**8 and X.worst_block(table[cells], table[cells], X.EVIDENCE).shape == (4,)
"""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root, timeout=300)

"""Fingerprints against the exact generalised Jaccard similarity and plain Python."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakestrata.llm.fingerprints import draw, fingerprints, words


def jaccard(one, other):
    total = sum((one | other).values())
    return sum((one & other).values()) / total if total else 1.0


def weights(text):
    found = Counter(re.findall(r"[^\W_]+", text.lower()))
    return Counter({w: n * len(w) for w, n in found.items()})


def plain_edits(rows):
    """rows: (doc_id, text), ids different; doc_id -> (n_chars, edited text, next text)."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    out = {}
    for at, (i, text) in enumerate(rows):
        following = rows[(at + 1) % len(rows)][1]
        take = len(text) // 4
        out[i] = len(text), text[: len(text) - take] + following[:take], following
    return out


def test_samples_agree_as_often_as_the_weights_say(spark):
    """2,000 samples of two bags of words: few terms, many terms, and weights of very different size."""
    rng = random.Random(1)
    bags = [
        ({1: 1, 2: 1, 3: 1}, {1: 1, 2: 1, 4: 1}),
        ({i: rng.randint(1, 9) for i in range(200)}, {i: rng.randint(1, 9) for i in range(60, 260)}),
        ({1: 1000, 2: 3, 3: 40}, {1: 700, 2: 300, 4: 1}),
        ({1: 5}, {1: 5}),
        ({1: 5}, {2: 5}),
    ]
    rows = []
    for n, (one, other) in enumerate(bags):
        rows += [(n, t, float(one[t]) if t in one else None, float(other[t]) if t in other else None) for t in one.keys() | other.keys()]
    df = spark.createDataFrame(rows, "bag int, term long, w0 double, w1 double")
    df = df.withColumns({"term": F.xxhash64("term"), "l0": F.ln("w0"), "l1": F.ln("w1")})
    sampled = df.crossJoin(spark.range(2000).withColumnRenamed("id", "sample"))
    a, b = draw(F.col("sample"), F.col("term"), F.col("l0"), F.col("l1"))
    least = sampled.groupBy("bag", "sample").agg((F.min(a) == F.min(b)).cast("int").alias("same"))
    found = {r.bag: r.same for r in least.groupBy("bag").agg(F.sum("same").alias("same")).collect()}
    for n, (one, other) in enumerate(bags):
        exact = jaccard(Counter(one), Counter(other))
        assert abs(found[n] / 2000 - exact) <= 4 * (exact * (1 - exact) / 2000) ** 0.5 + 1e-9


def test_words(spark):
    texts = ["The the, x's 42 é!", "漢字かな の text", "ไทย", "", "!!! $$", None, "áb c_d"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [[w for w in r[0] if w] if r[0] is not None else None for r in df.select(words(F.col("t"))).collect()]
    assert got[0] == ["the", "the", "x", "s", "42", "é"]
    assert got[1] == ["漢", "字", "か", "な", "の", "text"]
    assert "".join(got[2]) == "ไทย" and len(got[2]) == 3
    assert got[3:] == [[], [], None, ["áb", "c", "d"]]


def prose(rng, n):
    return " ".join(rng.choice(["of", "the", "tha", "ndre"]) + rng.choice(["", "ra", "mo", "tion", "en"]) * rng.randint(0, 2) for _ in range(n))


@pytest.mark.parametrize("samples", [16, 64])
def test_fingerprints(spark, samples):
    rng = random.Random(2)
    rows = [(3 * i, prose(rng, rng.choice([1, 8, 100, 300]))) for i in range(120)]
    rows += [(1, None), (4, ""), (7, rows[0][1]), (1000, rows[-1][1]), (10, "!!! $$$"), (2000, "漢字" * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in fingerprints(df, samples=samples).collect()}
    wanted, texts = plain_edits(rows), {i: t or "" for i, t in rows}
    assert got.keys() == wanted.keys()
    errors = []
    for i, (n, edited, following) in wanted.items():
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert len(r.fingerprint) == len(r.edited_fingerprint) == 8 * samples
        if "漢" not in texts[i] + edited + following and "!" not in texts[i] + edited + following:
            for value, other in ((r.near_edited, edited), (r.near_next, following)):
                exact = jaccard(weights(texts[i]), weights(other))
                assert abs(value - exact) <= 5 * (max(exact * (1 - exact), 0.01) / samples) ** 0.5 + 1e-9
                errors.append(value - exact)
    assert abs(sum(errors) / len(errors)) < 0.02
    by_text = {}
    for i, r in got.items():
        assert by_text.setdefault(texts[i], r.fingerprint) == r.fingerprint
    assert len(set(by_text.values())) == len(by_text)
    assert got[1].near_edited == 1.0 and got[1].n_chars == 0


def test_equal_rows_follow_each_other(spark, with_conf):
    """A third of all rows are one row; ids repeat and are missing."""
    rows = [(5, "same words here and there")] * 40 + [(i, f"text number {i} of many") for i in range(76)]
    rows += [(None, "no id"), (None, "none either"), (5, "another text of five")]
    with_conf(spark__sql__adaptive__enabled="false")
    got = fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_chars) for r in got if r.doc_id is not None) == sorted(
        (i, len(t)) for i, t in rows if i is not None
    )
    same = [r for r in got if r.doc_id == 5 and r.n_chars == 25]
    assert len(same) == 40 and sum(r.near_next == 1.0 for r in same) >= 39
    itself = hashlib.sha256(b"same words here and" + b"same w").hexdigest()
    assert sum(r.edited_sha256 == itself for r in same) == 39


def test_odd_documents(spark, odd_documents, odd_texts, no_documents):
    got = fingerprints(odd_documents).collect()
    assert len(got) == len(odd_texts) + 2
    assert sorted(r.n_chars for r in got if r.doc_id not in (None, 7)) == sorted(
        len(t or "") for i, t in enumerate(odd_texts) if i != 7
    )
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert fingerprints(no_documents).collect() == []
    (alone,) = fingerprints(spark.createDataFrame([(1, "one text alone")], "doc_id long, text string")).collect()
    assert alone.near_next == 1.0
    assert alone.edited_sha256 == hashlib.sha256(b"one text al" + b"one").hexdigest()

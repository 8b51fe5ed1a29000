"""Sharding, exact and near duplicates and exact search against brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lakestrata.llm import near_dup, topk
from lakestrata.llm.exact_dedup import duplicate_groups
from lakestrata.llm.sharding import permuted, shard_rows
from lakestrata.llm.shingles import shingle_hashes, weighted_shingles, word_hashes


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4097])
def test_the_permutation_is_one(spark, n):
    places = [r[0] for r in spark.range(n).select(permuted(F.col("id"), F.lit(n), 7)).collect()]
    assert sorted(places) == list(range(n))
    if n > 100:
        assert sum(a == b for a, b in zip(places, range(n))) < n / 20


def check_shards(rows, n, shards):
    assert len(rows) == n
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    counts = [len(slots[s]) for s in range(shards)]
    assert sum(counts) == n and max(counts) - min(counts) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding(odd_documents, odd_texts, no_documents):
    rows = shard_rows(odd_documents, 4).collect()
    check_shards(rows, len(odd_texts) + 2, 4)
    for r in rows:
        text = ("no id" if r.doc_id is None else odd_texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(text) + 1, zlib.crc32(text), "rows")
    assert sorted(shard_rows(odd_documents, 4).collect(), key=str) == sorted(rows, key=str)
    again = shard_rows(odd_documents.repartition(1), 4).collect()
    assert sorted(again, key=str) == sorted(rows, key=str)
    assert shard_rows(no_documents).collect() == []


def test_a_third_of_the_rows_are_one_row(spark):
    df = spark.range(900).selectExpr("if(id % 3 = 0, -1, id) doc_id", "if(id % 3 = 0, 'x', string(id)) text")
    check_shards(shard_rows(df).collect(), 900, 16)


@pytest.mark.parametrize("hash_all", [False, True])
def test_exact_duplicates(odd_documents, odd_texts, no_documents, clashing, hash_all):
    rows = duplicate_groups(odd_documents, hash_all=hash_all, carry=True).collect()
    texts = {i: t or "" for i, t in enumerate(odd_texts)} | {None: "no id"}
    groups = defaultdict(list)
    for i in [*texts, 7]:
        groups[texts[i]].append(i)
    assert len(rows) == len(odd_texts) + 2
    for r in rows:
        group = groups[texts[r.doc_id]]
        assert r.group_size == len(group)
        assert r.keep_id == (None if group == [None] else max(group))
        assert r.row.doc_id == r.doc_id and clashing <= set(r.row.asDict())
        if hash_all or len(group) > 1:
            assert r.text_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert Counter(r.text_sha256 for r in rows if r.kept and r.text_sha256).most_common(1)[0][1] == 1
    assert sum(r.kept for r in rows) == len(groups)
    assert duplicate_groups(no_documents).collect() == []


def test_of_equal_rows_one_stays(spark):
    df = spark.createDataFrame([(5, "x")] * 3 + [(4, "x"), (None, "x"), (None, "y"), (None, "y")], "doc_id long, text string")
    kept = duplicate_groups(df).where("kept").collect()
    assert sorted((r.doc_id, r.group_size) for r in kept if r.doc_id) == [(5, 5)]
    assert [r.group_size for r in kept if r.doc_id is None] == [2]


def test_texts_that_agree_in_length_and_start_are_kept_apart(spark):
    start = "s" * 100
    df = spark.createDataFrame([(1, start + "a"), (2, start + "b"), (3, start + "a")], "doc_id long, text string")
    found = {r.doc_id: (r.keep_id, r.group_size) for r in duplicate_groups(df).collect()}
    assert found == {1: (3, 2), 2: (2, 1), 3: (3, 2)}


def test_words_of_other_scripts():
    def count(text):
        return len(word_hashes(text))

    assert count("one\u00a0two\u2014three \u201cfour\u201d five\u2026six") == 6
    assert (word_hashes("\u201cÉté\u201d caf\u00e9") == word_hashes("été café")).all()
    assert (word_hashes("the café")[0] == word_hashes("the")[0]) and count("\U0001f600\U0001f600 a") == 1
    assert count("漢字。かな\u3000カナ") == 6 and count("漢字abc字") == 4
    assert count("ที่นี่") == 2 and count("한국어 문장") == 2 and count("हिन्दी में") == 2 and count("\U00020000\U00020001") == 2
    assert count("\U0001f600 \U0001f601") == 2 and count("\u3000\u00a0") == 0
    assert count("\ue000\ue001") == count("\x7f") == 1


def test_near_copies_without_blanks(spark):
    rng = np.random.default_rng(4)
    texts = []
    for _ in range(4):
        own = [chr(c) for c in rng.integers(0x4E00, 0x9000, 400)]
        texts.append("".join(own))
        own[200] = "。"
        texts.append("".join(own))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = near_dup.near_duplicates(df).collect()
    assert sum(r.kept for r in rows) == 4 and len(rows) == 8


def test_words_and_shingles():
    assert len(word_hashes("One two, THREE-four\n")) == 4
    assert (word_hashes("aB c") == word_hashes("Ab... C")).all()
    assert len(word_hashes("")) == len(word_hashes(" \n")) == 0
    assert len(word_hashes("$$ !!")) == 2
    assert len(set(word_hashes(" ".join(map(str, range(10_000)))).tolist())) == 10_000
    assert len(shingle_hashes("a b c d e f")) == 2 and len(shingle_hashes("a b")) == len(shingle_hashes("")) == 1
    assert shingle_hashes("a b")[0] != shingle_hashes("a b c")[0] != shingle_hashes("")[0]
    elements, counts = weighted_shingles("a b c d e a b c d e a b c d e")
    assert sorted(counts.tolist()) == [2, 2, 2, 2, 3]


@pytest.mark.parametrize("weighted", [False, True])
def test_signatures_agree_as_often_as_sets_are_similar(weighted):
    rng = np.random.default_rng(4)
    agreed, wanted = [], []
    for _ in range(40):
        x = rng.integers(0, 2**63, 300).astype(np.uint64)
        a, b = (rng.integers(0, 4, 300) if weighted else rng.integers(0, 2, 300) for _ in range(2))
        if weighted:
            a, b = a * 0.75, b * 0.75
        shared = rng.random(300) < 0.6
        b = np.where(shared, a, b)
        same = near_dup.dart_minhash(x, a) == near_dup.dart_minhash(x, b)
        agreed.append(same.mean())
        wanted.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(agreed) - np.mean(wanted)) < 0.03


def test_signature_of_few_and_many_elements():
    one = near_dup.dart_minhash(np.array([3], np.uint64), np.array([1]))
    assert len(set(one.tolist())) == near_dup.SIGNATURE
    x = np.arange(near_dup._CHUNK + 999, dtype=np.uint64)
    many = near_dup.dart_minhash(x, np.ones(len(x)))
    order = np.random.default_rng(1).permutation(len(x))
    assert (near_dup.dart_minhash(x[order], np.ones(len(x))) == many).all()
    assert (near_dup.dart_minhash(np.empty(0, np.uint64), np.empty(0)) == 0).all()


def weighted_similarity_set(text):
    return Counter(shingle_hashes(text).tolist())


def brute_similarity(a, b):
    return (a & b).total() / (a | b).total()


def classes(texts, threshold=0.8):
    """Smallest index of each text's class, by all pairs."""
    sets = [weighted_similarity_set(t) for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if brute_similarity(sets[i], sets[j]) >= threshold:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    return root


def test_near_duplicates_by_brute_force(spark):
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(12):
        base = rng.choice(words, 120).tolist()
        for _ in range(6):
            own = list(base)
            for at in rng.integers(0, 120, rng.integers(0, 4)):
                own[at] = str(rng.choice(words))
            texts.append(" ".join(own))
    # Many texts share a passage and little else.
    passage = rng.choice(words, 60).tolist()
    texts += [" ".join(passage + rng.choice(words, 40).tolist()) for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = near_dup.near_duplicates(df).collect()
    wanted = classes(texts)
    assert {r.doc_id: r.class_id for r in rows} == dict(enumerate(wanted))
    sizes = Counter(wanted)
    assert all(r.class_size == sizes[r.class_id] and r.kept == (r.class_id == r.doc_id) for r in rows)


def test_near_duplicates_of_odd_texts(odd_documents, odd_texts, no_documents, clashing):
    rows = near_dup.near_duplicates(odd_documents, carry=True).collect()
    assert len(rows) == len(odd_texts) + 2
    root = classes([t or "" for t in odd_texts])
    assert {r.doc_id: r.class_id for r in rows if r.doc_id is not None} == dict(enumerate(root))
    assert sum(r.kept for r in rows) == len(set(root)) + 1
    assert all(clashing <= set(r.row.asDict()) for r in rows)
    assert near_dup.near_duplicates(no_documents).collect() == []


def test_one_bucket_of_many_that_are_hardly_alike(spark, monkeypatch):
    """Copies with few to many changes: most are linked, the rest only to some or to none."""
    monkeypatch.setattr(near_dup, "CELL", 16)
    monkeypatch.setattr(near_dup, "GROUP", 20_000)
    rng = np.random.default_rng(6)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(160):
        own = list(base)
        for at in rng.integers(0, 150, rng.integers(0, 16)):
            own[at] = f"x{rng.integers(0, 5)}"
        texts.append(" ".join(own))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    wanted = classes(texts)
    assert 5 < len(set(wanted)) < 120
    assert {r.doc_id: r.class_id for r in near_dup.near_duplicates(df).collect()} == dict(enumerate(wanted))


def test_a_chain_of_links_is_one_class(spark):
    words = [f"w{i}" for i in range(130)]
    texts = [" ".join(words[i : i + 110]) for i in range(0, 20, 4)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.class_id for r in near_dup.near_duplicates(df).collect()} == {0}


def brute_top(vectors, k, every):
    ids = [i for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    ints = {i: np.floor(256 * np.array(v, float)).astype(int) for i, v in vectors if i in ids}
    return {
        (q, n + 1): (c, s)
        for q in ids
        if q % every == 0
        for n, (s, c) in enumerate(sorted(((-int(ints[q] @ ints[c]), c) for c in ids if c != q))[:k])
    }


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 100)
    monkeypatch.setattr(topk, "BLOCK", 4)
    monkeypatch.setattr(topk, "LEAF", 8)
    rng = np.random.default_rng(3)
    vectors = [(i, rng.normal(0, 1, 8).astype(np.float32).tolist()) for i in range(-20, 480)]
    vectors = [(i, vectors[30][1]) if i % 3 == 0 else (i, v) for i, v in vectors]  # a third are equal
    vectors += [(500, None), (501, [1.0, None]), (502, [float("nan")] * 8), (503, [float("inf")] * 8), (None, [1.0] * 8)]
    df = spark.createDataFrame([(i, v, "x") for i, v in vectors], "vec_id long, embedding array<float>, query_id string")
    found = {(r.query_id, r["rank"]): (r.vec_id, -r.score) for r in topk.top_k(df, every=10).collect()}
    assert found == brute_top(vectors, 5, 10)


def test_top_k_of_few_or_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    df = spark.createDataFrame([(50, [1.0]), (1, [2.0]), (2, [2.0])], schema)
    assert [tuple(r) for r in topk.top_k(df).orderBy("rank").collect()] == [(50, 1, 1, 131072), (50, 2, 2, 131072)]
    assert topk.top_k(spark.createDataFrame([], schema)).collect() == []
    assert topk.top_k(spark.createDataFrame([(50, [1.0])], schema)).collect() == []
    repeated = spark.createDataFrame([(50, [1.0]), (50, [1.0]), (3, [1.0])], schema)
    assert [tuple(r) for r in topk.top_k(repeated).collect()] == [(50, 1, 3, 65536)]


@pytest.mark.parametrize("name", ["op5_topk", "op9_exact_dedup"])
def test_queries_with_sql(spark, name):
    import glob
    import os

    import duckdb

    from tools.check_oracles import rows_of

    database = duckdb.connect()
    for path in glob.glob("/root/testdata/sf0.001/*.parquet"):
        database.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    df = entry.queries()[name](spark, "/root/testdata/sf0.001")
    cursor = database.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(names, cursor.fetchall())

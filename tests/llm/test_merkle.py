"""The Merkle manifest against one made in plain Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from lakestrata.llm.merkle import descend, fold, manifest, records


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(digests):
    """The root, and each leaf's siblings by level: what stands before and behind it."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for i, place in enumerate(at):
            run = digests[place // 8 * 8 : place // 8 * 8 + 8]
            paths[i].append(("".join(run[: place % 8]), "".join(run[place % 8 + 1 :])))
            at[i] = place // 8
        digests = [sha("".join(digests[i : i + 8])) for i in range(0, len(digests), 8)]
    return digests[0], paths


def plain_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text); the result as a sorted list of tuples."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for lang in langs:
        own = [(r[0], plain_leaf(*r), r) for r in groups[lang]]
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[lang] = own, *climb([leaf for _, leaf, _ in own])
    root, tops = climb([trees[lang][1] for lang in langs])
    out = []
    for lang, top in zip(langs, tops, strict=True):
        own, subroot, paths = trees[lang]
        for (doc_id, leaf, row), path in zip(own, paths, strict=True):
            path = path + top
            node = leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and row[4] is not None:
                lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
                node = plain_leaf(*row[:4], lowered)
            for before, after in path:
                node = sha(before + node + after)
            proof = sha("".join(before + after for before, after in path))
            out.append((doc_id, leaf, subroot, root, proof, node, node == root))
    return sorted(out, key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def checked(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted((tuple(r) for r in manifest(df).collect()), key=str)
    assert got == plain_manifest(rows)
    return got


def test_trees_of_many_sizes(spark):
    rows = []
    for lang, n in ((None, 3), ("", 1), ("de", 8), ("en", 75), ("é", 9)):
        for i in range(n):
            rows.append((len(rows) * 7 % 101, f"s{i % 2}" if i % 3 else None, lang, i if i % 4 else None, f"Text {i} ÄB"))
    got = checked(spark, rows)
    assert {r[6] for r in got} == {True, False}
    assert len({r[3] for r in got}) == 1 and len({r[2] for r in got}) == 5


def test_odd_rows(spark, odd_texts):
    rows = [(i, "s", "en", None, t) for i, t in enumerate(odd_texts)]
    rows += [(None, None, None, None, None), (None, None, None, None, "A"), (5, "s", "en", None, "other"), (5, "s", "en", None, "Z")]
    rows.append((99, "12:x", "-", 1, "A" * 3_000_000))
    checked(spark, rows)


@pytest.mark.parametrize("n", [1, 30])
def test_equal_rows_are_leaves_each(spark, n):
    checked(spark, [(3, "s", "en", 1, "Same")] * n + [(i, "s", "en", 1, "x") for i in range(1, n)])


def test_one_row_and_none(spark):
    (row,) = checked(spark, [(1, "s", "en", 1, "a")])
    assert row[1] == row[2] == row[3] and row[4] == sha("")
    assert manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_clashing_columns(spark, odd_documents):
    df = odd_documents.withColumns({"source": F.lit("s"), "n_chars": F.length("text")})
    df = df.withColumns({c: F.lit("x") for c in ("tree", "rank", "depth", "digest", "path", "children")})
    rows = [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = sorted((tuple(r) for r in manifest(df).collect()), key=str)
    assert got == plain_manifest(rows)


def test_ranges_do_not_change_the_result(spark, with_conf):
    rows = [(i % 40, "s", "en" if i % 3 else "fr", i, f"T{i}") for i in range(400)]
    with_conf(spark__sql__shuffle__partitions="7", spark__sql__adaptive__enabled="false")
    checked(spark, rows)


def test_chosen_requests(spark, tmp_path):
    """A few leaves only: their paths lead to the root, by records that are found by digest."""
    leaves = [sha(str(i)) for i in range(100)]
    root, paths = climb(leaves)
    nodes = spark.createDataFrame([("t", i, 3, d) for i, d in enumerate(leaves)], "tree string, rank long, depth int, digest string")
    from lakestrata.llm.merkle import build

    tops = build(nodes, str(tmp_path)).select("tree", "depth", "digest").withColumn(
        "path", F.array().cast("array<struct<left: string, right: string>>")
    )
    asked = nodes.where("rank in (0, 9, 99)").select("tree", "rank", "depth")
    found = descend(tops, asked, str(tmp_path)).withColumn("folded", fold(F.col("digest"), F.col("path"))).collect()
    assert sorted(r.rank for r in found) == [0, 9, 99]
    for r in found:
        assert r.digest == leaves[r.rank] and r.folded == r.top == root
        assert [tuple(s) for s in r.path][::-1] == paths[r.rank]
    assert records(spark, str(tmp_path), 1).count() == 13

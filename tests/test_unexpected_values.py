"""The values that break a rule, against plain counting."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakestrata.quality import (
    expect_length_equal,
    expect_match_regex,
    expect_type,
    expect_unique_key,
    unexpected_values,
)
from lakestrata.quality import values as V

SUITE = [
    expect_match_regex("name", r"^\D*$"),
    expect_length_equal("code", 3),
    expect_type("code", "int"),
    expect_unique_key("code"),
    expect_match_regex("none", "x"),
]


def plain(rows, top):
    out = []
    for column, name, breaks in (
        (0, "expect_column_values_to_match_regex", lambda v: not re.fullmatch(r"\D*", v)),
        (1, "expect_column_value_lengths_to_equal", lambda v: len(v) != 3),
    ):
        found = Counter(r[column] for r in rows if r[column] is not None and breaks(r[column]))
        best = sorted(found.items(), key=lambda x: (-x[1], x[0].encode()))[:top]
        out += [(name, ("name", "code")[column], i, v, n) for i, (v, n) in enumerate(best, 1)]
    return out


def got(df, top, **options):
    found = unexpected_values(df, SUITE, "T", top, **options).collect()
    assert {(r.table, r.suite) for r in found} <= {("T", "dq_T")}
    return [(r.expectation, r.column, r["rank"], r.value, r.n_rows) for r in found]


def table(spark, rows, parts=5):
    return spark.createDataFrame(rows, "name string, code string").repartition(parts)


@pytest.mark.parametrize("seed", [1, 2])
def test_values(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b1", "c2", "é3", None, f"x{rng.randint(0, 9)}"]), rng.choice(["abc", "ab", "", "abcd", None])) for _ in range(3000)]
    for top in (1, 3, 20):
        assert got(table(spark, rows), top) == plain(rows, top)


def test_many_rare_values_beside_frequent_ones(spark, monkeypatch):
    """More values than a summary keeps: first with clear winners, then with none."""
    rows = [(f"r{i}", "abc") for i in range(4000)] + [(f"often{i}", "ab") for i in range(5) for _ in range(400 + i)]
    counts = []
    original = V._ranked
    monkeypatch.setattr(V, "_ranked", lambda df, top: counts.append(1) or original(df, top))
    monkeypatch.setattr(V, "_MAP_SIZE", 128)
    df = table(spark, rows)
    for top, passes in ((5, 1), (8, 2)):
        counts.clear()
        found = unexpected_values(df, SUITE[:1], "T", top, tracked=90).collect()
        assert [(r.value, r.n_rows) for r in found] == [(v, n) for c, _, _, v, n in plain(rows, top) if "regex" in c]
        assert len(counts) == passes
    assert got(df, 5, tracked=90) == plain(rows, 5)  # a value that all rows of a rule hold


def test_a_third_of_the_rows_hold_one_value(spark):
    rows = [("bad 1", "abc")] * 1000 + [(f"bad {i % 7}", "abc") for i in range(2000)]
    assert got(table(spark, rows), 3) == plain(rows, 3)


def test_nothing_unexpected(spark):
    assert got(table(spark, [("a", "abc"), (None, None)]), 3) == []
    assert unexpected_values(spark.createDataFrame([], "other int"), SUITE, "T").collect() == []
    assert unexpected_values(table(spark, [("1", "1")]), SUITE[2:4], "T").columns[0] == "table"
    with pytest.raises(ValueError):
        unexpected_values(table(spark, []), SUITE, "T", top=0)


def test_values_of_other_types(spark):
    df = spark.range(10).select((F.col("id") % 3 + 98).alias("code"), F.lit("x").alias("name"))
    assert got(df, 2) == [("expect_column_value_lengths_to_equal", "code", 1, "98", 4), ("expect_column_value_lengths_to_equal", "code", 2, "99", 3)]

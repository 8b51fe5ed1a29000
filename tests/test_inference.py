"""Types that one parse finds, against Spark's own inference."""

import random

import pytest
from pyspark.sql import functions as F

from lakestrata import storage
from lakestrata.sources import inference, read_delimited, stage_delimited
from lakestrata.sources.inference import kind_measures, merged_types

SINGLE = [
    "2024-01-01", "2024-1-1", "2024-01", "2024", "+5", "-0", "007", "2147483648", "99999999999999999999",
    "-99999999999999999999", "1" * 39, "0" * 45 + "1", "1.", "1.5", "1e5", "1E400", ".5", "5.", "-.5e-3", "1d", "1.5f",
    "0x1p3", "NaN", "Inf", "-Inf", "Infinity", "nan", "inf", " 1", "1 ", " 1.5 ", "2024-01-01 10:00:00",
    "2024-01-01T10:00:00Z", "2024-01-01 10:00:00.123", "2024-01-01 x", "2024-13-01", "2024-02-30", "10:00:00", "12:30",
    "true", "TRUE", "False", "yes", "x", "2024-01-01 ", "2024-01-01T", "2024-01-01 10:00:00+02:00", "1,5", "--5", "1_0",
    "1L", "1e", "e5", "+", "-", "+1.5", "Z", "", "-9223372036854775808", "9223372036854775808", "0", "00", "é",
]
MIXED = [
    ["1", "99999999999999999999"], ["1.5", "99999999999999999999"], ["1", "true"], ["true", "FALSE", ""],
    ["2024-01-01", "2024-01-01 10:00:00"], ["1", "2024-01-01"], ["12345678901", "99999999999999999999"],
    ["1", "2", "30000000000"], ["1", "30000000000", "2.5"], ["", "", ""], ["", "7"], ["a", "1"], ["2024-01-01", "1.5"],
    ["1" * 25, "9" * 30, "4"], ["1" * 39, "1" * 30], ["NaN", "1"], ["2024-01-01", "true"],
]


def write(path, columns):
    rows = max(len(c) for c in columns)
    lines = ["|".join(f"c{i}" for i in range(len(columns)))]
    lines += ["|".join([*(c[r] if r < len(c) else "" for c in columns)]) for r in range(rows)]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_single_values(spark, tmp_path):
    path = write(tmp_path / "a.csv", [[v] for v in SINGLE])
    wanted = read_delimited(spark, path, separator="|")
    got = stage_delimited(spark, path, str(tmp_path / "staged"), separator="|")
    assert {v: f.dataType for v, f in zip(SINGLE, got.schema)} == {v: f.dataType for v, f in zip(SINGLE, wanted.schema)}
    assert [str(v) for v in got.first()] == [str(v) for v in wanted.first()]


def test_columns_of_several_kinds(spark, tmp_path):
    path = write(tmp_path / "a.csv", MIXED)
    wanted = read_delimited(spark, path, separator="|")
    got = stage_delimited(spark, path, str(tmp_path / "staged"), separator="|")
    assert [f.dataType for f in got.schema] == [f.dataType for f in wanted.schema]
    assert [[str(v) for v in r] for r in got.collect()] == [[str(v) for v in r] for r in wanted.collect()]


@pytest.mark.parametrize("seed", range(3))
def test_the_aggregate_merges_in_any_order(spark, seed):
    rng = random.Random(seed)
    columns = [rng.sample(SINGLE, 4) * 3 for _ in range(12)]
    rows = list(zip(*columns, strict=True))
    schema = ", ".join(f"`c {i}` string" for i in range(12))
    found = set()
    for parts in (1, 2, 5):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, schema).repartition(parts)
        found.add(merged_types(df.columns, df.agg(*kind_measures(df)).first().asDict()).simpleString())
    assert len(found) == 1


def test_the_text_is_parsed_once(spark, tmp_path, monkeypatch):
    folder = tmp_path / "in"
    folder.mkdir()
    for n in range(3):
        write(folder / f"{n}.csv", [["1", str(n)], ["a b", "ä"], ["007", "8"]])
    scans = []
    original = type(spark.read).csv

    def counted(reader, *args, **options):
        scans.append(args)
        return original(reader, *args, **options)

    monkeypatch.setattr(type(spark.read), "csv", counted)
    staged = str(tmp_path / "staged")
    df = stage_delimited(spark, str(folder), staged, separator="|", keep_text=lambda name: name == "c2")
    assert dict(df.dtypes) == {"c0": "int", "c1": "string", "c2": "string"}
    assert sorted(r.c2 for r in df.collect()) == ["007"] * 3 + ["8"] * 3
    assert len(scans) == 1 and "csv" not in df._jdf.queryExecution().toString().lower().replace(".csv", "")
    assert storage.children(spark, staged)


def test_no_rows_and_no_columns(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("a|b ä\n")
    df = stage_delimited(spark, str(path), str(tmp_path / "staged"), separator="|")
    assert df.dtypes == [("a", "string"), ("b ä", "string")] and df.count() == 0
    (tmp_path / "empty.csv").write_text("")
    assert stage_delimited(spark, str(tmp_path / "empty.csv"), str(tmp_path / "none"), separator="|").columns == []


def test_encoding_and_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('nome;valor\n"São; Paulo";1\nRio;"2"\n'.encode("iso-8859-1"))
    df = stage_delimited(spark, str(tmp_path / "a.csv"), str(tmp_path / "s"), separator=";", encoding="ISO-8859-1")
    assert sorted((r.nome, r.valor) for r in df.collect()) == [("Rio", 2), ("São; Paulo", 1)]
    assert df.select(F.sum("valor")).first()[0] == 3


BOUNDS = [
    "2147483647", "+2147483647", "0000002147483647", "-2147483648", "-2147483649", "999999999", "-99999999999",
    "9223372036854775807", "+9223372036854775808", "-0009223372036854775808", "-9223372036854775809", "1" * 19, "9" * 20,
    "1" * 20 + ".", "1" * 39 + ".", "0x1p", "0x.8p1d", "1-URGENT", "5-LOW", "1.5.2", "\t1.5", ".", "1e5x", "12-34",
]


def test_bounds_of_whole_numbers_and_text_that_looks_like_a_number(spark, tmp_path):
    path = write(tmp_path / "a.csv", [[v] for v in BOUNDS])
    wanted = read_delimited(spark, path, separator="|")
    got = stage_delimited(spark, path, str(tmp_path / "staged"), separator="|")
    assert {v: f.dataType for v, f in zip(BOUNDS, got.schema)} == {v: f.dataType for v, f in zip(BOUNDS, wanted.schema)}
    assert [str(v) for v in got.first()] == [str(v) for v in wanted.first()]


def test_kinds_are_found_before_they_are_observed(spark, tmp_path, monkeypatch):
    seen, original = [], inference.kind_measures

    def kept(*args):
        seen.extend(original(*args))
        return seen

    monkeypatch.setattr(inference, "kind_measures", kept)
    path = write(tmp_path / "a.csv", [["1-URGENT", "30000000000"], ["7", "8"]])
    got = stage_delimited(spark, path, str(tmp_path / "staged"), separator="|")
    assert [t for _, t in got.dtypes] == ["string", "int"]
    assert len(seen) == 4 and not any("cast" in str(m).lower() for m in seen)

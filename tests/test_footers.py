"""Schemas that Spark tasks read from footers."""

import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakestrata.sources import concat_by_name, land_recursive, list_files
from lakestrata.sources.footers import file_schemas, footer_schema, footers

KINDS = {
    "whole": pa.table({"id": pa.array([1], pa.int32()), "v": pa.array([2], pa.int64())}),
    "exact": pa.table({"id": pa.array([1], pa.int64()), "v": pa.array([2.5], pa.float64())}),
    "words": pa.table({"v": pa.array(["x"]), "more": pa.array([True])}),
}


def write(root, layout):
    """layout: (folder, kind, number of files)."""
    for folder, kind, n in layout:
        path = root / folder
        path.mkdir(parents=True, exist_ok=True)
        for i in range(n):
            pq.write_table(KINDS[kind], path / f"{kind}-{i:05d}.parquet")


def test_five_thousand_files_of_three_schemas(spark, tmp_path):
    write(tmp_path, [("a", "whole", 1700), ("b/c", "exact", 1600), ("d", "words", 1400), ("e", "words", 180), ("e", "whole", 120)])
    found = file_schemas(list_files(spark, str(tmp_path)))
    assert [(x.n_files, x.schema.names) for x in found] == [(1820, ["id", "v"]), (1600, ["id", "v"]), (1580, ["v", "more"])]
    assert [[f.rsplit("/", 1)[-1] for f in x.folders] for x in found] == [["a"], ["c"], ["d"]]
    assert [len(x.files) for x in found] == [120, 0, 180]  # names only where a folder is mixed
    rows = concat_by_name(spark, str(tmp_path))
    assert dict(rows.dtypes) == {"id": "bigint", "v": "string", "more": "boolean"}
    got = {(r.v, r.id, r.more): r.n for r in rows.groupBy("v", "id", "more").agg(F.count("*").alias("n")).collect()}
    assert got == {("2", 1, None): 1820, ("2.5", 1, None): 1600, ("x", None, True): 1580}


def test_provenance_glob_and_keep(spark, tmp_path):
    write(tmp_path, [("a", "whole", 3), ("a", "exact", 2), ("b", "words", 1)])
    (tmp_path / "a" / "notes.txt").write_text("no parquet")
    landed = land_recursive(spark, str(tmp_path), glob="*.parquet") if "glob" in land_recursive.__code__.co_varnames else None
    rows = concat_by_name(spark, str(tmp_path), glob="*.parquet", provenance="file", keep=lambda name: ~name.startswith("words"))
    assert dict(rows.dtypes) == {"id": "bigint", "v": "double", "file": "string"}
    assert sorted(r.file for r in rows.collect()) == sorted([f"whole-{i:05d}.parquet" for i in range(3)] + [f"exact-{i:05d}.parquet" for i in range(2)])
    assert landed is None or landed.count() == 6


def test_partition_columns_stay(spark, tmp_path):
    write(tmp_path, [("day=1", "whole", 2), ("day=2", "exact", 2), ("day=2", "whole", 1)])
    rows = concat_by_name(spark, str(tmp_path))
    assert sorted((r.day, r.v) for r in rows.collect()) == [(1, 2.0), (1, 2.0), (2, 2.0), (2, 2.5), (2, 2.5)]


def test_the_footer_says_what_spark_reads(spark, tmp_path):
    df = spark.sql(
        "select 1 a, cast(2 as bigint) b, 1.5D c, cast(1.5 as decimal(9, 2)) d, 'x' e, date'2024-01-01' f, true g,"
        " timestamp'2024-01-01 00:00:00' h, timestamp_ntz'2024-01-01 00:00:00' i, array(1, 2) j, map('k', 1) k,"
        " named_struct('x', 1, 'y', array('z')) l, cast(1 as tinyint) m, cast('b' as binary) n"
    )
    df.coalesce(1).write.parquet(str(tmp_path / "spark"))
    when = datetime.datetime(2024, 1, 1)
    table = pa.table(
        {
            "a": pa.array([1], pa.int32()),
            "b": pa.array([1.5], pa.float32()),
            "c": pa.array([when], pa.timestamp("us")),
            "d": pa.array([when], pa.timestamp("us", "UTC")),
            "e": pa.array([["x"]]),
            "f": pa.array([{"x": 1}]),
            "g": pa.array([when.date()]),
        }
    )
    (tmp_path / "arrow").mkdir()
    (tmp_path / "old").mkdir()
    pq.write_table(table, tmp_path / "arrow" / "x y%20z.parquet")
    pq.write_table(table.select(["a", "c"]), tmp_path / "old" / "x.parquet", use_deprecated_int96_timestamps=True)
    for name in ("spark", "arrow", "old"):
        path = str(tmp_path / name)
        (file,) = list_files(spark, path).collect()
        assert footer_schema(file.file_path) == spark.read.parquet(path).schema
    assert footers(list_files(spark, str(tmp_path))).select("folder").distinct().count() == 3


def test_a_broken_file_is_an_error(spark, tmp_path):
    write(tmp_path, [("a", "whole", 1)])
    (tmp_path / "a" / "broken.parquet").write_bytes(b"PAR1 nothing")
    with pytest.raises(Exception, match="[Pp]arquet"):
        file_schemas(list_files(spark, str(tmp_path)))

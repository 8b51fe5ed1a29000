"""Overwrites that readers never see half done."""

import os

import pytest
from pyspark.sql import functions as F

from lakestrata import storage
from lakestrata.sinks import drop_versions, versions, write_layer
from lakestrata.sinks.versions import write_version
from lakestrata.sources import read_layer


def ids(spark, path):
    return sorted(r.id for r in read_layer(spark, path).collect())


def broken(spark):
    """Rows whose last task fails after others have written their files."""
    return spark.range(0, 40, 1, 4).select(F.when(F.col("id") < 39, F.col("id")).otherwise(F.raise_error(F.lit("died"))).cast("long").alias("id"))


def test_versions(spark, tmp_path):
    path = str(tmp_path / "layer")
    write_layer(spark.range(5), path, versioned=True)
    before = read_layer(spark, path)
    write_layer(spark.range(7), path + "/", versioned=True)
    assert ids(spark, path) == list(range(7)) and before.count() == 5
    write_layer(spark.range(0), path, versioned=True)
    assert ids(spark, path) == []
    assert [n for n, _ in versions(spark, path)] == [1, 2, 3]


def test_a_write_that_dies_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "layer")
    write_layer(spark.range(5), path, versioned=True)
    with pytest.raises(Exception, match="died"):
        write_layer(broken(spark), path, versioned=True)
    assert ids(spark, path) == list(range(5))
    # Killed after the data and before the log entry.
    with pytest.raises(KeyboardInterrupt):

        def killed(folder):
            spark.range(3).write.parquet(folder)
            raise KeyboardInterrupt

        write_version(spark, path, killed)
    assert ids(spark, path) == list(range(5)) and len(versions(spark, path)) == 1
    write_layer(spark.range(6), path, versioned=True)
    assert ids(spark, path) == list(range(6))
    # What it was before: the same failure without versions loses the old rows.
    plain = str(tmp_path / "plain")
    write_layer(spark.range(5), plain)
    with pytest.raises(Exception, match="died"):
        write_layer(broken(spark), plain)
    assert not any(n.endswith(".parquet") for n in os.listdir(plain)) if os.path.isdir(plain) else True


def test_a_reader_of_the_layer_may_write_its_next_version(spark, tmp_path):
    path = str(tmp_path / "layer")
    write_layer(spark.range(5), path, versioned=True)
    write_layer(read_layer(spark, path).where("id > 1"), path, versioned=True)
    assert ids(spark, path) == [2, 3, 4]


def test_old_versions_go(spark, tmp_path):
    path = str(tmp_path / "layer")
    for n in (3, 4, 5):
        write_layer(spark.range(n), path, versioned=True)
    with pytest.raises(Exception, match="died"):
        write_layer(broken(spark), path, versioned=True)
    left = os.listdir(f"{path}/data")
    assert len(drop_versions(spark, path, keep=2)) == 1
    assert len(drop_versions(spark, path)) == 1 and drop_versions(spark, path) == []
    assert ids(spark, path) == list(range(5))
    drop_versions(spark, path, abandoned=True)
    assert len(os.listdir(f"{path}/data")) == 1 < len(left) and ids(spark, path) == list(range(5))
    with pytest.raises(ValueError):
        drop_versions(spark, path, keep=0)


def test_partitioned_versions(spark, tmp_path):
    path = str(tmp_path / "layer")
    df = spark.range(20).selectExpr("id", "date_add(date'2024-01-01', cast(id % 3 as int)) day")
    write_layer(df, path, partition_by="day", versioned=True)
    write_layer(df.where("id < 10"), path, partition_by="day", versioned=True)
    got = read_layer(spark, path)
    assert dict(got.dtypes)["day"] == "date" and got.count() == 10
    assert got.where("day = date'2024-01-02'").count() == 3
    with pytest.raises(ValueError, match="static"):
        write_layer(df, path, partition_by="day", versioned=True, overwrite_partitions="dynamic")


def test_two_writers_publish_whole_versions(spark, tmp_path):
    path = str(tmp_path / "layer")

    def slow(folder):
        write_layer(spark.range(9), path, versioned=True)
        spark.range(4).write.parquet(folder)

    write_version(spark, path, slow)
    assert len(versions(spark, path)) == 2
    assert ids(spark, path) in (list(range(9)), list(range(4)))


def test_storage(spark, tmp_path):
    root = str(tmp_path)
    spark.range(1).write.parquet(f"{root}/a")
    storage.rename(spark, f"{root}/a", f"{root}/x/y/b")
    assert storage.children(spark, root) == ["x"] and storage.children(spark, f"{root}/none") == []
    with pytest.raises(OSError):
        storage.rename(spark, f"{root}/none", f"{root}/c")
    storage.delete(spark, f"{root}/x")
    storage.delete(spark, f"{root}/x")
    assert storage.children(spark, root) == []

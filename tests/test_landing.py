"""Landing that copies only what is new, against landing everything."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from lakestrata import storage
from lakestrata.cli import main
from lakestrata.plans import land_new_job, read_landed
from lakestrata.plans import landing as L
from lakestrata.sinks import read_delivery
from lakestrata.sources import land_recursive


def put(root, name, values, kind="int64", at=None):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.table({"v": pa.array(values, kind), "n": pa.array([name] * len(values))}), path)
    if at is not None:
        os.utime(path, (at, at))


def rows_of(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=str)


@pytest.fixture
def folders(tmp_path):
    source = str(tmp_path / "in")
    put(source, "a/x.parquet", [1, 2], at=1000)
    put(source, "b/x y%20.parquet", [3], at=1000)
    return source, str(tmp_path / "out")


def test_only_new_and_changed_files(spark, folders):
    source, target = folders
    assert land_new_job(spark, source, target) == 2
    assert land_new_job(spark, source, target + "/") == 0
    assert rows_of(read_landed(spark, target)) == rows_of(land_recursive(spark, source))
    put(source, "a/x.parquet", [1, 9], at=2000)  # as long as before
    put(source, "c/d/new.parquet", [7, 7], at=1000)
    assert land_new_job(spark, source, target) == 2
    assert rows_of(read_landed(spark, target)) == rows_of(land_recursive(spark, source))
    put(source, "a/x.parquet", [], at=2000)
    assert land_new_job(spark, source, target) == 1
    assert rows_of(read_landed(spark, target)) == rows_of(land_recursive(spark, source))
    assert storage.children(spark, f"{target}/data") == ["batch=1", "batch=2", "batch=3"]


def test_files_whose_types_conflict(spark, folders):
    source, target = folders
    land_new_job(spark, source, target)
    put(source, "a/half.parquet", [0.5], "float64")
    put(source, "a/whole.parquet", [5])
    put(source, "e/half.parquet", [1.5], "float64")
    assert land_new_job(spark, source, target) == 3
    got, wanted = read_landed(spark, target), land_recursive(spark, source)
    assert sorted(got.dtypes) == sorted(wanted.dtypes) and dict(got.dtypes)["v"] == "double"
    assert rows_of(got) == rows_of(wanted)


def test_a_run_that_dies_is_repeated(spark, folders, monkeypatch):
    source, target = folders
    land_new_job(spark, source, target)
    before = rows_of(read_landed(spark, target))
    put(source, "c/z.parquet", [8])
    original = type(spark).createDataFrame

    def dies(self, data, schema=None, **options):
        if schema == L._ENTRY and data:
            raise KeyboardInterrupt
        return original(self, data, schema, **options)

    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "createDataFrame", dies)
        with pytest.raises(KeyboardInterrupt):
            land_new_job(spark, source, target)
    assert storage.children(spark, f"{target}/data") == ["batch=1", "batch=2"]
    assert rows_of(read_landed(spark, target)) == before
    assert land_new_job(spark, source, target) == 1
    assert rows_of(read_landed(spark, target)) == rows_of(land_recursive(spark, source))


def test_files_that_are_gone_stay(spark, folders):
    source, target = folders
    land_new_job(spark, source, target)
    os.unlink(f"{source}/a/x.parquet")
    assert land_new_job(spark, source, target) == 0
    assert read_landed(spark, target).count() == 3
    with pytest.raises(ValueError, match="overlap"):
        land_new_job(spark, source, source + "/out")


def test_the_commands(spark, folders):
    source, target = folders
    main(["land-new", "--source", source, "--target", target, "--glob", "x.parquet"])
    assert read_landed(spark, target).count() == 2
    delivered = target + "-table"
    for _ in range(2):
        main(["deliver-files", "--source", source, "--target", delivered, "--load-id", "one", "--variant", "create"])
    assert sorted(r.v for r in read_delivery(spark, delivered).collect()) == [1, 2, 3]

"""Delivery tables in files: loads that fail, run again or meet."""

import os
import threading

import pytest
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.plans import deliver_files_job
from lakestrata.sinks import (
    DELIVERY_SCHEMA,
    DeliveryConflict,
    KeyViolation,
    create_delivery,
    deliver_load,
    drop_replaced,
    published_loads,
    read_delivery,
)
from lakestrata.sinks import transactional as X

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("at", T.TimestampType()), T.StructField("v", T.StringType())])


@pytest.fixture
def target(tmp_path):
    path = str(tmp_path / "table")
    create_delivery(path, SCHEMA, "id")
    return path


def rows(spark, first, last, parts=4, value="x"):
    df = spark.range(first, last, 1, parts)
    return df.select("id", F.timestamp_seconds(F.col("id")).alias("at"), F.lit(value).alias("v"))


def ids(spark, path):
    return sorted(r.id for r in read_delivery(spark, path).collect())


def staged(path):
    folder = os.path.join(path, "_staging")
    return [os.path.join(f, n) for f, _, names in os.walk(folder) for n in names]


def test_loads_add_up(spark, target):
    assert read_delivery(spark, target).schema == SCHEMA and ids(spark, target) == []
    assert deliver_load(rows(spark, 0, 10), target, "monday")
    assert deliver_load(rows(spark, 10, 15), "file:" + target, "tuesday")
    assert deliver_load(rows(spark, 0, 0), target, "empty")
    assert ids(spark, target) == list(range(15))
    assert [(x.number, x.load_id, x.rows) for x in published_loads(target)] == [(1, "monday", 10), (2, "tuesday", 5), (3, "empty", 0)]
    assert read_delivery(spark, target).where("id = 3").first().at.second == 3


def test_a_repeated_load_adds_nothing(spark, target):
    assert deliver_load(rows(spark, 0, 10), target, "monday")
    assert not deliver_load(rows(spark, 0, 10), target, "monday")
    assert not deliver_load(rows(spark, 50, 60), target, "monday", mode="overwrite")
    assert ids(spark, target) == list(range(10))


def failing_writer(kind):
    """A writer whose first task attempts fail after they have written their file."""

    class Failing(X.DeliveryWriter):
        def write(self, iterator):
            message = super().write(iterator)
            context = TaskContext.get()
            if context.partitionId() % 2 and (kind == "always" or context.attemptNumber() == 0):
                raise OSError("lost after the write")
            return message

    class Source(X.DeliverySource):
        def writer(self, schema, overwrite):
            return Failing(dict(self.options), schema, overwrite)

    return Source


def test_a_task_that_fails_after_its_write(spark, target, monkeypatch):
    monkeypatch.setattr(X, "DeliverySource", failing_writer("once"))
    assert deliver_load(rows(spark, 0, 100), target, "monday")
    assert ids(spark, target) == list(range(100))
    assert staged(target) == []
    files = [n for n in os.listdir(f"{target}/load=00000001") if n.startswith("part-")]
    assert len(files) == 4


def test_a_job_that_fails_leaves_the_table_as_it_was(spark, target, monkeypatch):
    assert deliver_load(rows(spark, 0, 10), target, "monday")
    with monkeypatch.context() as patch:
        patch.setattr(X, "DeliverySource", failing_writer("always"))
        with pytest.raises(Exception, match="lost after the write"):
            deliver_load(rows(spark, 10, 20), target, "tuesday")
    assert ids(spark, target) == list(range(10)) and staged(target) == []
    assert deliver_load(rows(spark, 10, 20), target, "tuesday")
    assert ids(spark, target) == list(range(20))


def test_staged_rows_are_not_read(spark, target):
    writer = X.DeliveryWriter({"path": target, "load_id": "a", "seen": "0", "attempt": "1"}, SCHEMA, False)
    os.makedirs(writer.staging)
    table = rows(spark, 0, 5).toArrow()
    X.pq.write_table(table, f"{writer.staging}/part-00000-x.parquet")
    X.pq.write_table(table, f"{writer.staging}/part-00000-failed.parquet")
    assert ids(spark, target) == []
    writer.commit([X.Staged("part-00000-x.parquet", 5), X.Staged(None, 0), None])
    assert ids(spark, target) == list(range(5))


def test_of_two_loads_that_meet_one_fails(spark, target, monkeypatch):
    """Both have checked the keys of the same table; both publishing would repeat a key."""
    seen = threading.Event()
    check = X._check_key

    def slow(df, table, key):
        check(df, table, key)
        if not seen.is_set():
            seen.set()
            assert deliver_load(rows(spark, 5, 15), target, "second")

    monkeypatch.setattr(X, "_check_key", slow)
    with pytest.raises(Exception, match="DeliveryConflict|published already"):
        deliver_load(rows(spark, 0, 10), target, "first")
    assert ids(spark, target) == list(range(5, 15)) and staged(target) == []
    with pytest.raises(KeyViolation):
        deliver_load(rows(spark, 0, 10), target, "first")


@pytest.mark.parametrize("wrong", ["twice", "null", "present"])
def test_the_key_is_kept(spark, target, wrong):
    assert deliver_load(rows(spark, 0, 10), target, "monday")
    more = {
        "twice": rows(spark, 20, 25).union(rows(spark, 24, 26)),
        "null": rows(spark, 20, 25).union(rows(spark, 30, 31).withColumn("id", F.lit(None).cast("long"))),
        "present": rows(spark, 9, 12),
    }[wrong]
    with pytest.raises(KeyViolation):
        deliver_load(more, target, "tuesday")
    assert ids(spark, target) == list(range(10))
    assert deliver_load(more, target, "unchecked", check_key=False)


def test_overwrite_replaces_at_once(spark, target):
    deliver_load(rows(spark, 0, 10), target, "monday")
    before = read_delivery(spark, target)
    assert deliver_load(rows(spark, 5, 8, value="y"), target, "tuesday", mode="overwrite")
    assert deliver_load(rows(spark, 8, 9, value="y"), target, "wednesday")
    assert ids(spark, target) == [5, 6, 7, 8]
    assert before.count() == 10  # a reader of the old rows is not disturbed
    assert drop_replaced(target) == 1 and drop_replaced(target) == 0
    assert ids(spark, target) == [5, 6, 7, 8]
    assert not deliver_load(rows(spark, 8, 9), target, "wednesday")


def test_created_anew(spark, target):
    deliver_load(rows(spark, 0, 10), target, "monday")
    create_delivery(target, T.StructType([T.StructField("a b", T.StringType())]), None)
    assert read_delivery(spark, target).columns == ["a b"]
    assert deliver_load(spark.createDataFrame([("x",), ("x",)], "`a b` string"), target, "monday")
    assert read_delivery(spark, target).count() == 2


def test_refused(spark, target):
    with pytest.raises(AnalysisException):
        deliver_load(rows(spark, 0, 1).drop("v"), target, "a")
    with pytest.raises(AnalysisException):
        deliver_load(rows(spark, 0, 1).withColumn("id", F.lit(1)), target, "a")
    with pytest.raises(ValueError, match="load id"):
        deliver_load(rows(spark, 0, 1), target, "../a")
    with pytest.raises(ValueError, match="append"):
        deliver_load(rows(spark, 0, 1), target, "a", mode="ignore")
    with pytest.raises(ValueError, match="mount"):
        create_delivery("s3a://bucket/table")
    with pytest.raises(ValueError, match="key"):
        create_delivery(target, SCHEMA, "other")
    assert issubclass(DeliveryConflict, RuntimeError)


def test_the_job(spark, tmp_path):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    df = spark.range(20).selectExpr("concat('bank ', id) a", "'1' b", "'2' c", "if(id = 3, null, '3') d", "'4' e", "'s' f", "string(id) g")
    df.write.parquet(source)
    assert deliver_files_job(spark, source, target, "one")
    assert not deliver_files_job(spark, source, target, "one")
    got = read_delivery(spark, target)
    assert got.schema == DELIVERY_SCHEMA and got.count() == 20
    with pytest.raises(KeyViolation):
        deliver_files_job(spark, source, target, "two")
    assert deliver_files_job(spark, source, target, "two", variant="replace", nulls_as_empty=True)
    assert read_delivery(spark, target).where("indice_satisfacao_funcionarios_bancos = ''").count() == 1
    assert deliver_files_job(spark, source, target, "one", variant="create")
    assert read_delivery(spark, target).columns == list("abcdefg")
    with pytest.raises(ValueError, match="variant"):
        deliver_files_job(spark, source, target, "x", variant="truncate")

import datetime
import json

import pytest
from pyspark.sql import functions as F

from lakestrata.quality import (
    expect_length_equal,
    expect_match_regex,
    expect_type,
    expect_unique_key,
    key_violations,
    run_suite,
    watch_suite,
    write_dq_report,
)

DAY = datetime.date(2024, 3, 5)
SUITE = [
    expect_match_regex("nome", r"^\D*$"),
    expect_length_equal("cnpj", 12),
    expect_type("n", "int"),
    expect_type("n", "bigint"),
    expect_length_equal("absent", 1),
]


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [("ana", "123456789012", 1), ("b0b", "12345678901", 2), ("", None, 3), (None, "123456789012", None)],
        "nome string, cnpj string, n int",
    )


WANTED = [
    # expectation, column, success, elements, missing, unexpected, percent
    ("expect_column_values_to_match_regex", "nome", False, 4, 1, 1, 100 / 3),
    ("expect_column_value_lengths_to_equal", "cnpj", False, 4, 1, 1, 100 / 3),
    ("expect_column_values_to_be_of_type", "n", True, 4, 1, 0, 0.0),
    ("expect_column_values_to_be_of_type", "n", False, 4, 1, 3, 100.0),
    ("expect_column_value_lengths_to_equal", "absent", False, 4, None, None, None),
]


def flat(report):
    return [
        (r.expectation, r["column"], r.success, r.element_count, r.missing_count, r.unexpected_count, r.unexpected_percent)
        for r in report.collect()
    ]


def test_suite(people):
    report = run_suite(people, SUITE, "Empregados")
    assert report.columns == [
        "table", "suite", "expectation", "column", "success", "element_count",
        "missing_count", "unexpected_count", "unexpected_percent",
    ]
    assert [f if f[-1] is None else (*f[:-1], pytest.approx(f[-1])) for f in WANTED] == flat(report)
    assert {(r.table, r.suite) for r in report.collect()} == {("Empregados", "dq_Empregados")}


def test_suite_reads_the_table_once(people):
    plan = run_suite(people, SUITE, "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1


def test_watch_counts_while_writing(people, tmp_path):
    watch = watch_suite(people, SUITE, "Empregados")
    watch.df.write.parquet(str(tmp_path / "t"))
    assert watch.report().collect() == run_suite(people, SUITE, "Empregados").collect()


@pytest.mark.parametrize("watched", [True, False])
def test_empty_table(spark, tmp_path, watched):
    empty = spark.createDataFrame([], "nome string, cnpj string, n int")
    if watched:
        watch = watch_suite(empty, SUITE, "t")
        watch.df.write.parquet(str(tmp_path / "t"))
        report = watch.report()
    else:
        report = run_suite(empty, SUITE, "t")
    assert [(r.success, r.element_count, r.unexpected_percent) for r in report.collect()] == [
        (True, 0, None), (True, 0, None), (True, 0, None), (False, 0, None), (False, 0, None),
    ]


def test_counts_survive_a_task_that_runs_again(spark, tmp_path):
    def fail_once(batches):
        from pyspark import TaskContext

        for batch in batches:
            yield batch
            if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() % 2 == 0:
                raise RuntimeError("lost")

    df = spark.range(0, 10_000, 1, 8).select(F.col("id").cast("string").alias("nome"))
    watch = watch_suite(df.mapInPandas(fail_once, "nome string"), [expect_match_regex("nome", "^1")], "t")
    watch.df.write.parquet(str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 10_000
    report = watch.report().first()
    assert (report.element_count, report.unexpected_count) == (10_000, 10_000 - 1111)


def test_unique_key(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "cnpj string")
    suite = [expect_unique_key("cnpj"), expect_unique_key("absent")]
    assert flat(run_suite(df, suite, "Banco")) == [
        ("expect_column_values_to_be_unique_key", "cnpj", False, 4, 1, 2, pytest.approx(200 / 3)),
        ("expect_column_values_to_be_unique_key", "absent", False, 4, None, None, None),
    ]
    good = run_suite(df.where("cnpj = 'b'"), suite[:1], "Banco").first()
    assert good.success and good.element_count == 1
    null_only = run_suite(df.where("cnpj is null"), suite[:1], "Banco").first()
    assert not null_only.success
    violations = {r.cnpj: r.n_rows for r in key_violations(df, "cnpj").collect()}
    assert violations == {"a": 2, None: 1}
    with pytest.raises(ValueError):
        watch_suite(df, suite, "Banco")


def test_report_layout_and_second_run(people, spark, tmp_path):
    path = tmp_path / "dq"
    report = run_suite(people, SUITE, "Empregados")
    write_dq_report(report, str(path), DAY)
    write_dq_report(run_suite(people, SUITE[:1], "Banco"), str(path), DAY)
    write_dq_report(run_suite(people, SUITE[:2], "Banco"), str(path), DAY)
    folder = path / "table=Empregados" / "year=2024" / "month=03" / "day=05"
    lines = [json.loads(x) for p in folder.glob("*.json") for x in p.read_text().splitlines()]
    assert len(lines) == 5 and lines[0]["report_date"] == "2024-03-05"
    counts = {r.table: r["count"] for r in spark.read.json(str(path)).groupBy("table").count().collect()}
    assert counts == {"Empregados": 5, "Banco": 2}
    write_dq_report(run_suite(people, SUITE[:2], "Banco"), str(path), DAY, mode="append")
    assert spark.read.json(str(path)).where("table = 'Banco'").count() == 4


def test_raw_headers_find_their_normalised_columns(people):
    suite = [expect_match_regex("Nome", r"^\D*$"), expect_unique_key("CNPJ")]
    report = run_suite(people, suite, "Empregados").collect()
    assert [(r["column"], r.unexpected_count) for r in report] == [("Nome", 1), ("CNPJ", 2)]


def test_column_names_with_dots(spark):
    df = spark.createDataFrame([("a1", None), ("b", 2)], "`x.y` string, `z.w` int")
    suite = [expect_match_regex("x.y", r"^\D*$"), expect_type("z.w", "int"), expect_unique_key("z.w")]
    assert [(r.success, r.missing_count, r.unexpected_count) for r in run_suite(df, suite, "t").collect()] == [
        (False, 0, 1), (True, 1, 0), (False, 1, 0),
    ]

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakestrata.plans import ROUTES, SILVER_ROUTES, SILVER_YEARS, route_job
from lakestrata.sources import (
    concat_by_name,
    land_recursive,
    list_files,
    name_collisions,
    name_year,
    preview,
    read_delimited,
    read_layer,
    read_route,
    route_by_filename,
)

SAMPLE = "Nome,Idade,Cidade\nJoão,30,São Paulo\nMaria,25,Rio de Janeiro\nJosé,35,Belo Horizonte\n"


def write(path, **columns):
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table(columns), path)


def test_sample_text(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(SAMPLE.encode("utf-8"))
    df = read_delimited(spark, str(tmp_path))
    assert df.dtypes == [("Nome", "string"), ("Idade", "int"), ("Cidade", "string")]
    assert df.where("Idade > 26").count() == 2
    lines = preview(spark, str(tmp_path), 2).collect()
    assert [r.value for r in lines] == ["Nome,Idade,Cidade", "João,30,São Paulo"]


def test_latin1_text_with_a_dash_of_another_code_page(spark, tmp_path):
    text = b"Institui\xe7\xe3o;Clientes \x96 CCS\nITA\xda;12\n"
    (tmp_path / "a.csv").write_bytes(text)
    df = read_delimited(spark, str(tmp_path), separator=";", encoding="ISO-8859-1")
    assert df.columns == ["Instituição", "Clientes \x96 CCS"]
    assert tuple(df.first()) == ("ITAÚ", 12)


@pytest.mark.parametrize("separator", ["\t", "|"])
def test_other_separators_and_a_given_schema(spark, tmp_path, separator):
    (tmp_path / "a.tsv").write_bytes(separator.join(["a", "b"]).encode() + b"\n" + separator.join("12").encode())
    df = read_delimited(spark, str(tmp_path), separator=separator, schema="a string, b bigint")
    assert [tuple(r) for r in df.collect()] == [("1", 2)]


def test_concat_fills_missing_columns(spark, tmp_path, rows):
    write(tmp_path / "a" / "x.parquet", id=[1], a=["p"])
    write(tmp_path / "b" / "x.parquet", id=[2], b=[2.5])
    (tmp_path / "_SUCCESS").write_bytes(b"")
    out = concat_by_name(spark, str(tmp_path))
    assert rows(out.select("id", "a", "b")) == [(1, "p", None), (2, None, 2.5)]


def test_concat_widens_types_that_differ(spark, tmp_path, rows):
    write(tmp_path / "x1.parquet", id=[1], n=pa.array([7], pa.int64()))
    write(tmp_path / "x2.parquet", id=[2], n=pa.array([0.5], pa.float64()))
    write(tmp_path / "x3.parquet", id=[3], n=pa.array([None], pa.float64()), extra=["e"])
    out = concat_by_name(spark, str(tmp_path), provenance="file")
    assert dict(out.dtypes)["n"] == "double"
    assert rows(out.select("id", "n", "extra", "file")) == [
        (1, 7.0, None, "x1.parquet"),
        (2, 0.5, None, "x2.parquet"),
        (3, None, "e", "x3.parquet"),
    ]


def test_concat_of_columns_that_are_empty_or_differ_in_case(spark, tmp_path, rows):
    write(tmp_path / "x1.parquet", id=[1], fee=pa.nulls(1), flag=pa.nulls(1), Extra=[1])
    write(tmp_path / "x2.parquet", id=[2], fee=[2.5], flag=["Y"], extra=[0.5])
    out = concat_by_name(spark, str(tmp_path))
    assert [(c.lower(), t) for c, t in out.dtypes] == [
        ("id", "bigint"), ("fee", "double"), ("flag", "string"), ("extra", "double"),
    ]
    assert rows(out) == [(1, None, None, 1.0), (2, 2.5, "Y", 0.5)]


def test_name_year(spark):
    names = ["a_2019-01", "a_20220-12", "a_latest", "v1_1999_2020", None]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    got = [r.y for r in df.select("i", name_year(F.col("n")).alias("y")).orderBy("i").collect()]
    assert got == [2019, 2022, None, 1999, None]


FILES = [
    "green_tripdata_2018-12.parquet",
    "green_tripdata_2019-01.parquet",
    "yellow_tripdata_2022-12.parquet",
    "yellow_tripdata_2023-01.parquet",
    "fhv_tripdata_2020-01.parquet",
    "fhvhv_tripdata_2020-01.parquet",
    "green_tripdata_latest.parquet",
    "green_tripdata_1234_2020.parquet",
]


@pytest.fixture
def raw(tmp_path):
    for i, name in enumerate(FILES):
        write(tmp_path / "raw" / ("deep" if i % 2 else ".") / name, id=[i], name=[name])
    return tmp_path / "raw"


def routed(spark, path):
    return sorted(r.name for r in read_layer(spark, str(path)).select("name").collect())


def test_routes_with_years(spark, raw, tmp_path):
    route_job(spark, str(raw), str(tmp_path / "silver"), SILVER_ROUTES, SILVER_YEARS)
    assert routed(spark, tmp_path / "silver" / "green") == ["green_tripdata_2019-01.parquet"]
    assert routed(spark, tmp_path / "silver" / "yellow") == ["yellow_tripdata_2022-12.parquet"]
    assert sorted(p.name for p in (tmp_path / "silver").iterdir()) == ["green", "yellow"]


def test_routes_without_years_are_disjoint_and_whole(spark, raw, tmp_path):
    route_job(spark, str(raw), str(tmp_path / "silver"), ROUTES, None)
    parts = {c: routed(spark, tmp_path / "silver" / c) for c in ROUTES}
    assert parts["fhv"] == ["fhv_tripdata_2020-01.parquet"]
    assert parts["fhvhv"] == ["fhvhv_tripdata_2020-01.parquet"]
    assert sorted(sum(parts.values(), [])) == sorted(FILES)


def test_a_category_without_files_is_left_out(spark, tmp_path):
    write(tmp_path / "raw" / "green_tripdata_2019-01.parquet", id=[1])
    write(tmp_path / "raw" / "yellow_tripdata_2018-01.parquet", id=[2])
    route_job(spark, str(tmp_path / "raw"), str(tmp_path / "silver"))
    assert [p.name for p in (tmp_path / "silver").iterdir()] == ["green"]


def test_files_outside_the_route_are_not_opened(spark, raw):
    (raw / "green_tripdata_2018-01.parquet").write_bytes(b"not parquet")
    (raw / "notes_2019.txt").write_bytes(b"text")
    out = read_route(spark, str(raw), "green_tripdata_", (2019, 2022), provenance="file")
    assert [r.file for r in out.collect()] == ["green_tripdata_2019-01.parquet"]


def test_route_with_types_that_differ(spark, tmp_path, rows):
    write(tmp_path / "green_tripdata_2019-01.parquet", n=pa.array([1], pa.int64()))
    write(tmp_path / "green_tripdata_2020-01.parquet", n=pa.array([2.5], pa.float64()))
    write(tmp_path / "green_tripdata_1111_2020.parquet", n=["excluded"])
    out = read_route(spark, str(tmp_path), "green_tripdata_", (2019, 2022))
    assert out.dtypes == [("n", "double")]
    assert rows(out) == [(1.0,), (2.5,)]


@pytest.mark.parametrize(
    "name, belongs",
    [
        ("t_v2_2020.parquet", True),
        ("t_12_2020.parquet", True),
        ("t_1234_2020.parquet", False),
        ("t_20205.parquet", True),
        ("t_12020.parquet", False),
        ("t_.parquet", False),
        ("T_2020.parquet", False),
    ],
)
def test_year_of_unusual_names(spark, tmp_path, name, belongs):
    write(tmp_path / "t_2019.parquet", id=[0])
    write(tmp_path / name, id=[1])
    found = read_route(spark, str(tmp_path), "t_", (2019, 2022), provenance="f").collect()
    assert sorted(r.f for r in found) == sorted(["t_2019.parquet"] + [name] * belongs)


def test_prefix_that_ends_in_digits(spark, tmp_path):
    write(tmp_path / "t12019.parquet", id=[0])
    write(tmp_path / "t1_2019.parquet", id=[1])
    assert [r.id for r in read_route(spark, str(tmp_path), "t1", (2019, 2022)).collect()] == [1]


def test_usual_names_need_no_test_per_row(spark, raw):
    df = read_route(spark, str(raw), "yellow_tripdata_", (2019, 2022))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "DataFilters: []" in text and " Filter " not in text


def test_route_rows_by_a_column(spark, rows):
    df = spark.createDataFrame([(n,) for n in FILES], "f string")
    out = route_by_filename(df, "f", "yellow_tripdata_", (2019, 2022))
    assert rows(out) == [("yellow_tripdata_2022-12.parquet",)]


def test_landing_reports_names_that_meet(spark, tmp_path, rows):
    write(tmp_path / "a" / "x.parquet", id=[1])
    write(tmp_path / "b" / "c" / "x.parquet", id=[2])
    write(tmp_path / "b" / "y.parquet", id=[3])
    landed = land_recursive(spark, str(tmp_path))
    assert rows(landed) == [(1, "x.parquet"), (2, "x.parquet"), (3, "y.parquet")]
    files = list_files(spark, str(tmp_path))
    assert files.count() == 3
    found = name_collisions(files).collect()
    assert [(r.file_name, r.n_files) for r in found] == [("x.parquet", 2)]
    assert found[0].first_path.endswith("/a/x.parquet")
    assert found[0].last_path.endswith("/b/c/x.parquet")


def test_paths_with_spaces_and_marks(spark, tmp_path, rows):
    root = tmp_path / "trip data"
    write(root / "a b" / "x é 1.parquet", id=[1], n=pa.array([1], pa.int64()))
    write(root / "c%20d" / "x+2.parquet", id=[2], n=pa.array([2.5], pa.float64()))
    wanted = [(1, 1.0, "x é 1.parquet"), (2, 2.5, "x+2.parquet")]
    assert rows(land_recursive(spark, str(root))) == wanted
    assert rows(list_files(spark, str(root)).select("file_name")) == [(w[2],) for w in wanted]
    one = land_recursive(spark, str(root / "a b"))
    assert rows(one) == [(1, 1, "x é 1.parquet")]


def test_partition_columns_survive_concatenation_and_landing(spark, tmp_path, rows):
    df = spark.range(6).selectExpr("id", "id % 3 as part")
    df.write.partitionBy("part").parquet(f"{tmp_path}/deep/layer")
    spark.range(10, 12).write.parquet(f"{tmp_path}/flat/a")
    wanted = [(i, i % 3) for i in range(6)]
    layer = concat_by_name(spark, f"{tmp_path}/deep/layer")
    assert rows(layer.select("id", "part")) == wanted
    assert rows(land_recursive(spark, f"{tmp_path}/deep").select("id", "part")) == wanted
    both = concat_by_name(spark, str(tmp_path))
    assert rows(both.select("id", "part")) == sorted([*wanted, (10, None), (11, None)], key=repr)
    chosen = layer.where("part = 1")
    assert "part" in chosen._jdf.queryExecution().executedPlan().toString().split("PartitionFilters:")[1][:60]


def test_a_given_schema_replaces_the_footers(spark, tmp_path, rows):
    spark.range(2).write.parquet(f"{tmp_path}/a")
    df = concat_by_name(spark, str(tmp_path), schema="id bigint, more string")
    assert df.columns == ["id", "more"] and rows(df) == [(0, None), (1, None)]
    landed = land_recursive(spark, str(tmp_path), schema="id bigint")
    assert landed.columns == ["id", "source_file"] and landed.count() == 2


def test_types_that_differ_in_a_partitioned_layer(spark, tmp_path, rows):
    spark.range(2).write.parquet(f"{tmp_path}/d=1")
    spark.range(2, 4).selectExpr("cast(id as double) id").write.parquet(f"{tmp_path}/d=2")
    df = concat_by_name(spark, str(tmp_path))
    assert rows(df.select("id", "d")) == [(0.0, 1), (1.0, 1), (2.0, 2), (3.0, 2)]


def test_folders_above_the_path_are_no_partitions(spark, tmp_path, rows):
    spark.range(2).write.parquet(f"{tmp_path}/run=5/raw/a")
    spark.range(9).write.parquet(f"{tmp_path}/run=6/raw/a")
    df = concat_by_name(spark, f"{tmp_path}/run=5/raw")
    assert df.columns == ["id"] and rows(df) == [(0,), (1,)]
    assert concat_by_name(spark, f"file://{tmp_path}").columns == ["id", "run"]


def test_folders_of_a_layer_are_listed_in_few_tasks(spark, tmp_path):
    """A session's own number stays."""
    number = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(number, None)
    path = str(tmp_path / "layer")
    spark.range(60).selectExpr("id", "id % 50 as k").write.partitionBy("k").parquet(path)
    try:
        spark.conf.unset(number)
        assert read_layer(spark, path).count() == 60
        assert int(spark.conf.get(number)) == 4 * spark.sparkContext.defaultParallelism
        spark.conf.set(number, "7")
        assert read_layer(spark, path).count() == 60
        assert spark.conf.get(number) == "7"
    finally:
        spark.conf.unset(number)
        if before is not None:
            spark.conf.set(number, before)

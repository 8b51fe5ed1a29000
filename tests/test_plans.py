import datetime

import pytest
from pyspark.sql import functions as F

from lakestrata import plans
from lakestrata.cli import main
from lakestrata.plans import (
    GOLD_COLUMNS,
    clean_source_job,
    deliver_job,
    delivery_table_job,
    export_jdbc_job,
    gold_job,
    silver_job,
)
from lakestrata.plans import delivery as delivery_plans
from lakestrata.quality import DataQualityError, expect_unique_key
from lakestrata.sinks import DELIVERY_SCHEMA, write_layer
from lakestrata.sources import read_layer

DAY = datetime.date(2024, 3, 5)

COMPLAINTS = (
    b"Institui\xe7\xe3o financeira;Quantidade total de reclama\xe7\xf5es;"
    b"Quantidade total de clientes \x96 CCS e SCR\n"
    b"  ITA\xda (Conglomerado);10; \n"
    b"Ita\xfa;5;1500000\n"
    b"\xd3timo BANCO - PRUDENCIAL;;20\n"
    b"Sem par;1;1\n"
)
BANKS = "Segmento\tCNPJ\tNome\nS1\t123456789012\tITAÚ\nS2\t12345678901\tItaú\nS1\t\tÓtimo Banco\n"
EMPLOYEES = (
    "Nome|Geral|Remuneração e benefícios\nItaú|4|3.5\nitau|5|-\nÓtimo Banco (Conglomerado)||\n|3|3\nBanco 1|1|1\n"
)


@pytest.fixture
def sources(tmp_path):
    for name, text in (("Reclamacoes", COMPLAINTS), ("Banco", BANKS.encode()), ("Empregados", EMPLOYEES.encode())):
        (tmp_path / "source" / name).mkdir(parents=True)
        (tmp_path / "source" / name / "part.csv").write_bytes(text)
    return tmp_path


def clean(spark, root, table, **options):
    return clean_source_job(
        spark, f"{root}/source/{table}", f"{root}/target/{table}", f"{root}/dq", DAY, table=table, **options
    )


WANTED_DELIVERY = [
    ("itau", "15.00", "1,500,000.00", "4.50", "3.50", "s1", "123456789012"),
    ("itau", "15.00", "1,500,000.00", "4.50", "3.50", "s2", "12345678901"),
    ("otimo banco", None, "20.00", None, None, "s1", None),
]


def test_bank_jobs(spark, sources, rows):
    reports = {t: clean(spark, sources, t).collect() for t in ("Reclamacoes", "Banco", "Empregados")}
    complaints = read_layer(spark, f"{sources}/target/Reclamacoes")
    assert complaints.columns == [
        "instituicao_financeira",
        "quantidade_total_de_reclamacoes",
        "quantidade_total_de_clientes__ccs_e_scr",
    ]
    assert [r.success for r in reports["Banco"]] == [False]
    assert [(r.missing_count, r.unexpected_count) for r in reports["Banco"]] == [(1, 1)]
    # "banco 1" has a digit; the empty name is read as null.
    assert [(r.element_count, r.missing_count, r.unexpected_count) for r in reports["Empregados"]] == [(5, 1, 1)]
    assert [r.success for r in reports["Reclamacoes"]] == [False]

    target = f"{sources}/delivery"
    delivery_table_job(
        spark, *[f"{sources}/target/{t}" for t in ("Reclamacoes", "Empregados", "Banco")], target
    )
    table = read_layer(spark, target)
    assert table.columns == [
        "instituicao_financeira",
        "sum_quantidade_total_de_reclamacoes",
        "sum_quantidade_total_de_clientes__ccs_e_scr",
        "avg_geral",
        "avg_remuneracao_e_beneficios",
        "segmento",
        "cnpj",
    ]
    assert rows(table) == sorted(WANTED_DELIVERY, key=repr)


def test_bank_jobs_from_the_command_line(spark, sources, rows):
    for table in ("Reclamacoes", "Banco", "Empregados"):
        main(["clean-source", "--table", table, "--source", f"{sources}/source/{table}",
              "--target", f"{sources}/target/{table}", "--report", f"{sources}/dq",
              "--run-date", "2024-03-05"])
    main(["delivery-table", "--complaints", f"{sources}/target/Reclamacoes",
          "--employees", f"{sources}/target/Empregados", "--banks", f"{sources}/target/Banco",
          "--target", f"{sources}/delivery"])
    assert rows(read_layer(spark, f"{sources}/delivery")) == sorted(WANTED_DELIVERY, key=repr)
    assert spark.read.json(f"{sources}/dq").count() == 3


def test_text_kept_as_text_gives_the_same_measures(spark, sources, rows):
    for table in ("Reclamacoes", "Banco", "Empregados"):
        clean(spark, sources, table, infer=False)
    banks = read_layer(spark, f"{sources}/target/Banco")
    assert {t for _, t in banks.dtypes} == {"string"}
    delivery_table_job(
        spark, *[f"{sources}/target/{t}" for t in ("Reclamacoes", "Empregados", "Banco")], f"{sources}/d"
    )
    as_text = [(*w[:-1], None if w[-1] is None else str(w[-1])) for w in WANTED_DELIVERY]
    assert rows(read_layer(spark, f"{sources}/d")) == sorted(as_text, key=repr)


def test_failing_suite_can_stop_the_job(spark, sources):
    with pytest.raises(DataQualityError, match="Banco"):
        clean(spark, sources, "Banco", on_failure="raise")
    assert not (sources / "target").exists()
    assert spark.read.json(f"{sources}/dq").count() == 1
    with pytest.raises(ValueError):
        clean(spark, sources, "Banco", on_failure="ignore")


def test_key_rules_and_own_suites(spark, sources):
    report = clean(spark, sources, "Banco", suite=[expect_unique_key("nome")]).collect()
    assert [(r.success, r.unexpected_count) for r in report] == [(False, 2)]
    assert read_layer(spark, f"{sources}/target/Banco").count() == 3


def test_unknown_table_needs_its_format(spark, sources):
    with pytest.raises(ValueError, match="separator"):
        clean(spark, sources, "Outra")
    (sources / "source" / "Outra").mkdir()
    (sources / "source" / "Outra" / "x.csv").write_text("Nome,N\nÁ - prudencial,1\n")
    report = clean(spark, sources, "Outra", separator=",", encoding="utf-8", entity_column="nome")
    assert [r["column"] for r in report.collect()] == ["quantidade_total_de_clientes__ccs_e_scr"]
    assert read_layer(spark, f"{sources}/target/Outra").first().nome == "a"


def test_targets_must_not_overlap_sources(spark, sources):
    with pytest.raises(ValueError, match="overlap"):
        clean_source_job(spark, "/x/a", "/x/a/b", "/x/dq", DAY, table="Banco")
    with pytest.raises(ValueError, match="overlap"):
        delivery_table_job(spark, "/x/a", "/x/b", "/x/c", "/x")
    with pytest.raises(ValueError, match="overlap"):
        silver_job(spark, "green", "/x", "/x")


def trips(spark, prefix, payment, n=6):
    """Row 1 has a null pickup, row 2 nulls in every defaulted column, rows 3 and 4 are equal."""
    columns = {
        "VendorID": "cast(1 as bigint)",
        f"{prefix}_pickup_datetime": "if(id = 1, null, timestamp'2020-01-01 23:59:59' + make_interval(0, 0, 0, cast(id % 3 as int)))",
        f"{prefix}_dropoff_datetime": "timestamp'2020-01-05 00:00:00'",
        "RatecodeID": "if(id = 2, null, 2.0D)",
        "PULocationID": "cast(10 as bigint)",
        "DOLocationID": "cast(11 as bigint)",
        "passenger_count": "if(id = 2, null, 3.0D)",
        "trip_distance": "1.5D",
        "fare_amount": "2.5D",
        "extra": "0.5D",
        "mta_tax": "0.5D",
        "tip_amount": "1.0D",
        "tolls_amount": "0.0D",
        "improvement_surcharge": "if(id = 2, null, 0.3D)",
        "total_amount": "9.5D",
        "payment_type": f"if(id = 2, null, cast(1 as {payment}))",
        "other": "'dropped'",
    }
    if prefix == "lpep":
        columns["trip_type"] = "if(id = 2, null, 2.0D)"
    return spark.range(n).selectExpr("*", *[f"{v} as {c}" for c, v in columns.items()]).drop("id")


@pytest.fixture
def layers(spark, tmp_path):
    for colour, prefix, payment in (("yellow", "tpep", "bigint"), ("green", "lpep", "double")):
        write_layer(trips(spark, prefix, payment), f"{tmp_path}/raw/{colour}")
        silver_job(spark, colour, f"{tmp_path}/raw/{colour}", f"{tmp_path}/silver/{colour}")
    gold_job(spark, {c: f"{tmp_path}/silver/{c}" for c in ("yellow", "green")}, f"{tmp_path}/gold")
    return tmp_path


def test_silver(spark, layers):
    green = read_layer(spark, f"{layers}/silver/green")
    yellow = read_layer(spark, f"{layers}/silver/yellow")
    assert len(green.columns) == 18 and len(yellow.columns) == 17
    assert green.count() == 6 and yellow.count() == 5
    assert green.where("partition_date is null").count() == 1
    assert (layers / "silver/green/partition_date=__HIVE_DEFAULT_PARTITION__").exists()
    assert yellow.where("rate_code_id is null").count() == 0
    # The other defaults belong to gold.
    assert green.where("passenger_count is null and payment_type is null and trip_type is null").count() == 1
    days = {str(r.partition_date): r["count"] for r in yellow.groupBy("partition_date").count().collect()}
    assert days == {"2020-01-01": 2, "2020-01-02": 1, "2020-01-03": 2}


def test_gold(spark, layers):
    gold = read_layer(spark, f"{layers}/gold")
    assert gold.columns == GOLD_COLUMNS and len(GOLD_COLUMNS) == 19
    assert gold.count() == 11
    types = dict(gold.dtypes)
    assert (types["payment_type"], types["trip_type"], types["partition_date"]) == ("double", "double", "date")
    defaulted = gold.where("rate_code_id = 1").collect()
    assert [
        (r.passenger_count, r.improvement_surcharge, r.payment_type) for r in defaulted
    ] == [(1.0, 0.0, 5.0)] * 2
    assert {r.taxi_type: r.trip_type for r in defaulted} == {"yellow": None, "green": 1.0}
    assert gold.where("taxi_type = 'yellow' and trip_type is not null").count() == 0


def test_silver_has_one_file_a_date_at_any_number_of_shuffle_partitions(spark, tmp_path, with_conf):
    """The shuffle partitions are too large for one task each, the dates are not."""
    with_conf(
        spark__sql__shuffle__partitions="4",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="1k",
    )
    raw = trips(spark, "lpep", "double").limit(1).crossJoin(spark.range(0, 40_000, 1, 8)).selectExpr(
        "* except (id, lpep_pickup_datetime, fare_amount, extra, total_amount)",
        "if(id % 201 = 200, null, timestamp_seconds(1577836800 + 86400 * (id % 201))) as lpep_pickup_datetime",
        *[f"rand({seed}) as {c}" for seed, c in enumerate(("fare_amount", "extra", "total_amount"))],
    )
    write_layer(raw, f"{tmp_path}/raw")
    silver_job(spark, "green", f"{tmp_path}/raw", f"{tmp_path}/silver")
    files = [len(list(p.glob("*.parquet"))) for p in (tmp_path / "silver").iterdir() if p.is_dir()]
    assert len(files) == 201 and sum(files) == 201
    assert read_layer(spark, f"{tmp_path}/silver").count() == 40_000


def test_gold_as_a_view(spark, layers):
    read_layer(spark, f"{layers}/gold").createOrReplaceTempView("trips")
    found = spark.sql("select taxi_type, count(*) n from trips group by all order by 1").collect()
    assert [tuple(r) for r in found] == [("green", 6), ("yellow", 5)]


def test_taxi_jobs_from_the_command_line(spark, tmp_path):
    import shutil

    for colour, prefix in (("yellow", "tpep"), ("green", "lpep")):
        write_layer(trips(spark, prefix, "bigint").coalesce(1), f"{tmp_path}/tmp/{colour}")
        (tmp_path / "raw").mkdir(exist_ok=True)
        part = next((tmp_path / "tmp" / colour).glob("*.parquet"))
        for year in (2018, 2021):
            shutil.copy(part, tmp_path / "raw" / f"{colour}_tripdata_{year}-01.parquet")
    main(["route", "--source", f"{tmp_path}/raw", "--target", f"{tmp_path}/routed"])
    for colour in ("yellow", "green"):
        main(["silver", "--colour", colour, "--source", f"{tmp_path}/routed/{colour}",
              "--target", f"{tmp_path}/silver/{colour}"])
    main(["silver", "--colour", "green", "--source", f"{tmp_path}/raw", "--from-raw",
          "--target", f"{tmp_path}/direct"])
    direct, routed = (read_layer(spark, f"{tmp_path}/{p}") for p in ("direct", "silver/green"))
    assert direct.columns == routed.columns
    assert direct.exceptAll(routed).isEmpty() and routed.exceptAll(direct).isEmpty()
    main(["gold", "--yellow", f"{tmp_path}/silver/yellow", "--green", f"{tmp_path}/silver/green",
          "--target", f"{tmp_path}/gold"])
    assert read_layer(spark, f"{tmp_path}/gold").count() == 11


@pytest.fixture
def written(monkeypatch):
    """What the jobs hand to the database writer."""
    calls = []

    def record(df, url, table, properties, **options):
        calls.append((df, url, table, properties, options))

    monkeypatch.setattr(delivery_plans, "write_jdbc", record)
    return calls


def delivered(spark, path, keys):
    df = spark.createDataFrame(
        [(f"b{i}", "1", "2", "3", "4", "s1", k) for i, k in enumerate(keys)],
        "a string, b string, c string, d string, e string, f string, g string",
    )
    write_layer(df, path)


def test_append_by_position(spark, tmp_path, written):
    delivered(spark, f"{tmp_path}/d", ["1", "2"])
    deliver_job(spark, f"{tmp_path}/d", "jdbc:x", "t", {"user": "u"}, connections=2)
    df, url, table, properties, options = written[0]
    assert df.columns == DELIVERY_SCHEMA.names and df.count() == 2
    assert (url, table, options) == ("jdbc:x", "t", {"mode": "append", "connections": 2})


@pytest.mark.parametrize("keys", [["1", "1"], ["1", None]])
def test_append_checks_the_key(spark, tmp_path, written, keys):
    delivered(spark, f"{tmp_path}/d", keys)
    with pytest.raises(DataQualityError, match="cnpj"):
        deliver_job(spark, f"{tmp_path}/d", "jdbc:x", "t", {})
    assert written == []
    deliver_job(spark, f"{tmp_path}/d", "jdbc:x", "t", {}, check_key=False)
    assert len(written) == 1


def test_replace_keeps_names(spark, tmp_path, written):
    delivered(spark, f"{tmp_path}/d", ["1", "1"])
    deliver_job(spark, f"{tmp_path}/d", "jdbc:x", "t", {}, variant="replace")
    export_jdbc_job(spark, f"{tmp_path}/d", "jdbc:x", "t", {}, truncate=True)
    assert [c[0].columns for c in written] == [list("abcdefg")] * 2
    assert [c[4] for c in written] == [{"mode": "overwrite"}, {"truncate": True}]
    with pytest.raises(ValueError):
        deliver_job(spark, f"{tmp_path}/d", "jdbc:x", "t", {}, variant="upsert")

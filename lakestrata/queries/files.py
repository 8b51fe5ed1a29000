"""Jobs, sources and sinks: the given tables written to the work folder and read again."""

import datetime
import os
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from lakestrata import storage
from lakestrata.operators import union_by_name
from lakestrata.plans import (
    BANK_SOURCES,
    ROUTES,
    clean_source_job,
    delivery_table_job,
    gold_job,
    land_new_job,
    read_landed,
    route_job,
    silver_job,
)
from lakestrata.quality import expect_length_equal, expect_unique_key, read_dq_report, write_dq_report
from lakestrata.queries import bank, quality, tables as t
from lakestrata.session import work_folder
from lakestrata.sinks import (
    create_delivery,
    deliver_load,
    drop_versions,
    read_delivery,
    write_delimited,
    write_layer,
)
from lakestrata.sources import (
    concat_by_name,
    land_recursive,
    list_files,
    name_collisions,
    preview,
    read_delimited,
    read_layer,
    stage_delimited,
)

_DAY = datetime.date(2024, 3, 5)


def _text_source(spark, sf_dir, root, name, raw):
    source = BANK_SOURCES[name]
    path = os.path.join(root, "source", name)
    write_delimited(
        raw(spark, sf_dir),
        path,
        separator=source.separator,
        header=True,
        encoding=source.encoding,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return path


def delimited_round_trip(spark, sf_dir):
    """`;`-separated ISO-8859-1 text with inferred types."""
    root = work_folder(spark, "delimited")
    path = _text_source(spark, sf_dir, root, "Reclamacoes", t.complaints)
    return read_delimited(spark, path, separator=";", encoding="ISO-8859-1").toDF(
        "name", "complaints", "clients"
    )


def headerless_round_trip(spark, sf_dir):
    path = work_folder(spark, "headerless")
    write_delimited(t.table(spark, sf_dir, "customer"), path)
    return spark.read.csv(
        path,
        sep=";",
        schema="c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    )


def _by_day(spark, sf_dir):
    """Orders partitioned by day; every seventh has none."""
    path = work_folder(spark, "partitioned")
    orders = t.table(spark, sf_dir, "orders").selectExpr(
        "*", "if(o_orderkey % 7 = 0, null, to_date(o_orderdate)) as partition_date"
    )
    write_layer(orders, path, partition_by="partition_date", file_bytes=256 << 20)
    return path


def partitioned_round_trip(spark, sf_dir):
    """A dataset partitioned by date, read back whole."""
    return read_layer(spark, _by_day(spark, sf_dir))


def partitioned_range(spark, sf_dir):
    """A dataset partitioned by date, read back for a range of dates."""
    return read_layer(spark, _by_day(spark, sf_dir)).where("partition_date >= date'1997-01-01'")


def concat_partitioned(spark, sf_dir):
    """A partitioned layer keeps its partition column."""
    return concat_by_name(spark, _by_segment(spark, sf_dir))


def _by_segment(spark, sf_dir):
    path = work_folder(spark, "by-segment")
    write_layer(t.table(spark, sf_dir, "customer"), path, partition_by="c_mktsegment")
    return path


def concat_with_schema(spark, sf_dir):
    """Columns of a given schema, also ones that no file has; no footer is read first."""
    root = work_folder(spark, "concat-schema")
    customers = t.table(spark, sf_dir, "customer")
    write_layer(customers.select("c_custkey", "c_name"), f"{root}/a")
    write_layer(customers.select("c_custkey", "c_acctbal"), f"{root}/b")
    return concat_by_name(
        spark, root, schema="c_custkey bigint, c_name string, c_acctbal double, c_phone string"
    )


def concat_files(spark, sf_dir):
    """Datasets that differ in their columns and in the type of one."""
    root = work_folder(spark, "concat")
    customers = t.table(spark, sf_dir, "customer")
    whole = customers.selectExpr("c_custkey", "cast(c_nationkey as bigint) as amount", "c_name")
    exact = customers.selectExpr("c_custkey", "c_acctbal as amount", "c_mktsegment")
    write_layer(whole, os.path.join(root, "a"))
    write_layer(exact, os.path.join(root, "b"))
    return concat_by_name(spark, root)


def concat_files_by_name(spark, sf_dir):
    root = work_folder(spark, "concat-by-name")
    customers = t.table(spark, sf_dir, "customer")
    write_layer(customers.select("c_custkey", "c_name"), f"{root}/a")
    write_layer(customers.select("c_acctbal", "c_custkey"), f"{root}/b")
    return concat_by_name(spark, root)


def union_tables(spark, sf_dir):
    customers = t.table(spark, sf_dir, "customer")
    return union_by_name(
        customers.select("c_custkey", "c_name"), customers.select("c_acctbal", "c_custkey")
    )


def _named_file(df, root, name):
    """Write a table as one parquet file of that name, by way of Spark's own file system."""
    staged = f"{root}/_staged/{uuid.uuid4().hex}"
    df.coalesce(1).write.parquet(staged)
    (part,) = [n for n in storage.children(df.sparkSession, staged) if n.startswith("part-")]
    storage.rename(df.sparkSession, f"{staged}/{part}", f"{root}/{name}")


def _named_files(df, column, root, names):
    """Write a table as parquet files named by a column: `names` gives the start of a value's names, a number follows.

    One pass over the table, in as many tasks as read it, each of which writes a file for each of its
    values. A value without rows gets one empty file.
    """
    spark, staged = df.sparkSession, f"{root}/_staged/{uuid.uuid4().hex}"
    df.write.partitionBy(column).parquet(staged)
    for value, name in names.items():
        folder = f"{staged}/{column}={value}"
        parts = [n for n in storage.children(spark, folder) if n.startswith("part-")]
        for number, part in enumerate(parts, 1):
            storage.rename(spark, f"{folder}/{part}", f"{root}/{name}-{number:02d}.parquet")
        if not parts:
            _named_file(df.drop(column).limit(0), root, f"{name}-01.parquet")


def _supplier_files(spark, sf_dir):
    """Suppliers of each region of nations as one file; two folders use one base name."""
    root = work_folder(spark, "landing")
    suppliers = t.table(spark, sf_dir, "supplier")
    _named_file(suppliers.where("s_nationkey % 3 = 0"), root, "x/some.parquet")
    _named_file(suppliers.where("s_nationkey % 3 = 1"), root, "y/z/some.parquet")
    _named_file(suppliers.where("s_nationkey % 3 = 2"), root, "y/other.parquet")
    return root


def landed(spark, sf_dir):
    """Files at several depths as one table, with the name each row came from."""
    return land_recursive(spark, _supplier_files(spark, sf_dir))


def landed_partitions(spark, sf_dir):
    """A partitioned layer landed with its partition column."""
    return land_recursive(spark, _by_segment(spark, sf_dir)).drop("source_file")


def names_that_meet(spark, sf_dir):
    """Base names that lie in several folders."""
    root = _supplier_files(spark, sf_dir)
    below = F.length(F.regexp_extract("first_path", "^(.*/landing-[^/]*/)", 1)) + 1
    return name_collisions(list_files(spark, root)).select(
        "file_name",
        "n_files",
        F.substr("first_path", below).alias("first_path"),
        F.substr("last_path", below).alias("last_path"),
    )


def text_preview(spark, sf_dir):
    """The first lines of one text file, written in the order of the names."""
    path = work_folder(spark, "preview")
    names = t.table(spark, sf_dir, "nation").select("n_name")
    names.coalesce(1).sortWithinPartitions("n_name").write.text(path)
    return preview(spark, path, 20)


def temporary_view(spark, sf_dir):
    """A layer queried by name in SQL."""
    path = work_folder(spark, "view")
    write_layer(t.table(spark, sf_dir, "orders"), path)
    read_layer(spark, path).createOrReplaceTempView("layer_of_orders")
    return spark.sql(
        "select o_orderpriority, count(*) as n_orders, max(o_totalprice) as largest"
        " from layer_of_orders group by o_orderpriority"
    )


_TRIP_YEARS = (1994, 1998)


def _raw_trip_files(spark, sf_dir):
    """Trips as raw files by category and year, besides files without a year."""
    root = work_folder(spark, "raw-trips")
    categories = {
        "green": (t.green_trips(spark, sf_dir), "lpep_dropoff_datetime"),
        "yellow": (t.yellow_trips(spark, sf_dir), "tpep_dropoff_datetime"),
        "fhv": (t.yellow_trips(spark, sf_dir).select("VendorID", "tpep_dropoff_datetime"), "tpep_dropoff_datetime"),
    }
    for name, (trips, day) in categories.items():
        names = {str(year): f"{name}_tripdata_{year}" for year in range(1992, 1999)}
        year = F.year(day)
        dated = trips.withColumn("__file", F.when(year > 1998, "latest").when(year >= 1992, year.cast("string")))
        _named_files(dated.where("__file is not null"), "__file", root, names | {"latest": f"{name}_tripdata_latest"})
    return root


def routed_years(spark, sf_dir):
    """The routed copy of each colour's files of some years."""
    raw, target = _raw_trip_files(spark, sf_dir), work_folder(spark, "routed")
    route_job(spark, raw, target, years=_TRIP_YEARS)
    parts = [
        read_layer(spark, f"{target}/{c}").select(F.lit(c).alias("category"), "DOLocationID", day)
        for c, day in (("green", "lpep_dropoff_datetime"), ("yellow", "tpep_dropoff_datetime"))
    ]
    return parts[0].union(parts[1]).withColumnRenamed("lpep_dropoff_datetime", "dropoff")


def routed_categories(spark, sf_dir):
    """Every category without a choice of years; a category without files is left out."""
    raw, target = _raw_trip_files(spark, sf_dir), work_folder(spark, "routed-all")
    route_job(spark, raw, target, routes=ROUTES, years=None)
    parts = [
        read_layer(spark, f"{target}/{c}").select(F.lit(c).alias("category"), "VendorID")
        for c in ("green", "yellow", "fhv")
    ]
    return parts[0].union(parts[1]).union(parts[2])


def silver_from_raw(spark, sf_dir):
    """Silver straight from the raw files of some years."""
    raw, target = _raw_trip_files(spark, sf_dir), work_folder(spark, "silver-raw")
    silver_job(spark, "green", raw, target, from_raw=True, years=_TRIP_YEARS)
    return read_layer(spark, target)


def report_round_trip(spark, sf_dir):
    """The report of `dq_report` as JSON by table and date."""
    path = work_folder(spark, "dq")
    write_dq_report(quality.dq_report(spark, sf_dir), path, _DAY)
    return read_dq_report(spark, path, "customer", _DAY)


def _clean(spark, sf_dir, root, name, raw, **options):
    target = os.path.join(root, "target", name)
    report = clean_source_job(
        spark,
        _text_source(spark, sf_dir, root, name, raw),
        target,
        os.path.join(root, "dq", name),
        _DAY,
        table=name,
        **options,
    )
    return target, report


def clean_source_files(spark, sf_dir):
    """Text to a cleaned parquet layer."""
    target, _ = _clean(spark, sf_dir, work_folder(spark, "clean"), "Banco", t.banks)
    return read_layer(spark, target)


def clean_source_report(spark, sf_dir):
    """The checks taken while a layer is written, of the tables with a suite and of another one."""
    root = work_folder(spark, "clean-report")
    _, employees = _clean(spark, sf_dir, root, "Empregados", t.employees)
    _, banks = _clean(spark, sf_dir, root, "Banco", t.banks)
    _, complaints = _clean(spark, sf_dir, root, "Reclamacoes", t.complaints)
    return employees.unionByName(banks).unionByName(complaints)


def _zero_led_banks(spark, sf_dir):
    """Banks whose keys start with zeros."""
    return t.banks(spark, sf_dir).withColumn("CNPJ", F.lpad(F.expr("CNPJ - 100000000000").cast("string"), 12, "0"))


def clean_source_keys(spark, sf_dir):
    """Keys keep their leading zeros."""
    target, _ = _clean(spark, sf_dir, work_folder(spark, "clean-keys"), "Banco", _zero_led_banks)
    return read_layer(spark, target)


def clean_source_key_report(spark, sf_dir):
    """A rule on rows and one on the key in one suite."""
    suite = [expect_length_equal("cnpj", 12), expect_unique_key("cnpj")]
    root = work_folder(spark, "clean-key-report")
    _, report = _clean(spark, sf_dir, root, "Banco", _zero_led_banks, suite=suite)
    return report


def delivery_files(spark, sf_dir):
    """Three text sources to the delivery table, each step through files."""
    root = work_folder(spark, "delivery")
    complaints, _ = _clean(spark, sf_dir, root, "Reclamacoes", t.complaints)
    employees, _ = _clean(spark, sf_dir, root, "Empregados", t.employees)
    banks, _ = _clean(spark, sf_dir, root, "Banco", t.banks)
    target = os.path.join(root, "delivery")
    delivery_table_job(spark, complaints, employees, banks, target)
    return read_layer(spark, target)


def taxi_files(spark, sf_dir):
    """Raw trips to silver to gold, each layer written by day and read."""
    root = work_folder(spark, "taxi")
    trips = {"yellow": t.yellow_trips, "green": t.green_trips}
    silver_paths = {colour: os.path.join(root, "silver", colour) for colour in trips}

    def to_silver(colour):
        source = os.path.join(root, "raw", colour)
        write_layer(trips[colour](spark, sf_dir), source)
        silver_job(spark, colour, source, silver_paths[colour])

    # The colours do not need each other: one's tasks run while the other's files are committed.
    with ThreadPoolExecutor(len(trips)) as pool:
        for _ in pool.map(inheritable_thread_target(spark)(to_silver), trips):
            pass
    gold_job(spark, silver_paths, os.path.join(root, "gold"))
    return read_layer(spark, os.path.join(root, "gold"))


def typed_in_one_parse(spark, sf_dir):
    """Delimited text with its types, from one parse."""
    root = work_folder(spark, "one-parse")
    orders = t.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "o_orderkey * 1000000000 as far_key",
        "o_totalprice",
        "to_date(o_orderdate) as day",
        "o_orderkey % 2 = 0 as even",
        "if(o_orderkey % 3 = 0, o_orderpriority, string(o_orderkey)) as mixed",
        "if(o_orderkey % 5 = 0, null, o_custkey) as customer",
    )
    write_delimited(orders, f"{root}/text", header=True)
    return stage_delimited(spark, f"{root}/text", f"{root}/staged", separator=";")


def delivered_twice(spark, sf_dir):
    """The delivery table in two loads, of which one runs again: each row once."""
    root = work_folder(spark, "delivered")
    rows = bank.deliver_rows(spark, sf_dir)
    write_layer(rows, f"{root}/rows")
    rows = read_layer(spark, f"{root}/rows")
    target = f"{root}/table"
    create_delivery(target, key=None)
    # The test tables give names to several banks, so that no column is a key.
    first = F.pmod(F.xxhash64("nome_banco"), F.lit(2)) == 0
    for load_id, part in (("first", rows.where(first)), ("second", rows.where(~first)), ("first", rows.where(first))):
        deliver_load(part, target, load_id)
    return read_delivery(spark, target)


def replaced_layer(spark, sf_dir):
    """A layer whose next version was made from it and replaced it."""
    path = work_folder(spark, "versions")
    orders = t.table(spark, sf_dir, "orders")
    write_layer(orders.where("o_orderkey % 2 = 0"), path, versioned=True)
    write_layer(read_layer(spark, path).unionByName(orders.where("o_orderkey % 2 = 1")), path, versioned=True)
    drop_versions(spark, path)
    return read_layer(spark, path)


def sized_partitions(spark, sf_dir):
    """Orders by year, in files planned by size; every seventh has no year."""
    path = work_folder(spark, "sized")
    orders = t.table(spark, sf_dir, "orders").selectExpr(
        "*", "if(o_orderkey % 7 = 0, null, year(o_orderdate)) as order_year"
    )
    write_layer(orders, path, partition_by="order_year", file_bytes=8 << 20)
    return read_layer(spark, path)


def landed_again(spark, sf_dir):
    """A landing that runs again after a file was changed and another came, with other columns."""
    root, target = work_folder(spark, "land-new"), work_folder(spark, "landed")
    customers = t.table(spark, sf_dir, "customer")
    _named_file(customers.where("c_nationkey < 10"), root, "a/some.parquet")
    _named_file(customers.where("c_nationkey between 10 and 14"), root, "b/some.parquet")
    land_new_job(spark, root, target)
    storage.delete(spark, f"{root}/b/some.parquet")
    _named_file(customers.where("c_nationkey between 12 and 19"), root, "b/some.parquet")
    _named_file(customers.where("c_nationkey > 19").drop("c_name"), root, "c/more.parquet")
    land_new_job(spark, root, target)
    return read_landed(spark, target)


QUERIES = {
    "read_delimited": delimited_round_trip,
    "write_delimited": headerless_round_trip,
    "write_layer_partitioned": partitioned_round_trip,
    "read_layer_pruned": partitioned_range,
    "concat_files": concat_files,
    "concat_by_name": concat_files_by_name,
    "concat_partitioned": concat_partitioned,
    "concat_schema": concat_with_schema,
    "union_by_name": union_tables,
    "land_recursive": landed,
    "land_partitioned": landed_partitions,
    "name_collisions": names_that_meet,
    "temporary_view": temporary_view,
    "route_years": routed_years,
    "route_categories": routed_categories,
    "silver_from_raw": silver_from_raw,
    "preview": text_preview,
    "write_dq_report": report_round_trip,
    "clean_source_files": clean_source_files,
    "clean_source_report": clean_source_report,
    "clean_source_keys": clean_source_keys,
    "clean_source_key_report": clean_source_key_report,
    "delivery_table_files": delivery_files,
    "taxi_layers_files": taxi_files,
    "infer_one_parse": typed_in_one_parse,
    "land_new": landed_again,
    "deliver_files": delivered_twice,
    "write_layer_versioned": replaced_layer,
    "write_layer_sized": sized_partitions,
}

_KEYS_AS_TEXT = "select * replace (cnpj::varchar as cnpj) from ({})"

_FILED = "'2024-03-05' as report_date, '2024' as year, '03' as month, '05' as day"


def _filed(row, source):
    return f"select {row}, {_FILED} from {source}"


_BANKS_COUNTED = f"(select count(*) as n from ({t.BANKS_SQL}))"
_ZERO_LED_SQL = f"select * replace (lpad((cnpj - 100000000000)::varchar, 12, '0') as cnpj) from ({t.BANKS_SQL})"

ORACLES = {
    "read_delimited": """
select case l_orderkey % 3
         when 0 then '  SÚPPLIÊR#' || lpad(l_suppkey::varchar, 9, '0') || ' (Conglomerado) ' || l_returnflag
         when 1 then 'Supplier#' || lpad(l_suppkey::varchar, 9, '0') || ' - Prudencial ' || l_linestatus
         else 'supplìer#' || lpad(l_suppkey::varchar, 9, '0') end as name,
       case l_orderkey % 5 when 0 then null when 1 then 'n/d' else l_quantity::int::varchar end as complaints,
       case when l_partkey % 4 = 0 then ' ' else l_partkey::varchar end as clients
from lineitem""",
    "write_delimited": "select * from customer",
    "write_layer_partitioned": """
select *, case when o_orderkey % 7 = 0 then null else o_orderdate::date end as partition_date
from orders""",
    "read_layer_pruned": """
select *, o_orderdate::date as partition_date
from orders where o_orderkey % 7 <> 0 and o_orderdate >= timestamp '1997-01-01'""",
    "concat_files": """
select c_custkey, c_nationkey::double as amount, c_name, null::varchar as c_mktsegment from customer
union all
select c_custkey, c_acctbal, null, c_mktsegment from customer""",
    "concat_by_name": """
select c_custkey, c_name, null::double as c_acctbal from customer
union all
select c_custkey, null, c_acctbal from customer""",
    "concat_partitioned": "select * from customer",
    "concat_schema": """
select c_custkey, c_name, null::double as c_acctbal, null::varchar as c_phone from customer
union all
select c_custkey, null, c_acctbal, null from customer""",
    "union_by_name": """
select c_custkey, c_name, null::double as c_acctbal from customer
union all
select c_custkey, null, c_acctbal from customer""",
    "land_recursive": """
select *, case when s_nationkey % 3 = 2 then 'other.parquet' else 'some.parquet' end as source_file
from supplier""",
    "land_partitioned": "select * from customer",
    "name_collisions": """
select 'some.parquet' as file_name, count(distinct s_nationkey % 3) as n_files,
       'x/some.parquet' as first_path, 'y/z/some.parquet' as last_path
from supplier where s_nationkey % 3 < 2""",
    "preview": "select n_name as value from nation order by n_name limit 20",
    "temporary_view": """
select o_orderpriority, count(*) as n_orders, max(o_totalprice) as largest from orders group by 1""",
    "route_years": """
select 'green' as category, l_orderkey as DOLocationID, l_shipdate as dropoff
from lineitem where year(l_shipdate) between 1994 and 1998
union all
select 'yellow', o_orderkey, o_orderdate from orders where year(o_orderdate) between 1994 and 1998""",
    "route_categories": """
select 'green' as category, l_suppkey as VendorID from lineitem
union all
select 'yellow', o_custkey from orders
union all
select 'fhv', o_custkey from orders""",
    "silver_from_raw": f"""
select * from ({t.GREEN_SILVER_SQL}) where year(lpep_dropoff_datetime) between 1994 and 1998""",
    "write_dq_report": f"select *, {_FILED} from ({quality.DQ_CUSTOMER_SQL})",
    "clean_source_files": _KEYS_AS_TEXT.format(t.BANKS_SQL),
    "clean_source_keys": _ZERO_LED_SQL,
    "clean_source_key_report": " union all ".join(
        (
            _filed(
                quality.row("Banco", "expect_column_value_lengths_to_equal", "cnpj", "0::bigint", "0::bigint"),
                _BANKS_COUNTED,
            ),
            _filed(
                quality.row("Banco", "expect_column_values_to_be_unique_key", "cnpj", "0::bigint", "u"),
                f"""(select count(*) as n, count(*) filter (k > 1) as u from
                     (select count(*) over (partition by cnpj) as k from ({_ZERO_LED_SQL})))""",
            ),
        )
    ),
    "clean_source_report": " union all ".join(
        (
            _filed(
                quality.row("Empregados", "expect_column_values_to_match_regex", "nome", "0::bigint", "n"),
                "(select count(*) as n from events)",
            ),
            _filed(
                quality.row("Banco", "expect_column_value_lengths_to_equal", "cnpj", "0::bigint", "0::bigint"),
                _BANKS_COUNTED,
            ),
            _filed(
                quality.row(
                    "Reclamacoes",
                    "expect_column_values_to_be_of_type",
                    "quantidade_total_de_clientes__ccs_e_scr",
                    "m",
                    "(n - m)",
                    "false",
                ),
                "(select count(*) as n, 0::bigint as m from lineitem)",
            ),
        )
    ),
    "delivery_table_files": _KEYS_AS_TEXT.format(t.DELIVERY_SQL),
    "taxi_layers_files": t.GOLD_SQL,
    "land_new": """
select * replace (case when c_nationkey < 20 then c_name end as c_name),
       case when c_nationkey < 20 then 'some.parquet' else 'more.parquet' end as source_file
from customer where c_nationkey not in (10, 11)""",
    "infer_one_parse": """
select o_orderkey::int as o_orderkey, o_orderkey * 1000000000 as far_key, o_totalprice, o_orderdate::date as day,
       o_orderkey % 2 = 0 as even,
       case when o_orderkey % 3 = 0 then o_orderpriority else o_orderkey::varchar end as mixed,
       case when o_orderkey % 5 = 0 then null else o_custkey::int end as customer
from orders""",
    "deliver_files": bank.ORACLES["deliver_positional"],
    "write_layer_versioned": "select * from orders",
    "write_layer_sized": """
select *, case when o_orderkey % 7 = 0 then null else year(o_orderdate)::int end as order_year
from orders""",
}

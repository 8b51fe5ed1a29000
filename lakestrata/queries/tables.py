"""The given tables, and the shapes of bank and taxi sources derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as complaints: raw headers, decorated names, numbers as text with blanks."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        """case l_orderkey % 3
             when 0 then concat('  SÚPPLIÊR#', lpad(l_suppkey, 9, '0'), ' (Conglomerado) ', l_returnflag)
             when 1 then concat('Supplier#', lpad(l_suppkey, 9, '0'), ' - Prudencial ', l_linestatus)
             else concat('supplìer#', lpad(l_suppkey, 9, '0'))
           end as `Instituição financeira`""",
        """case l_orderkey % 5 when 0 then '' when 1 then 'n/d'
             else cast(cast(l_quantity as int) as string)
           end as `Quantidade total de reclamações`""",
        """case when l_partkey % 4 = 0 then ' ' else cast(l_partkey as string)
           end as `Quantidade total de clientes \u0096 CCS e SCR`""",
    )


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ratings of an employer."""
    return table(spark, sf_dir, "events").selectExpr(
        "concat('SUPPLIER#', lpad(user_id, 9, '0')) as `Nome`",
        "case when event_id % 6 = 0 then '' else cast(cast(round(value) as int) as string) end as `Geral`",
        """case when event_type = 'error' then '-' else cast(cast(event_id % 1000 as int) as string)
           end as `Remuneração e benefícios`""",
    )


def banks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as banks; every fourth has two rows."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "explode(if(s_suppkey % 4 = 0, array('S1', 'S2'), array('S1'))) as `Segmento`",
        "100000000000 + s_suppkey as `CNPJ`",
        "s_name as `Nome`",
    )


COMPLAINTS_SQL = """
  select trim(regexp_replace(regexp_replace(regexp_replace(name, '^\\s+|\\s+$', '', 'g'),
           '\\(conglomerado\\).*', '', 'g'), '- prudencial.*', '', 'g')) as instituicao_financeira,
         reclamacoes, clientes, suppkey
  from (select translate(lower(case l_orderkey % 3
             when 0 then '  SÚPPLIÊR#' || lpad(l_suppkey::varchar, 9, '0') || ' (Conglomerado) ' || l_returnflag
             when 1 then 'Supplier#' || lpad(l_suppkey::varchar, 9, '0') || ' - Prudencial ' || l_linestatus
             else 'supplìer#' || lpad(l_suppkey::varchar, 9, '0') end),
             'áàâãäéèêëíìîïóòôõöúùûüç', 'aaaaaeeeeiiiiooooouuuuc') as name,
           case when l_orderkey % 5 in (0, 1) then null else l_quantity end as reclamacoes,
           case when l_partkey % 4 = 0 then null else l_partkey::double end as clientes,
           l_suppkey as suppkey
        from lineitem)"""

EMPLOYEES_SQL = """
  select 'supplier#' || lpad(user_id::varchar, 9, '0') as nome,
         case when event_id % 6 = 0 then null else round(value) end as geral,
         case when event_type = 'error' then null else (event_id % 1000)::double end as remuneracao
  from events"""

BANKS_SQL = """
  select 's1' as segmento, 100000000000 + s_suppkey as cnpj, lower(s_name) as nome from supplier
  union all
  select 's2', 100000000000 + s_suppkey, lower(s_name) from supplier where s_suppkey % 4 = 0"""

DELIVERY_SQL = f"""
with complaints as ({COMPLAINTS_SQL}),
     employees as ({EMPLOYEES_SQL}),
     banks as ({BANKS_SQL}),
     c as (select instituicao_financeira, sum(reclamacoes) as r, sum(clientes) as k
           from complaints group by 1),
     e as (select nome, avg(geral) as g, avg(remuneracao) as b from employees group by 1)
select instituicao_financeira,
       format('{{:,.2f}}', r) as sum_quantidade_total_de_reclamacoes,
       format('{{:,.2f}}', k) as sum_quantidade_total_de_clientes__ccs_e_scr,
       format('{{:,.2f}}', g) as avg_geral,
       format('{{:,.2f}}', b) as avg_remuneracao_e_beneficios,
       segmento, cnpj
from c join e on c.instituicao_financeira = e.nome join banks on banks.nome = c.instituicao_financeira
"""


def green_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as green trips."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey as VendorID",
        "if(l_orderkey % 7 = 0, null, l_shipdate) as lpep_pickup_datetime",
        "l_shipdate as lpep_dropoff_datetime",
        "if(l_linenumber = 2, null, cast(l_linenumber as double)) as RatecodeID",
        "l_partkey as PULocationID",
        "l_orderkey as DOLocationID",
        "if(l_linenumber = 3, null, l_quantity) as passenger_count",
        "l_quantity as trip_distance",
        "l_extendedprice as fare_amount",
        "l_discount as extra",
        "l_tax as mta_tax",
        "l_discount as tip_amount",
        "l_tax as tolls_amount",
        "if(l_returnflag = 'A', null, l_tax) as improvement_surcharge",
        "l_extendedprice as total_amount",
        "if(l_linestatus = 'O', null, cast(l_linenumber as double)) as payment_type",
        "if(l_partkey % 2 = 0, null, l_discount) as trip_type",
        "l_linestatus as store_and_fwd_flag",
    )


def yellow_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as yellow trips; payment_type is an integer here and a double in green."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_custkey as VendorID",
        "if(o_orderkey % 7 = 0, null, o_orderdate) as tpep_pickup_datetime",
        "o_orderdate as tpep_dropoff_datetime",
        "if(o_orderkey % 3 = 0, null, cast(o_orderkey % 5 as double)) as RatecodeID",
        "o_custkey as PULocationID",
        "o_orderkey as DOLocationID",
        "if(o_orderkey % 4 = 0, null, cast(o_orderkey % 6 as double)) as passenger_count",
        "o_totalprice as trip_distance",
        "o_totalprice as fare_amount",
        "o_totalprice as extra",
        "o_totalprice as mta_tax",
        "o_totalprice as tip_amount",
        "o_totalprice as tolls_amount",
        "if(o_orderstatus = 'F', null, o_totalprice) as improvement_surcharge",
        "o_totalprice as total_amount",
        "if(o_orderkey % 9 = 0, null, o_orderkey % 4) as payment_type",
    )


GREEN_SILVER_SQL = """
  select l_suppkey as vendor_id,
         case when l_orderkey % 7 = 0 then null else l_shipdate end as lpep_pickup_datetime,
         l_shipdate as lpep_dropoff_datetime,
         case when l_linenumber = 2 then 1.0::double else l_linenumber::double end as rate_code_id,
         l_partkey as pu_location_id, l_orderkey as do_location_id,
         case when l_linenumber = 3 then null else l_quantity end as passenger_count,
         l_quantity as trip_distance, l_extendedprice as fare_amount, l_discount as extra,
         l_tax as mta_tax, l_discount as tip_amount, l_tax as tolls_amount,
         case when l_returnflag = 'A' then null else l_tax end as improvement_surcharge,
         l_extendedprice as total_amount,
         case when l_linestatus = 'O' then null else l_linenumber::double end as payment_type,
         case when l_partkey % 2 = 0 then null else l_discount end as trip_type,
         case when l_orderkey % 7 = 0 then null else l_shipdate::date end as partition_date
  from lineitem"""

YELLOW_SILVER_SQL = """
  select o_custkey as vendor_id, o_orderdate as tpep_pickup_datetime,
         o_orderdate as tpep_dropoff_datetime,
         case when o_orderkey % 3 = 0 then 1.0::double else (o_orderkey % 5)::double end as rate_code_id,
         o_custkey as pu_location_id, o_orderkey as do_location_id,
         case when o_orderkey % 4 = 0 then null else (o_orderkey % 6)::double end as passenger_count,
         o_totalprice as trip_distance, o_totalprice as fare_amount, o_totalprice as extra,
         o_totalprice as mta_tax, o_totalprice as tip_amount, o_totalprice as tolls_amount,
         case when o_orderstatus = 'F' then null else o_totalprice end as improvement_surcharge,
         o_totalprice as total_amount,
         case when o_orderkey % 9 = 0 then null else o_orderkey % 4 end as payment_type,
         o_orderdate::date as partition_date
  from orders where o_orderkey % 7 <> 0"""

_GOLD_SHARED = """rate_code_id, pu_location_id, do_location_id,
       coalesce(passenger_count, 1) as passenger_count, trip_distance, fare_amount, extra, mta_tax,
       tip_amount, tolls_amount, coalesce(improvement_surcharge, 0) as improvement_surcharge,
       total_amount, coalesce(payment_type, 5)::double as payment_type"""

GOLD_SQL = f"""
with y as ({YELLOW_SILVER_SQL}), g as ({GREEN_SILVER_SQL})
select vendor_id, tpep_pickup_datetime as pickup_datetime, tpep_dropoff_datetime as dropoff_datetime,
       {_GOLD_SHARED}, null::double as trip_type, 'yellow' as taxi_type, partition_date
from y
union all
select vendor_id, lpep_pickup_datetime, lpep_dropoff_datetime,
       {_GOLD_SHARED}, coalesce(trip_type, 1), 'green', partition_date
from g
"""

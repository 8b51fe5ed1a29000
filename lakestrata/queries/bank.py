from pyspark.sql import functions as F

from lakestrata.functions import normalize_columns
from lakestrata.operators import aggregate, join_entities
from lakestrata.plans import BANK_SOURCES, clean_source, delivery_table
from lakestrata.queries import tables as t
from lakestrata.sinks import deliver_positional


def final_table(spark, sf_dir):
    """Clean three sources, aggregate two, join all."""
    return delivery_table(
        clean_source(t.complaints(spark, sf_dir), BANK_SOURCES["Reclamacoes"].entity_column),
        clean_source(t.employees(spark, sf_dir), BANK_SOURCES["Empregados"].entity_column),
        clean_source(t.banks(spark, sf_dir), BANK_SOURCES["Banco"].entity_column),
    )


def group_agg_formatted(spark, sf_dir):
    return aggregate(
        t.table(spark, sf_dir, "lineitem"),
        "l_returnflag",
        {"l_quantity": "avg", "l_extendedprice": "sum"},
    )


def group_agg_numeric(spark, sf_dir):
    return aggregate(
        t.table(spark, sf_dir, "lineitem"),
        ["l_suppkey", "l_linestatus"],
        {"l_quantity": "avg", "l_linenumber": "sum"},
        formatted=False,
    )


def join_entities_plain(spark, sf_dir):
    """Two aggregates with one row per key."""
    orders = aggregate(
        t.table(spark, sf_dir, "orders").withColumn("cents", F.round(F.col("o_totalprice") * 100)),
        "o_custkey",
        {"cents": "sum"},
        formatted=False,
    )
    events = aggregate(
        t.table(spark, sf_dir, "events"), "user_id", {"event_id": "avg"}, formatted=False
    )
    return join_entities(orders, events, "o_custkey", "user_id")


def join_entities_spread(spark, sf_dir):
    """An aggregate and a table that repeats keys, with a share low enough to spread all."""
    parts = aggregate(
        t.table(spark, sf_dir, "lineitem"), "l_suppkey", {"l_quantity": "sum"}, formatted=False
    )
    customers = t.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return join_entities(
        parts,
        customers,
        "l_suppkey",
        "c_nationkey",
        spread_hot_keys=True,
        hot_share=0.005,
    )


def join_entities_hot(spark, sf_dir):
    """A third of the rows under one key, spread by the default share."""
    sums = aggregate(
        t.table(spark, sf_dir, "lineitem"), "l_suppkey", {"l_quantity": "sum"}, formatted=False
    )
    orders = t.table(spark, sf_dir, "orders").selectExpr(
        "if(o_orderkey % 3 = 0, 1, o_custkey) as bank", "o_orderkey"
    )
    return join_entities(sums, orders, "l_suppkey", "bank", spread_hot_keys=True)


def deliver_rows(spark, sf_dir):
    """The seven-column delivery table, loaded by position."""
    return deliver_positional(final_table(spark, sf_dir))


def headers(spark, sf_dir):
    """Raw headers to normalised names."""
    return normalize_columns(
        t.table(spark, sf_dir, "customer").selectExpr(
            "c_custkey as `Código`",
            "c_name as `Instituição financeira`",
            "c_acctbal as `Índice (%)`",
            "c_nationkey as `Pré-pago`",
            "c_mktsegment as `Clientes \u0096 CCS`",
        )
    )



QUERIES = {
    "final_table": final_table,
    "group_agg_formatted": group_agg_formatted,
    "group_agg_numeric": group_agg_numeric,
    "join_entities_plain": join_entities_plain,
    "join_entities_spread": join_entities_spread,
    "join_entities_hot": join_entities_hot,
    "deliver_positional": deliver_rows,
    "normalize_columns": headers,
}

ORACLES = {
    "final_table": t.DELIVERY_SQL,
    "group_agg_formatted": """
select l_returnflag, format('{:,.2f}', avg(l_quantity)) as avg_l_quantity,
       format('{:,.2f}', sum(l_extendedprice)) as sum_l_extendedprice
from lineitem group by 1""",
    "group_agg_numeric": """
select l_suppkey, l_linestatus, avg(l_quantity) as avg_l_quantity,
       sum(l_linenumber)::double as sum_l_linenumber
from lineitem group by 1, 2""",
    "join_entities_plain": """
select o_custkey, sum_cents, user_id, avg_event_id
from (select o_custkey, sum(round(o_totalprice * 100)) as sum_cents from orders group by 1)
join (select user_id, avg(event_id) as avg_event_id from events group by 1)
  on o_custkey = user_id""",
    "join_entities_spread": """
select l_suppkey, sum_l_quantity, c_custkey, c_nationkey
from (select l_suppkey, sum(l_quantity) as sum_l_quantity from lineitem group by 1)
join customer on l_suppkey = c_nationkey""",
    "join_entities_hot": """
select l_suppkey, sum_l_quantity, bank, o_orderkey
from (select l_suppkey, sum(l_quantity) as sum_l_quantity from lineitem group by 1)
join (select case when o_orderkey % 3 = 0 then 1 else o_custkey end as bank, o_orderkey from orders)
  on l_suppkey = bank""",
    "deliver_positional": f"""
select instituicao_financeira as nome_banco,
       sum_quantidade_total_de_reclamacoes as quantidade_reclamacoes,
       sum_quantidade_total_de_clientes__ccs_e_scr as quantidade_clientes_bancos,
       avg_geral as indice_satisfacao_funcionarios_bancos,
       avg_remuneracao_e_beneficios as indice_satisfacao_salarios_funcionarios_bancos,
       segmento as classificacao_do_banco, cnpj::varchar as cnpj
from ({t.DELIVERY_SQL})""",
    "normalize_columns": """
select c_custkey as codigo, c_name as instituicao_financeira, c_acctbal as indice__,
       c_nationkey as pre_pago, c_mktsegment as clientes__ccs
from customer""",
}

from lakestrata.quality import (
    expect_length_equal,
    expect_match_regex,
    expect_type,
    expect_unique_key,
    key_violations,
    run_suite,
    unexpected_values,
)
from lakestrata.queries import tables as t

_CUSTOMERS = [
    expect_match_regex("name_text", r"^\D*$"),
    expect_length_equal("c_mktsegment", 9),
    expect_length_equal("no_such_column", 9),
]
_ORDERS = [
    expect_type("o_orderkey", "bigint"),
    expect_type("o_orderkey", "int"),
    expect_type("quantidade_total_de_clientes", "int"),
]


def dq_report(spark, sf_dir):
    customers = t.table(spark, sf_dir, "customer").selectExpr(
        "c_mktsegment",
        """case c_custkey % 4 when 0 then null when 1 then ''
             when 2 then c_mktsegment else c_name end as name_text""",
    )
    return run_suite(customers, _CUSTOMERS, "customer")


def dq_type_check(spark, sf_dir):
    return run_suite(t.table(spark, sf_dir, "orders"), _ORDERS, "orders")


def dq_unique_key(spark, sf_dir):
    orders = t.table(spark, sf_dir, "orders")
    return run_suite(
        orders, [expect_unique_key("o_orderkey"), expect_unique_key("o_custkey")], "orders"
    )


def dq_key_violations(spark, sf_dir):
    orders = t.table(spark, sf_dir, "orders").selectExpr(
        "nullif(o_custkey, 1) as o_custkey"
    )
    return key_violations(orders, "o_custkey")


def dq_unexpected_values(spark, sf_dir):
    """The values that break two rules on orders most often, one of few values and one of many."""
    suite = [expect_match_regex("o_orderpriority", "^[12]"), expect_length_equal("o_custkey", 2)]
    return unexpected_values(t.table(spark, sf_dir, "orders"), suite, "orders", top=15)


QUERIES = {
    "dq_unexpected_values": dq_unexpected_values,
    "dq_report": dq_report,
    "dq_type_check": dq_type_check,
    "dq_unique_key": dq_unique_key,
    "dq_key_violations": dq_key_violations,
}

_COLUMNS = (
    "'{0}' as \"table\", 'dq_{0}' as suite, '{1}' as expectation, '{2}' as \"column\", "
    "{3} as success, n as element_count, {4} as missing_count, {5} as unexpected_count, "
    "{6} as unexpected_percent"
)


def row(table, expectation, column, missing, unexpected, success=None):
    percent = f"case when n > {missing} then {unexpected} * 100.0::double / (n - {missing}) end"
    return _COLUMNS.format(
        table, expectation, column, success or f"{unexpected} = 0", missing, unexpected, percent
    )


def _unknown(table, expectation, column):
    return _COLUMNS.format(
        table, expectation, column, "false", "null::bigint", "null::bigint", "null::double"
    )


DQ_CUSTOMER_SQL = f"""
with s as (
  select count(*) as n, count(*) filter (name_text is null) as m0,
         count(*) filter (regexp_matches(name_text, '[0-9]')) as u0,
         count(*) filter (length(c_mktsegment) <> 9) as u1
  from (select c_mktsegment, case c_custkey % 4 when 0 then null when 1 then ''
          when 2 then c_mktsegment else c_name end as name_text from customer))
select {row("customer", "expect_column_values_to_match_regex", "name_text", "m0", "u0")} from s
union all
select {row("customer", "expect_column_value_lengths_to_equal", "c_mktsegment", "0::bigint", "u1")} from s
union all
select {_unknown("customer", "expect_column_value_lengths_to_equal", "no_such_column")} from s
"""

ORACLES = {
    "dq_unexpected_values": """
with broken as (
    select 'expect_column_values_to_match_regex' as expectation, 'o_orderpriority' as "column",
           o_orderpriority as value
    from orders where not regexp_matches(o_orderpriority, '^[12]')
    union all
    select 'expect_column_value_lengths_to_equal', 'o_custkey', o_custkey::varchar
    from orders where length(o_custkey::varchar) <> 2
), counted as (
    select expectation, "column", value, count(*) as n_rows from broken group by all
)
select 'orders' as "table", 'dq_orders' as suite, expectation, "column",
       row_number() over (partition by expectation order by n_rows desc, value) as rank, value, n_rows
from counted qualify rank <= 15""",
    "dq_report": DQ_CUSTOMER_SQL,
    "dq_type_check": f"""
with s as (select count(*) as n, 0::bigint as zero from orders)
select {row("orders", "expect_column_values_to_be_of_type", "o_orderkey", "0::bigint", "zero")} from s
union all
select {row("orders", "expect_column_values_to_be_of_type", "o_orderkey", "0::bigint", "n", "false")} from s
union all
select {_unknown("orders", "expect_column_values_to_be_of_type", "quantidade_total_de_clientes")} from s
""",
    "dq_unique_key": f"""
with s as (
  select count(*) as n,
         count(*) filter (o_orderkey in (select o_orderkey from orders group by 1 having count(*) > 1)) as u0,
         count(*) filter (o_custkey in (select o_custkey from orders group by 1 having count(*) > 1)) as u1
  from orders)
select {row("orders", "expect_column_values_to_be_unique_key", "o_orderkey", "0::bigint", "u0")} from s
union all
select {row("orders", "expect_column_values_to_be_unique_key", "o_custkey", "0::bigint", "u1")} from s
""",
    "dq_key_violations": """
select nullif(o_custkey, 1) as o_custkey, count(*) as n_rows
from orders group by 1 having count(*) > 1 or nullif(o_custkey, 1) is null""",
}

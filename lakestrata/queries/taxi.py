from lakestrata.operators import unify
from lakestrata.plans import gold, silver
from lakestrata.queries import tables as t


def silver_not_null(spark, sf_dir):
    """Yellow: rows without a pickup are dropped."""
    return silver(t.yellow_trips(spark, sf_dir), "yellow")


def silver_keep_null(spark, sf_dir):
    """Green: they stay, without a partition date."""
    return silver(t.green_trips(spark, sf_dir), "green")


def gold_union(spark, sf_dir):
    return gold(
        {"yellow": silver_not_null(spark, sf_dir), "green": silver_keep_null(spark, sf_dir)}
    )


def unify_accounts(spark, sf_dir):
    """A union whose branches lack columns of each other."""
    customers = t.table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as key", "c_acctbal as balance", "c_mktsegment as segment"
    )
    suppliers = t.table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey as key", "s_acctbal as balance", "s_nationkey as nation"
    )
    return unify(
        {"customer": customers, "supplier": suppliers},
        "kind",
        ["kind", "key", "balance", "segment", "nation"],
    )


QUERIES = {
    "silver_not_null": silver_not_null,
    "silver_keep_null": silver_keep_null,
    "gold_union": gold_union,
    "unify_accounts": unify_accounts,
}

ORACLES = {
    "silver_not_null": t.YELLOW_SILVER_SQL,
    "silver_keep_null": t.GREEN_SILVER_SQL,
    "gold_union": t.GOLD_SQL,
    "unify_accounts": """
select 'customer' as kind, c_custkey as key, c_acctbal as balance, c_mktsegment as segment,
       null::int as nation
from customer
union all
select 'supplier', s_suppkey, s_acctbal, null, s_nationkey from supplier""",
}

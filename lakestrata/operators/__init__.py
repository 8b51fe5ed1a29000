from lakestrata.operators.aggregate import aggregate
from lakestrata.operators.conform import conform, default_nulls, with_partition_date
from lakestrata.operators.joins import hot_keys, join_entities
from lakestrata.operators.unify import union_by_name, unify

__all__ = [
    "aggregate",
    "conform",
    "default_nulls",
    "hot_keys",
    "join_entities",
    "unify",
    "union_by_name",
    "with_partition_date",
]

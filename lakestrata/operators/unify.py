"""One table out of several."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions.text import quoted


def union_by_name(*tables: DataFrame) -> DataFrame:
    """Rows of all tables, columns matched by name; a column a table lacks is null.

    Types widen as in any union. A column that is text in one table and something
    else in another (an empty column is stored as an integer) becomes text.
    """
    types = defaultdict(set)
    for df in tables:
        for field in df.schema.fields:
            types[field.name.lower()].add(field.dataType)
    mixed = {
        name
        for name, found in types.items()
        if len(found) > 1 and any(isinstance(t, T.StringType) for t in found)
    }
    as_text = [
        df.withColumns({c: F.col(quoted(c)).cast("string") for c in df.columns if c.lower() in mixed})
        for df in tables
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), as_text)


def unify(branches: Mapping[str, DataFrame], tag: str, columns: Sequence[str]) -> DataFrame:
    """UNION ALL of differently shaped tables into `columns`, duplicates kept.

    Every row carries the name of its branch in the column `tag`. A column a
    branch lacks is null, typed as in the first branch that has it, so the
    schema does not depend on the order of the branches.
    """
    types = {}
    for df in branches.values():
        for field in df.schema.fields:
            types.setdefault(field.name, field.dataType)
    unknown = [c for c in columns if c != tag and c not in types]
    if unknown:
        raise ValueError(f"no branch has the columns {unknown}")

    def shaped(name: str, df: DataFrame) -> DataFrame:
        return df.select(
            *[
                F.lit(name).alias(c)
                if c == tag
                else F.col(c)
                if c in df.columns
                else F.lit(None).cast(types[c]).alias(c)
                for c in columns
            ]
        )

    return reduce(DataFrame.unionByName, [shaped(n, df) for n, df in branches.items()])

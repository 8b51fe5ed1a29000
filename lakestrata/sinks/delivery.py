"""The typed delivery table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions.text import quoted

# Columns of the delivery table, in order, and its key.
DELIVERY_SCHEMA = T.StructType(
    [
        T.StructField("nome_banco", T.StringType()),
        T.StructField("quantidade_reclamacoes", T.StringType()),
        T.StructField("quantidade_clientes_bancos", T.StringType()),
        T.StructField("indice_satisfacao_funcionarios_bancos", T.StringType()),
        T.StructField("indice_satisfacao_salarios_funcionarios_bancos", T.StringType()),
        T.StructField("classificacao_do_banco", T.StringType()),
        T.StructField("cnpj", T.StringType()),
    ]
)
DELIVERY_KEY = "cnpj"


def deliver_positional(
    df: DataFrame, schema: T.StructType = DELIVERY_SCHEMA, *, nulls_as_empty: bool = False
) -> DataFrame:
    """Give the columns of `df`, by position, the names and types of `schema`.

    Text that the target type cannot hold becomes null. Nulls stay nulls; `nulls_as_empty=True` makes them empty strings in string
    columns, as a load from delimited text would.
    """
    if len(df.columns) != len(schema.fields):
        raise ValueError(
            f"{len(df.columns)} columns given, the target has {len(schema.fields)}: {schema.names}"
        )
    columns = []
    for name, field in zip(df.columns, schema.fields):
        value = F.col(quoted(name)).try_cast(field.dataType)
        if nulls_as_empty and isinstance(field.dataType, T.StringType):
            value = F.coalesce(value, F.lit(""))
        columns.append(value.alias(field.name))
    return df.select(*columns)


def delivery_ddl(
    table: str, schema: T.StructType = DELIVERY_SCHEMA, key: str = DELIVERY_KEY
) -> str:
    """Statements that drop and create the delivery table, for the database's own client.

    Spark's writer cannot declare a primary key; load into a table made by these
    with `mode="append"`, or with `truncate=True`, to keep the key.
    """
    sql_types = {T.StringType(): "varchar", T.DoubleType(): "double precision"}
    columns = [f"{f.name} {sql_types.get(f.dataType, f.dataType.simpleString())}" for f in schema]
    body = ",\n    ".join([*columns, f"primary key ({key})"])
    return f"drop table if exists {table};\ncreate table {table} (\n    {body}\n);\n"

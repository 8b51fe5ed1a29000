from pyspark.sql import functions as F

from lakestrata.functions import clean_entity_name, normalize_values, to_double
from lakestrata.queries import tables as t
from lakestrata.sources import route_by_filename


def folded_documents(spark, sf_dir):
    return normalize_values(t.table(spark, sf_dir, "documents"))


def folded_conversations(spark, sf_dir):
    return normalize_values(t.table(spark, sf_dir, "conversations"))


def entity_names(spark, sf_dir):
    decorated = t.table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.expr("""case c_custkey % 3
                    when 0 then concat('  ', lower(c_name), ' (conglomerado) ', c_mktsegment, '  ')
                    when 1 then concat(lower(c_name), ' - prudencial x')
                    else concat(lower(c_name), '\\n(conglomerado) a\\n b') end""").alias("name"),
    )
    return clean_entity_name(decorated, "name")


def entity_names_in_documents(spark, sf_dir):
    """Whole texts, in which a suffix ends at its line break."""
    decorated = t.table(spark, sf_dir, "documents").select(
        "doc_id",
        F.expr("""if(doc_id % 2 = 0, concat('\\t', text, ' - prudencial x\\n'),
                     concat(source, ' (conglomerado) ', text))""").alias("text"),
    )
    return clean_entity_name(decorated, "text")


def numbers_from_text(spark, sf_dir):
    as_text = t.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.expr("""case o_orderkey % 6 when 0 then '' when 1 then ' ' when 2 then 'abc'
                    when 3 then '1,5' when 4 then concat(' ', o_orderkey, '.5 ')
                    else cast(o_orderkey as string) end""").alias("amount"),
    )
    return to_double(as_text, ["amount"])


def routed_rows(spark, sf_dir):
    """Green files of 2019 to 2022."""
    named = t.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.expr("""case when o_orderkey % 11 = 0 then 'green_tripdata_latest.parquet'
                       when o_orderkey % 2 = 0
                         then concat('green_tripdata_', 2017 + o_orderkey % 8, '-01.parquet')
                       else concat('yellow_tripdata_', 2017 + o_orderkey % 8, '-02.parquet')
                  end""").alias("file_name"),
    )
    return route_by_filename(named, "file_name", "green_tripdata_", (2019, 2022))


QUERIES = {
    "normalize_values": folded_documents,
    "normalize_values_conversations": folded_conversations,
    "clean_entity_name": entity_names,
    "clean_entity_name_documents": entity_names_in_documents,
    "to_double": numbers_from_text,
    "route_by_filename": routed_rows,
}

_FOLD = "translate(lower({0}), 'áàâãäéèêëíìîïóòôõöúùûüç', 'aaaaaeeeeiiiiooooouuuuc') as {0}"
_CLEAN = (
    "trim(regexp_replace(regexp_replace(regexp_replace({0}, '^\\s+|\\s+$', '', 'g'), "
    "'\\(conglomerado\\).*', '', 'g'), '- prudencial.*', '', 'g')) as {0}"
)

ORACLES = {
    "normalize_values": f"""
select doc_id, {_FOLD.format("text")}, {_FOLD.format("lang")}, {_FOLD.format("source")}, n_chars
from documents""",
    "normalize_values_conversations": f"""
select conv_id, turn, {_FOLD.format("role")}, {_FOLD.format("text")} from conversations""",
    "clean_entity_name": f"""
select c_custkey, {_CLEAN.format("name")} from (
  select c_custkey, case c_custkey % 3
    when 0 then '  ' || lower(c_name) || ' (conglomerado) ' || c_mktsegment || '  '
    when 1 then lower(c_name) || ' - prudencial x'
    else lower(c_name) || chr(10) || '(conglomerado) a' || chr(10) || ' b' end as name
  from customer)""",
    "clean_entity_name_documents": f"""
select doc_id, {_CLEAN.format("text")} from (
  select doc_id, case when doc_id % 2 = 0 then chr(9) || text || ' - prudencial x' || chr(10)
    else source || ' (conglomerado) ' || text end as text
  from documents)""",
    "to_double": """
select o_orderkey, case o_orderkey % 6 when 4 then o_orderkey + 0.5::double
    when 5 then o_orderkey::double end as amount
from orders""",
    "route_by_filename": """
select o_orderkey, 'green_tripdata_' || (2017 + o_orderkey % 8) || '-01.parquet' as file_name
from orders
where o_orderkey % 11 <> 0 and o_orderkey % 2 = 0 and 2017 + o_orderkey % 8 between 2019 and 2022""",
}

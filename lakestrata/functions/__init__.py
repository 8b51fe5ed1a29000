from lakestrata.functions.naming import normalize_columns, normalize_name
from lakestrata.functions.numbers import format_measure, to_double
from lakestrata.functions.text import (
    clean_entity_name,
    entity_name,
    fold_accents,
    normalize_values,
)

__all__ = [
    "clean_entity_name",
    "entity_name",
    "fold_accents",
    "format_measure",
    "normalize_columns",
    "normalize_name",
    "normalize_values",
    "to_double",
]

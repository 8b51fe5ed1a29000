"""Normalised column names."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame

from lakestrata.functions.text import ACCENTED, FOLDED

# U+0096 is what a Windows-1252 en dash becomes when read as
# ISO-8859-1; it is deleted. Separators become an underscore.
_LETTERS = str.maketrans(ACCENTED, FOLDED)
_SEPARATORS = str.maketrans({" ": "_", "-": "_", "\u0096": None})
_UPPER_O = str.maketrans("óòôõö", "OOOOO")


def normalize_name(name: str, legacy_upper_o: bool = False) -> str:
    """`Índice (%)` -> `indice__`.

    `legacy_upper_o=True` folds an accented o to a capital O, as datasets written
    by older versions of these jobs have it (`Código` -> `cOdigo`).
    """
    lowered = name.lower()
    if legacy_upper_o:
        lowered = lowered.translate(_UPPER_O)
    return lowered.translate(_LETTERS).replace("(%)", "_").translate(_SEPARATORS)


def normalize_columns(df: DataFrame, legacy_upper_o: bool = False) -> DataFrame:
    """Rename every column to its normalised name; two headers must not meet in one name."""
    names = [normalize_name(c, legacy_upper_o) for c in df.columns]
    headers = defaultdict(list)
    for header, name in zip(df.columns, names):
        headers[name.lower()].append(header)
    clashes = {name: found for name, found in headers.items() if len(found) > 1}
    if clashes:
        raise ValueError(f"headers with the same normalised name: {clashes}")
    return df.toDF(*names)

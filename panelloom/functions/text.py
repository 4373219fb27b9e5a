"""Text expressions.  Everything that touches data rows stays inside the JVM.

Expressions for data cells are built as SQL text, operand and result alike: a table has dozens
of rate columns, and one parsed expression each keeps plan building quick on the driver.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The two helpers below travel with their tasks; executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The characters Python's ``str.strip`` removes.
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
              "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
              "\u2028\u2029\u202f\u205f\u3000")
# Cell texts that stand for "no value".
MISSING_MARKERS = ("", "--", "-", "nan", "none", "null")


def quote(name: str) -> str:
    """A column name as SQL text."""
    return "`" + name.replace("`", "``") + "`"


def literal(value: str) -> str:
    """A string as SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def strip(text: str) -> str:
    """Nearly every cell starts and ends with a visible ASCII character and is left as it is;
    only the others are searched for the whole set of white space."""
    return (f"CASE WHEN left({text}, 1) BETWEEN '!' AND '~' AND right({text}, 1) BETWEEN '!' AND '~' "
            f"THEN {text} ELSE btrim({text}, {literal(WHITESPACE)}) END")


def blank_to_null(text: str) -> str:
    return f"nullif({strip(text)}, '')"


def fold_text(value: str | None) -> str:
    """Lower-case ``value``, decompose it for compatibility and drop combining marks."""
    if value is None or value != value:
        return ""
    decomposed = unicodedata.normalize("NFKD", value.strip().lower())
    return "".join(c for c in decomposed if not unicodedata.combining(c))


@F.pandas_udf(T.StringType())
def fold(texts: pd.Series) -> pd.Series:
    """Folded text; meant for sheet names, never for data rows."""
    return texts.map(fold_text)


@F.pandas_udf(T.ArrayType(T.StringType()))
def fold_cells(rows: pd.Series) -> pd.Series:
    """Folded cells of header candidates: at most a few dozen rows of each sheet."""
    return rows.map(lambda cells: [] if cells is None else [fold_text(c) for c in cells])


def column_name(folded: Column) -> Column:
    return F.replace(folded, F.lit(" "), F.lit("_"))


@functools.cache
def _marker_folding() -> tuple[str, str]:
    """Code points that fold to a letter of a missing marker, and those that fold to nothing.

    Derived from the Unicode data instead of being listed: the same rule as ``fold_text``,
    applied to every single character.
    """
    letters = set("".join(MISSING_MARKERS))
    targets, sources, dropped = [], [], []
    for point in (*range(0x80, 0xD800), *range(0xE000, 0x30000), *range(0xE0100, 0xE01F0)):
        char = chr(point)
        folded = fold_text(char) if not char.isspace() else char
        if folded == "":
            dropped.append(char)
        elif folded in letters and char.lower() == char:
            sources.append(char)
            targets.append(folded)
    return "".join(sources + dropped), "".join(targets)


def clean_cells(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Strips the cells of the given columns; NULL where a missing marker in any spelling remains."""
    sources, targets = map(literal, _marker_folding())
    markers = ", ".join(map(literal, MISSING_MARKERS))

    def cleaned(column: str) -> str:
        cell = quote(column)
        folded = (f"CASE WHEN {cell} RLIKE '[^\\\\x00-\\\\x7f]' THEN translate(lower({cell}), {sources}, {targets}) "
                  f"ELSE lower({cell}) END")
        return f"CASE WHEN {folded} NOT IN ({markers}) THEN {cell} END AS {cell}"

    others = [quote(c) for c in rows.columns if c not in columns]
    stripped = rows.selectExpr(*others, *[f"{strip(quote(c))} AS {quote(c)}" for c in columns])
    return stripped.selectExpr(*others, *[cleaned(c) for c in columns])


def padded(number: Column, width: Column | int) -> Column:
    """A number as text with leading zeros; a longer one stays whole, where `lpad` alone would cut it."""
    text = number.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, F.lit("0"))).otherwise(text)

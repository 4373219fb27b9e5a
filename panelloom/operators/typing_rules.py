"""From rows as read to the typed history, with flags for what breaks the contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from panelloom.contract import SCHOOL_RATES, Contract
from panelloom.functions.batches import with_numbers
from panelloom.functions.numbers import decimal_point, flag, parse_number, total, unless_marker
from panelloom.functions.text import literal, quote, strip

# Helper columns beside the history columns; dropped before anything is written.
ORDER = "_ordem"
TEXT_CELLS = "_celulas_textuais"
TEXT_RATE = "_taxa_textual_escola"
WRONG_YEAR = "_ano_divergente"
NUMERIC_CODE = "_codigo_numerico"
FLAGS = (ORDER, TEXT_CELLS, TEXT_RATE, WRONG_YEAR, NUMERIC_CODE)

_TEXT = "_texto_"
_POINT = "_ponto_"
_YEAR = "_ano_do_arquivo"
_UNREAD = "_taxas_nao_lidas"
_UNREAD_TEXTS = "_textos_nao_lidos"


def type_rows(rows: DataFrame, columns: Sequence[str], file_year: Column, order: Column,
              contract: Contract = SCHOOL_RATES, batches: bool = False) -> DataFrame:
    """Rows of files that share one schema, in the types and order of the history.

    Columns the files lack become NULL.  Rate text that is no number moves into a JSON
    object when the row names no entity; with an entity it is flagged as an error.

    Rates are read by expressions, of which only those of the wanted columns are computed, or, for plans that want
    all columns of many rows, in Arrow ``batches``: the same numbers without a copy of the wide row at each step.

    The steps are projections of their own because each result is used more than once.
    """
    source = {f.name: f.dataType for f in rows.schema.fields}
    rates = [c for c in columns if contract.is_rate(c)]
    # Floating-point and integer input is taken as it is; anything else goes through its text.
    as_double = [c for c in rates if isinstance(source.get(c), (T.DoubleType, T.IntegerType, T.LongType, T.ShortType))]
    as_text = [c for c in rates if c in source and c not in as_double]
    others = [c for c in columns if c not in rates and c not in (contract.year, contract.textual_rates)]
    numeric_codes = [f"{quote(c)} IS NOT NULL" for c in contract.code_digits
                     if isinstance(source.get(c), (T.NumericType, T.BooleanType))]

    def plain(column: str) -> str:
        if column not in source:
            return f"CAST(NULL AS STRING) AS {quote(column)}"
        return f"{strip(f'CAST({quote(column)} AS STRING)')} AS {quote(column)}"

    def kept(names: Sequence[str], prefix: str = "") -> list[str]:
        return [quote(prefix + n) for n in names]

    flags = [contract.year, ORDER, WRONG_YEAR, NUMERIC_CODE]
    located = rows.withColumns({_YEAR: file_year.cast("int"), ORDER: order})
    stripped = located.selectExpr(
        f"{_YEAR} AS {quote(contract.year)}", ORDER,
        f"coalesce({parse_number(f'btrim(CAST({quote(contract.year)} AS STRING))')} <> {_YEAR}, true) AS {WRONG_YEAR}",
        f"{' OR '.join(numeric_codes) or 'false'} AS {NUMERIC_CODE}",
        *[plain(c) for c in others],
        *[f"nanvl(CAST({quote(c)} AS DOUBLE), NULL) AS {quote(c)}" for c in as_double],
        *[f"{text if batches else strip(text)} AS {quote(_TEXT + c)}" for c in as_text for text in [f"CAST({quote(c)} AS STRING)"]])
    filled = [f"nullif({quote(c)}, '') AS {quote(c)}" for c in others]
    named = f"{quote(contract.entity)} IS NOT NULL"
    if not as_text:
        counted = stripped.selectExpr(*kept([*flags, *as_double]), *filled, f"0 AS {_UNREAD}")
        texts = first_rate = "CAST(NULL AS STRING)"
    elif batches:
        present = stripped.selectExpr(*kept([*flags, *as_double]), *filled, *kept(as_text, _TEXT))
        counted = with_numbers(present, rates, {c: _TEXT + c for c in as_text}, _UNREAD_TEXTS).selectExpr(
            "*", f"CASE WHEN {_UNREAD_TEXTS} IS NULL THEN 0 ELSE size({_UNREAD_TEXTS}) END AS {_UNREAD}")
        texts = f"CASE WHEN NOT {named} THEN to_json({_UNREAD_TEXTS}) END"
        first_rate = f"CASE WHEN {named} THEN map_keys({_UNREAD_TEXTS})[0] END"
    else:
        present = stripped.selectExpr(
            *kept([*flags, *as_double]), *filled,
            *[f"{unless_marker(quote(_TEXT + c))} AS {quote(_TEXT + c)}" for c in as_text])
        pointed = present.selectExpr("*", *[f"{decimal_point(quote(_TEXT + c))} AS {quote(_POINT + c)}" for c in as_text])
        typed = pointed.selectExpr(*kept([*flags, *as_double, *others]), *kept(as_text, _TEXT),
                                   *[f"{parse_number(quote(_POINT + c))} AS {quote(c)}" for c in as_text])

        unread = {c: f"({quote(_TEXT + c)} IS NOT NULL AND {quote(c)} IS NULL)" for c in as_text}
        counted = typed.selectExpr("*", f"{total([flag(condition) for condition in unread.values()])} AS {_UNREAD}")
        entries = ", ".join(f"CASE WHEN {condition} THEN struct({literal(c)} AS key, {quote(_TEXT + c)} AS value) END"
                            for c, condition in unread.items())
        texts = (f"CASE WHEN NOT {named} AND {_UNREAD} > 0 "
                 f"THEN to_json(map_from_entries(array_compact(array({entries})))) END")
        first = ", ".join(f"CASE WHEN {condition} THEN {literal(c)} END" for c, condition in unread.items())
        first_rate = f"CASE WHEN {named} AND {_UNREAD} > 0 THEN coalesce({first}) END"
    final = []
    for column in columns:
        if column == contract.textual_rates:
            final.append(f"{texts} AS {quote(column)}")
        elif column in rates and column not in counted.columns:
            final.append(f"CAST(NULL AS DOUBLE) AS {quote(column)}")
        else:
            final.append(quote(column))
    return counted.selectExpr(
        *final, ORDER, f"CASE WHEN {named} THEN 0 ELSE {_UNREAD} END AS {TEXT_CELLS}",
        f"{first_rate} AS {TEXT_RATE}", WRONG_YEAR, NUMERIC_CODE)

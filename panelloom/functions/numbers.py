"""Reading numbers written as text.  Operands and results are SQL text, see ``text``."""

from __future__ import annotations

from collections.abc import Sequence

# Rate texts that mean "no value".
RATE_MARKERS = ("", "--", "-")
# Accepted spellings of infinity, compared in lower case.
POSITIVE_INFINITY = ("inf", "+inf", "infinity", "+infinity")
NEGATIVE_INFINITY = ("-inf", "-infinity")


def _listed(values: Sequence[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def unless_marker(stripped: str) -> str:
    """A stripped rate text, NULL for a missing marker."""
    return f"CASE WHEN {stripped} NOT IN ({_listed(RATE_MARKERS)}) THEN {stripped} END"


def decimal_point(text: str) -> str:
    """A decimal comma becomes a point; every comma counts."""
    return f"replace({text}, ',', '.')"


def parse_number(text: str) -> str:
    """A double, or NULL when the text is not a plain decimal literal or an infinity.

    The character test keeps out what a JVM cast would take (``1d``, ``0x1p3``, ``nan``);
    a finite literal too large for a double is not a number either.  Without an exponent a few digits cannot
    be too large: nearly every text is cast once and not looked at again.
    """
    infinity = "double('infinity')"
    return (f"CASE WHEN {text} RLIKE '^[0-9.+-]{{1,300}}$' THEN try_cast({text} AS DOUBLE) "
            f"WHEN {text} RLIKE '^[0-9eE.+-]+$' "
            f"THEN nullif(nullif(try_cast({text} AS DOUBLE), {infinity}), -{infinity}) "
            f"WHEN lower({text}) IN ({_listed(POSITIVE_INFINITY)}) THEN {infinity} "
            f"WHEN lower({text}) IN ({_listed(NEGATIVE_INFINITY)}) THEN -{infinity} END")


def total(terms: Sequence[str]) -> str:
    """Sum of many terms as a balanced tree, so that wide tables do not nest deeply."""
    if len(terms) <= 1:
        return terms[0] if terms else "0"
    middle = len(terms) // 2
    return f"({total(terms[:middle])} + {total(terms[middle:])})"


def flag(condition: str) -> str:
    """1 where the condition holds, else 0, NULL included."""
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def out_of_range(value: str, lowest: float, highest: float) -> str:
    """True for a present value outside the bounds; NaN and the infinities are outside."""
    return f"({value} IS NOT NULL AND NOT ({value} BETWEEN {lowest}D AND {highest}D))"


def within_range(value: str, lowest: float, highest: float) -> str:
    """The value, or NULL when it is outside the bounds."""
    return f"CASE WHEN {value} BETWEEN {lowest}D AND {highest}D THEN {value} END"

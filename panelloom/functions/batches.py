"""Numbers written as text, read from whole Arrow columns: the rules of ``numbers`` over a column's distinct texts."""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterable, Iterator, Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from panelloom.functions.numbers import NEGATIVE_INFINITY, POSITIVE_INFINITY, RATE_MARKERS
from panelloom.functions.text import WHITESPACE

# What is below travels with its tasks; executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

INFINITIES = {**dict.fromkeys(POSITIVE_INFINITY, math.inf), **dict.fromkeys(NEGATIVE_INFINITY, -math.inf)}
BLANK, MARKERS = WHITESPACE, RATE_MARKERS
NUMBER = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
# Texts that Arrow reads as Spark does: nearly all.  The others, and those that could be too large, are looked at one by one.
PLAIN = r"\A-?([0-9]+\.?[0-9]*|\.[0-9]+)\z"
LONGEST = 300


def number(text: str) -> float | None:
    """``numbers.parse_number`` of one text with its decimal point."""
    if re.fullmatch(NUMBER, text):
        value = float(text)
        return value if math.isfinite(value) else None
    return INFINITIES.get(text.lower())


def read_texts(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Stripped texts, NULL for a missing marker, and their numbers, NULL where there is none."""
    stripped = pc.utf8_trim(texts, characters=BLANK)
    stripped = pc.if_else(pc.is_in(stripped, value_set=pa.array(MARKERS, stripped.type)), pa.scalar(None, stripped.type), stripped)
    pointed = pc.replace_substring(stripped, ",", ".")
    plain = pc.and_(pc.match_substring_regex(pointed, PLAIN), pc.less_equal(pc.binary_length(pointed), LONGEST))
    numbers = pc.cast(pc.if_else(plain, pointed, pa.scalar(None, pointed.type)), pa.float64())
    if pc.any(pc.invert(plain)).as_py():
        rest = pa.array([None if known or text is None else number(text) for known, text in zip(plain.to_pylist(), pointed.to_pylist())], pa.float64())
        numbers = pc.coalesce(numbers, rest)
    return stripped, numbers


def read_column(column: pa.Array) -> tuple[pa.Array, list[tuple[int, str]]]:
    """The numbers of a column, and the places and texts of those that are none.  Each distinct text is read once."""
    encoded = column.dictionary_encode()
    texts, numbers = read_texts(encoded.dictionary)
    unread = pc.and_(pc.is_valid(texts), pc.is_null(numbers))
    places = []
    if pc.any(unread).as_py():
        told = pc.take(pc.if_else(unread, texts, pa.scalar(None, texts.type)), encoded.indices)
        places = [(i, told[i].as_py()) for i in pc.indices_nonzero(pc.is_valid(told)).to_pylist()]
    return pc.take(numbers, encoded.indices), places


def with_numbers(rows: DataFrame, names: Sequence[str], texts: Mapping[str, str], unread: str) -> DataFrame:
    """All columns of ``rows`` but the text columns, and a number under each of ``names``.

    ``texts`` tells the text column that a number is read from; one that has none is a column of its name, or NULL.  The
    columns are the same for tables that lack some, so that one compiled projection serves what follows for all of them.
    What is neither a number nor a missing marker is told in the map ``unread``, name to text, NULL where there is none.
    """
    names, texts = list(names), dict(texts)
    others = [f for f in rows.schema.fields if f.name not in {*names, *texts.values()}]
    present = set(rows.columns)
    schema = T.StructType([*others, *[T.StructField(name, T.DoubleType()) for name in names],
                           T.StructField(unread, T.MapType(T.StringType(), T.StringType()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, told = [], [None] * batch.num_rows
            for name in names:
                if name not in texts:
                    numbers.append(batch.column(name) if name in present else pa.nulls(batch.num_rows, pa.float64()))
                    continue
                column, places = read_column(batch.column(texts[name]))
                numbers.append(column)
                for i, text in places:
                    told[i] = [*(told[i] or ()), (name, text)]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in others], *numbers, pa.array(told, pa.map_(pa.string(), pa.string()))],
                                             names=schema.names)

    return rows.mapInArrow(run, schema)

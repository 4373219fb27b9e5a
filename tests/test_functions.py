"""Text, number and hash functions against plain Python on hand-made and generated values."""

import hashlib
import json
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from panelloom.functions.hashing import fingerprint, row_signature, with_content_id
from panelloom.functions.numbers import decimal_point, parse_number, unless_marker
from panelloom.functions.text import MISSING_MARKERS, blank_to_null, clean_cells, fold, fold_cells, fold_text, strip

SPACES = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isspace())


def column(spark, values, name="x", kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} {kind}")


def results(frame, expression):
    return [r.r for r in frame.selectExpr("i", f"{expression} AS r").orderBy("i").collect()]


def test_strip_is_pythons(spark):
    texts = [s + "a" + s + "é" + s for s in SPACES] + ["", " ", "a", "é ", " ​", SPACES, "x" + SPACES + "y", None]
    assert results(column(spark, texts), strip("x")) == [t if t is None else t.strip() for t in texts]
    assert results(column(spark, ["", " \t", " a "]), blank_to_null("x")) == [None, None, "a"]


def test_clean_cell_knows_markers_in_any_spelling(spark):
    rng = random.Random(7)
    single = [chr(c) for c in (*range(0x20, 0x3000), *range(0xFB00, 0x10000), *range(0x1D400, 0x1D800))
              if not 0xD800 <= c < 0xE000]
    lookalikes = [c for c in single if fold_text(c) in set("-naoeul") and fold_text(c)]
    texts = ["NaN", " null ", "－", "--", "-", "- -", "nañ", "NONE", "ñan", "nulo", "nan.", "", " ", None, "ℕone", "ﬁ"]
    texts += single[::7]
    for marker in ("--", "-", "nan", "none", "null"):
        for _ in range(60):
            texts.append("".join(rng.choice([c for c in lookalikes if fold_text(c) == m] + [m, m.upper()])
                                 + rng.choice(["", "", "́"]) for m in marker))

    def expected(text):
        if text is None:
            return None
        stripped = text.strip()
        return None if fold_text(stripped) in MISSING_MARKERS else stripped

    found = [r.x for r in clean_cells(column(spark, texts), ["x"]).orderBy("i").collect()]
    assert found == [expected(t) for t in texts]


def test_fold(spark):
    texts = ["Município", " Nº da ESCOLA ", "1ª série", "ﬁm", None, "ÀÉÎÕÜ"]
    rows = column(spark, texts).select("i", fold("x").alias("r"), fold_cells(F.array("x")).alias("c")).orderBy("i").collect()
    plain = ["municipio", "no da escola", "1a serie", "fim", "", "aeiou"]
    assert [r.r for r in rows] == plain and [r.c for r in rows] == [[p] for p in plain]
    assert unicodedata.normalize("NFKD", "º") == "o"


@pytest.mark.parametrize("text,value", [
    ("92,1", 92.1), ("1e2", 100.0), (".5", 0.5), ("5.", 5.0), ("+5", 5.0), ("-2", -2.0), ("0", 0.0),
    ("inf", float("inf")), ("INF", float("inf")), ("-Infinity", float("-inf")), ("+infinity", float("inf")),
    ("1d", None), ("1f", None), ("nan", None), ("NaN", None), ("1e400", None), ("-1e999", None), ("0x10", None),
    ("1,2,3", None), ("texto", None), ("1 2", None), (".", None), ("e5", None), ("1e", None), ("--5", None), (None, None)])
def test_numbers(spark, text, value):
    frame = column(spark, [text]).selectExpr("i", f"{decimal_point('x')} AS x")
    assert results(frame, parse_number("x")) == [value]


def test_rate_markers(spark):
    assert results(column(spark, ["", "-", "--", "---", "0", None]), unless_marker("x")) == [None, None, None, "---", "0", None]


def test_content_id_is_the_hash_of_compact_json(spark):
    rng = random.Random(3)
    alphabet = ["a", "é", "\"", "\\", "\t", "\n", "\r", "\b", "\f", "\x0b", "\x1f", "\x00", "\x0e", "\x1a", "\x7f",
                " ", "😀", "/", "'", "u000B", "\\u001F", "<", "&", None]
    rows = []
    for _ in range(300):
        pick = [rng.choice(alphabet[:-1]) * rng.randint(1, 2) + rng.choice(alphabet[:-1]) for _ in range(3)]
        rows.append(tuple(None if rng.random() < 0.2 else p for p in pick))
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string, c string")
    found = [r.h for r in with_content_id(frame, ["a", "b", "c"], "h").orderBy("i").collect()]

    def expected(values):
        if values[0] is None:
            return None
        return hashlib.sha256(json.dumps(values, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()

    assert found == [expected(r) for r in rows]


def test_signature_tells_null_sign_and_place_apart(spark):
    rows = [(None, "a", 0.0), ("a", None, 0.0), (None, "a", -0.0), (None, "a", 0.0)]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string, c double")
    one, two, three, four = [bytes(r.s) for r in frame.select("i", row_signature(["a", "b", "c"]).alias("s")).orderBy("i").collect()]
    assert one == four and len({one, two, three}) == 3


def test_fingerprint_ignores_order_and_sees_changes(spark):
    rows = [(i, None if i % 3 else "x", i / 7) for i in range(200)]
    frame = spark.createDataFrame(rows, "a int, b string, c double")
    base = fingerprint(frame, "t").first()
    assert fingerprint(frame.select("c", "b", "a").repartition(5), "t").first() == base
    moved = frame.select("a", F.when(F.col("a") == 3, "y").otherwise(F.col("b")).alias("b"), "c")
    assert fingerprint(moved, "t").first() != base
    assert fingerprint(frame.unionAll(frame.limit(2)), "t").first() != base
    swapped = spark.createDataFrame([("a", None)], "a string, b string")
    assert fingerprint(swapped, "t").first() != fingerprint(spark.createDataFrame([(None, "a")], "a string, b string"), "t").first()
    assert fingerprint(frame.where("false"), "t").first().linhas == 0


def test_padding_keeps_longer_numbers(spark):
    from panelloom.functions.text import padded
    rows = spark.createDataFrame([(7,), (12345678,), (100000001,), (None,)], "k long")
    assert [r[0] for r in rows.select(padded(rows["k"], 8)).collect()] == ["00000007", "12345678", "100000001", None]


def test_chunked_forms_keep_rows_with_nulls(spark):
    from pyspark.sql import functions as F

    from panelloom.operators.headers import forward_fill, forward_fill_chunked, unique_names, unique_names_chunked
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), (None, 3, "x"), (None, 5000, None), ("a", None, "z"), ("a", 9000, "x"), (None, 9001, "x")],
                                 "s string, o long, v string")
    for plain, chunked in ((forward_fill(rows, F.col("v"), ["s"], "o", "out"), forward_fill_chunked(rows, F.col("v"), ["s"], "o", "out")),
                           (unique_names(rows, ["s"], "o", "v", "out"), unique_names_chunked(rows, ["s"], "o", "v", "out"))):
        assert sorted(map(str, plain.collect())) == sorted(map(str, chunked.collect()))

"""The Merkle manifest against a tree built in plain Python."""

import hashlib
import zlib

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from panelloom.llm import merkle
from panelloom.llm.oracles import merkle_sql

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, leaf string, `_g` int, root string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row.doc_id, row.source, row.lang, row.n_chars, row.text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row.lang, []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r)))
    trees = {g: levels([leaf(r) for r in groups[g]]) for g in names}
    top = levels([trees[g][-1][0] for g in names])
    out = []
    for place, g in enumerate(names):
        for i, row in enumerate(groups[g]):
            now, beside = leaf(row), ""
            if row.doc_id is not None and row.text is not None and zlib.crc32(str(row.doc_id).encode()) % 3 == 0:
                changed = row.text.translate({c: c + 32 for c in range(65, 91)})
                now = leaf(type("Row", (), {**row.asDict(), "text": changed}))
            for tree, at in ((trees[g], i), (top, place)):
                for level in tree[:-1]:
                    run, slot = level[at // 8 * 8:at // 8 * 8 + 8], at % 8
                    beside += "".join(run[:slot] + run[slot + 1:])
                    now = h(*run[:slot], now, *run[slot + 1:])
                    at //= 8
            out.append((row.doc_id, leaf(row), trees[g][-1][0], top[-1][0], h(beside), now, now == top[-1][0]))
    return sorted(out, key=str)


def found(docs, **parameters):
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, lowered).otherwise(F.col("text"))
    return sorted([tuple(r) for r in merkle.manifest(docs, tampered={"text": tampered}, **parameters).collect()], key=str)


@pytest.fixture(scope="module")
def odd(spark):
    """NULLs in every column, equal rows and ids, empty and very long texts, many small languages, clashing names."""
    rows = [(1, "A text", "en", "s", 6), (1, "A text", "en", "s", 6), (1, "other", "en", "s", 5), (None, "No ID", "en", None, None), (None, None, None, None, None),
            (3, "", "", "", 0), (3, None, "", "", None), (6, "É" * 90_000 + "A", "fr", "s", 90_001)]
    rows += [(i, f"Text {i}", f"l{i % 11}" if i % 2 else "de", None, i) for i in range(10, 160)]
    return spark.createDataFrame([(*r, "x", "y", 1, "z") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("of_block", [1, 2, 4])
def test_odd_rows(odd, of_block):
    assert found(odd, levels=of_block) == expected(odd.collect())


def test_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = found(docs)
    assert rows == expected(docs.collect()) and {True, False} == {r[-1] for r in rows}
    connection = connect(FOLDER)
    assert difference(merkle.op11_merkle_manifest(spark, FOLDER).toPandas(), connection.execute(merkle_sql()).df()) is None


def test_few_rows(spark, odd):
    assert found(odd.limit(0)) == []
    lone = spark.createDataFrame([(5, "Only", None, None, 4)], "doc_id long, text string, lang string, source string, n_chars long")
    (row,) = found(lone)
    assert row[1] == row[2] == row[3] and row[4] == h("") and row[6] == (zlib.crc32(b"5") % 3 != 0)


def test_a_parent_resumes_its_states():
    parent = merkle.Parent([h(str(i)).encode() for i in range(8)])
    for slot in range(8):
        other = h("other").encode()
        plain = hashlib.sha256(b"".join((*parent.children[:slot], other, *parent.children[slot + 1:]))).hexdigest().encode()
        assert parent.folded(slot, other) == plain and parent.folded(slot, parent.children[slot]) == parent.digest

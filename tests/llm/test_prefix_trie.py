"""The trie of conversation prefixes against one built from dictionaries."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from compare import connect, difference

from panelloom.llm import prefix_trie
from panelloom.llm.oracles import trie_sql

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, node string, depth int, block string, `members` int"


def expected(rows):
    turns = {}
    for row in rows:
        if row.conv_id is not None:
            role, text = row.role or "", row.text or ""
            code = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            turns.setdefault(row.conv_id, []).append((row.turn is not None, row.turn or 0, code, role, text))
    turns = {c: [t[3:] for t in sorted(ts)] for c, ts in turns.items()}
    nodes, whole = {}, {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = (*turns.get(c - int(math.fmod(c, 20)), [])[:h], *own[h:])
        for d in range(len(whole[c]) + 1):
            nodes.setdefault(whole[c][:d], []).append(c)
    children, leaves, saved = ({k: 0 for k in nodes} for _ in range(3))
    for k in nodes:
        if k:
            children[k[:-1]] += 1
    for k, members in nodes.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(members) - 1) * words
            leaves[k[:d]] += children[k] == 0
    out = []
    for k, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(whole[c]) == len(k))
        out.append((min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), children[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(conversations, **parameters):
    return sorted([tuple(r) for r in prefix_trie.prefix_trie(conversations, **parameters).collect()], key=str)


@pytest.fixture(scope="module")
def odd(spark):
    """NULLs in every column, tied and repeated turns, empty and long conversations, many equal ones, negative ids."""
    random.seed(4)
    rows = [(c, random.choice([None, *range(10)]), random.choice(["u", "a", None]), random.choice([None, "", "x y", "z", " q\tr s"]))
            for c in range(-30, 150) for _ in range(random.choice([0, 1, 1, 2, 3, 5, 9]))]
    rows += [(None, 1, "u", "t"), (None, None, None, None)] + [(7000 + 20 * i, 0, "u", "same") for i in range(40)]
    rows += [(9000, i, "u", f"t{i % 3} w") for i in range(300)] + [(9001, i, "u", f"t{i % 3} w") for i in range(290)]
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("block_turns", [1, 7, 60, 200_000])
def test_odd_rows(odd, block_turns):
    """Blocks of any size, down to one sequence, give the same nodes."""
    assert found(odd, block_turns=block_turns) == expected(odd.collect())


def test_conversations(spark):
    given = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    assert found(given) == expected(given.collect())
    assert difference(prefix_trie.op13_prefix_trie(spark, FOLDER).toPandas(), connect(FOLDER).execute(trie_sql()).df()) is None


def test_empty_table(odd):
    assert found(odd.limit(0)) == []


def test_extents():
    random.seed(2)
    values = np.array([random.randrange(6) for _ in range(97)])
    table = prefix_trie.RangeMinimum(values)
    for bound in range(7):
        at = np.arange(97)
        right, left = (f(at, np.full(97, bound)) for f in (table.right_extent, table.left_extent))
        for i in at:
            r, l = i, i
            while r + 1 < 97 and values[r + 1] >= bound:
                r += 1
            while l > 0 and values[l] >= bound:
                l -= 1
            assert (l, r) == (left[i], right[i])
            assert table.of(at[i:i + 1], right[i:i + 1])[0] == values[i:r + 1].min()

"""Operator 11: a Merkle manifest of a dataset; parents keep a copied hash state in front of every child."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.llm.common import gapless_rank, keep_table, table

FANOUT = 8
# Levels that one task builds at a time; a block is what lies below one node of the highest of them.
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "_g string, _p long, _n long, subroot string, root string, slots array<int>, runs array<string>"
NODE = "_g string, _p long, _n long, digest binary"
HEX = 64


class Parent:
    """The node over a run of children.  ``states[i]`` is its hash as it stood before child i went in."""

    def __init__(self, children: Sequence[bytes]):
        self.children, self.states = children, []
        state = hashlib.sha256()
        for child in children:
            self.states.append(state.copy())
            state.update(child)
        self.digest = state.hexdigest().encode()

    def folded(self, slot: int, digest: bytes) -> bytes:
        """The parent's digest with another child in the slot: the state before it, the replacement, what is right of it."""
        state = self.states[slot].copy()
        state.update(digest)
        state.update(b"".join(self.children[slot + 1:]))
        return state.hexdigest().encode()

    def siblings(self, slot: int) -> bytes:
        return b"".join((*self.children[:slot], *self.children[slot + 1:]))

    @classmethod
    def parsed(cls, run: str) -> Parent:
        data = run.encode()
        return cls([data[i:i + HEX] for i in range(0, len(data), HEX)])


def height(nodes: int, levels: int, fanout: int) -> int:
    """Levels a block rises: all of them below other blocks, else until one node remains."""
    rise = 0
    while rise < levels and nodes > 1:
        nodes, rise = -(-nodes // fanout), rise + 1
    return rise


def grown(digests: list[bytes], rise: int, fanout: int) -> list[list[Parent]]:
    """The parents of each level, lowest first."""
    out: list[list[Parent]] = []
    for _ in range(rise):
        out.append([Parent(digests[i:i + fanout]) for i in range(0, len(digests), fanout)])
        digests = [parent.digest for parent in out[-1]]
    return out


def _sorted_columns(rows: pa.Table) -> dict[str, list]:
    return rows.sort_by("_p").to_pydict()


def _hex(digests: Sequence[bytes]) -> list[bytes]:
    return [d.hex().encode() for d in digests]


def climbed(nodes: DataFrame, name: str, levels: int, fanout: int) -> list[DataFrame]:
    """The given nodes and, block round by block round, the nodes above them, up to one per group.

    A round turns the at most ``fanout ** levels`` nodes of a block into one, so no task holds more than
    a block, whatever a group holds.
    """
    span = fanout ** levels

    def rise(key: tuple, rows: pa.Table) -> pa.Table:
        part = _sorted_columns(rows)
        digests, n = _hex(part["digest"]), part["_n"][0]
        tree = grown(digests, height(n, levels, fanout), fanout)
        top = tree[-1][0].digest if tree else digests[0]
        return pa.table({"_g": [part["_g"][0]], "_p": [part["_p"][0] // span], "_n": [-(-n // span)],
                         "digest": [bytes.fromhex(top.decode())]}, pa.schema([("_g", pa.string()), ("_p", pa.int64()), ("_n", pa.int64()), ("digest", pa.binary())]))

    rounds = [nodes]
    while len(rounds) == 1 or (rounds[-1].agg(F.max("_n")).first()[0] or 0) > 1:
        below = rounds[-1].select("_g", "_p", "_n", "digest", F.expr(f"_p div {span}").alias("_b"))
        rounds.append(keep_table(below.groupBy("_g", "_b").applyInArrow(rise, NODE), f"{name}-{len(rounds)}"))
    return rounds


def _walk(digests: list[bytes], n: int, path: dict[str, list], levels: int, fanout: int) -> Iterator[list[tuple[Parent, int]]]:
    """Per node of a block the parents up to the root, each with the slot the way takes."""
    tree = grown(digests, height(n, levels, fanout), fanout)
    above = [(Parent.parsed(run), slot) for run, slot in zip(path["runs"][0], path["slots"][0])]
    for i in range(len(digests)):
        here = []
        for level in tree:
            here.append((level[i // fanout], i % fanout))
            i //= fanout
        yield here + above


def _beside(nodes: DataFrame, paths: DataFrame, function: Callable, schema: str, span: int) -> DataFrame:
    """``function`` of the nodes of each block and of the path of the node that the block ends in."""
    blocks = nodes.withColumn("_b", F.expr(f"_p div {span}")).groupBy("_g", "_b")
    return blocks.cogroup(paths.withColumn("_b", F.col("_p")).groupBy("_g", "_b")).applyInArrow(function, schema)


def descended(nodes: DataFrame, paths: DataFrame, levels: int, fanout: int) -> DataFrame:
    """The paths of nodes, from the paths of the nodes one round above."""

    def extend(rows: pa.Table, above: pa.Table) -> pa.Table:
        part, path = _sorted_columns(rows), above.to_pydict()
        ways = list(_walk(_hex(part["digest"]), part["_n"][0], path, levels, fanout))
        n = len(ways)
        return pa.table([part["_g"], part["_p"], part["_n"], path["subroot"] * n, path["root"] * n,
                         pa.array([[slot for _, slot in way] for way in ways], pa.list_(pa.int32())),
                         pa.array([[b"".join(parent.children).decode() for parent, _ in way] for way in ways], pa.list_(pa.string()))],
                        names=["_g", "_p", "_n", "subroot", "root", "slots", "runs"])

    return _beside(nodes, paths, extend, PATH, fanout ** levels)


def leaf_hash(values: Sequence[Column]) -> Column:
    """H of the values, each `-` if NULL, else its number of UTF-8 bytes, a colon and itself."""
    told = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.unhex(F.sha2(F.concat(*told), 256))


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "lang", fields: Sequence[str] = FIELDS,
             tampered: Mapping[str, Column] | None = None, levels: int = LEVELS, fanout: int = FANOUT) -> DataFrame:
    """One row per document: key, leaf, subroot, root, proof_sha256, folded_root, verified.

    Leaves of a ``group`` value ascend by key (NULL first, equal keys by leaf); every ``fanout``
    consecutive nodes become the hash of their concatenation until one, the subroot, remains; subroots,
    NULL group first, then bytewise, become the root alike.  ``tampered`` gives other values of fields:
    the leaf they make is folded up the document's way, where each parent resumes the hash state it
    kept before the slot.  `verified` tells whether that ends in the root.

    A NULL field is told apart from an empty one.  Rows repeated exactly are leaves of their own, with
    equal leaves beside each other, so their proofs differ by position only.  A NULL key is a key; an empty
    table has no rows and no root.  Other columns of the input are not looked at, whatever their names.

    Texts are hashed where they are read; what is ranked, grouped and joined are digests.  A task holds a
    block of ``fanout ** levels`` digests; a group of any size is many blocks.
    """
    span = fanout ** levels
    plain = [F.col(f) for f in fields]
    changed = leaf_hash([(tampered or {}).get(f, c) for f, c in zip(fields, plain)])
    # The length before the value keeps NULL in front; values sort bytewise.
    rows = docs.select(F.when(F.col(group).isNull(), F.lit("-")).otherwise(F.concat(F.lit(":"), F.col(group).cast("string"))).alias("_g"),
                       F.col(key).alias("_key"), leaf_hash(plain).alias("digest"), changed.alias("_changed"))
    rows = rows.withColumn("_null", F.col("_g") != "-")
    ranked = gapless_rank(rows, [F.col("_null"), F.col("_g"), F.col("_key"), F.col("digest")], "_rank", "merkle-rows")
    sizes = keep_table(ranked.groupBy("_g", "_null").agg(F.min("_rank").alias("_first"), F.count(F.lit(1)).alias("_n")), "merkle-groups")
    leaves = keep_table(ranked.join(sizes.select("_g", "_first", "_n"), "_g")
                        .select("_g", (F.col("_rank") - F.col("_first")).alias("_p"), "_n", "digest", "_key",
                                F.when(F.col("_changed") != F.col("digest"), F.col("_changed")).alias("_changed")), "merkle-leaves")
    rounds = climbed(leaves, "merkle-nodes", levels, fanout)

    # The subroots as leaves of one more tree.
    order = gapless_rank(sizes.select("_g", "_null"), [F.col("_null"), F.col("_g")], "_place", "merkle-order")
    groups = order.agg(F.count(F.lit(1)).alias("_groups"))
    subroots = keep_table(rounds[-1].join(order, "_g").crossJoin(groups)
                          .select(F.lit("").alias("_g"), F.col("_place").alias("_p"), F.col("_groups").alias("_n"), "digest", F.col("_g").alias("_name")), "merkle-subroots")
    tops = climbed(subroots, "merkle-tops", levels, fanout)
    root = F.lower(F.hex("digest"))
    paths = tops[-1].select("_g", "_p", "_n", F.lit("").alias("subroot"), root.alias("root"),
                            F.array().cast("array<int>").alias("slots"), F.array().cast("array<string>").alias("runs"))
    for nodes in reversed(tops[:-1]):
        paths = descended(nodes.select("_g", "_p", "_n", "digest"), paths, levels, fanout)
    paths = (paths.join(subroots.select("_p", "_name", F.lower(F.hex("digest")).alias("_sub")), "_p")
             .select(F.col("_name").alias("_g"), F.lit(0).cast("long").alias("_p"), F.lit(1).cast("long").alias("_n"), F.col("_sub").alias("subroot"), "root", "slots", "runs"))
    for nodes in reversed(rounds[1:-1]):
        paths = descended(nodes, paths, levels, fanout)

    kind = {f.name: f.dataType for f in docs.schema.fields}[key].simpleString()

    def prove(part: pa.Table, above: pa.Table) -> pa.Table:
        part, path = part.sort_by("_p"), above.to_pydict()
        originals, others = _hex(part["digest"].to_pylist()), part["_changed"].to_pylist()
        proofs, folded = [], []
        upper: dict[int, bytes] = {}
        for i, way in enumerate(_walk(originals, part["_n"][0].as_py(), path, levels, fanout)):
            # The siblings above the first level are the same for all leaves of a run.
            if i // fanout not in upper:
                upper = {i // fanout: b"".join(parent.siblings(slot) for parent, slot in way[1:])}
            first = way[0][0].siblings(way[0][1]) if way else b""
            proofs.append(hashlib.sha256(first + upper[i // fanout]).hexdigest())
            digest = originals[i] if others[i] is None else others[i].hex().encode()
            for parent, slot in way:
                digest = parent.folded(slot, digest)
            folded.append(digest.decode())
        n, root = len(proofs), path["root"][0]
        return pa.table([part["_key"], [x.decode() for x in originals], path["subroot"] * n, [root] * n, proofs, folded, [f == root for f in folded]],
                        names=["_key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    out = _beside(leaves, paths, prove, f"_key {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean", span)
    return out.withColumnRenamed("_key", key)


def op11_merkle_manifest(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    chosen = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return manifest(docs, tampered={"text": F.when(chosen, lowered).otherwise(F.col("text"))})

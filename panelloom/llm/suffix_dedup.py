"""Operator 9: repeated byte strings across documents, by distributed prefix doubling on sparse positions.

Ranking every suffix of the corpus would shuffle each byte as a row, once per doubling.  So the first
rank is taken on few positions only.  Every 50-byte string contains 31 strings of 20 bytes; the one with
the smallest hash is its anchor.  Equal 50-byte strings have equal anchors, so a string whose anchor is
unique in the corpus is unique and leaves after the first round.  The strings that start at neighbouring
places mostly share an anchor; such a run of starts, a stretch, travels as one item.

Round 1 ranks anchors (20 bytes): blocks of documents send the hashes of their anchors to the hash's
bucket, and hear which occur in more than one document.  Round 2 sends the bytes of the stretches whose
anchor is shared to the anchor's bucket.  There the names of 2, 4, .. 32 bytes are formed from pairs of
names at growing offsets; places whose 32-byte name belongs to one document leave, the others are ranked
by the pair of names at offset 18, which spans the 50 bytes, and each learns the smallest document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.llm.common import MULTIPLIER, in_arrow, keep_table, mixed, record, table, text_chunks

LENGTH, ANCHOR = 50, 20
WINDOWS = LENGTH - ANCHOR + 1
BLOCK_BYTES = 2 << 20
BUCKET_BYTES = 2 << 20
_LAST = np.iinfo(np.int64).max
_BYTE_NAMES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _pack(values: np.ndarray | bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(values if isinstance(values, bytes) else np.ascontiguousarray(values).tobytes())


def _unpack(cell, kind=np.uint8) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(cell), kind)


def names(data: np.ndarray, length: int) -> np.ndarray:
    """The names of all strings of the length, each formed from two names at an offset.

    The last pair may overlap: it still stands for the whole string.
    """
    n = len(data) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    known, width = _BYTE_NAMES[data], 1
    while width < length:
        offset = min(width, length - width)
        power = np.uint64(pow(int(MULTIPLIER), width, 1 << 64))
        first = known[:len(known) - offset] * power
        first += known[offset:]
        known, width = first, width + offset
    return mixed(known)


def stretches(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of starts, offset of the anchor from the first start) of each stretch, in text order.

    Stretches tile the places at which a string of LENGTH bytes starts within its document.
    """
    n = len(data) - LENGTH + 1
    if n <= 0:
        return np.empty(0, np.uint8), np.empty(0, np.uint8)
    place_bits = np.uint64(max(1, int(len(data)).bit_length()))
    packed = (names(data, ANCHOR) >> place_bits << place_bits) | np.arange(len(data) - ANCHOR + 1, dtype=np.uint64)
    width = 1
    while 2 * width <= WINDOWS:
        packed = np.minimum(packed[:-width], packed[width:])
        width *= 2
    rest = WINDOWS - width
    packed = np.minimum(packed[:n], packed[rest:rest + n])
    anchor = (packed & ((np.uint64(1) << place_bits) - np.uint64(1))).astype(np.int64)
    starts = start_places(sizes)
    anchor = anchor[starts]
    # A new document starts a new stretch: its first anchor lies behind all earlier ones.
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]])) if len(anchor) else np.empty(0, np.int64)
    counts = np.diff(np.append(first, len(anchor)))
    return counts.astype(np.uint8), (anchor[first] - starts[first]).astype(np.uint8)


def start_places(sizes: np.ndarray) -> np.ndarray:
    """The places in the joined block at which a string of LENGTH bytes starts within its document."""
    many = np.maximum(0, sizes - LENGTH + 1)
    begin = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), many)
    return begin[owner] + np.arange(len(owner)) - (np.cumsum(many) - many)[owner]


def block_table(docs: DataFrame) -> DataFrame:
    """One row per block of documents: ids (NULL last), byte lengths, the joined bytes and the stretches."""
    schema = pa.schema([("block", pa.string()), ("doc_ids", pa.list_(pa.int64())), ("nulls", pa.list_(pa.bool_())),
                        ("sizes", pa.list_(pa.int64())), ("data", pa.binary()), ("counts", pa.binary()), ("anchors", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task = TaskContext.get().partitionId()
        for number, (rows, texts) in enumerate(text_chunks(batches, limit=BLOCK_BYTES)):
            joined = b"".join(texts)
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            counts, anchors = stretches(np.frombuffer(joined, np.uint8), sizes)
            ids = rows.column(0)
            yield record(schema, [[f"{task}-{number}"], [ids.fill_null(_LAST).to_pylist()], [ids.is_null().to_pylist()], [sizes],
                                  [_pack(joined)], [_pack(counts)], [_pack(anchors)]])

    return in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run,
                    "block string, doc_ids array<long>, nulls array<boolean>, sizes array<long>, data binary, counts binary, anchors binary")


class Block:
    """The columns of a block row, laid out for one round."""

    def __init__(self, doc_ids, sizes, data, counts, anchors):
        self.ids, self.sizes = doc_ids.values.to_numpy(), sizes.values.to_numpy()
        self.data = _unpack(data.as_py()).tobytes()
        self.counts = _unpack(counts.as_py()).astype(np.int64)
        starts = start_places(self.sizes)
        self.first_start = np.cumsum(self.counts) - self.counts
        self.begin = starts[self.first_start] if len(starts) else np.empty(0, np.int64)
        self.anchor = self.begin + _unpack(anchors.as_py())
        self.doc = self.ids[np.searchsorted(np.cumsum(self.sizes), self.begin, side="right")]
        data = self.data
        self.rank = np.fromiter((xxhash.xxh3_64_intdigest(data[a:a + ANCHOR]) for a in self.anchor.tolist()), np.uint64, len(self.anchor))

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct anchors in order, and for each whether two documents of the block have it."""
        order = np.lexsort((self.doc, self.rank))
        rank, doc = self.rank[order], self.doc[order]
        first = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1]])) if len(rank) else np.empty(0, np.int64)
        last = np.append(first[1:], len(rank)) - 1
        return rank[first], doc[first] != doc[last] if len(first) else np.empty(0, bool)

    def shared(self, buckets: int, replies: list[dict]) -> Shared:
        """The stretches with a shared anchor and their distinct contents."""
        ranks, known = self.distinct()
        known = known.copy()
        bucket = bucket_of(ranks, buckets)
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], [[r["bucket"], r["bucket"] + 1] for r in replies or []]) if replies else []
        for reply, (low, high) in zip(replies or [], ends):
            known[order[low:high]] |= np.unpackbits(_unpack(reply["bits"]), count=high - low).astype(bool)
        chosen = np.flatnonzero(known[np.searchsorted(ranks, self.rank)]) if len(ranks) else np.empty(0, np.int64)
        places: dict[bytes, int] = {}
        data = self.data
        ends_of = self.begin[chosen] + self.counts[chosen] + LENGTH - 1
        which = np.fromiter((places.setdefault(data[b:e], len(places)) for b, e in zip(self.begin[chosen].tolist(), ends_of.tolist())),
                            np.int64, len(chosen))
        smallest = np.full(len(places), _LAST)
        np.minimum.at(smallest, which, self.doc[chosen])
        first = np.full(len(places), len(self.counts), np.int64)
        np.minimum.at(first, which, chosen)
        return Shared(chosen, which, list(places), smallest, first)


@dataclass
class Shared:
    """Numbers of the stretches with a shared anchor and the content of each; per distinct content its
    bytes, the block's smallest document with it, and the first stretch that has it."""

    chosen: np.ndarray
    which: np.ndarray
    contents: list[bytes]
    smallest: np.ndarray
    first: np.ndarray


def bucket_of(ranks: np.ndarray, buckets: int) -> np.ndarray:
    return ((ranks >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _ask_anchors(blocks: DataFrame, buckets: int) -> DataFrame:
    """Round 1, out: per block and bucket the low halves of the distinct anchors' hashes."""
    schema = pa.schema([("bucket", pa.int64()), ("block", pa.string()), ("ranks", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ranks, _ = Block(*(batch.column(c)[i] for c in range(1, 6))).distinct()
                bucket = bucket_of(ranks, buckets)
                order = np.argsort(bucket, kind="stable")
                low = (ranks[order] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                used, first = np.unique(bucket[order], return_index=True)
                parts = [p.tobytes() for p in np.split(low, first[1:])] if len(used) else []
                yield record(schema, [used, [batch.column(0)[i].as_py()] * len(used), parts])

    return in_arrow(blocks.select("block", "doc_ids", "sizes", "data", "counts", "anchors"), run, "bucket long, block string, ranks binary")


def _rank_anchors(asked: pa.Table) -> pa.Table:
    """Round 1, in a bucket: which anchors more than one block has, as one bit each, in the order asked."""
    parts = [np.frombuffer(x, np.uint32) for x in asked.column("ranks").to_pylist()]
    _, where, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    bits = np.split(counts[where] > 1, np.cumsum([len(p) for p in parts])[:-1])
    return pa.table({"block": asked.column("block"), "bucket": asked.column("bucket"),
                     "bits": pa.array([_pack(np.packbits(b)) for b in bits], pa.binary())})


def _ask_stretches(blocks: DataFrame, buckets: int) -> DataFrame:
    """Round 2, out: per block and bucket the distinct contents of the stretches with a shared anchor,
    each once with the block's smallest document that has it."""
    schema = pa.schema([("bucket", pa.int64()), ("block", pa.string()), ("stretches", pa.binary()), ("counts", pa.binary()),
                        ("docs", pa.binary()), ("contents", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(*(batch.column(c)[i] for c in range(1, 6)))
                shared = block.shared(buckets, batch.column(6)[i].as_py())
                first, docs, texts = shared.first.astype(np.int32), shared.smallest, shared.contents
                bucket = bucket_of(block.rank[first], buckets)
                order = np.lexsort((block.rank[first], bucket))
                used, begin = np.unique(bucket[order], return_index=True)
                rows = [(_pack(first[g]), _pack(block.counts[first[g]].astype(np.uint8)), _pack(docs[g]), _pack(b"".join(texts[k] for k in g)))
                        for g in (np.split(order, begin[1:]) if len(used) else [])]
                yield record(schema, [used, [batch.column(0)[i].as_py()] * len(used), *([list(c) for c in zip(*rows)] if rows else [[]] * 4)])

    return in_arrow(blocks, run, "bucket long, block string, stretches binary, counts binary, docs binary, contents binary")


def first_documents(data: np.ndarray, counts: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For every start in the contents, one after the other: does a smaller document have its string?"""
    sizes = counts + LENGTH - 1
    begin = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(counts)), counts)
    places = begin[owner] + np.arange(len(owner)) - (np.cumsum(counts) - counts)[owner]
    known = names(data, 32)
    doc = docs[owner]
    again = np.zeros(len(owner), bool)
    left = np.arange(len(owner))
    for length in (32, LENGTH):
        at = places[left]
        rank = known[at] if length == 32 else mixed(known[at] * MULTIPLIER + known[at + length - 32])
        order = np.argsort(rank, kind="stable")
        ordered = rank[order]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.empty(0, np.int64)
        if not len(first):
            break
        smallest = np.repeat(np.minimum.reduceat(doc[left][order], first), np.diff(np.append(first, len(ordered))))
        if length == LENGTH:
            again[left[order]] = doc[left][order] > smallest
        else:
            largest = np.repeat(np.maximum.reduceat(doc[left][order], first), np.diff(np.append(first, len(ordered))))
            left = np.sort(left[order[smallest < largest]])
    return again


def _rank_stretches(asked: pa.Table) -> pa.Table:
    """Round 2, in a bucket: per stretch one bit for each start, set if a smaller document has the string."""
    counts = [_unpack(x).astype(np.int64) for x in asked.column("counts").to_pylist()]
    data = np.concatenate([_unpack(x) for x in asked.column("contents").to_pylist()])
    docs = np.concatenate([_unpack(x, np.int64) for x in asked.column("docs").to_pylist()])
    again = first_documents(data, np.concatenate(counts), docs)
    bits = np.split(again, np.cumsum([c.sum() for c in counts])[:-1])
    return pa.table({"block": asked.column("block"), "stretches": asked.column("stretches"),
                     "again": pa.array([_pack(np.packbits(b)) for b in bits], pa.binary())})


def removed_bytes(block: Block, replies: list[dict], shared: Shared) -> np.ndarray:
    """Which bytes of the block are removed."""
    # The starts of the asked contents, one after the other in the order of the replies.
    content_of = np.full(len(block.counts) + 1, -1, np.int64)
    content_of[shared.first] = np.arange(len(shared.first))
    offset = np.full(len(shared.first), -1, np.int64)
    flags, total = [], 0
    for reply in replies or []:
        stretch = _unpack(reply["stretches"], np.int32)
        sizes = block.counts[stretch]
        offset[content_of[stretch]] = total + np.cumsum(sizes) - sizes
        total += int(sizes.sum())
        flags.append(np.unpackbits(_unpack(reply["again"]), count=int(sizes.sum())).astype(bool))
    again = np.concatenate([*flags, np.zeros(1, bool)])
    begin, counts = block.begin[shared.chosen], block.counts[shared.chosen]
    edges = np.zeros(len(block.data) + 1, np.int64)
    # A content that a smaller document of the block has goes as a whole.
    whole = block.doc[shared.chosen] > shared.smallest[shared.which]
    np.add.at(edges, begin[whole], 1)
    np.add.at(edges, begin[whole] + counts[whole] + LENGTH - 1, -1)
    part = np.flatnonzero(~whole & (offset[shared.which] >= 0))
    owner = np.repeat(part, counts[part])
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(counts[part]) - counts[part], counts[part])
    gone = again[offset[shared.which[owner]] + inner]
    starts = (begin[owner] + inner)[gone]
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + LENGTH, -1)
    return np.cumsum(edges)[:-1] > 0


def _results(blocks: DataFrame, buckets: int) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                        ("kept_sha256", pa.string()), ("spans", pa.list_(pa.list_(pa.int64())))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(*(batch.column(c)[i] for c in range(1, 6)))
                gone = removed_bytes(block, batch.column(7)[i].as_py(), block.shared(buckets, batch.column(6)[i].as_py()))
                data = np.frombuffer(block.data, np.uint8)
                nulls = batch.column(8)[i].values.to_numpy(zero_copy_only=False)
                rows, at = [], 0
                for doc, size, null in zip(block.ids.tolist(), block.sizes.tolist(), nulls):
                    mask = gone[at:at + size]
                    turns = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
                    kept = data[at:at + size][~mask].tobytes()
                    rows.append((None if null else doc, size, int(mask.sum()), len(turns) // 2, hashlib.sha256(kept).hexdigest(), turns.reshape(-1, 2).tolist()))
                    at += size
                yield record(schema, [list(c) for c in zip(*rows)])

    return in_arrow(blocks, run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>")


def repeated_strings(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans (start, end in bytes) of every row.

    A byte is removed if a string of 50 bytes that covers it also starts in a document with a smaller
    doc_id.  Texts under 50 bytes, empty and NULL ones lose nothing.  Rows with equal doc_id are one
    document as far as "smaller" goes, and each has its own result; a NULL doc_id comes after all
    others.  Further columns of the input are ignored; an empty table gives no rows.

    A task holds one block (2 MB, or one longer text) or one bucket (the shared stretches of 2 MB of text).  A bucket gets a content at most
    once per block, however many documents repeat it.
    """
    blocks = keep_table(block_table(docs), "repeats-blocks")
    total = blocks.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    buckets = max(8, -(-int(total) // BUCKET_BYTES))
    anchors = _ask_anchors(blocks, buckets).groupBy("bucket").applyInArrow(_rank_anchors, "block string, bucket long, bits binary")
    first = keep_table(anchors.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("first")), "repeats-anchors")
    columns = ["block", "doc_ids", "sizes", "data", "counts", "anchors", "first"]
    known = blocks.join(first, "block", "left")
    ranked = (_ask_stretches(known.select(*columns), buckets).groupBy("bucket")
              .applyInArrow(_rank_stretches, "block string, stretches binary, again binary"))
    second = keep_table(ranked.groupBy("block").agg(F.collect_list(F.struct("stretches", "again")).alias("second")), "repeats-stretches")
    final = blocks.join(first.join(second, "block", "full"), "block", "left")
    return _results(final.select(*columns, "second", "nulls"), buckets)


def op9_suffix_dedup(spark, folder: str) -> DataFrame:
    return repeated_strings(table(spark, folder, "documents")).drop("spans")

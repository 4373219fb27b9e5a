"""Operator 4: near-duplicates by fast similarity sketching, banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelloom.llm.common import (connected_components, gapless_rank, hashes, id_bit, in_arrow, is_member, keep_table, marked, member_bits, mixed,
                                  record, shingle_hashes, table, text_chunks)

SHINGLE, PERCENT = 5, 75
BANDS, ROWS = 32, 4
BIN_BITS = 7
MARKS = [f"mark{i}" for i in range(16)]
COORDINATES = BANDS * ROWS
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_set(text: bytes, length: int = SHINGLE) -> np.ndarray:
    """The sorted distinct shingles as 64-bit hashes; fewer words than one shingle are one shingle."""
    words = hashes(text.translate(_LOWER).split())
    if not len(words):
        return words
    return np.unique(shingle_hashes(words, min(length, len(words))))


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """One row of COORDINATES values per (non-empty) set; equal values mark an element in common.

    In each of the first rounds every element throws one value into a hashed bin, where the smallest
    stays and earlier rounds win.  A set whose bins are all full stops.  In the later rounds every
    element goes to the one bin of the round, so that each coordinate fills for certain.
    """
    t = COORDINATES
    out = np.full(len(sets) * t, np.iinfo(np.uint64).max)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    elements = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    low = np.uint64((1 << 56) - 1)
    for turn in range(2 * t):
        if not len(elements):
            break
        thrown = mixed(elements + np.uint64((turn + 1) * 0xD6E8FEB86659FD93 & (1 << 64) - 1))
        bins = (thrown >> np.uint64(64 - BIN_BITS)).astype(np.int64) if turn < t else turn - t
        np.minimum.at(out, owner * t + bins, (thrown & low) | np.uint64(turn << 56))
        open_sets = (out.reshape(-1, t) == np.iinfo(np.uint64).max).any(axis=1)
        go_on = open_sets[owner]
        elements, owner = elements[go_on], owner[go_on]
    return out.reshape(-1, t)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """One 64-bit key per band and row."""
    rows = sketch.reshape(len(sketch), BANDS, ROWS)
    key = np.broadcast_to(mixed(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(sketch), BANDS)).copy()
    for i in range(ROWS):
        key = mixed(key ^ rows[:, :, i])
    return key


def _sketch_table(docs: DataFrame, carried: str) -> DataFrame:
    made = [("n_shingles", pa.int64()), ("content", pa.binary()), ("bands", pa.list_(pa.int64()))]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_chunks(batches):
            sets = [shingle_set(t) for t in texts]
            filled = [i for i, s in enumerate(sets) if len(s)]
            keys = band_keys(sketches([sets[i] for i in filled])).view(np.int64)
            bands: list = [None] * len(sets)
            for i, k in zip(filled, keys):
                bands[i] = k
            content = [content_of(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), *map(pa.array, ([len(s) for s in sets], content, bands), (t for _, t in made))],
                                             names=["doc_id", "row", *[n for n, _ in made]])

    kinds = dict(docs.dtypes)
    return in_arrow(docs.select("doc_id", F.col(carried).alias("row"), "text"), run,
                    f"doc_id {kinds['doc_id']}, row {kinds[carried]}, n_shingles long, content binary, bands array<long>")


def content_of(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _set_table(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """(content, shingles) of the documents whose id may be among the wanted ones."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    schema = pa.schema([("content", pa.binary()), ("shingles", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.filter(pa.array(is_member(shared.value, batch.column(2).to_numpy())))
            for rows, texts in text_chunks([wanted]):
                sets = [s for s in map(shingle_set, texts) if len(s)]
                yield record(schema, [[content_of(s) for s in sets], [s.tobytes() for s in sets]])

    return in_arrow(docs.select("doc_id", "text", id_bit("doc_id")), run, "content binary, shingles binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) whose full sets reach the similarity."""
    both = (pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("left")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("right")), "b").select("a", "b", "left", "right"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(side.as_buffer(), np.uint64) for side in (left, right))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            mask = pa.array(keep, pa.bool_())
            yield record(schema, [batch.column(0).filter(mask), batch.column(1).filter(mask)])

    kinds = dict(both.dtypes)
    return in_arrow(both, run, f"a {kinds['a']}, b {kinds['b']}")


def _parity_bitmaps(rows: DataFrame) -> DataFrame:
    """(id, the words of its parity bitmap)."""
    schema = pa.schema([("id", pa.int64()), *[(m, pa.int64()) for m in MARKS]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.zeros((batch.num_rows, 64 * len(MARKS)), np.uint8)
            for i in range(batch.num_rows):
                place = mixed(np.frombuffer(batch.column(1)[i].as_buffer(), np.uint64)) % np.uint64(bits.shape[1])
                bits[i] = np.bincount(place.astype(np.int64), minlength=bits.shape[1]) & 1
            yield record(schema, [batch.column(0), *np.packbits(bits, axis=1, bitorder="little").view(np.int64).T])

    return in_arrow(rows.select("id", "shingles"), run, f"id {dict(rows.dtypes)['id']}, " + ", ".join(f"{m} long" for m in MARKS))


def _prefix_pairs(undecided: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of documents of different components that share one of their rarest shingles.

    With any common order of shingles, two sets this similar share one of the first
    n - ceil(n * percent / 100) + 1 of each.  Rarest first keeps common passages out of the groups.
    Shingles that only documents of one component have make no pair.

    Documents edited from one template share such a shingle without being similar enough.  Each set has
    a parity bitmap: a bit is set if an odd number of its shingles hash to it.  Bits that differ bound
    the number of shingles that only one of the two has from below, so the bitmaps refuse most of those
    pairs inside the join, and none that is similar.
    """
    schema = pa.schema([("id", pa.int64()), ("component", pa.int64()), ("n", pa.int64()), ("shingle", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                s = np.frombuffer(batch.column(2)[i].as_buffer(), np.int64)
                where = pa.array(np.full(len(s), i, np.int64))
                yield record(schema, [batch.column(0).take(where), batch.column(1).take(where), np.full(len(s), len(s)), s])

    kinds = dict(undecided.dtypes)
    rows = keep_table(in_arrow(undecided.join(sets, "id").select("id", "component", "shingles"), run,
                               f"id {kinds['id']}, component {kinds['component']}, n long, shingle long"), "dedup-shingles")
    common = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("df"), F.min("component").alias("low"), F.max("component").alias("high"))
    place = F.row_number().over(Window.partitionBy("id").orderBy("df", "shingle"))
    reach = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    prefix = (rows.join(common, "shingle").withColumn("place", place).where((F.col("place") <= reach) & (F.col("low") < F.col("high")))
              .select("id", "component", "n", "shingle"))
    prefix = keep_table(prefix.join(_parity_bitmaps(undecided.select("id").distinct().join(sets, "id")), "id"), "dedup-prefixes")
    other = prefix.select(F.col("id").alias("b"), F.col("component").alias("component_b"), F.col("n").alias("n_b"), "shingle",
                          *[F.col(m).alias(f"{m}_b") for m in MARKS])
    apart = sum((F.bit_count(F.col(m).bitwiseXOR(F.col(f"{m}_b"))) for m in MARKS), F.lit(0))
    # Similar sets have at most (100 - percent) / (100 + percent) of both sizes apart.
    fits = ((100 * F.least("n", "n_b") >= percent * F.greatest("n", "n_b")) & (F.col("component") < F.col("component_b"))
            & ((100 + percent) * apart <= (100 - percent) * (F.col("n") + F.col("n_b"))))
    return prefix.join(other, "shingle").where(fits).select(F.col("id").alias("a"), "b").distinct()


def classes(docs: DataFrame, percent: int = PERCENT, carried: str = "doc_id") -> DataFrame:
    """Per row doc_id, `row` (the ``carried`` column), n_shingles, node, component, first_id and own_id.

    A node is a distinct shingle set, numbered in order of its smallest doc_id (own_id; NULL last), so that an id
    with several texts is several nodes; `component` is the smallest node that links lead to and first_id
    its doc_id.  All four are NULL for a row without words.

    Nodes that share a band meet in a bucket.  First each is compared with the bucket's smallest node; where a
    bucket then still holds several components, its nodes are compared by a prefix join, which leaves out
    no pair of different components that can be similar.  Every link is confirmed on the full sets.  A
    pair of similarity 0.75 shares no band in 1 of 190,000 cases.
    """
    rows = keep_table(_sketch_table(docs, carried), "dedup-sketches")
    named = rows.where("n_shingles > 0")
    groups = named.groupBy("content").agg(F.min("doc_id").alias("own_id"), F.first("bands").alias("bands"))
    groups = keep_table(gapless_rank(groups, [F.col("own_id").asc_nulls_last(), F.col("content")], "id", "dedup-groups"), "dedup-nodes")
    nodes = keep_table(groups.select("id", F.explode("bands").alias("band")), "dedup-bands")
    buckets = nodes.groupBy("band").agg(F.min("id").alias("leader"), F.max("id").alias("last")).where("leader < last")
    members = keep_table(nodes.join(buckets.select("band", "leader"), "band"), "dedup-members")
    pairs = keep_table(members.where("id > leader").select(F.col("id").alias("a"), F.col("leader").alias("b")).distinct(), "dedup-pairs")
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct().join(groups.select("id", "content", "own_id"), "id")
    wanted = keep_table(wanted, "dedup-wanted")
    sets = _set_table(docs, member_bits(wanted, id_bit("own_id"))).join(wanted.select("id", "content"), "content").select("id", "shingles")
    sets = keep_table(sets.dropDuplicates(["id"]), "dedup-sets")
    links = keep_table(_verified(pairs, sets, percent), "dedup-links")
    first = keep_table(connected_components(links, "dedup-star"), "dedup-components")
    placed = (members.join(first.withColumnRenamed("node", "id"), "id", "left")
              .select("id", "band", F.coalesce("component", "id").alias("component")))
    mixed_buckets = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    undecided = keep_table(placed.join(mixed_buckets.select("band"), "band", "left_semi").select("id", "component").distinct(), "dedup-undecided")
    more = keep_table(_verified(_prefix_pairs(undecided, sets, percent).join(pairs, ["a", "b"], "left_anti"), sets, percent), "dedup-late-links")
    found = first
    if not more.isEmpty():
        found = keep_table(connected_components(links.unionByName(more), "dedup-all"), "dedup-all-components")
    linked = found.where("component < node").withColumnRenamed("node", "id")
    linked = linked.join(groups.select(F.col("id").alias("component"), F.col("own_id").alias("first_id")), "component")
    told = (groups.select("content", "id", "own_id").join(linked, "id", "left")
            .select("content", F.col("id").alias("node"), F.coalesce("component", "id").alias("component"),
                    F.when(F.col("component").isNull(), F.col("own_id")).otherwise(F.col("first_id")).alias("first_id"), "own_id"))
    # Rows without words join on their own id's hash instead of meeting as NULLs.
    spread = F.coalesce("content", F.encode(F.concat(F.lit("#"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), "UTF-8"))
    return rows.select("doc_id", "row", "n_shingles", spread.alias("content")).join(told, "content", "left").drop("content")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row.

    Texts without words, empty and NULL ones are linked with nothing.  Rows with equal doc_id count as
    one document if their sets are equal; an id with different sets is linked through each of them, and
    each of its rows is told its own component.  A row without a doc_id cannot be named: it is kept, with a
    NULL component_id.  Further columns of the input are not looked at.
    """
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("first_id", "doc_id"))
    return (classes(docs.select("doc_id", "text"), percent)
            .select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept")))


def distinct_documents(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without those of which a near-duplicate stays, with all their columns.

    Of each class of near-duplicate texts the text of the smallest doc_id stays (NULL last, then by its set),
    and of its rows the one with that id; of rows with one id and text the least by all columns.  So no
    text is lost through an id that other texts have too.  Rows without words are nobody's duplicate,
    but of rows with one id and text one stays.  An empty table stays empty; no column name is reserved.
    Whole rows are shuffled only where they may go or be repeated, and a few that a bit set cannot tell from them.
    """
    held = _held(docs)
    rows = classes(held.select("doc_id", "text", "_name"), percent, "_name").select("doc_id", F.col("row").alias("_name"), "node", "component", "own_id")
    stays = F.when(F.col("node").isNull(), True).otherwise((F.col("node") == F.col("component")) & F.col("doc_id").eqNullSafe(F.col("own_id")))
    told = keep_table(rows.groupBy("_name").agg(F.count(F.lit(1)).alias("_times"), F.min(stays).alias("_stays")).where("_times > 1 OR NOT _stays"), "dedup-told")
    held = marked(held, told, "_name", _told=F.lit(True), _several=F.col("_stays"))
    alone = held.where("NOT _told").select("_row")
    once = held.where("_told").join(told.select("_name"), "_name", "left_anti").select("_row")
    several = (held.where("_several").join(told.where("_stays").select("_name"), "_name", "left_semi")
               .groupBy("_name").agg(F.min("_row").alias("_row")).select("_row"))
    return _given(alone.unionByName(once).unionByName(several), docs)


def _held(docs: DataFrame) -> DataFrame:
    """doc_id and text, the name of a row by both, and the row itself under names of its own."""
    told = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in (F.col("doc_id").cast("string"), F.col("text"))]
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    return docs.select("doc_id", "text", F.unhex(F.sha2(F.concat(*told), 256)).alias("_name"), row.alias("_row"))


def _given(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(docs.columns)])


def op4_near_dedup(spark, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))

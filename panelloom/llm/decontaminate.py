"""Operator 8: benchmark decontamination over a positional inverted index of the corpus."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.llm.common import (bit_of_digest, digest_bit, in_arrow, is_member, keep_table, let, member_bits, record,
                                  table, text_chunks)

WINDOW = 10
# So many words of benchmark items are searched for at once; more are searched in further blocks.
BLOCK_WORDS = 500_000
# A proximity match: a window's two rarest words at most SLOP words apart, and NEAR percent of its words in order around them.
SLOP, NEAR = 10, 80
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


class Block:
    """Some benchmark items with their words as numbers of the block's own vocabulary."""

    def __init__(self, items: list[tuple[str, bytes]]):
        self.vocabulary: dict[bytes, int] = {}
        self.names, self.items = [], []
        for name, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text)]
            if ids:
                self.names.append(name)
                self.items.append(np.array(ids, np.int32))

    def anchors(self, counts: np.ndarray) -> list[tuple[int, ...]]:
        """(item, term, place, second term, second place, first window, last window): the two rarest words of
        every window, by corpus count, once for neighbouring windows that share them.

        Windows that share them follow one another: a rarer word enters after both and leaves after both.
        """
        found = {}
        for i, ids in enumerate(self.items):
            width = min(WINDOW, len(ids))
            rarity = sorted(range(len(ids)), key=lambda p: (counts[ids[p]], ids[p], p))
            rank = np.empty(len(ids), np.int64)
            rank[rarity] = np.arange(len(ids))
            for start in range(len(ids) - width + 1):
                order = np.argsort(rank[start:start + width]) + start
                first, second = int(order[0]), int(order[min(1, width - 1)])
                opened = found[i, first, second][5] if (i, first, second) in found else start
                found[i, first, second] = (i, int(ids[first]), first, int(ids[second]), second, opened, start)
        return list(found.values())


def blocks_of(benchmark: DataFrame, block_words: int) -> Iterator[Block]:
    """The items in blocks by a hash of their id; an item is never divided."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text").where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.regexp_count("text", F.lit(r"\S+")))).first()[0] or 0
    n = -(-int(total) // block_words)
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k).orderBy("item_id", "text").collect()
        yield Block([(r[0], r[1].encode()) for r in rows])


def term_counts(docs: DataFrame, block: Block) -> np.ndarray:
    """How often each word of the block occurs in the whole corpus."""
    schema = pa.schema([("term", pa.int32()), ("n", pa.int64())])
    vocabulary = docs.sparkSession.sparkContext.broadcast(block.vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        counts = np.zeros(len(known) + 1, np.int64)
        for _, texts in text_chunks(batches):
            for text in texts:
                words = words_of(text)
                # Unknown words count in the last place.
                counts += np.bincount(np.fromiter((known.get(w, -1) for w in words), np.int32, len(words)) % len(counts), minlength=len(counts)) if words else 0
        terms = np.flatnonzero(counts[:-1])
        yield record(schema, [terms.astype(np.int32), counts[terms]])

    out = np.zeros(len(block.vocabulary), np.int64)
    for term, n in in_arrow(docs.select("text"), run, "term int, n long").groupBy("term").agg(F.sum("n")).collect():
        out[term] = n
    return out


def build_index(docs: DataFrame, block: Block, anchors: list[tuple[int, ...]]) -> DataFrame:
    """doc_id, content (a digest of the words' text), n_words, and the postings of the anchor terms:
    terms with their positions, in the order of the text."""
    kind = dict(docs.dtypes)["doc_id"]
    schema = pa.schema([("doc_id", pa.int64()), ("content", pa.binary()), ("n_words", pa.int64()),
                        ("terms", pa.list_(pa.int32())), ("positions", pa.list_(pa.int32()))])
    used = {t for a in anchors for t in (a[1], a[3])}
    vocabulary = docs.sparkSession.sparkContext.broadcast({w: i for w, i in block.vocabulary.items() if i in used})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for rows, texts in text_chunks(batches):
            n, terms, positions = [], [], []
            for text in texts:
                words = words_of(text)
                ids = np.fromiter((known.get(w, -1) for w in words), np.int32, len(words))
                where = np.flatnonzero(ids >= 0)
                n.append(len(words))
                terms.append(ids[where])
                positions.append(where.astype(np.int32))
            yield record(schema, [rows.column(0), [xxhash.xxh3_128_digest(t) for t in texts], n, terms, positions])

    return in_arrow(docs.select("doc_id", "text"), run,
                    f"doc_id {kind}, content binary, n_words long, terms array<int>, positions array<int>")


def postings(index: DataFrame) -> DataFrame:
    """(term, content, position) of every distinct text: the index inverted."""
    distinct = index.where(F.size("terms") > 0).dropDuplicates(["content"])
    return (distinct.select("content", F.explode(F.arrays_zip("terms", "positions")).alias("p"))
            .select(F.col("p.terms").alias("term"), "content", F.col("p.positions").alias("position")))


def _anchor_table(lists: DataFrame, anchors: list[tuple[int, ...]]) -> DataFrame:
    """As many rows as BLOCK_WORDS at most, so its size is known before it is broadcast."""
    return lists.sparkSession.createDataFrame([(k, *a[:5]) for k, a in enumerate(anchors)],
                                              "pair int, item int, term1 int, place1 int, term2 int, place2 int")


def phrase_candidates(lists: DataFrame, anchors: list[tuple[int, ...]]) -> DataFrame:
    """(content, item, shift): both lists of a window, adjusted by the words' places, meet at the shift."""
    pairs = _anchor_table(lists, anchors)
    first = (lists.join(F.broadcast(pairs), lists["term"] == pairs["term1"])
             .select("pair", "item", "content", (F.col("position") - F.col("place1")).alias("shift")))
    second = (lists.join(F.broadcast(pairs), lists["term"] == pairs["term2"])
              .select("pair", "content", (F.col("position") - F.col("place2")).alias("shift")))
    return first.join(second, ["pair", "content", "shift"], "left_semi").select("content", "item", "shift").distinct()


def proximity_matches(lists: DataFrame, anchors: list[tuple[int, ...]], slop: int = SLOP) -> DataFrame:
    """(content, item, pair, near, far): the two rarest words of a window within ``slop`` words of each
    other, in any order; positions meet in cells of ``slop`` + 1 words and their neighbours."""
    pairs = _anchor_table(lists, anchors).where("place1 <> place2")
    width = slop + 1
    first = (lists.join(F.broadcast(pairs), lists["term"] == pairs["term1"])
             .select("pair", "item", "content", F.col("position").alias("near"),
                     F.explode(F.array(*[F.floor(F.col("position") / width) + d for d in (-1, 0, 1)])).alias("cell")))
    second = (lists.join(F.broadcast(pairs), lists["term"] == pairs["term2"])
              .select("pair", "content", F.col("position").alias("far"), F.floor(F.col("position") / width).alias("cell")))
    return (first.join(second, ["pair", "content", "cell"]).where((F.abs(F.col("near") - F.col("far")) <= slop) & (F.col("near") != F.col("far")))
            .select("content", "item", "pair", "near", "far").distinct())


def aligned_runs(words: np.ndarray, item: np.ndarray, shift: int) -> list[tuple[int, int]]:
    """The stretches of ``words`` (start, end) covered by windows of ``item`` that occur at ``shift``."""
    low, high = max(0, shift), min(len(words), shift + len(item))
    width = min(WINDOW, len(item))
    same = np.zeros(high - low + 2, np.int8)
    same[1:-1] = words[low:high] == item[low - shift:high - shift]
    turns = np.flatnonzero(np.diff(same))
    return [(low + int(s), low + int(e)) for s, e in zip(turns[::2], turns[1::2]) if e - s >= width]


def common_in_order(window: list[int], stretch: list[int]) -> int:
    """The length of the longest common subsequence; a bit per word of the window, a step per word of the stretch."""
    places: dict[int, int] = {}
    for i, word in enumerate(window):
        places[word] = places.get(word, 0) | 1 << i
    every = (1 << len(window)) - 1
    open_ = every
    for word in stretch:
        met = open_ & places.get(word, 0)
        open_ = ((open_ + met) | (open_ - met)) & every
    return len(window) - open_.bit_count()


def near_run(words: np.ndarray, item: np.ndarray, anchor: tuple[int, ...], at: int, slop: int) -> tuple[int, int] | None:
    """The stretch (start, end) of ``words`` that is near a window of the ``anchor``, whose rarest word is met ``at``.

    Searched are the places where the window lay if nothing were inserted, and ``slop`` words on both sides.
    The stretch is trimmed to words of the window; of several windows it is the hull.
    """
    width, runs = min(WINDOW, len(item)), []
    for start in range(anchor[5], anchor[6] + 1):
        window = item[start:start + width]
        low = max(0, at - (anchor[2] - start) - slop)
        stretch = words[low:at - (anchor[2] - start) + width + slop]
        if 100 * common_in_order(window.tolist(), stretch.tolist()) >= NEAR * width:
            own = np.flatnonzero(np.isin(stretch, window))
            runs.append((low + int(own[0]), low + int(own[-1]) + 1))
    return (min(r[0] for r in runs), max(r[1] for r in runs)) if runs else None


def confirmed(docs: DataFrame, block: Block, candidates: DataFrame, anchors: list[tuple[int, ...]], slop: int | None) -> DataFrame:
    """content, runs (start, end) and item names, and those of proximity matches, of every text that holds a
    window or comes near one, read from the text itself.  Candidates without a ``pair`` are shifts of phrases,
    the others positions of a pair's rarest word."""
    bits = docs.sparkSession.sparkContext.broadcast(member_bits(candidates, digest_bit("content")))
    shared = docs.sparkSession.sparkContext.broadcast((block, anchors))
    texts_of = pa.schema([("content", pa.binary()), ("text", pa.binary())])

    def choose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_chunks(batches):
            chosen: dict[bytes, bytes] = {}
            for text in texts:
                content = xxhash.xxh3_128_digest(text)
                if is_member(bits.value, bit_of_digest(content)):
                    chosen[content] = text
            yield record(texts_of, [list(chosen), list(chosen.values())])

    texts = in_arrow(docs.select("text").where(F.col("text").isNotNull()), choose, "content binary, text binary").dropDuplicates(["content"])
    wanted = candidates.groupBy("content").agg(F.collect_set(F.struct("item", "pair", "place")).alias("places"))
    spans, names_of = pa.list_(pa.list_(pa.int32())), pa.list_(pa.string())
    out = pa.schema([("content", pa.binary()), ("runs", spans), ("items", names_of), ("near_runs", spans), ("near_items", names_of)])

    def confirm(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, anchors = shared.value
        known = block.vocabulary
        for batch in batches:
            rows = []
            for content, text, places in zip(batch.column(0), batch.column(1), batch.column(2)):
                words = words_of(text.as_py())
                ids = np.fromiter((known.get(w, -1) for w in words), np.int32, len(words))
                runs, names, near_runs, near_names = set(), set(), set(), set()
                for place in places.as_py():
                    item, name = block.items[place["item"]], block.names[place["item"]]
                    if place["pair"] is None:
                        found = aligned_runs(ids, item, place["place"])
                        runs.update(found)
                        names.update([name] if found else [])
                    elif near := near_run(ids, item, anchors[place["pair"]], place["place"], slop):
                        near_runs.add(near)
                        near_names.add(name)
                if runs or near_runs:
                    rows.append((content.as_py(), sorted(map(list, runs)), sorted(names), sorted(map(list, near_runs)), sorted(near_names)))
            yield record(out, [list(c) for c in zip(*rows)] if rows else [[] for _ in out])

    return in_arrow(texts.join(wanted, "content"), confirm, ", ".join(
        ["content binary", *[f"{c} {kind}" for c, kind in FOUND.items()]]))


FOUND = {"runs": "array<array<int>>", "items": "array<string>", "near_runs": "array<array<int>>", "near_items": "array<string>"}


def covered(runs: Column) -> Column:
    """How many positions the runs cover together."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(F.array_sort(runs), start, lambda acc, run: F.struct(
        (acc["n"] + F.greatest(F.lit(0), run[1] - F.greatest(run[0], acc["end"]))).alias("n"),
        F.greatest(acc["end"], run[1]).alias("end")), lambda acc: acc["n"])


def search(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS, slop: int | None = None) -> DataFrame:
    """doc_id, n_words, runs (covered word stretches) and items (matched item ids, as sorted text) per row, and
    near_runs and near_items: proximity matches, the items without those matched by a whole window.

    For every block of items: corpus counts choose the two rarest words of each window, their postings
    are built and intersected at equal shifts, and texts at the meeting points are read again to confirm
    whole windows.  Equal texts are one entry of the index.

    Proximity matches are searched for where ``slop`` is given: the same two postings at most ``slop`` words apart,
    in any order, and then NEAR percent of the window's words in their order, with others between them, in the
    stretch that `near_run` reads.  An item of one word has none.

    Texts without words, empty and NULL ones match nothing; items without words or with NULL text are
    skipped; items with equal ids count once; a NULL id counts as the empty one.  Rows with equal or
    NULL doc_id are separate rows.  An empty benchmark leaves every row clean.
    """
    base, hits = None, None
    for block in blocks_of(benchmark, block_words):
        if not block.items:
            continue
        anchors = block.anchors(term_counts(docs, block))
        index = keep_table(build_index(docs, block, anchors), "decon-index")
        # Two searches read written postings; a single one makes them in passing.
        lists = postings(index) if slop is None else keep_table(postings(index), "decon-postings")
        places = phrase_candidates(lists, anchors).select("content", "item", F.lit(None).cast("int").alias("pair"), F.col("shift").alias("place"))
        if slop is not None:
            near = proximity_matches(lists, anchors, slop).select("content", "item", "pair", F.col("near").alias("place"))
            places = places.unionByName(near.distinct())
        candidates = keep_table(places, "decon-candidates")
        found = keep_table(confirmed(docs, block, candidates, anchors, slop), "decon-hits")
        base = index.select("doc_id", "content", "n_words") if base is None else base
        hits = found if hits is None else hits.unionByName(found)
    if base is None:
        return (build_index(docs, Block([]), []).select("doc_id", "n_words", *[F.array().cast(kind).alias(c) for c, kind in FOUND.items()]))
    merged = hits.groupBy("content").agg(*[F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in FOUND])
    whole = {c: F.coalesce(c, F.array().cast(kind)) for c, kind in FOUND.items()}
    return (base.join(merged, "content", "left")
            .select("doc_id", "n_words", whole["runs"].alias("runs"), F.array_sort(whole["items"]).alias("items"),
                    whole["near_runs"].alias("near_runs"),
                    F.array_sort(F.array_except(whole["near_items"], whole["items"])).alias("near_items")))


def op8_decontaminate(spark, folder: str) -> DataFrame:
    found = search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), slop=SLOP)
    n_hit = let(F.col("runs"), covered)
    return found.select("doc_id", "n_words", n_hit.cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("items") > 0).alias("contaminated"),
                        F.size("near_items").cast("long").alias("n_near_items"), F.array_join("near_items", ",").alias("near_items"))

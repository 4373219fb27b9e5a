"""Operator 1: a hidden Markov language model, trained by Baum-Welch over all partitions, exact in scoring."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.llm.common import bucket_of_id, hashes, in_arrow, keep_table, record, table, text_chunks

HELD_OUT = (5, 1)
STATES, ROUNDS = 8, 6
FREQUENT, CLASSES = 4096, 1024
END = FREQUENT + CLASSES
SYMBOLS = END + 1
SEGMENT = 256
BLOCK_BYTES = 12 << 20
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# Rows of a round's sums that are not symbols.
_START, _MIDDLE, _MOVES = SYMBOLS, SYMBOLS + 1, SYMBOLS + 2


@dataclass
class Model:
    """Emissions per symbol and state, moves from state to state, states at the start and inside of a text."""

    emission: np.ndarray
    moves: np.ndarray
    start: np.ndarray
    middle: np.ndarray


def block_table(docs: DataFrame) -> DataFrame:
    """One row per block of documents: their ids and lengths, the tokens as places in the block's own
    vocabulary, and per vocabulary word its hash, class and count in training texts.

    A word's class is a hash of its last three bytes; it stands for the word where the word is rare.
    """
    schema = pa.schema([("block", pa.string()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
                        ("lengths", pa.list_(pa.int32())), ("tokens", pa.binary()), ("words", pa.list_(pa.int64())),
                        ("classes", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task, packer = TaskContext.get().partitionId(), zstandard.ZstdCompressor(level=1)
        for number, (rows, texts) in enumerate(text_chunks(batches, limit=BLOCK_BYTES)):
            places: dict[bytes, int] = {}
            held = rows.column(1).to_numpy(zero_copy_only=False)
            parts = []
            for text in texts:
                words = text.translate(_LOWER).split()
                parts.append(np.fromiter((places.setdefault(w, len(places)) for w in words), np.int32, len(words)))
            tokens = np.concatenate(parts)
            lengths = np.fromiter(map(len, parts), np.int32, len(parts))
            counts = np.bincount(tokens[np.repeat(~held, lengths)], minlength=len(places))
            vocabulary = list(places)
            classes = np.fromiter((zlib.crc32(w[-3:]) % CLASSES for w in vocabulary), np.int32, len(vocabulary))
            ids = rows.column(0)
            yield record(schema, [[f"{task}-{number}"], pa.array([ids.to_pylist()], pa.list_(ids.type)), [held], [lengths],
                                  [packer.compress(tokens.tobytes())], [hashes(vocabulary).view(np.int64)], [classes], [counts]])

    modulus, held = HELD_OUT
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", (bucket_of_id(modulus) == held).alias("held"), "text")
    return in_arrow(rows, run, f"block string, doc_ids array<{kind}>, held array<boolean>, lengths array<int>, tokens binary, "
                               "words array<long>, classes array<int>, counts array<long>")


def _tokens(cell) -> np.ndarray:
    # Not frombuffer of the compressed size: a block of empty texts has no tokens.
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(cell.as_py()) if cell.is_valid else b"", np.int32)


def symbols_of(words: np.ndarray, classes: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The symbol of every vocabulary word: its place among the sorted frequent hashes, or its class."""
    if not len(frequent):
        return FREQUENT + classes
    place = np.minimum(np.searchsorted(frequent, words), len(frequent) - 1)
    return np.where(frequent[place] == words, place, FREQUENT + classes).astype(np.int32)


def segments(sequence: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows of up to SEGMENT symbols, padded with -1; whether the row begins a text)."""
    pieces = -(-lengths // SEGMENT)
    owner = np.repeat(np.arange(len(lengths)), pieces)
    first = np.concatenate([[0], np.cumsum(pieces)[:-1]]) if len(pieces) else np.empty(0, np.int64)
    inner = np.arange(len(owner)) - first[owner]
    begin = (np.cumsum(lengths) - lengths)[owner] + inner * SEGMENT
    size = np.minimum(SEGMENT, lengths[owner] - inner * SEGMENT)
    grid = np.full((len(owner), SEGMENT), -1, np.int32)
    columns = np.arange(SEGMENT)
    mask = columns < size[:, None]
    grid[mask] = sequence[(begin[:, None] + columns)[mask]]
    return grid, inner == 0


def expected_counts(grid: np.ndarray, opens: np.ndarray, model: Model, sums: np.ndarray) -> float:
    """Adds the expected counts of scaled forward-backward over the rows; returns their log likelihood."""
    n, states = len(grid), model.moves.shape[0]
    size = (grid >= 0).sum(axis=1)
    order = np.argsort(-size, kind="stable")
    grid, opens, size = grid[order].T.copy(), opens[order], size[order]
    longest = int(size[0])
    active = np.searchsorted(-size, -np.arange(longest), side="left")
    emission = np.concatenate([model.emission, np.ones((1, states))]).astype(np.float32)
    moves = model.moves.astype(np.float32)
    forward = np.empty((longest, n, states), np.float32)
    scale = np.ones((longest, n), np.float32)
    now = np.where(opens[:, None], model.start, model.middle).astype(np.float32)
    for t in range(longest):
        m = active[t]
        now = (now[:m] if t == 0 else now[:m] @ moves) * emission[grid[t, :m]]
        total = now.sum(axis=1)
        now /= total[:, None]
        forward[t, :m], scale[t, :m] = now, total
    backward = np.ones((n, states), np.float32)
    for t in range(longest - 1, -1, -1):
        m = active[t]
        gamma = forward[t, :m] * backward[:m]
        gamma /= gamma.sum(axis=1, keepdims=True)
        forward[t, :m], before = gamma, forward[t - 1, :m] if t else None
        seen = emission[grid[t, :m]] * backward[:m] / scale[t, :m, None]
        if t:
            sums[_MOVES:_MOVES + states] += moves * (before.T @ seen)
            backward[:m] = seen @ moves.T
    sums[_START] += forward[0, opens].sum(axis=0)
    sums[_MIDDLE] += forward[0, ~opens].sum(axis=0)
    mask = grid[:longest] >= 0
    flat, gammas = grid[:longest][mask], forward[mask]
    for k in range(states):
        sums[:SYMBOLS, k] += np.bincount(flat, gammas[:, k], SYMBOLS)
    return float(np.log(scale[mask]).sum())


def with_ends(symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sequence with the end symbol after every text."""
    return np.insert(symbols, np.cumsum(lengths), END).astype(np.int32), lengths.astype(np.int64) + 1


def trained(blocks: DataFrame, frequent: np.ndarray, weights: np.ndarray, states: int, rounds: int) -> Model:
    """Baum-Welch: a round is one pass over all blocks, summed per symbol, and one new model.

    ``weights`` are the smoothed counts of the symbols; the first emissions are these with seeded noise.
    A task adds up its own blocks, so a round's shuffle has about 5,000 rows per task.
    """
    random = np.random.default_rng(11)
    share = weights / weights.sum()
    noisy = share[:, None] * np.exp(random.normal(0, 1, (SYMBOLS, states)))
    moves = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(moves, 0.9 if states > 1 else 1.0)
    model = Model(noisy / noisy.sum(axis=0), moves, np.full(states, 1 / states), np.full(states, 1 / states))
    names = [f"e{k}" for k in range(states)]
    schema = pa.schema([("symbol", pa.int32()), *[(c, pa.float64()) for c in names]])
    spark = blocks.sparkSession
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((model, frequent))

        def run(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            now, known = shared.value
            sums = np.zeros((_MOVES + states, states))
            for batch in batches:
                for i in range(batch.num_rows):
                    held, lengths = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in (0, 1))
                    word_symbols = symbols_of(*(batch.column(c)[i].values.to_numpy() for c in (3, 4)), known)
                    symbols = word_symbols[_tokens(batch.column(2)[i])][np.repeat(~held, lengths)]
                    grid, opens = segments(*with_ends(symbols, lengths[~held]))
                    for at in range(0, len(grid), 2048):
                        expected_counts(grid[at:at + 2048], opens[at:at + 2048], now, sums)
            rows = np.flatnonzero(sums.any(axis=1))
            yield record(schema, [rows.astype(np.int32), *sums[rows].T])

        found = in_arrow(blocks.select("held", "lengths", "tokens", "words", "classes"), run,
                         "symbol int, " + ", ".join(f"{c} double" for c in names))
        sums = np.zeros((_MOVES + states, states))
        for row in found.groupBy("symbol").agg(*[F.sum(c) for c in names]).collect():
            sums[row[0]] = row[1:]
        emission = sums[:SYMBOLS] + 20 * share[:, None]
        moves = sums[_MOVES:] + 1.0
        start, middle = sums[_START] + 0.5, sums[_MIDDLE] + 0.5
        model = Model(emission / emission.sum(axis=0), moves / moves.sum(axis=1, keepdims=True), start / start.sum(), middle / middle.sum())
        shared.unpersist()
    return model


def sequence_log10(sequence: np.ndarray, lengths: np.ndarray, model: Model) -> np.ndarray:
    """The exact log10 likelihood of every text by the scaled forward recursion.

    Texts advance together, longest first; those that have ended leave the work.
    """
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    active = np.searchsorted(-lengths[order], -np.arange(lengths.max(initial=0)), side="left")
    out = np.zeros(len(lengths))
    now = np.broadcast_to(model.start, (len(lengths), len(model.start)))
    for t, m in enumerate(active):
        now = (now if t == 0 else now[:m] @ model.moves) * model.emission[sequence[starts[:m] + t]]
        total = now.sum(axis=1)
        now = now / total[:, None]
        out[:m] += np.log10(total)
    scores = np.empty(len(lengths))
    scores[order] = out
    return scores


def score_texts(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    The model emits symbols: a frequent word, the class of another word, or the end of the text.  A word
    of a class has the class's probability times its smoothed share of the class's training tokens, so
    `score` is the log10 probability of the words themselves.  Texts are trained on in whole, as pieces
    of SEGMENT tokens; scores come from one recursion over the whole text.  Words are told apart by a
    64-bit hash.

    Empty and NULL texts consist of their end alone.  With no training text every count is 0 and both
    scores rest on the smoothing.  Repeated rows are scored, and counted in training, each; NULL ids
    count as the empty text for the split.  Further columns of the input are ignored.
    """
    blocks = keep_table(block_table(docs), "lm-blocks")
    known = (blocks.select(F.explode(F.arrays_zip("words", "classes", "counts")).alias("w")).where("w.counts > 0")
             .groupBy(F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("c"), F.max("w.classes").alias("class")))
    known = keep_table(known, "lm-counts")
    texts = blocks.select(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0
    common = known.orderBy(F.desc("c"), "word").limit(FREQUENT)
    frequent_rows = sorted((r[0], r[1]) for r in common.select("word", "c").collect())
    frequent = np.array([w for w, _ in frequent_rows], np.int64)
    per_class = known.groupBy("class").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    rare_n, rare_v = np.zeros(CLASSES), np.zeros(CLASSES)
    for name, n, v in per_class:
        rare_n[name], rare_v[name] = n, v
    total, distinct = rare_n.sum() + texts, rare_v.sum() + (1 if texts else 0)
    # The frequent words leave their classes.
    for name, n, v in (known.join(F.broadcast(common.select("word")), "word", "left_semi").groupBy("class")
                       .agg(F.sum("c"), F.count(F.lit(1))).collect()):
        rare_n[name] -= n
        rare_v[name] -= v
    weights = np.full(SYMBOLS, 0.5)
    weights[:len(frequent)] += [c for _, c in frequent_rows]
    weights[FREQUENT:END] += rare_n
    weights[END] += texts
    weights[len(frequent):FREQUENT] = 1e-12
    model = trained(blocks, frequent, weights, states, rounds)

    asked = blocks.select("block", F.posexplode("words").alias("place", "word"))
    answers = asked.join(known.select("word", "c"), "word").select("block", "place", "c")
    packed = pa.schema([("block", pa.string()), ("places", pa.binary()), ("known", pa.binary())])

    def pack(answer: pa.Table) -> pa.Table:
        packer = zstandard.ZstdCompressor(level=1)
        order = np.argsort(answer.column("place").to_numpy())
        columns = [answer.column(c).to_numpy()[order] for c in ("place", "c")]
        return pa.Table.from_batches([record(packed, [[answer.column("block")[0].as_py()],
                                                      *[[packer.compress(x.tobytes())] for x in columns]])])

    replies = answers.groupBy("block").applyInArrow(pack, "block string, places binary, known binary")
    shared = docs.sparkSession.sparkContext.broadcast((model, frequent, np.log10(rare_n + 0.5 * (rare_v + 1))))
    scale = np.log10(total + 0.5 * (distinct + 1))
    out = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                     ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, known_words, class_scale = shared.value
        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(batch.num_rows):
                ids, held, lengths, words, classes = (batch.column(c)[i].values for c in (0, 1, 2, 4, 5))
                lengths, classes = lengths.to_numpy().astype(np.int64), classes.to_numpy()
                symbols = symbols_of(words.to_numpy(), classes, known_words)
                counts = np.zeros(len(symbols))
                if batch.column(6)[i].is_valid:
                    where, c = (np.frombuffer(opener.decompress(batch.column(n)[i].as_py()), t) for n, t in ((6, np.int32), (7, np.int64)))
                    counts[where] = c
                tokens = _tokens(batch.column(3)[i])
                owner = np.repeat(np.arange(len(lengths)), lengths)
                log = np.log10(counts + 0.5)
                base = np.bincount(owner, log[tokens], len(lengths)) + np.log10(texts + 0.5) - scale * (lengths + 1)
                inside = np.where(symbols >= FREQUENT, log - class_scale[classes], 0.0)
                score = sequence_log10(*with_ends(symbols[tokens], lengths), now) + np.bincount(owner, inside[tokens], len(lengths))
                seen = np.bincount(owner, (counts > 0)[tokens], len(lengths)).astype(np.int64) + (texts > 0)
                yield record(out, [ids, held, lengths + 1, seen, np.full(len(lengths), int(total)), base, score])

    kind = dict(docs.dtypes)["doc_id"]
    return in_arrow(blocks.join(replies, "block", "left").select("doc_ids", "held", "lengths", "tokens", "words", "classes", "places", "known"), run,
                    f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op1_language_model(spark, folder: str) -> DataFrame:
    return score_texts(table(spark, folder, "documents"))

"""Operator 2: quality rules - base statistics, then boosted trees with monotonic constraints over them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.llm.common import hashes, in_arrow, keep_table, record, shingle_hashes, table, text_chunks
from panelloom.llm.labelled import PER_CLASS, label_sample

# Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Feature and the direction in which the score may move with it: -1 down, 0 free.
FEATURES = {"log_words": 0, "mean_word": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1,
            "same_as_last_share": -1, "upper_share": -1, "distinct_share": 0, "punctuation_share": 0, "digit_share": 0,
            "line_words": 0, "bang_share": -1}
TREES, DEPTH, RATE, BINS, LEAST = 60, 3, 0.2, 64, 20


def _class_table(test) -> np.ndarray:
    return np.array([test(b) for b in range(256)])


_IS_SYMBOL = _class_table(lambda b: b in SYMBOLS)
_IS_UPPER = _class_table(lambda b: 65 <= b <= 90)
_IS_LETTER = _class_table(lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
_IS_DIGIT = _class_table(lambda b: 48 <= b <= 57)
_IS_SPACE = _class_table(lambda b: b == 32 or 9 <= b <= 13)
_STARTS = _class_table(lambda b: b & 0xC0 != 0x80)


def statistics(text: bytes) -> tuple[list[int], list[float]]:
    """The five base counts and the feature values of one text."""
    words = text.split()
    n = len(words)
    if not n:
        symbols = int(_IS_SYMBOL[np.frombuffer(text, np.uint8)].sum()) if text else 0
        return [0, 0, symbols, 0, 0], [0.0] * len(FEATURES)
    data = np.frombuffer(text, np.uint8)
    chars = int((_STARTS[data] & ~_IS_SPACE[data]).sum())
    symbols = int(_IS_SYMBOL[data].sum())
    seen: set[bytes] = set()
    lines = doubled = 0
    for line in text.split(b"\n"):
        if line.split(None, 1):
            lines += 1
            doubled += line in seen
            seen.add(line)
    ids = hashes(words)
    windows = shingle_hashes(ids, WINDOW)
    repeated = 0
    if len(windows):
        _, where, counts = np.unique(windows, return_inverse=True, return_counts=True)
        starts = np.flatnonzero(counts[where] > 1)
        edges = np.zeros(n + 1, np.int64)
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + WINDOW, -1)
        repeated = int((np.cumsum(edges[:n]) > 0).sum())
    letters = int(_IS_LETTER[data].sum())
    other = len(data) - letters - int(_IS_DIGIT[data].sum()) - int(_IS_SPACE[data].sum())
    features = [float(np.log1p(n)), chars / n, symbols / chars, doubled / lines, repeated / n,
                float((ids[1:] == ids[:-1]).mean()) if n > 1 else 0.0, float(_IS_UPPER[data].sum()) / max(letters, 1),
                len(np.unique(ids)) / n, other / chars, float(_IS_DIGIT[data].sum()) / chars, n / lines, text.count(b"!") / n]
    return [n, chars, symbols, doubled, repeated], features


class Trees:
    """Boosted trees, flattened: per node its feature, threshold, left child (right is the next), value."""

    def __init__(self, start: float):
        self.start = start
        self.feature, self.threshold, self.left, self.value, self.roots = [], [], [], [], []

    def flat(self) -> Trees:
        for name, kind in (("feature", np.int32), ("threshold", np.float64), ("left", np.int32), ("value", np.float64), ("roots", np.int32)):
            setattr(self, name, np.asarray(getattr(self, name), kind))
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability per row.  All rows walk one tree together, a level at a time."""
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(DEPTH):
                inner = self.left[node] >= 0
                right = x[rows, np.maximum(self.feature[node], 0)] > self.threshold[node]
                node = np.where(inner, self.left[node] + right, node)
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def _best_split(binned, rows, gradient, hessian, directions, low, high):
    """(gain, feature, bin, left value, right value) of the best allowed split, or None."""
    best = None
    g, h = gradient[rows].sum(), hessian[rows].sum()
    for f, direction in enumerate(directions):
        column = binned[rows, f]
        gs = np.cumsum(np.bincount(column, gradient[rows], BINS))[:-1]
        hs = np.cumsum(np.bincount(column, hessian[rows], BINS))[:-1]
        ns = np.cumsum(np.bincount(column, minlength=BINS))[:-1]
        left = np.clip(-gs / (hs + 1.0), low, high)
        right = np.clip(-(g - gs) / (h - hs + 1.0), low, high)
        allowed = (ns >= LEAST) & (len(rows) - ns >= LEAST) & (direction * (right - left) >= 0)
        gain = -(gs * left + 0.5 * (hs + 1.0) * left ** 2 + (g - gs) * right + 0.5 * (h - hs + 1.0) * right ** 2)
        gain = np.where(allowed, gain, -np.inf)
        k = int(np.argmax(gain))
        if np.isfinite(gain[k]) and (best is None or gain[k] > best[0] + 1e-12):
            best = (gain[k], f, k, left[k], right[k])
    return best


def fit_trees(x: np.ndarray, y: np.ndarray, directions: list[int], weight: np.ndarray) -> Trees:
    """Logistic boosting on binned features.

    A split on a constrained feature must order its children, and hands each child the midpoint as a
    bound, so the whole tree is monotonic in the feature, and so is their sum.
    """
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    share = np.clip(np.average(y, weights=weight), 1e-3, 1 - 1e-3)
    trees = Trees(float(np.log(share / (1 - share))))
    raw = np.full(len(y), trees.start)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        gradient, hessian = weight * (p - y), weight * p * (1 - p)

        def grow(node, rows, depth, low, high, value):
            trees.value[node] = RATE * value
            raw[rows] += RATE * value if depth == DEPTH else 0
            split = _best_split(binned, rows, gradient, hessian, directions, low, high) if depth < DEPTH else None
            if split is None or split[0] <= 1e-9 or split[2] >= len(cuts[split[1]]):
                if depth < DEPTH:
                    raw[rows] += RATE * value
                return
            _, f, k, left, right = split
            child = len(trees.feature)
            for _ in range(2):
                for values, empty in ((trees.feature, 0), (trees.threshold, 0.0), (trees.left, -1), (trees.value, 0.0)):
                    values.append(empty)
            trees.feature[node], trees.threshold[node], trees.left[node] = f, cuts[f][k], child
            goes_left = binned[rows, f] <= k
            middle = (left + right) / 2
            bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high), (low, high))}[directions[f]]
            grow(child, rows[goes_left], depth + 1, *bounds[0], left)
            grow(child + 1, rows[~goes_left], depth + 1, *bounds[1], right)

        root = len(trees.feature)
        trees.roots.append(root)
        for values, empty in ((trees.feature, 0), (trees.threshold, 0.0), (trees.left, -1), (trees.value, 0.0)):
            values.append(empty)
        grow(root, np.arange(len(y)), 0, -4.0, 4.0, 0.0)
    return trees.flat()


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the five base counts and the features of every whole text (NULL: no words)."""
    kind = dict(docs.dtypes)["doc_id"]
    schema = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in BASE], *[(f, pa.float64()) for f in FEATURES]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_chunks(batches):
            found = [statistics(t) for t in texts]
            base = np.array([b for b, _ in found], np.int64).reshape(-1, len(BASE)).T
            values = np.array([f for _, f in found], np.float64).reshape(-1, len(FEATURES)).T
            yield record(schema, [rows.column(0), *base, *values])

    columns = ", ".join([f"doc_id {kind}", *[f"{c} long" for c in BASE], *[f"{f} double" for f in FEATURES]])
    return in_arrow(docs.select("doc_id", "text"), run, columns)


def apply_rules(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, threshold: float = 0.5) -> DataFrame:
    """doc_id, the base counts, base_failed, score and kept, one row per document row.

    The trees learn `labels.quality` from at most ``per_class`` labelled documents of each label; with
    labels of one kind only, or none, the base rules decide alone and score is 1.  Empty texts fail the
    base rules.  Repeated rows get equal results; further columns of the input are not looked at.
    """
    stats = keep_table(document_statistics(docs), "quality-statistics")
    ids, counts = label_sample(labels, per_class)
    sample = stats.join(F.broadcast(ids), "doc_id").select("label", *FEATURES).toPandas()
    model = None
    if sample["label"].nunique() == 2:
        y = sample["label"].to_numpy(float)
        seen = np.array([(y == c).sum() for c in (0, 1)], float)
        weight = np.array([counts[0], counts[1]], float) / seen
        model = fit_trees(sample[list(FEATURES)].to_numpy(float), y, list(FEATURES.values()), weight[y.astype(int)] / weight.max())
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    flagged = stats.withColumn("base_failed", failed)
    names = ["doc_id", *BASE, "base_failed"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(len(names) + i).to_numpy() for i in range(len(FEATURES))], axis=1)
            score = model.score(x) if model is not None else np.ones(len(x))
            failed = batch.column(len(names) - 1).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], pa.array(score), pa.array(~failed & (score >= threshold))],
                                             names=[*names, "score", "kept"])

    kinds = dict(flagged.dtypes)
    return in_arrow(flagged.select(*names, *FEATURES), run, ", ".join(f"{c} {kinds[c]}" for c in names) + ", score double, kept boolean")


def op2_quality_rules(spark, folder: str) -> DataFrame:
    return apply_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))

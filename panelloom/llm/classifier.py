"""Operator 5: quality classifier - Naive Bayes scaled n-gram indicators under a linear hinge-loss model."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.llm.common import MULTIPLIER, bucket_of_id, hashes, in_arrow, mixed, record, table, text_chunks
from panelloom.llm.labelled import HELD_OUT, PER_CLASS, label_sample

BITS = 18
SMOOTHING, COST, EPOCHS = 1.0, 1.0, 30
_SHAPE = bytes(ord("X") if 65 <= b <= 90 else ord("x") if 97 <= b <= 122 or b >= 128 else ord("0") if 48 <= b <= 57 else
               b for b in range(256))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def indicators(text: bytes, bits: int = BITS) -> np.ndarray:
    """The distinct hashed n-grams of a text: words and word pairs, and runs of one to three word shapes.

    A shape is the word with runs of upper, lower, digit or equal other characters cut to one; a
    word equal to the one before it has a shape of its own.
    """
    words = text.translate(_LOWER).split()
    if not words:
        return np.empty(0, np.int32)
    shaped = np.frombuffer(text.translate(_SHAPE), np.uint8)
    keep = np.ones(len(shaped), bool)
    keep[1:] = shaped[1:] != shaped[:-1]
    ids, shapes = hashes(words), hashes(shaped[keep].tobytes().split())
    with np.errstate(over="ignore"):
        shapes[1:] = np.where(ids[1:] == ids[:-1], shapes[1:] * MULTIPLIER + np.uint64(1), shapes[1:])
        pair = mixed(shapes[1:] * MULTIPLIER + shapes[:-1])
        grams = [ids, mixed(ids[1:] * MULTIPLIER + ids[:-1]), mixed(shapes), pair, mixed(pair[1:] * MULTIPLIER + shapes[:-2])]
    return np.unique((np.concatenate(grams) >> np.uint64(64 - bits)).astype(np.int32))


def fit(rows: list[np.ndarray], y: np.ndarray, odds: float, bits: int = BITS) -> tuple[np.ndarray, float, float]:
    """(weight per indicator, bias, scale): log-count ratios, then dual coordinate descent on the hinge loss.

    ``odds`` is how often label 1 occurs for each label 0 among all labelled rows; the sample is
    weighed back to it when the margin becomes a probability.
    """
    ratio = log_count_ratio(rows, y, bits)
    sign = np.where(y > 0, 1.0, -1.0)
    values = []
    for indices in rows:
        v = ratio[indices]
        norm = np.sqrt((v * v).sum())
        values.append(v / norm if norm else v)
    w, bias = np.zeros(1 << bits), 0.0
    alpha = np.zeros(len(rows))
    balance = np.where(y > 0, 1.0, max(1.0, (y > 0).sum() / max(1, (y <= 0).sum())))
    random = np.random.default_rng(7)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in random.permutation(len(rows)):
            indices, v = rows[i], values[i]
            slope = sign[i] * (w[indices] @ v + bias) - 1.0
            # Rows have unit norm, and the bias is one more constant feature.
            new = min(max(alpha[i] - slope / ((1.0 if len(v) else 0.0) + 1.0), 0.0), COST * balance[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                w[indices] += step * v
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    margin = np.array([w[indices] @ v + bias for indices, v in zip(rows, values)])
    # A probability from the margin: one scale, fitted with the prior of all labelled rows.
    weigh = np.where(y > 0, odds * (y <= 0).sum() / max(1, (y > 0).sum()), 1.0)
    scales = np.linspace(0.5, 8, 31)
    losses = [(weigh * np.log1p(np.exp(-s * sign * margin))).sum() for s in scales]
    return w * ratio, bias, float(scales[int(np.argmin(losses))])


def score_text(text: bytes, weights: np.ndarray, ratio: np.ndarray, bias: float, scale: float) -> float:
    indices = indicators(text)
    norm = np.sqrt((ratio[indices] ** 2).sum())
    margin = (weights[indices].sum() / norm if norm else 0.0) + bias
    return float(1 / (1 + np.exp(-scale * margin)))


def classify(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, score, predicted and the ``carried`` columns of every row of ``docs``.

    Only the text is an input of a score.  The model is fitted on at most ``per_class`` labelled documents of each
    label, none of them held out.  With labels of one kind only, or none, every score is 1.  Texts
    without words, empty and NULL ones get the model's constant part.  Repeated rows get equal results;
    columns that are neither named here nor carried are ignored.
    """
    ids, counts = label_sample(labels, per_class)
    sample = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    # One row per id: a document that occurs twice counts once.
    kind = "doc_id long, label int, grams binary"
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("grams", pa.binary())])

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_chunks(batches):
            yield record(schema, [rows.column(0), rows.column(1), [indicators(t).tobytes() for t in texts]])

    grams = in_arrow(sample.select("doc_id", F.col("label").cast("int").alias("label"), "text"), extract, kind)
    found = sorted(grams.dropDuplicates(["doc_id"]).collect())
    y = np.array([r[1] for r in found], float)
    model = None
    if len(set(y)) == 2:
        rows = [np.frombuffer(r[2], np.int32) for r in found]
        scaled, bias, scale = fit(rows, y, counts[1] / counts[0])
        ratio = log_count_ratio(rows, y)
        model = (scaled.astype(np.float32), ratio.astype(np.float32), bias, scale)
    modulus, held = HELD_OUT
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = dict(docs.dtypes)
    names = ["doc_id", "held_out", *carried]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_chunks(batches, column="_text"):
            scores = [score_text(t, *shared.value) if shared.value else 1.0 for t in texts]
            yield pa.RecordBatch.from_arrays([*rows.columns[1:], pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())],
                                             names=[*names, "score", "predicted"])

    chosen = docs.select(F.col("text").alias("_text"), "doc_id", (bucket_of_id(modulus) == held).alias("held_out"), *carried)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in carried)
    return in_arrow(chosen, run, f"doc_id {kinds['doc_id']}, held_out boolean, " + (schema + ", " if schema else "") + "score double, predicted int")


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray, bits: int = BITS) -> np.ndarray:
    counts = np.full((2, 1 << bits), SMOOTHING)
    for indices, label in zip(rows, y):
        counts[int(label), indices] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def op5_quality_classifier(spark, folder: str) -> DataFrame:
    return classify(table(spark, folder, "documents"), table(spark, folder, "labels"))

"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct hashed n-grams of its lower-cased characters. Each is
scaled by the log ratio of its smoothed share in toxic and in other training texts; logistic
regression is fitted on the scaled features. Two more fits, each without half of the sample,
give the margins from which the final margin is calibrated to a probability.

Fitted on at most `limit` labelled texts (6,000), in one bounded task per fit. Scoring holds
the weights only (2^19 floats), so a task's memory does not depend on the corpus.

A text of any length is scored whole, in blocks of characters whose hashes are marked in one table; the order of
its hashes, and so the sum of their weights, depends on the text alone, so equal texts have equal scores wherever they
lie. A score of exactly 0.5 counts as toxic.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import held_out, training_texts

LIMIT = 6000
BITS = 19
SIZES = (4, 6, 8)
MIN_TEXTS = 3
WEIGHT_OF_TOXIC = 5.0
L2 = 1e-3
FOLDS = 2
FINAL = FOLDS
#: Characters hashed at once, so that a very long text needs no long arrays of hashes.
BLOCK = 1 << 18


#: Where each hash was last met in the text at hand; read only where the same text has just written.
LAST_MET = np.zeros(1 << BITS, np.int32)


def grams(codes: np.ndarray) -> np.ndarray:
    """The hash of BITS bits of every n-gram of the sizes, each size grown from the one below it."""
    h, found = np.full(len(codes), 0x9E3779B9, np.uint32), []
    for n in range(1, min(SIZES[-1], len(codes)) + 1):
        h = (h[: len(codes) - n + 1] ^ codes[n - 1 :]) * np.uint32(0x01000193)
        h ^= h >> np.uint32(15)
        if n in SIZES:
            found.append(((h ^ np.uint32(n)) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS))
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


def features(text: str) -> np.ndarray:
    """The distinct n-gram hashes of the whole text, in an order that depends on the text alone."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(codes) > BLOCK:
        held = np.zeros(1 << BITS, bool)
        for at in range(0, len(codes), BLOCK):
            held[grams(codes[at : at + BLOCK + SIZES[-1] - 1])] = True
        return np.flatnonzero(held).astype(np.uint32)
    found = grams(codes)
    order = np.arange(len(found), dtype=np.int32)
    LAST_MET[found] = order
    return found[LAST_MET[found] == order]


def minimize(value_and_slope, start: np.ndarray, rounds: int = 60, memory: int = 8) -> np.ndarray:
    """L-BFGS with step halving."""
    x, steps = start, []
    f, g = value_and_slope(x)
    for _ in range(rounds):
        d, alphas = -g, []
        for s, y in reversed(steps):
            alphas.append(s @ d / (s @ y))
            d = d - alphas[-1] * y
        if steps:
            d = d * (steps[-1][0] @ steps[-1][1] / (steps[-1][1] @ steps[-1][1]))
        for (s, y), alpha in zip(steps, reversed(alphas)):
            d = d + s * (alpha - y @ d / (s @ y))
        step = 1.0 if steps else 1 / max(np.linalg.norm(g), 1e-12)
        slope = g @ d
        while True:
            f_new, g_new = value_and_slope(x + step * d)
            if f_new <= f + 1e-4 * step * slope or step < 1e-8:
                break
            step /= 2
        s, y = step * d, g_new - g
        if s @ y > 1e-14:
            steps = [*steps, (s, y)][-memory:]
        x, done = x + s, abs(f - f_new) < 1e-6
        f, g = f_new, g_new
        if done:
            break
    return x


def log_count_ratio(rows: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """By hash, the log of its smoothed share in toxic texts over that in others; 0 for hashes in few texts."""
    counts = np.ones((2, 1 << BITS))
    for row, label in zip(rows, toxic):
        counts[label][row] += 1
    ratio = np.log(counts[1] / (toxic.sum() + 2)) - np.log(counts[0] / ((1 - toxic).sum() + 2))
    ratio[counts.sum(0) - 2 < MIN_TEXTS] = 0
    return ratio


def fit(rows: list[np.ndarray], toxic: np.ndarray, per_block: int = 500) -> tuple[np.ndarray, float]:
    """Weights by hash (ratio times coefficient) and the intercept."""
    size = 1 << BITS
    ratio = log_count_ratio(rows, toxic)
    rows = [row[ratio[row] != 0] for row in rows]
    blocks = []
    for at in range(0, len(rows), per_block):
        part = rows[at : at + per_block]
        blocks.append((np.concatenate(part), np.array([len(r) for r in part]), slice(at, at + len(part))))
    weight = np.where(toxic == 1, WEIGHT_OF_TOXIC, 1.0)
    weight /= weight.sum()

    def value_and_slope(x):
        z, slope, value = (ratio * x[:-1]).astype(np.float32), np.zeros(size), L2 / 2 * (x[:-1] @ x[:-1])
        slope_of_intercept = 0.0
        for index, lengths, where in blocks:
            owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
            margin = np.bincount(owner, z[index], len(lengths)) + x[-1]
            value += (weight[where] * (np.logaddexp(0, margin) - toxic[where] * margin)).sum()
            g = (1 / (1 + np.exp(-margin)) - toxic[where]) * weight[where]
            slope += np.bincount(index, g.astype(np.float32)[owner], size)
            slope_of_intercept += g.sum()
        return value, np.append(ratio * slope + L2 * x[:-1], slope_of_intercept)

    x = minimize(value_and_slope, np.zeros(size + 1))
    return (ratio * x[:-1]).astype(np.float32), float(x[-1])


def fit_one(group: pd.DataFrame) -> pd.DataFrame:
    """One fit: `model` FINAL learns from all rows, a fold's number leaves out the rows of that fold."""
    model = int(group["model"].iloc[0])
    group = group.sort_values(["doc_id", "text"]).drop_duplicates("doc_id", ignore_index=True)
    toxic = group["label"].to_numpy(np.int64)
    rows = [features(t) for t in group["text"]]
    left_out = np.arange(len(rows)) % FOLDS == model
    learn = np.flatnonzero(~left_out)
    if len(set(toxic[learn])) < 2:
        return pd.DataFrame(columns=["model", "weights", "intercept", "margins", "labels"])
    weights, intercept = fit([rows[i] for i in learn], toxic[learn])
    margins = [float(weights[rows[i]].sum() + intercept) for i in np.flatnonzero(left_out)]
    stored = weights.astype("<f4").tobytes() if model == FINAL else b""
    return pd.DataFrame(
        [(model, stored, intercept, margins, toxic[left_out].tolist())],
        columns=["model", "weights", "intercept", "margins", "labels"],
    )


def calibration(margins: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Scale and shift that make margins left out of a fit into log odds; the scale stays positive."""
    if len(set(toxic)) < 2:
        return 1.0, 0.0
    target = np.where(toxic == 1, (toxic.sum() + 1) / (toxic.sum() + 2), 1 / ((1 - toxic).sum() + 2))

    def value_and_slope(x):
        z = np.exp(x[0]) * margins + x[1]
        g = 1 / (1 + np.exp(-z)) - target
        value = (np.logaddexp(0, z) - target * z).mean()
        return value, np.array([(g * margins).mean() * np.exp(x[0]), g.mean()])

    log_scale, shift = minimize(value_and_slope, np.zeros(2))
    return float(np.exp(log_scale)), float(shift)


def train(documents: DataFrame, labels: DataFrame, limit: int = LIMIT) -> tuple[np.ndarray, float, float] | None:
    """(weights, scale, shift) of the margin, or None without labelled texts of both classes."""
    sample = training_texts(documents, labels, "toxic", limit)
    models = F.explode(F.array(*[F.lit(i) for i in range(FOLDS + 1)]))
    fitted = (
        sample.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "label", models.alias("model"))
        .groupBy("model")
        .applyInPandas(
            fit_one, "model int, weights binary, intercept double, margins array<double>, labels array<bigint>"
        )
        .collect()
    )
    final = next((r for r in fitted if r["model"] == FINAL), None)
    if final is None:
        return None
    folds = [r for r in fitted if r["model"] != FINAL]
    margins = np.concatenate([np.asarray(r["margins"], float) for r in folds] or [np.zeros(0)])
    toxic = np.concatenate([np.asarray(r["labels"], int) for r in folds] or [np.zeros(0, int)])
    scale, shift = calibration(margins, toxic)
    return np.frombuffer(final["weights"], "<f4"), scale, scale * final["intercept"] + shift


def score(documents: DataFrame, model, default: float = 0.0) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    A null or empty text scores as a text without known n-grams. Without a model every score
    is `default`. Rows with a null or repeated id are scored like others; other columns are not read.
    """
    context = documents.sparkSession.sparkContext
    shared = context.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores = np.full(batch.num_rows, default)
            if model is not None:
                weights, scale, shift = model
                for i, text in enumerate(batch.column(1)):
                    margin = scale * float(weights[features(text.as_py() or "")].sum()) + shift
                    scores[i] = 1 / (1 + np.exp(-np.clip(margin, -700, 700)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    kept = documents.select("doc_id", F.col("text").cast("string"))
    kind = kept.schema[0].dataType.simpleString()
    scored = kept.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

A text is a bag of terms in two halves: hashed byte 1- and 2-grams, and hashed pairs of adjacent
words, in which all pairs of a word with itself are one term. Log counts times inverse text frequency,
each half brought to length one, are projected to the leading singular vectors of the sample. Each
document meets every labelled vector, block by block, in exact cosine products; its nearest labelled
texts vote with a power of their similarity.

Vectors are rounded to whole multiples of 1/4096, so products are exact whole numbers: equal texts have
equal scores wherever they lie. Labelled texts that tie in likeness are taken by their id as text.

Fitted on at most `limit` labelled texts (6,000). Their terms are counted in many tasks; one task
gets the counts, at most 4,097 numbers a text however long it is, and fits. What is broadcast is
bounded by that limit: at most 6,000 x 32 + 4,097 x 33 doubles, about 3 MB.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import WORD, fresh, gram_hashes, held_out, training_texts

LIMIT = 6000
BITS = 11
SIZES = (1, 2)
GRAMS = 1 << BITS
#: Grams, then pairs of different words, then the one term of pairs of equal words.
TERMS = 2 * GRAMS + 1
RANK, EXTRA, ROUNDS = 32, 64, 5
NEIGHBOURS = 10
#: Similarity is squared so many times: a vote weighs by its eighth power.
SQUARINGS = 3
STEPS = 4096
KEEP = 0.3
#: Documents that meet the labelled vectors at once, and characters hashed at once.
ROWS, BLOCK = 256, 1 << 20
FIND_WORDS = re.compile(WORD)
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def terms(text: str) -> np.ndarray:
    """Log term counts of the whole text."""
    codes = np.frombuffer(f" {text} ".encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.zeros(TERMS)
    for n in SIZES:
        for at in range(0, len(codes), BLOCK):
            hashes = gram_hashes(codes[at : at + BLOCK + n - 1].astype(np.uint32), n, BITS)
            counts[:GRAMS] += np.bincount(hashes, minlength=GRAMS)
    words = FIND_WORDS.findall(text)
    if len(words) > 1:
        hashes = pd.util.hash_array(np.array(words, dtype=object))
        before, after = hashes[:-1], hashes[1:]
        same = before == after
        pairs = ((before * SPREAD + after) * SPREAD)[~same] >> np.uint64(64 - BITS)
        counts[GRAMS:-1] = np.bincount(pairs.astype(np.int64), minlength=GRAMS)
        counts[-1] = np.count_nonzero(same)
    return np.log1p(counts)


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=-1, keepdims=True), 1e-9)


def weighted(counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Each half of the terms, by rarity, at length one."""
    rows = counts * rarity
    for half in (rows[..., :GRAMS], rows[..., GRAMS:]):
        half[...] = unit(half)
    return unit(rows)


def placed(counts: np.ndarray, rarity: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """A text's latent vector in steps of 1/4096. Worked out text by text, so that no other text bears on it."""
    return np.rint(STEPS * unit(weighted(counts, rarity) @ projection))


def count_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The terms of each labelled text that it has, with their log counts."""
    for batch in batches:
        for doc_id, text, label in zip(batch["doc_id"], batch["text"], batch["label"]):
            counts = terms(text)
            found = np.flatnonzero(counts)
            row = [doc_id, label, found.astype("<u2").tobytes(), counts[found].astype("<f4").tobytes()]
            yield pd.DataFrame([row], columns=["doc_id", "label", "found", "counts"])


def leading(rows: np.ndarray) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration from a fixed start."""
    basis = np.random.default_rng(0).normal(size=(rows.shape[1], RANK + EXTRA)).astype(rows.dtype)
    for _ in range(ROUNDS):
        basis, _ = np.linalg.qr(rows.T @ (rows @ basis))
    _, sizes, turn = np.linalg.svd(rows @ basis, full_matrices=False)
    rank = max(1, min(RANK, int((sizes > 1e-4 * sizes[0]).sum())))
    return basis @ turn[:rank].T


def fit_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rarity of each term, the projection, the labelled vectors and their labels, from the whole bounded sample."""
    sample = pd.concat(list(batches) or [pd.DataFrame({"doc_id": [], "label": [], "found": [], "counts": []})])
    if len(sample) == 0:
        return
    sample = sample.sort_values(["doc_id", "found", "counts"]).drop_duplicates("doc_id")
    counts = np.zeros((len(sample), TERMS), np.float32)
    for row, found, values in zip(counts, sample["found"], sample["counts"]):
        row[np.frombuffer(found, "<u2")] = np.frombuffer(values, "<f4")
    rarity = np.log((1 + len(counts)) / (1 + np.count_nonzero(counts, axis=0))) + 0.1
    projection = leading(weighted(counts, rarity.astype(np.float32))).astype(np.float64)
    labelled = np.stack([placed(row.astype(np.float64), rarity, projection) for row in counts])
    parts = [rarity, projection, labelled, sample["label"].to_numpy(np.float64)]
    yield pd.DataFrame([[p.astype("<f8").tobytes() for p in parts]], columns=["rarity", "projection", "labelled", "labels"])


def train(documents: DataFrame, labels: DataFrame, limit: int = LIMIT):
    """(rarity, projection, labelled vectors, labels), or None without labelled texts."""
    sample = training_texts(documents, labels, "quality", limit)
    row = (
        sample.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "label")
        .mapInPandas(count_terms, "doc_id string, label int, found binary, counts binary")
        .repartition(1)
        .mapInPandas(fit_all, "rarity binary, projection binary, labelled binary, labels binary")
        .collect()
    )
    if not row:
        return None
    rarity, projection, labelled, votes = (np.frombuffer(row[0][i], "<f8") for i in range(4))
    return rarity, projection.reshape(TERMS, -1), labelled.reshape(len(votes), -1), votes


def vote(texts: list[str | None], model) -> np.ndarray:
    rarity, projection, labelled, votes = model
    vectors = np.stack([placed(terms(t or ""), rarity, projection) for t in texts])
    likeness = vectors @ labelled.T  # whole numbers below 2^53: exact in any order of summation
    count = min(NEIGHBOURS, len(votes))
    # One number a pair, none equal: likeness first, then the place by id.
    order = np.arange(len(votes)) - likeness * len(votes)
    nearest = np.sort(np.argpartition(order, count - 1, axis=1)[:, :count], axis=1)
    weight = np.maximum(np.take_along_axis(likeness, nearest, 1), 0) / STEPS**2
    for _ in range(SQUARINGS):
        weight = weight * weight
    weight += 1e-9
    return np.clip((weight * votes[nearest]).sum(1) / weight.sum(1), 0, 1)


def with_scores(documents: DataFrame, model, name: str, default: float = 1.0) -> DataFrame:
    """Every row with all its columns and its score in the new column `name`.

    Whole texts are read; a null text is an empty one and scores by the neighbours of that.
    Without labelled texts every score is `default`: what nothing is known of is not rejected.
    Null and repeated ids and further columns do not matter; rows with equal texts have equal scores.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    at_text = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores = np.full(batch.num_rows, default)
            if model is not None:
                for at in range(0, batch.num_rows, ROWS):
                    texts = batch.column(at_text).slice(at, ROWS).to_pylist()
                    scores[at : at + ROWS] = vote(texts, model)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, name])

    schema = type(documents.schema)([*documents.schema.fields]).add(name, "double")
    return documents.mapInArrow(run, schema)


def score(documents: DataFrame, labels: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    model = train(documents, labels, limit)
    kept = documents.select("doc_id", F.col("text").cast("string"))
    scored = with_scores(kept, model, "score")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= KEEP).cast("int").alias("predicted"))


def keep_good(documents: DataFrame, labels: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The rows, with their columns, whose score reaches `KEEP`."""
    (name,) = fresh(documents, "quality_score")
    scored = with_scores(documents, train(documents, labels, limit), name)
    return scored.where(F.col(name) >= KEEP).drop(name)

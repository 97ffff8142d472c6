"""Target-distribution importance resampling by bit-sliced sums.

A text's features are its words, lower-cased A-Z, repeats counted; a feature's bucket is the crc32 of its
UTF-8 bytes modulo `BUCKETS`. A bucket's gain is the floored thousandfold logarithm of its smoothed share in the
target texts over its share in all documents. A document's weight is the mean gain of its features; a Gumbel
number from a hash of its id is added, and the highest scores are drawn, which draws without replacement in
proportion to the weights' exponentials.

Sums are bit-sliced: the bucket counts of a block of documents become planes of `BUCKETS` bits, one for
each binary digit of the counts. The gains become planes too, one for each binary digit of their size, apart for
positive and negative ones. A document's sum of gains is the sum over pairs of planes of popcount(AND) times a power
of two: whole numbers throughout, so it is exact and alike in every partition.

Defined cases: a null or empty text, or one without words, has no features and weight 0. Its features still count for
nothing, so it changes no gain. A row without an id has no score and is never drawn, but its text counts as one of the
documents. Rows of the same id and text have equal scores, each takes a rank of its own. An empty documents table
gives an empty result; empty target texts give the gains of zero counts. Extra columns are left out.
Very long texts are taken in slices of about `SLICE` bytes, cut between words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import numbered

BUCKETS, SEED, LEAST_WORDS, PERCENT = 10_000, 2024, 20, 10
PLANE = -(-BUCKETS // 64)
SLICE, BLOCK = 1 << 20, 64
#: On the UTF-8 bytes of a lower-cased text: digits, a-z and all bytes of the other characters.
FEATURE = re.compile(rb"[0-9a-z\x80-\xff]+")
BREAK = re.compile(rb"[^0-9a-z\x80-\xff]")


def buckets_of(text: bytes) -> Iterator[np.ndarray]:
    """The bucket of each feature, a slice of the text at a time."""
    low, at = text.lower(), 0
    while at < len(low):
        cut = BREAK.search(low, at + SLICE)
        end = cut.start() if cut else len(low)
        yield np.fromiter(map(crc32, FEATURE.findall(low, at, end)), np.uint32) % BUCKETS
        at = end


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Up to BLOCK rows with the last column's text, and their counts by bucket."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            counts = np.zeros((part.num_rows, BUCKETS), np.int64)
            for row, text in zip(counts, part.column(part.num_columns - 1)):
                for found in buckets_of(text.as_py() or b""):
                    row += np.bincount(found, minlength=BUCKETS)
            yield part, counts


def as_bytes(texts: DataFrame) -> Column:
    return F.col("text").cast("string").cast("binary").alias("text")


def bucket_totals(texts: DataFrame) -> np.ndarray:
    """Features by bucket over all texts. A task sends one row a bucket; the driver gets BUCKETS rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(BUCKETS, np.int64)
        for _, counts in blocks(batches):
            totals += counts.sum(0)
        held = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(totals[held])], names=["bucket", "n"])

    parts = texts.select(as_bytes(texts)).mapInArrow(run, "bucket bigint, n bigint")
    totals = np.zeros(BUCKETS, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        totals[row["bucket"]] = row["n"]
    return totals


def gains_of(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))) of each bucket."""
    t, s = target.astype(float), source.astype(float)
    shares = (t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS))
    return np.floor(1000 * np.log(shares)).astype(np.int64)


def planes_of(values: np.ndarray) -> np.ndarray:
    """(digits, rows, PLANE) words of 64 bits: bit b of plane d is binary digit d of a row's value in bucket b."""
    digits = int(values.max(initial=0)).bit_length()
    out = np.zeros((digits, len(values), PLANE * 8), np.uint8)
    for d in range(digits):
        packed = np.packbits((values >> d & 1).astype(bool), axis=1)
        out[d, :, : packed.shape[1]] = packed
    return out.view(np.uint64)


def sliced_sums(counts: np.ndarray, up: np.ndarray, down: np.ndarray) -> np.ndarray:
    """Each row's sum of counts times gains, from the planes of its counts and of the gains."""
    sums = np.zeros(len(counts), np.int64)
    for i, plane in enumerate(planes_of(counts)):
        for sign, gains in ((1, up), (-1, down)):
            for j, gain in enumerate(gains):
                sums += sign * (np.bitwise_count(plane & gain).sum(1, dtype=np.int64) << (i + j))
    return sums


def weigh(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """(doc_id, n_features, weight): the floored mean gain of each document's features."""
    up, down = planes_of(np.maximum(gains, 0)[None]), planes_of(np.maximum(-gains, 0)[None])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, counts in blocks(batches):
            n = counts.sum(1)
            weight = sliced_sums(counts, up, down) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n), pa.array(weight)], names=["doc_id", "n_features", "weight"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", as_bytes(docs)).mapInArrow(run, f"doc_id {kind}, n_features bigint, weight bigint")


def gumbel(seed: int) -> Column:
    """floor(-1000 ln(-ln((h+0.5)/2^32))), h the first 8 hex digits of sha256('seed:doc_id'); null without an id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): rank 1, 2, ... for the drawn `percent` of the documents with
    `least_words` or more, null for the others. Equal scores go to the smaller doc_id."""
    gains = gains_of(bucket_totals(target), bucket_totals(docs))
    scored = weigh(docs, gains).withColumn("score", F.col("weight") + gumbel(seed))
    takes_part = F.coalesce((F.col("n_features") >= least_words) & F.col("doc_id").isNotNull(), F.lit(False))
    order = [F.col("score").desc(), "doc_id", "n_features", "weight"]
    placed = numbered(scored.withColumn("takes_part", takes_part), ["takes_part"], order, "place")
    drawn = placed.where("takes_part").count() * percent // 100
    rank = F.when(F.col("takes_part") & (F.col("place") < drawn), F.col("place") + 1)
    return placed.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))


def drawn_documents(docs: DataFrame, target: DataFrame, **parameters) -> DataFrame:
    """The documents that are drawn, all columns, by id (ids once each)."""
    ids = resample(docs, target, **parameters).where("rank IS NOT NULL").select("doc_id").distinct()
    return docs.join(ids, "doc_id", "left_semi")

"""Line dedup: sharded cuckoo filters over exact reference-count tables, open to insertions and deletions.

A line's key is the line without ASCII white space at its ends and with A-Z in lower case. Keys of
`MIN_CHARS` code points or more that are in `MIN_DOCS` documents or more lose all their lines
but those of the largest doc_id that holds them.

The index is three tables: references (each key and document once), counts (documents and
largest doc_id of each key), and for each shard of the key space a cuckoo filter of the keys that
have enough documents. A document's keys are first looked up in the filter of their shard;
only those it may hold are then joined to the counts, which decide. `insert` and `delete` change
the counts of the keys they touch and the filters where a key crosses the number of documents, so a
deletion takes back what the insertion did.

Keys are 128-bit digests. Skew: counts combine in the map tasks, a shard's look-ups are dealt to
`SALTS` streams which hold one filter at a time, and the join with the counts is one that adaptive
execution can split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import SPACE_CHARS, fresh, stored

MIN_CHARS, MIN_DOCS = 20, 3
KEYS_PER_SHARD, LEAST_SHARDS, SALTS = 200_000, 8, 32
SLOTS, KICKS = 4, 500
BLANKS = SPACE_CHARS.encode()


def line_keys(text: bytes) -> list[bytes | None]:
    """The key digest of each line, None for those too short to count."""
    out: list[bytes | None] = []
    for line in text.split(b"\n"):
        key = line.strip(BLANKS).lower()
        long = len(key) >= MIN_CHARS and (key.isascii() or len(key.decode("utf-8", "replace")) >= MIN_CHARS)
        out.append(hashlib.blake2b(key, digest_size=16).digest() if long else None)
    return out


def references_of(docs: DataFrame) -> DataFrame:
    """(hi, lo, doc_id), each once. Rows without an id or text have none; rows of one id are one document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                owners, found = [], []
                for i, text in enumerate(part.column(1)):
                    keys = {k for k in line_keys(text.as_py() or b"") if k}
                    owners += [i] * len(keys)
                    found += keys
                pairs = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
                ids = part.column(0).take(pa.array(owners, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy()), ids], names=["hi", "lo", "doc_id"]
                )

    kept = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    kept = kept.select("doc_id", F.col("text").cast("string").cast("binary"))
    kind = kept.schema[0].dataType.simpleString()
    return kept.mapInArrow(run, f"hi bigint, lo bigint, doc_id {kind}").distinct()


def counted(references: DataFrame) -> DataFrame:
    return references.groupBy("hi", "lo").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))


# Cuckoo filters: fingerprints of 16 bits in buckets of four slots, 0 for a free slot


def fingerprints(hi: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint and first bucket of each key; a bucket's partner differs by the hash of the fingerprint."""
    u = hi.astype(np.int64).view(np.uint64)
    return (u >> np.uint64(48)).astype(np.int64) % 65535 + 1, (u & np.uint64(buckets - 1)).astype(np.int64)


def partner(bucket, fingerprint, buckets: int):
    return bucket ^ ((fingerprint * 0x5BD1E995) & (buckets - 1))


def add_key(cells: np.ndarray, bucket: int, mark: int) -> bool:
    """Put a fingerprint into one of its two buckets, moving others; False if the filter is full."""
    for turn in range(KICKS):
        for place in (bucket, partner(bucket, mark, len(cells))):
            free = np.flatnonzero(cells[place] == 0)
            if len(free):
                cells[place, free[0]] = mark
                return True
        bucket = partner(bucket, mark, len(cells))
        slot = (turn * 7 + mark) % SLOTS
        cells[bucket, slot], mark = mark, int(cells[bucket, slot])
        bucket = partner(bucket, mark, len(cells))
    return False


def remove_key(cells: np.ndarray, bucket: int, mark: int) -> None:
    """Take one copy of a fingerprint that was put in."""
    for place in (bucket, partner(bucket, mark, len(cells))):
        at = np.flatnonzero(cells[place] == mark)
        if len(at):
            cells[place, at[0]] = 0
            return


def filled(hi: np.ndarray) -> np.ndarray:
    """A filter of the keys, as large as it takes."""
    buckets = 1 << max(2, int(np.ceil(np.log2(max(1, len(hi)) / (SLOTS * 0.8)))))
    while True:
        cells = np.zeros((buckets, SLOTS), np.int64)
        marks, places = fingerprints(hi, buckets)
        if all(add_key(cells, int(p), int(m)) for m, p in zip(marks, places)):
            return cells
        buckets *= 2


def may_hold(cells: np.ndarray, hi: np.ndarray) -> np.ndarray:
    marks, places = fingerprints(hi, len(cells))
    other = partner(places, marks, len(cells))
    return (cells[places] == marks[:, None]).any(1) | (cells[other] == marks[:, None]).any(1)


def packed(cells: np.ndarray) -> bytes:
    return cells.astype("<u2").tobytes()


def unpacked(cells: bytes) -> np.ndarray:
    return np.frombuffer(cells, "<u2").reshape(-1, SLOTS).astype(np.int64)


def shard_of(shards: int) -> Column:
    return F.pmod(F.col("lo"), F.lit(shards)).cast("int").alias("shard")


def build_filters(keys: DataFrame, shards: int) -> DataFrame:
    """(shard, cells) for every shard with keys; a shard holds about KEYS_PER_SHARD of them."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        hi = np.sort(group["hi"].to_numpy(np.int64))
        return pd.DataFrame({"shard": group["shard"].iloc[:1].to_numpy(), "cells": [packed(filled(hi))]})

    return keys.select("hi", shard_of(shards)).groupBy("shard").applyInPandas(run, "shard int, cells binary")


@dataclass(frozen=True)
class LineIndex:
    """references (hi, lo, doc_id), counts (hi, lo, n_docs, last_doc), filters (shard, cells)."""

    references: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int = MIN_DOCS


def build(docs: DataFrame, min_docs: int = MIN_DOCS) -> LineIndex:
    """The index of a first set of documents."""
    references = stored(references_of(docs))
    counts = stored(counted(references))
    repeated = counts.where(F.col("n_docs") >= min_docs)
    shards = max(LEAST_SHARDS, repeated.count() // KEYS_PER_SHARD + 1)
    return LineIndex(references, counts, stored(build_filters(repeated, shards)), shards, min_docs)


def changed(index: LineIndex, references: DataFrame, counts: DataFrame) -> LineIndex:
    """The index with new tables; filters change where a key crossed the number of documents."""
    was = index.counts.select("hi", "lo", F.col("n_docs").alias("before"))
    both = was.join(counts.select("hi", "lo", "n_docs"), ["hi", "lo"], "full")
    now, before = (F.coalesce(c, F.lit(0)) >= index.min_docs for c in ("n_docs", "before"))
    crossed = both.where(now != before).select(shard_of(index.shards), "hi", "lo", now.alias("enters"))

    def run(key: tuple, olds: pd.DataFrame, moves: pd.DataFrame) -> pd.DataFrame:
        cells = unpacked(olds["cells"].iloc[0]) if len(olds) else filled(np.zeros(0, np.int64))
        moves = moves.sort_values(["enters", "hi", "lo"])
        marks, places = fingerprints(moves["hi"].to_numpy(np.int64), len(cells))
        full = False
        for mark, place, enters in zip(marks, places, moves["enters"]):
            if enters:
                full = full or not add_key(cells, int(place), int(mark))
            else:
                remove_key(cells, int(place), int(mark))
        return pd.DataFrame({"shard": [key[0]], "cells": [packed(cells)], "full": [full]})

    updated = index.filters.groupBy("shard").cogroup(crossed.groupBy("shard"))
    updated = stored(updated.applyInPandas(run, "shard int, cells binary, full boolean"))
    # A filter that had no room is built again, larger, from the exact counts of its shard.
    full = updated.where("full").select("shard")
    keys = counts.where(F.col("n_docs") >= index.min_docs).withColumn("shard", shard_of(index.shards))
    rebuilt = build_filters(keys.join(full, "shard", "left_semi").drop("shard"), index.shards)
    filters = updated.where(~F.col("full")).select("shard", "cells").unionByName(rebuilt)
    return LineIndex(references, counts, stored(filters), index.shards, index.min_docs)


def insert(index: LineIndex, docs: DataFrame) -> LineIndex:
    """The index with further documents. References that it already holds count once."""
    added = references_of(docs).join(index.references, ["hi", "lo", "doc_id"], "left_anti")
    added = stored(added)
    delta = counted(added).select("hi", "lo", F.col("n_docs").alias("more"), F.col("last_doc").alias("last_more"))
    counts = index.counts.join(delta, ["hi", "lo"], "full").select(
        "hi",
        "lo",
        (F.coalesce("n_docs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n_docs"),
        F.greatest("last_doc", "last_more").alias("last_doc"),
    )
    return changed(index, stored(index.references.unionByName(added)), stored(counts))


def delete(index: LineIndex, ids: DataFrame) -> LineIndex:
    """The index without the documents of `ids` (doc_id): only keys they held are counted again."""
    gone = ids.select("doc_id").distinct()
    references = stored(index.references.join(gone, "doc_id", "left_anti").select("hi", "lo", "doc_id"))
    touched = index.references.join(gone, "doc_id", "left_semi").select("hi", "lo").distinct()
    again = counted(references.join(touched, ["hi", "lo"], "left_semi"))
    counts = index.counts.join(touched, ["hi", "lo"], "left_anti").unionByName(again)
    return changed(index, references, stored(counts))


def candidates(index: LineIndex, references: DataFrame) -> DataFrame:
    """The references whose key the filter of its shard may hold."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    kind = references.schema["doc_id"].dataType.simpleString()
    filters = index.filters.select(
        "shard", salts.alias("salt"), F.lit(None).cast("bigint").alias("hi"), F.lit(None).cast("bigint").alias("lo"),
        F.lit(None).cast(kind).alias("doc_id"), "cells",
    )
    asked = references.select(
        shard_of(index.shards), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"), "hi", "lo", "doc_id",
        F.lit(None).cast("binary").alias("cells"),
    )
    streams = filters.unionByName(asked).repartition("shard", "salt")
    # A stream begins with its filter: null keys sort first.
    streams = streams.sortWithinPartitions("shard", "salt", F.col("cells").isNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, cells = None, None
        for batch in batches:
            shard, salt = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            starts = np.flatnonzero((np.diff(shard) != 0) | (np.diff(salt) != 0)) + 1
            for begin, end in zip([0, *starts], [*starts, len(shard)]):
                if begin == end:
                    continue
                if place != (shard[begin], salt[begin]):
                    place, cells = (shard[begin], salt[begin]), None
                if batch.column(5)[int(begin)].is_valid:
                    cells = unpacked(batch.column(5)[int(begin)].as_py())
                    begin += 1
                if cells is not None and begin < end:
                    part = batch.slice(int(begin), int(end - begin))
                    hits = may_hold(cells, part.column(2).to_numpy())
                    yield part.select(["hi", "lo", "doc_id"]).filter(pa.array(hits))

    return streams.mapInArrow(run, f"hi bigint, lo bigint, doc_id {kind}")


def dropped(index: LineIndex, references: DataFrame) -> DataFrame:
    """(doc_id, keys): the key digests whose lines each document loses."""
    repeated = index.counts.where(F.col("n_docs") >= index.min_docs).select("hi", "lo", "last_doc")
    lost = candidates(index, references).join(repeated, ["hi", "lo"]).where(F.col("doc_id") != F.col("last_doc"))
    return lost.groupBy("doc_id").agg(F.collect_list(F.struct("hi", "lo")).alias("keys"))


def without_lines(docs: DataFrame, lost: DataFrame, new_text: str, n_lines: str, n_dropped: str) -> DataFrame:
    """Every row with its columns and three new ones: the text that stays, lines before, lines dropped."""
    (keys, lost_id) = fresh(docs, "lost_keys", "lost_id")
    named = lost.select(F.col("doc_id").alias(lost_id), F.col("keys").alias(keys))
    joined = docs.join(named, F.col("doc_id") == F.col(lost_id), "left").drop(lost_id)
    at_text, at_keys = docs.columns.index("text"), len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, befores, gone = [], [], []
            for text, lose in zip(batch.column(at_text), batch.column(at_keys)):
                raw = (text.as_py() or "").encode()
                before = drop = 0
                if lose.is_valid:
                    marks = {np.array([k["hi"], k["lo"]], "<i8").tobytes() for k in lose.as_py()}
                    rows = raw.split(b"\n")
                    stay = [r for r, k in zip(rows, line_keys(raw)) if k not in marks]
                    before, drop = len(rows), len(rows) - len(stay)
                    raw = b"\n".join(stay)
                else:
                    before = raw.count(b"\n") + 1
                texts.append(raw.decode())
                befores.append(before)
                gone.append(drop)
            columns = [*batch.columns[:at_keys], pa.array(texts, pa.string()), pa.array(befores, pa.int64()), pa.array(gone, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:at_keys], new_text, n_lines, n_dropped])

    schema = type(docs.schema)([*docs.schema.fields]).add(new_text, "string").add(n_lines, "long").add(n_dropped, "long")
    return joined.mapInArrow(run, schema)


def deduped(docs: DataFrame) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped) of every row.

    A null or empty text is one empty line. Rows without a doc_id keep all lines and are not
    counted; rows that share one are one document and lose the same keys. Of a key's documents
    the largest id keeps all its lines, also where the key repeats within it.
    """
    index = build(docs)
    cleaned = without_lines(docs.select("doc_id", F.col("text").cast("string").alias("text")), dropped(index, index.references), "kept_text", "n_lines", "n_dropped")
    return cleaned.select("doc_id", F.col("kept_text").alias("text"), "n_lines", "n_dropped")


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """All rows with their columns; `text` without the lines that are dropped, other columns as they were."""
    index = build(docs)
    new_text, n_lines, n_dropped = fresh(docs, "kept_text", "line_count", "drop_count")
    cleaned = without_lines(docs, dropped(index, index.references), new_text, n_lines, n_dropped)
    return cleaned.select(*[F.col(new_text).alias(c) if c == "text" else F.col(c) for c in docs.columns])

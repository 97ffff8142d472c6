"""Outbox: pending rows, pages, payloads, delivery and write-back."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby, islice
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.context import ensure_checkpoint_dir
from tideline.functions.texts import json_payload
from tideline.operators.paging import page_rows
from tideline.operators.upsert import src, tgt, update_from

# Fixed value: rows per request.
PAGE_SIZE = 1_000_000
ROWS_PER_CHUNK = 10_000

BOOKKEEPING = ("submission_status", "submission_attempt_count", "max_submission_attempt_count")
DELIVERED, REFUSED, BROKEN = "SUCCESS", "FAILURE", "ERROR"


def pending(outbox: DataFrame) -> DataFrame:
    """Rows to deliver: not yet successful and attempts left. A null status drops out."""
    return outbox.where(
        ~F.col("submission_status").isin(DELIVERED)
        & (F.col("submission_attempt_count") < F.col("max_submission_attempt_count"))
    )


def batches(outbox: DataFrame, identity: str = "identity", page_size: int = PAGE_SIZE) -> DataFrame:
    """A snapshot of the pending rows in identity order, cut into numbered batches."""
    return page_rows(pending(outbox), identity, page_size)


@dataclass(frozen=True)
class OutboxSource:
    """What one source sends: its columns by name and its identity. Without columns all data columns go."""

    identity: str = "identity"
    columns: tuple[str, ...] | None = None

    def payload_columns(self, names: Sequence[str]) -> list[str]:
        if self.columns is not None:
            return list(self.columns)
        return [c for c in names if c not in (self.identity, *BOOKKEEPING, "position", "batch_no")]


def payloads(rows: DataFrame, source: OutboxSource = OutboxSource()) -> DataFrame:
    """Each row as a JSON object of the columns its source sends."""
    return rows.withColumn("payload", json_payload(source.payload_columns(rows.columns)))


def deliver(paged: DataFrame, send: Callable[[Iterator[list[dict]]], bool], source: OutboxSource = OutboxSource()) -> DataFrame:
    """Hand every batch to `send` and return (batch_no, rows, outcome, error).

    `send` gets a batch as an iterator of lists of rows, in order, so a page is never held whole, and
    answers whether the receiver took it; an exception marks the batch ERROR and its text is kept. The
    outcomes are checkpointed at once, so later use does not send again; a task that is lost while it
    sends is repeated, so receivers must accept a batch twice.
    """
    ensure_checkpoint_dir(paged.sparkSession)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(b.column("batch_no").to_pylist(), b.column("payload").to_pylist()))
        for number, batch in groupby(rows, itemgetter(0)):
            counted = [0]

            def chunks(batch=batch, counted=counted) -> Iterator[list[dict]]:
                while chunk := [json.loads(text) for _, text in islice(batch, ROWS_PER_CHUNK)]:
                    counted[0] += len(chunk)
                    yield chunk

            error = None
            try:
                outcome = DELIVERED if send(chunks()) else REFUSED
            except Exception as problem:  # every batch gets an outcome; the text is kept
                outcome, error = BROKEN, f"{type(problem).__name__}: {problem}"
            left = sum(1 for _ in batch)
            yield pa.record_batch(
                {
                    "batch_no": pa.array([number], pa.int64()),
                    "rows": pa.array([counted[0] + left], pa.int64()),
                    "outcome": pa.array([outcome], pa.string()),
                    "error": pa.array([error], pa.string()),
                }
            )

    sent = payloads(paged, source).select("batch_no", "position", "payload")
    return (
        sent.repartition("batch_no")
        .sortWithinPartitions("batch_no", "position")
        .mapInArrow(post, "batch_no bigint, rows bigint, outcome string, error string")
        .checkpoint(eager=True)
    )


def write_back(outbox: DataFrame, paged: DataFrame, outcomes: DataFrame, identity: str = "identity") -> DataFrame:
    """The outbox with status and attempt count of the rows whose batch got an answer.

    An identity that was sent in several batches counts each of them and keeps the last answer.
    """
    answered = (
        paged.select("batch_no", identity)
        .join(outcomes.where(F.col("outcome") != BROKEN), "batch_no")
        .groupBy(identity)
        .agg(F.count_distinct("batch_no").alias("tries"), F.max(F.struct("batch_no", "outcome")).alias("last"))
        .select(identity, "tries", "last.outcome")
    )
    values = {
        "submission_status": src("outcome"),
        "submission_attempt_count": tgt("submission_attempt_count") + src("tries"),
    }
    return update_from(outbox, answered, [identity], values)

"""Byte-level BPE encoding and decoding with a local rank file.

Ids travel as little-endian unsigned 32-bit integers in one binary column. Texts over
`PIECE` characters are cut before a blank or line end that follows a visible character: no
match of the pattern spans such a place, nor does the match before it look past it, so the
pieces give the ids of the whole text. Where no such place is near, the piece runs on to the next.
The pattern needs memory for each blank of a run, so a run of more than `BLANKS` is found by a linear scan and taken
without it: all but the last blank are one match, the last one belongs to what follows; at the end of a text all are one.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE, BLANKS = 1 << 16, 1 << 12
#: White space as the pattern's \\s has it.
LONG_RUN = regex.compile(rf"\p{{White_Space}}{{{BLANKS + 1},}}+")
SAFE = regex.compile(r"(?<=[\p{L}\p{N}!-~])(?=[ \n])|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})")


@lru_cache(maxsize=4)
def encoding(ranks_path: str, pattern: str):
    """One encoder per Python worker, without special tokens."""
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in pieces of about `size` characters, cut at safe boundaries only."""
    start = 0
    while len(text) - start > size:
        cut = SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def matches(text: str) -> Iterator[tuple[str, bool]]:
    """The text in parts, and whether a part is one match of the pattern already (all of a long run of blanks but its last)."""
    start = 0
    for run in LONG_RUN.finditer(text):
        if run.start() > start:
            yield text[start : run.start()], False
        start = run.end() if run.end() == len(text) else run.end() - 1
        yield text[run.start() : start], True
    yield text[start:], False


def token_ids(encoder, text: str | None) -> bytes:
    if not text:
        return b""
    out = []
    for part, whole in matches(text):
        if whole:
            out.append(np.array(encoder._encode_single_piece(part), "<u4").tobytes())
        else:
            out += [encoder.encode_to_numpy(p, disallowed_special=()).astype("<u4").tobytes() for p in pieces(part)]
    return b"".join(out)


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, token_ids binary, n_tokens) of every whole text; other columns are not read.

    A null or empty text has no ids. Rows with a null or repeated id are encoded like others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(ranks_path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = [token_ids(encoder, t) for t in part.column(1).to_pylist()]
                counts = pa.array([len(i) // 4 for i in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), counts], names=names)

    kept = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    names = [id_col, "token_ids", "n_tokens"]
    kind = kept.schema[0].dataType.simpleString()
    return kept.mapInArrow(run, f"`{id_col}` {kind}, token_ids binary, n_tokens bigint")


def decode(encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """The encoded frame with a column `decoded`: the raw bytes of the ids (null ids: none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(ranks_path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = part.column(1).to_pylist()
                raw = [encoder.decode_bytes(np.frombuffer(i or b"", "<u4").tolist()) for i in ids]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(raw, pa.binary())], names=names)

    kept = encoded.select(id_col, "token_ids", "n_tokens")
    names = [id_col, "token_ids", "n_tokens", "decoded"]
    kind = kept.schema[0].dataType.simpleString()
    return kept.mapInArrow(run, f"`{id_col}` {kind}, token_ids binary, n_tokens bigint, decoded binary")

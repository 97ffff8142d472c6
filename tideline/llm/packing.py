"""Packing along a space-filling curve.

Each document is tokenized and its distinct ids are projected to four dimensions by fixed random
weights. Documents are range-sorted by the Hilbert key of that point, laid end to end, and the row
of ids is cut every `length` ids: neighbours on the curve share sequences and only the last sequence
has room left. Positions come from running sums within range partitions and one sum per
partition, so no task sees more than its own rows.

The ids are tokenized once, stored, and joined by row number to their positions.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import stored

LENGTH, END_ID = 4096, 2
DIMENSIONS, BITS, SEED = 4, 8, 7
TEXTS, WORDS, CACHED, CACHED_PARTS = 512, 200, 400_000, 900_000
#: In texts of these characters lower case and composition work character by character, so that a
#: text's tokens are those of its words. A zero character is left over to part words.
OTHER_SCRIPT = re.compile("[^\x01-\x1b -ɏ]|İ")
PART = "\x00"
#: Marks that end words. A word of letters and such marks is two tokens' worth of text, parted there by the split pattern.
ENDS = ".,;:!?&%*$#-\"'()"
END_OF_WORD = "</w>"
#: The ASCII characters that OTHER_SCRIPT finds.
RARE = "\x00\x1c\x1d\x1e\x1f"
#: The tokenizer's own split pattern (fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: In any other text, tokens never span a blank or a line end.
RUN = re.compile("[^ \n]+")


class Tokens:
    """Ids of whole texts, with the ids of words kept for the next text. One per Python worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        # For words in lower case already: many at once, parted by a token of their own.
        self.lower = Tokenizer.from_file(path)
        self.lower.encode_special_tokens = True
        self.lower.normalizer = None
        bytewise = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        split = pre_tokenizers.Split(Regex(SPLIT), "removed", invert=True)
        self.lower.pre_tokenizer = pre_tokenizers.Sequence([split, bytewise])
        # For runs of letters, which the pattern leaves whole: no pattern.
        self.letters = Tokenizer.from_file(path)
        self.letters.encode_special_tokens = True
        self.letters.normalizer = None
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), bytewise])
        (self.part,) = self.lower.encode(PART, add_special_tokens=False).ids
        size = self.tokenizer.get_vocab_size()
        # The last token of a run carries a suffix, so runs of letters need nothing between them.
        self.ends = np.zeros(size, bool)
        self.ends[[i for token, i in self.letters.get_vocab().items() if token.endswith(END_OF_WORD)]] = True
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.weights = np.random.default_rng(SEED).standard_normal((size, DIMENSIONS)).astype(np.float32)
        self.words: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {"": b""}

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [not any(c in t for c in RARE) if t.isascii() else OTHER_SCRIPT.search(t) is None for t in texts]
        split = [t.lower().split() if p else RUN.findall(t) for t, p in zip(texts, plain)]
        for known in (self.words, self.runs):
            if len(known) > CACHED:
                known.clear()
        if len(self.parts) > CACHED_PARTS:
            self.parts = {"": b""}
        self.add_words(set(chain.from_iterable(s for s, p in zip(split, plain) if p)).difference(self.words))
        new = list(set(chain.from_iterable(s for s, p in zip(split, plain) if not p)).difference(self.runs))
        found = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        self.runs.update(zip(new, (np.array(e.ids, self.kind).tobytes() for e in found)))
        return [b"".join(map((self.words if p else self.runs).__getitem__, s)) for s, p in zip(split, plain)]

    def add_words(self, words: set[str]) -> None:
        """The ids of new words: of their letters and of the marks behind, where a word is such, else of the whole."""
        cut = {w: len(w.rstrip(ENDS)) for w in words}
        cut = {w: n if w[:n].isalpha() else len(w) for w, n in cut.items()}
        new = ({w[:n] for w, n in cut.items()} | {w[n:] for w, n in cut.items()}).difference(self.parts)
        letters = [p for p in new if p.isalpha()]
        found = self.letters.encode_batch_fast(joined(letters, " "), add_special_tokens=False)
        ids = self.ids_of(found)
        self.add_parts(letters, ids, np.flatnonzero(self.ends[ids]) + 1, 0)
        others = list(new.difference(letters))
        found = self.lower.encode_batch_fast([f"{t} {PART}" for t in joined(others, f" {PART} ")], add_special_tokens=False)
        ids = self.ids_of(found)
        self.add_parts(others, ids, np.flatnonzero(ids == self.part), 1)
        parts = self.parts
        self.words.update((w, parts[w[:n]] + parts[w[n:]]) for w, n in cut.items())

    def ids_of(self, found: list) -> np.ndarray:
        return np.fromiter(chain.from_iterable([e.ids for e in found]), self.kind)

    def add_parts(self, new: list[str], ids: np.ndarray, ends: np.ndarray, between: int) -> None:
        """Keep the ids of each new part; they lie one after the other, `between` ids apart."""
        raw, width, begin = ids.tobytes(), self.kind.itemsize, 0
        for part, end in zip(new, ends.tolist(), strict=True):
            self.parts[part] = raw[width * begin : width * end]
            begin = end + between

    def points(self, ids: list[bytes]) -> np.ndarray:
        """Each document's point, in whole steps of a cube; about standard normal before it is spread evenly."""
        counts = np.fromiter(map(len, ids), np.int64, len(ids)) // self.kind.itemsize
        owned = np.repeat(np.arange(len(ids)) << 32, counts) | np.frombuffer(b"".join(ids), self.kind)
        owned.sort()  # each document's ids, then those that differ from the one before
        owned = owned[np.append(True, owned[1:] != owned[:-1])[: len(owned)]]
        begins = np.searchsorted(owned, np.arange(len(ids) + 1) << 32)
        sums, some = np.zeros((len(ids), DIMENSIONS)), begins[1:] > begins[:-1]
        if some.any():
            sums[some] = np.add.reduceat(self.weights[owned & 0xFFFFFFFF], begins[:-1][some])
        sums /= np.sqrt(np.maximum(1, np.diff(begins)))[:, None]
        return np.minimum((1 << BITS) - 1, (1 << BITS) / (1 + np.exp(-1.702 * sums))).astype(np.int64)


def joined(parts: list[str], between: str) -> list[str]:
    return [between.join(parts[at : at + WORDS]) for at in range(0, len(parts), WORDS)]


@lru_cache(maxsize=2)
def tokens_of(path: str) -> Tokens:
    return Tokens(path)


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position of each point on the Hilbert curve through the cube (axes to transposed index, then bits together)."""
    x = points.astype(np.int64).copy()
    count = x.shape[1]
    step = 1 << (bits - 1)
    while step > 1:
        low = step - 1
        for i in range(count):
            high = (x[:, i] & step) != 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(high, low, swap)
            x[:, i] ^= swap
        step >>= 1
    for i in range(1, count):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), np.int64)
    step = 1 << (bits - 1)
    while step > 1:
        flip ^= np.where((x[:, -1] & step) != 0, step - 1, 0)
        step >>= 1
    x ^= flip[:, None]
    key = np.zeros(len(x), np.int64)
    for bit in reversed(range(bits)):
        for i in range(count):
            key = key << 1 | (x[:, i] >> bit & 1)
    return key


def tokenized(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids without the end id, n_tokens with it, curve)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(path)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                ids = tokens.encode([t or "" for t in part.column(1).to_pylist()])
                counts = pa.array([len(i) // tokens.kind.itemsize + 1 for i in ids], pa.int64())
                curve = pa.array(hilbert_key(tokens.points(ids)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), counts, curve], names=names)

    names = ["doc_id", "ids", "n_tokens", "curve"]
    kept = docs.select("doc_id", F.col("text").cast("string"))
    kind = kept.schema[0].dataType.simpleString()
    return kept.mapInArrow(run, f"doc_id {kind}, ids binary, n_tokens bigint, curve bigint")


def starts(sizes: DataFrame) -> DataFrame:
    """(row, at): where each row's ids begin when rows lie end to end in curve order, ties by row number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        so_far = 0
        for batch in batches:
            ends = so_far + np.cumsum(batch.column(2).to_numpy())
            begins = ends - batch.column(2).to_numpy()
            so_far = int(ends[-1]) if len(ends) else so_far
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(begins)], names=["part", "row", "n_tokens", "begin"]
            )

    ranged = sizes.repartitionByRange("curve", "row").sortWithinPartitions("curve", "row")
    ranged = ranged.select(F.spark_partition_id().alias("part"), "row", "n_tokens")
    placed = stored(ranged.mapInArrow(run, "part int, row bigint, n_tokens bigint, begin bigint"))
    # One row per range partition.
    totals = placed.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return placed.join(F.broadcast(bases), "part").select("row", (F.col("base") + F.col("begin")).alias("at"))


def pack(docs: DataFrame, path: str, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]): the pieces of each document.

    Every row of `docs` is a document, also when its id is null or repeats. A null or empty
    text is the end id alone. Equal curve keys are laid in row order. Other columns are not read.
    """
    rows = stored(tokenized(docs, path).withColumn("row", F.monotonically_increasing_id()))
    placed = rows.join(starts(rows.select("curve", "row", "n_tokens")), "row")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
        + ", ids binary" * with_ids
    )
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = tokens_of(path).kind
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                found, owners, cut = [], [], []
                for i, (raw, place) in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist())):
                    ids = np.append(np.frombuffer(raw, width).astype("<u4"), np.uint32(END_ID)).astype("<u4")
                    start = 0
                    while start < len(ids):
                        sequence, offset = divmod(place + start, length)
                        piece = ids[start : start + length - offset].tobytes()
                        found.append((start, len(piece) // 4, zlib.crc32(piece), len(ids), sequence, offset))
                        owners.append(i)
                        cut.append(piece)
                        start += len(piece) // 4
                columns = [pa.array([f[k] for f in found], pa.int64()) for k in range(6)]
                owner = part.column(0).take(pa.array(owners, pa.int64()))
                pieces = [pa.array(cut, pa.binary())] * with_ids
                yield pa.RecordBatch.from_arrays([owner, *columns, *pieces], names=names)

    return placed.select("doc_id", "ids", "at").mapInArrow(run, schema)

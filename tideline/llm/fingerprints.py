"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A paragraph (line) is cut after words chosen by their own hash, about every fourth and every eighth
at the latest, so that an edit changes the digests near it only; one of up to eight words is cut
every four bytes. The n-th repeat of a piece counts as a piece of its own. A digest is 48 bits and
16 that check them; it is added to one cell in each of three rows, which hold the number and the sum (modulo 2^64) of
their digests. A row has a power of two cells, by the document's own number of pieces and with enough room
that two fingerprints of documents without a common piece can still be told apart.

Two stored fingerprints are compared without their texts: the smaller table is peeled, which gives back all its
digests, and filled again at the size of the larger; the tables are subtracted; cells with one digest are peeled
until nothing is left, which recovers the digests that differ. Where peeling stops early (about one pair in a thousand),
sketches of the two texts are built again larger until it does not.

Likeness is the number of shared pieces over that of all pieces, with counts from the tables
and differences from peeling. Two texts without words are alike (1), a text with and one without are not (0).
Sketches of a block of documents lie end to end in the same arrays and are filled, subtracted and peeled together.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructType

from tideline.llm.common import SPACE_CHARS, fresh, numbered

EVERY, LONGEST = 4, 8
LEAST, TURNS = 32, 300
#: Rows and characters of a block; a longer text is a block alone. Words are hashed SLICE bytes at a time.
ROWS, CHARS, SLICE = 256, 1 << 20, 1 << 22
BASE = np.uint64(0x2545F4914F6CDD1D)
POWERS: tuple[np.ndarray, ...] = (np.zeros(0, np.uint64), np.zeros(0, np.uint64))
BLANK = np.isin(np.arange(256), list(SPACE_CHARS.encode()))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function (the finalizer constants are fixed values)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pieces_from(last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces begin, and each word's place in its piece, from the marks of last words."""
    begins = np.concatenate([[0], np.flatnonzero(last[:-1]) + 1])
    return begins, np.arange(len(last)) - np.repeat(begins, np.concatenate([begins[1:], [len(last)]]) - begins)


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the hash base and of its inverse, at least `count` of them."""
    global POWERS
    if len(POWERS[0]) < count:
        size = 1 << int(np.ceil(np.log2(count + 1)))
        with np.errstate(over="ignore"):
            POWERS = tuple(
                np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, base, np.uint64)]), dtype=np.uint64)
                for base in (BASE, pow(int(BASE), -1, 1 << 64))
            )
    return POWERS


def spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and last-of-its-piece mark of each word, or of each four bytes of a short line. Blanks surround the text."""
    blank = BLANK[raw]
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    begins, ends = edges[::2], edges[1::2]
    if len(begins) == 0:
        return begins, ends, begins.astype(bool)
    line = np.searchsorted(np.flatnonzero(raw == 10), begins)
    head = np.concatenate([[0], np.flatnonzero(line[1:] != line[:-1]) + 1])
    words = np.concatenate([head[1:], [len(line)]]) - head
    short = words <= LONGEST
    tail = head + words - 1
    ends_line = np.zeros(len(line), bool)
    ends_line[tail] = True
    if not short.any():
        return begins, ends, ends_line
    first, last = begins[head[short]], ends[tail[short]]
    blocks = (last - first + 3) // 4
    at = np.repeat(first, blocks) + 4 * (np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks))
    stay = ~np.repeat(short, words)
    begins = np.concatenate([begins[stay], at])
    order = np.argsort(begins, kind="stable")
    ends = np.concatenate([ends[stay], np.minimum(at + 4, np.repeat(last, blocks))])
    marks = np.concatenate([ends_line[stay], np.ones(len(at), bool)])
    return begins[order], ends[order], marks[order]


def word_hashes(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial hash of each span's bytes, whatever stands before it."""
    out, i = np.empty(len(begins), np.uint64), 0
    while i < len(begins):
        j = max(i + 1, int(np.searchsorted(ends, begins[i] + SLICE, "right")))
        base, part = begins[i], raw[begins[i] : ends[j - 1]]
        up, down = powers(len(part))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], dtype=np.uint64)])
        out[i:j] = mixed((sums[ends[i:j] - base] - sums[begins[i:j] - base]) * down[begins[i:j] - base])
        i = j
    return out


class Digests(NamedTuple):
    """The distinct digests of some texts, those of text i from bounds[i] to bounds[i + 1]."""

    keys: np.ndarray
    bounds: np.ndarray

    def of(self, i: int) -> np.ndarray:
        return self.keys[self.bounds[i] : self.bounds[i + 1]]

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def digests_of(texts: list[str]) -> Digests:
    """The piece digests of whole texts (65,535 at most): 48 bits of hash and 16 that check them."""
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b"\n" + b"\n".join(encoded) + b"\n", np.uint8)
    starts = np.cumsum([1, *(len(e) + 1 for e in encoded[:-1])]) if encoded else np.zeros(0, np.int64)
    begins, ends, last = spans(raw)
    if len(begins) == 0:
        return Digests(np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64))
    hashes = word_hashes(raw, begins, ends)
    last = last | (hashes % np.uint64(EVERY) == 0)
    _, within = pieces_from(last)
    at, within = pieces_from(last | (within % LONGEST == LONGEST - 1))
    pieces = np.add.reduceat(mixed(hashes + within.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), at)
    owner = (np.searchsorted(starts, begins[at], "right") - 1).astype(np.uint64)
    # Number the repeats of a piece in its text: equal ones of one text come together.
    told = mixed(pieces + owner * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(told)
    told, pieces, owner = told[order], pieces[order], owner[order]
    firsts = np.flatnonzero(np.append(True, told[1:] != told[:-1]))
    repeat = np.arange(len(told)) - np.repeat(firsts, np.diff(np.append(firsts, len(told))))
    keys = np.unique(owner << np.uint64(48) | mixed(pieces + repeat.astype(np.uint64)) >> np.uint64(16))
    bounds = np.searchsorted(keys >> np.uint64(48), np.arange(len(texts) + 1, dtype=np.uint64))
    keys &= np.uint64((1 << 48) - 1)
    return Digests(keys << np.uint64(16) | check(keys), bounds)


def digests(text: str) -> np.ndarray:
    """The distinct piece digests of a whole text."""
    return digests_of([text]).keys


def check(keys: np.ndarray) -> np.ndarray:
    """16 bits that a digest carries beside its 48."""
    return mixed(keys + np.uint64(0xA5A5A5A5)) >> np.uint64(48)


# Sketches


class Sketches(NamedTuple):
    """Some sketches: a row of sketch i lies from starts[i] on in each of the three rows."""

    sizes: np.ndarray
    starts: np.ndarray
    counts: list[np.ndarray]
    sums: list[np.ndarray]

    def pieces(self) -> np.ndarray:
        """How many digests each sketch holds."""
        return np.add.reduceat(self.counts[0], self.starts) if len(self.starts) else self.starts


def size_for(n: np.ndarray) -> np.ndarray:
    """Cells a row for n digests: 2n digests have to peel, and hardly ever may two of them share all their cells."""
    room = np.maximum(1.25 * n, np.cbrt(700.0 * n * n))
    return 1 << np.ceil(np.log2(np.maximum(room, LEAST))).astype(np.int64)


def blank(sizes: np.ndarray) -> Sketches:
    total = int(sizes.sum())
    return Sketches(sizes, np.cumsum(sizes) - sizes, [np.zeros(total, np.int64) for _ in range(3)], [np.zeros(total, np.uint64) for _ in range(3)])


def cells(keys: np.ndarray, owners: np.ndarray, sketches: Sketches) -> list[np.ndarray]:
    """The cell of each key of a sketch in each row."""
    h, mask, start = mixed(keys), (sketches.sizes[owners] - 1).astype(np.uint64), sketches.starts[owners]
    return [start + (h >> np.uint64(21 * row) & mask).astype(np.int64) for row in range(3)]


def fill(sketches: Sketches, keys: np.ndarray, owners: np.ndarray, signs: np.ndarray | None = None) -> None:
    """Add digests to sketches; those with sign -1 are taken out."""
    ones = np.ones(len(keys), np.int64) if signs is None else signs
    values = keys * ones.view(np.uint64)
    for row, at in enumerate(cells(keys, owners, sketches)):
        np.add.at(sketches.counts[row], at, ones)
        np.add.at(sketches.sums[row], at, values)


def sketches_of(found: Digests, sizes: np.ndarray | None = None) -> Sketches:
    out = blank(size_for(np.diff(found.bounds)) if sizes is None else sizes)
    fill(out, found.keys, found.owners())
    return out


class Peeled(NamedTuple):
    """Digests with the sketch they were in and their sign, and which sketches are peeled to the end."""

    keys: np.ndarray
    owners: np.ndarray
    signs: np.ndarray
    done: np.ndarray


def peel(sketches: Sketches) -> Peeled:
    """Take out the digests that are alone in a cell until none is left. The sketches are used up.

    A digest by chance (one cell in 65,536) could be taken out and put back for ever, so the turns are bounded.
    """
    owner_of = np.repeat(np.arange(len(sketches.sizes)), sketches.sizes)
    found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    idle = 0
    for turn in range(TURNS):
        row = turn % 3
        counts = sketches.counts[row]
        alone = np.flatnonzero((counts == 1) | (counts == -1))
        signs, owners = counts[alone], owner_of[alone]
        keys = sketches.sums[row][alone] * signs.view(np.uint64)
        # A row holds a digest in one cell only, so those alone in it are distinct.
        true = (check(keys >> np.uint64(16)) == keys & np.uint64(0xFFFF)) & (cells(keys, owners, sketches)[row] == alone)
        keys, owners, signs = keys[true], owners[true], signs[true]
        idle = 0 if len(keys) else idle + 1
        if idle == 3:
            break
        if len(keys):
            found.append((keys, owners, signs))
            fill(sketches, keys, owners, -signs)
    done = np.ones(len(sketches.sizes), bool)
    for row in range(3):
        done[owner_of[(sketches.counts[row] != 0) | (sketches.sums[row] != 0)]] = False
    keys, owners, signs = (np.concatenate(column) for column in zip(*found))
    return Peeled(keys, owners, signs, done)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size says."""
    ends = np.cumsum(sizes)
    return np.arange(int(sizes.sum())) + np.repeat(starts - (ends - sizes), sizes)


def resized(sketches: Sketches, which: np.ndarray, sizes: np.ndarray) -> tuple[Sketches, np.ndarray]:
    """Copies of some sketches at sizes not below their own, and which of them could be had: smaller ones are peeled."""
    out, had = blank(sizes), np.ones(len(which), bool)
    same = sketches.sizes[which] == sizes
    to, source = (ranges(s.starts[i], sizes[same]) for s, i in ((out, np.flatnonzero(same)), (sketches, which[same])))
    for row in range(3):
        out.counts[row][to] = sketches.counts[row][source]
        out.sums[row][to] = sketches.sums[row][source]
    if not same.all():
        small = blank(sketches.sizes[which[~same]])
        source = ranges(sketches.starts[which[~same]], small.sizes)
        for row in range(3):
            small.counts[row][:] = sketches.counts[row][source]
            small.sums[row][:] = sketches.sums[row][source]
        got = peel(small)
        fill(out, got.keys, np.flatnonzero(~same)[got.owners], got.signs)
        had[~same] = got.done
    return out, had


def differing(sketches: Sketches, left: np.ndarray, right: np.ndarray) -> Peeled:
    """For each pair of sketches the digests that only the left (1) or only the right (-1) holds."""
    sizes = np.maximum(sketches.sizes[left], sketches.sizes[right])
    (rest, had), (other, had_other) = resized(sketches, left, sizes), resized(sketches, right, sizes)
    for row in range(3):
        rest.counts[row] -= other.counts[row]
        rest.sums[row] -= other.sums[row]
    got = peel(rest)
    return got._replace(done=got.done & had & had_other)


def only_in(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The digests only the first and only the second holds, from sketches that grow until they peel."""
    found = Digests(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
    size = int(size_for(np.array(max(len(a), len(b)))))
    while True:
        size *= 2
        got = differing(sketches_of(found, np.full(2, size)), np.array([0]), np.array([1]))
        if got.done[0]:
            return got.keys[got.signs == 1], got.keys[got.signs == -1]


def likenesses(found: Digests, sketches: Sketches, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Shared over all pieces of each pair of sketches; the digests are used only where a pair does not peel."""
    got, n = differing(sketches, left, right), sketches.pieces()
    only_left = np.bincount(got.owners[got.signs == 1], minlength=len(left))
    only_right = np.bincount(got.owners[got.signs == -1], minlength=len(left))
    for i in np.flatnonzero(~got.done):
        only_left[i], only_right[i] = map(len, only_in(found.of(left[i]), found.of(right[i])))
    shared, union = n[left] - only_left, n[left] + only_right
    return np.where(union > 0, shared / np.maximum(union, 1), 1.0)


# Fingerprints as text


def written(sketches: Sketches) -> list[str]:
    """Each sketch in base64: binary logarithm of the size, width of a count, counts, sums of the cells that hold any."""
    out = []
    for start, size in zip(sketches.starts.tolist(), sketches.sizes.tolist()):
        counts = np.concatenate([c[start : start + size] for c in sketches.counts])
        sums = np.concatenate([s[start : start + size] for s in sketches.sums])
        width = 1 if counts.max() < 256 else 4
        head = bytes([size.bit_length() - 1, width])
        out.append(base64.b64encode(head + counts.astype(f"<u{width}").tobytes() + sums[counts > 0].astype("<u8").tobytes()).decode())
    return out


def read(fingerprints: list[str]) -> Sketches:
    """The sketches that were written."""
    raws = [base64.b64decode(f) for f in fingerprints]
    out = blank(np.array([1 << raw[0] for raw in raws], np.int64))
    for raw, start, size in zip(raws, out.starts.tolist(), out.sizes.tolist()):
        width = raw[1]
        counts = np.frombuffer(raw, f"<u{width}", 3 * size, 2).astype(np.int64)
        sums = np.zeros(3 * size, np.uint64)
        sums[counts > 0] = np.frombuffer(raw, "<u8", -1, 2 + 3 * size * width)
        for row in range(3):
            out.counts[row][start : start + size] = counts[row * size : (row + 1) * size]
            out.sums[row][start : start + size] = sums[row * size : (row + 1) * size]
    return out


def fingerprint(text: str) -> str:
    return written(sketches_of(digests_of([text])))[0]


def compared(old: str, new: str) -> tuple[np.ndarray, np.ndarray, float] | None:
    """Removed and added digests and the likeness of two stored fingerprints, or None if they do not peel."""
    sketches = read([old, new])
    got, (n, _) = differing(sketches, np.array([0]), np.array([1])), sketches.pieces()
    if not got.done[0]:
        return None
    removed, added = got.keys[got.signs == 1], got.keys[got.signs == -1]
    union = n + len(added)
    return removed, added, float((n - len(removed)) / union) if union else 1.0


def with_differences(versions: DataFrame, old: str, new: str, compare: Callable) -> DataFrame:
    """Every row with its columns and removed, added (arrays of digests in hex) and likeness of two of them."""
    names = fresh(versions, "removed", "added", "likeness")
    at_old, at_new = versions.columns.index(old), versions.columns.index(new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b in zip(batch.column(at_old), batch.column(at_new)):
                found = compare(a.as_py(), b.as_py())
                out.append(found and (*([f"{d:016x}" for d in only] for only in found[:2]), found[2]) or (None, None, None))
            texts = pa.list_(pa.string())
            columns = [pa.array([o[i] for o in out], kind) for i, kind in enumerate((texts, texts, pa.float64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *names])

    digest_list = ArrayType(StringType())
    schema = StructType([*versions.schema.fields]).add(names[0], digest_list).add(names[1], digest_list).add(names[2], DoubleType())
    return versions.mapInArrow(run, schema)


def differences(versions: DataFrame, old: str, new: str) -> DataFrame:
    """Every row with removed, added and likeness of the two texts named; a null text is an empty one."""

    def compare(a: str | None, b: str | None) -> tuple:
        found = digests_of([a or "", b or ""])
        removed, added = only_in(found.of(0), found.of(1))
        union = len(found.of(0)) + len(added)
        return removed, added, (len(found.of(0)) - len(removed)) / union if union else 1.0

    return with_differences(versions, old, new, compare)


def stored_differences(versions: DataFrame, old: str, new: str) -> DataFrame:
    """Every row with removed, added and likeness of the two fingerprints named; nulls where one is null or they do not peel."""
    return with_differences(versions, old, new, lambda a, b: None if a is None or b is None else compared(a, b))


# The next document


def with_next(docs: DataFrame, run: Callable, schema: str) -> DataFrame:
    """Apply `run` to the (doc_id, text, next text) of each task, streamed in descending doc_id; after the last comes the first.

    Ids are integers. Rows of one id are ordered by text, rows without an id come last. Texts move once, to ranges of
    about as many ids each; each range also gets the first text of the range after it. The driver
    holds the first ids of the ranges, four for each shuffle partition.
    """
    spark = docs.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = kept.schema["doc_id"].dataType.simpleString()
    placed = numbered(docs.select("doc_id"), [], [F.col("doc_id").desc_nulls_last()], "place")
    last = placed.agg(F.max("place")).first()[0]
    if last is None:
        return spark.createDataFrame([], schema)
    step = -(-(last + 1) // parts)
    every = placed.where(F.col("place") % step == 0).select("doc_id").distinct().collect()
    heads = sorted((r["doc_id"] for r in every if r["doc_id"] is not None), reverse=True)
    nulls = docs.where("doc_id IS NULL").limit(1).count()
    firsts: list[int | None] = [*heads, *[None] * nulls]
    bounds = np.array(heads[::-1], np.int64)

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        """Ranges in order of descending id, rows without an id in the last one."""
        known = ids.notna().to_numpy()
        above = len(bounds) - 1 - np.searchsorted(bounds, ids.where(known, 0).to_numpy(np.int64))
        return pd.Series(np.where(known, above, len(bounds)).astype(np.int32))

    sent = [((i - 1) % len(firsts), first) for i, first in enumerate(firsts)]
    sent = spark.createDataFrame(sent, f"to int, head {kind}")
    own = kept.select(range_of("doc_id").alias("part"), F.lit(0).alias("guest"), "doc_id", "text")
    guests = kept.join(F.broadcast(sent), F.col("doc_id").eqNullSafe(F.col("head")))
    guests = guests.groupBy(F.col("to").alias("part")).agg(F.min("text").alias("text"))
    rows = own.unionByName(guests.select("part", F.lit(1).alias("guest"), F.lit(None).cast(kind).alias("doc_id"), "text"))
    rows = rows.repartitionById(len(firsts), F.col("part")).sortWithinPartitions("part", "guest", F.col("doc_id").desc_nulls_last(), "text")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(doc_id as an array of one, text, next text) of own rows; a guest only follows the last own row of its range."""
        waiting = None
        for batch in batches:
            for i, (part, guest, text) in enumerate(zip(*(batch.column(k).to_pylist() for k in (0, 1, 3)))):
                if waiting is not None and waiting[0] == part:
                    yield (*waiting[1:], text)
                waiting = None if guest else (part, batch.column(2).slice(i, 1), text)

    names = [f.split()[0] for f in schema.split(", ")]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for owners, columns in run(blocks(pairs(batches))):
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(owners), *map(pa.array, columns)], names=names)

    return rows.mapInArrow(stream, schema)


def blocks(pairs: Iterator[tuple]) -> Iterator[list[tuple]]:
    block, chars = [], 0
    for pair in pairs:
        block.append(pair)
        chars += len(pair[1])
        if len(block) == ROWS or chars >= CHARS:
            yield block
            block, chars = [], 0
    if block:
        yield block


def compare_with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The edited text has its last third replaced by the beginning of the next document. Null and
    empty texts are empty; the only row of a table is its own next one. Other columns are not read.
    """

    def run(blocks: Iterator[list[tuple]]) -> Iterator[tuple]:
        for block in blocks:
            owners, texts, after = zip(*block)
            edited = [t[: len(t) - len(t) // 3] + n[: len(t) // 3] for t, n in zip(texts, after)]
            numbers = {t: i for i, t in enumerate(dict.fromkeys([*texts, *after, *edited]))}
            own, following, changed = (np.array([numbers[t] for t in of]) for of in (texts, after, edited))
            found = digests_of(list(numbers))
            sketches = sketches_of(found)
            prints = written(sketches)
            near = likenesses(found, sketches, np.concatenate([own, own]), np.concatenate([changed, following]))
            yield owners, (
                [len(t) for t in texts],
                [hashlib.sha256(e.encode()).hexdigest() for e in edited],
                [prints[i] for i in own],
                [prints[i] for i in changed],
                near[: len(own)],
                near[len(own) :],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return with_next(
        docs,
        run,
        f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )

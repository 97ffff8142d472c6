"""MinHash near-dedup: one-permutation hashing with optimal densification, banded buckets, star-shaped edges.

A document's set holds its distinct word shingles. Documents with the same set are one class, and
only the smallest doc_id of a class goes on. Its signature comes from one hash of the set: each of
`BINS` bins keeps its least hash, an empty bin takes that of the first filled bin in a probing order
of its own. Four bins make a band; classes that share a band meet in a bucket, where each is paired
with the bucket's smallest id only, so a bucket of n classes gives n - 1 pairs. Pairs are confirmed on
the full sets and components are found over the confirmed links.

A star can miss a link between two classes of which one is unlike the centre. So buckets that still
hold several components are looked at again: there, classes of different components are compared by
signature, block against block, and those that may be alike are confirmed on the full sets, until no link joins
two components. A pair at the least similarity shares no band with probability 5e-6; the signature
comparison leaves six standard deviations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tideline.llm.common import fresh, stored
from tideline.llm.fingerprints import mixed

WORDS, PERCENT = 5, 75
BINS, ROWS = 128, 4
BANDS = BINS // ROWS
#: Bins that agree for a pair of the least similarity, less six standard deviations.
LEAST_AGREEING = int(BINS * 0.75 - 6 * np.sqrt(BINS * 0.75 * 0.25))
BLOCK = 256


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text (A-Z in lower case, ASCII blanks)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(WORDS, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : len(words) - width + 1 + k])
    return np.unique(out)


def set_digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.astype("<u8").tobytes(), digest_size=16).digest()


@lru_cache(maxsize=1)
def probes() -> np.ndarray:
    """For each bin the order in which it asks others: independent random bins."""
    return np.random.default_rng(11).integers(0, BINS, (BINS, 4096), np.int16)


def signature(hashes: np.ndarray) -> np.ndarray:
    """BINS values of 16 bits of a non-empty sorted set."""
    bins = (hashes >> np.uint64(57)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
    out = np.zeros(BINS, np.uint16)
    filled = np.zeros(BINS, bool)
    filled[bins[first]] = True
    out[bins[first]] = (mixed(hashes[first]) >> np.uint64(48)).astype(np.uint16)
    empty = np.flatnonzero(~filled)
    begin, end = 0, 16
    while len(empty) and begin < probes().shape[1]:
        hits = filled[probes()[empty, begin:end]]
        found = hits.any(1)
        source = probes()[empty[found], begin + hits[found].argmax(1)]
        out[empty[found]] = out[source]
        empty = empty[~found]
        begin, end = end, end * 8
    if len(empty):
        out[empty] = out[bins[first[0]]]
    return out


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, hi, lo, signature): the size, digest and signature of each text's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                sets = [shingles(t.as_py()) for t in part.column(1)]
                digests = np.frombuffer(b"".join(map(set_digest, sets)), "<i8").reshape(-1, 2)
                signatures = [signature(s).astype("<u2").tobytes() if len(s) else None for s in sets]
                columns = [pa.array([len(s) for s in sets], pa.int64()), pa.array(digests[:, 0].copy()), pa.array(digests[:, 1].copy())]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns, pa.array(signatures, pa.binary())], names=names)

    names = ["doc_id", "n_shingles", "hi", "lo", "signature"]
    kept = docs.select("doc_id", F.col("text").cast("string"))
    kind = kept.schema[0].dataType.simpleString()
    return kept.mapInArrow(run, f"doc_id {kind}, n_shingles bigint, hi bigint, lo bigint, signature binary")


def bands(classes: DataFrame) -> DataFrame:
    """(bucket, node): a row for each band of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                signatures = np.frombuffer(b"".join(part.column(1).to_pylist()), "<u2").reshape(-1, BINS)
                buckets = buckets_of(signatures).ravel()
                owners = pa.array(np.repeat(np.arange(part.num_rows), BANDS))
                yield pa.RecordBatch.from_arrays([pa.array(buckets), part.column(0).take(owners)], names=["bucket", "node"])

    kept = classes.select("node", "signature")
    return kept.mapInArrow(run, f"bucket bigint, node {kept.schema[0].dataType.simpleString()}")


def star_pairs(members: DataFrame) -> DataFrame:
    """(a, b): each member of a bucket with the smallest one, once. Buckets are counted in the map tasks first."""
    centres = members.groupBy("bucket").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1")
    pairs = members.join(centres.select("bucket", "a"), "bucket").where("node > a")
    return pairs.select("a", F.col("node").alias("b")).distinct()


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """100 * intersection >= PERCENT * union, of two sorted sets."""
    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= PERCENT * (len(a) + len(b) - shared)


def texts_of(nodes: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, text): the text of each class in `nodes` (rows that repeat its doc_id come along)."""
    wanted = classes.select("node").join(nodes, "node", "left_semi")
    return docs.select(F.col("doc_id").alias("node"), F.col("text").cast("string").alias("text")).join(wanted, "node").distinct()


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose full sets are alike. Only the texts of nodes in pairs move."""
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    texts = texts_of(nodes, classes, docs)
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, centre = None, np.zeros(0, np.uint64)
        for batch in batches:
            keep = []
            for text_a, text_b in zip(batch.column(2), batch.column(3)):
                text_a = text_a.as_py() or ""
                if text_a != last:
                    last, centre = text_a, shingles(text_a)
                keep.append(alike(centre, shingles(text_b.as_py())))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    kind = pairs.schema["a"].dataType.simpleString()
    return rows.mapInArrow(run, f"a {kind}, b {kind}").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node with a link. Alternating large and small stars."""
    edges = stored(links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u < v").distinct())
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).withColumn("m", F.least("v", "m"))
        # Large star: larger neighbours go to the least of the neighbourhood.
        large = both.join(least, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        # Small star: smaller neighbours and the node itself go to the least of them.
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v")
        small = small.select(F.col("u").alias("v"), F.col("m").alias("u")).unionByName(least.select("v", F.col("m").alias("u")))
        edges = stored(small.where("u < v").distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("root"))
        seen = state


def buckets_of(signatures: np.ndarray) -> np.ndarray:
    """The bucket of each band of each signature."""
    salt = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))
    return mixed(np.ascontiguousarray(signatures).view("<u8") ^ salt).view(np.int64)


def possible(unit: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs in a unit that may be alike and join two components.

    A unit of one block pairs its rows, a unit of two pairs rows of one with rows of the other. A
    pair that shares an earlier band is left to that bucket.
    """
    second = unit["own"] != unit["p"][0]
    one_block = unit["p"][0] == unit["q"][0]
    first = np.flatnonzero(~second)
    other = first if one_block else np.flatnonzero(second)
    if len(first) == 0 or len(other) == 0:
        return first[:0], first[:0]
    sizes, roots = unit["n_shingles"], unit["root"]
    small, large = np.minimum.outer(sizes[first], sizes[other]), np.maximum.outer(sizes[first], sizes[other])
    may = np.not_equal.outer(roots[first], roots[other]) & (100 * small >= PERCENT * large)
    if one_block:
        may &= np.triu(np.ones(may.shape, bool), 1)
    i, j = np.nonzero(may)
    band = int((buckets_of(unit["signature"][:1])[0] == unit["bucket"][0]).argmax())
    out: list[tuple[np.ndarray, np.ndarray]] = [(first[:0], first[:0])]
    for at in range(0, len(i), 1 << 14):
        x, y = first[i[at : at + (1 << 14)]], other[j[at : at + (1 << 14)]]
        same = unit["signature"][x] == unit["signature"][y]
        earlier = same[:, : band * ROWS].reshape(len(x), band, ROWS).all(2).any(1)
        hit = (same.sum(1) >= LEAST_AGREEING) & ~earlier
        out.append((x[hit], y[hit]))
    return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


def by_unit(rows: DataFrame, found: Callable[[dict], dict], schema: str) -> DataFrame:
    """Apply `found` to the columns of each (bucket, p, q), streamed in order: a task holds one unit at a time."""
    rows = rows.repartition("bucket", "p", "q").sortWithinPartitions("bucket", "p", "q")

    def columns(parts: list[pa.RecordBatch]) -> dict[str, np.ndarray]:
        whole = pa.Table.from_batches(parts)
        out = {name: whole.column(name).to_numpy() for name in whole.column_names if name != "signature"}
        out["signature"] = np.frombuffer(b"".join(whole.column("signature").to_pylist()), "<u2").reshape(-1, BINS)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, parts = None, []
        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy() for k in ("bucket", "p", "q")])
            starts = np.flatnonzero((np.diff(keys) != 0).any(0)) + 1
            for begin, end in zip([0, *starts], [*starts, batch.num_rows]):
                if begin == end:
                    continue
                if unit != (key := tuple(keys[:, begin])):
                    if sum(p.num_rows for p in parts) > 1:
                        yield pa.RecordBatch.from_pydict(found(columns(parts)))
                    unit, parts = key, []
                parts.append(batch.slice(int(begin), int(end - begin)))
        if sum(p.num_rows for p in parts) > 1:
            yield pa.RecordBatch.from_pydict(found(columns(parts)))

    return rows.mapInArrow(run, schema)


def left_over_links(members: DataFrame, classes: DataFrame, roots: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b): links between different components within a bucket, as many as it takes to join them.

    A bucket's members are dealt by hash to blocks of about `BLOCK`; a unit holds two of them. First signatures
    say which members may have a link, then the texts of those come to their units, where sets are
    compared until the components that are alike are joined.
    """
    placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("k"))
    several = several.where("low < high").select("bucket", F.ceil(F.col("k") / BLOCK).cast("int").alias("blocks"))
    rows = placed.join(several, "bucket").join(classes.select("node", "n_shingles", "signature"), "node")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    names = ["bucket", "p", "q", "own", "node", "root", "n_shingles", "signature"]
    units = rows.withColumns({"p": F.least("own", "other"), "q": F.greatest("own", "other")}).select(*names)
    kind = units.schema["node"].dataType.simpleString()

    def worth(unit: dict) -> dict:
        x, y = possible(unit)
        at = np.unique(np.concatenate([x, y]))
        out = {name: pa.array(unit[name][at]) for name in names[:-1]}
        return out | {"signature": pa.array([s.tobytes() for s in unit["signature"][at]], pa.binary())}

    def joined(unit: dict) -> dict:
        leader = {r: r for r in unit["root"].tolist()}

        def lead(r):
            while leader[r] != r:
                r = leader[r]
            return r

        sets = [shingles(t) for t in unit["text"]]
        links = []
        for x, y in zip(*possible(unit)):
            a, b = lead(unit["root"][x].item()), lead(unit["root"][y].item())
            if a != b and alike(sets[x], sets[y]):
                leader[max(a, b)] = min(a, b)
                links.append(sorted((unit["node"][x].item(), unit["node"][y].item())))
        return {"a": pa.array([k[0] for k in links], id_type), "b": pa.array([k[1] for k in links], id_type)}

    id_type = to_arrow_type(units.schema["node"].dataType)
    schema = f"bucket bigint, p int, q int, own int, node {kind}, root {kind}, n_shingles bigint, signature binary"
    few = stored(by_unit(units, worth, schema))
    texts = texts_of(few.select("node").distinct(), classes, docs)
    return by_unit(few.join(texts, "node").select(*names, "text"), joined, f"a {kind}, b {kind}").distinct()


def near_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Documents without words have no links and are their own component. Rows of one id count as one
    document for the ids, each with its own text. A row without an id is linked with nothing, has no component_id
    and is kept. Ids are integers.
    """
    rows = stored(described(docs.select("doc_id", "text")))
    linkable = rows.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = linkable.groupBy("hi", "lo").agg(
        F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")
    )
    classes = stored(classes)
    members = stored(bands(classes))
    links = stored(confirmed(star_pairs(members), classes, docs))
    more = stored(left_over_links(members, classes, components(links), docs))
    roots = components(links.unionByName(more))
    named = classes.join(roots, "node", "left").select("hi", "lo", F.coalesce("root", "node").alias("root"))
    joined = rows.select("doc_id", "n_shingles", "hi", "lo").join(named, ["hi", "lo"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, with their columns, whose document is kept: the smallest doc_id of each component.

    Rows without an id are kept. Rows that repeat an id go or stay together.
    """
    (gone,) = fresh(docs, "gone_id")
    dropped = near_components(docs).where(~F.col("kept")).select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(dropped, F.col("doc_id") == F.col(gone), "left_anti")

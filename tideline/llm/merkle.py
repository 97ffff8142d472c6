"""Merkle dataset manifest with octopus multiproofs.

A leaf is the sha256 of a row's fields. The leaves of a source ascend by doc_id; every `FAN` consecutive nodes of a
level become their digest (the last run may be shorter, of one even), up to the source's subroot. The subroots by
source, null first, are the leaves of the top tree (`TOP`), whose last node is the root. Digests are lowercase hex and
are hashed as such text.

Built in blocks of FAN**LEVELS consecutive nodes: a task turns a block into its subtree, and the tops of the blocks
are the nodes of the next round, so a tree of any size takes a few shuffles of digests and no task holds more than
a block.

Proofs are octopus multiproofs: the leaves to be proved are dealt to the same blocks, each block (a leaf
partition) works out the coordinates (tree, level, place) that none of its own leaves can derive, once for
all its leaves; one join with the stored nodes fetches them; the block derives the interior nodes its leaves share, once
each, and expands every leaf's own proof from them. For a whole block those are two nodes a level above it.

Defined cases: a null field counts as `-`, an empty one as `0:`. Rows of the same source and id keep a leaf each, in
order of their leaves; rows that are equal in all fields have equal leaves and may swap places. A null id is less than all
others. A tree of one leaf has that leaf as its subroot. An empty table has no root and no rows. Extra columns are no
part of a leaf. Texts are hashed whole, inside Spark; only digests reach Python.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import fresh, numbered, stored

FAN, LEVELS, TOP = 3, 7, -1
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = "tree bigint, level int, place bigint, digest string, top boolean"


def leaf(fields: tuple[str, ...] = FIELDS, **instead: Column) -> Column:
    """The digest of a row's fields; `instead` gives other values for some."""

    def told(name: str) -> Column:
        value = instead.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(told, fields)).cast("binary"), 256)


def hashed(*digests: str) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def width_at(size: int, level: int) -> int:
    """Nodes of a tree of `size` leaves at a level."""
    return -(-size // FAN**level)


@dataclass
class Manifest:
    """leaves: (tree, place, size of the tree, leaf, carried columns); nodes: (tree, level, place, digest, top),
    of level 1 and above, and all levels of the top tree; trees: (source, size, tree); root is None without rows."""

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame
    root: str | None


def subtrees(level: int, levels: int):
    """For applyInPandas: the nodes above a block of nodes of `level`, `levels` levels at most."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("place")
        size, tree, start = int(block["size"].iloc[0]), int(block["tree"].iloc[0]), int(block["place"].iloc[0])
        digests, out = block["digest"].tolist(), []
        for up in range(level + 1, level + levels + 1):
            if width_at(size, up - 1) == 1:
                break
            digests = [hashed(*digests[i : i + FAN]) for i in range(0, len(digests), FAN)]
            start //= FAN
            top = width_at(size, up) == 1
            out += [(tree, up, start + i, d, top) for i, d in enumerate(digests)]
        return pd.DataFrame(out, columns=["tree", "level", "place", "digest", "top"])

    return run


def climbed(bottom: DataFrame, largest: int) -> DataFrame:
    """All nodes above (tree, place, size, digest), the largest tree having `largest` of them."""
    rounds, level, at = [], 0, bottom
    while level == 0 or width_at(largest, level) > 1:
        block = F.floor(F.col("place") / FAN**LEVELS).alias("block")
        made = at.groupBy("tree", block).applyInPandas(subtrees(level, LEVELS), NODE)
        rounds.append(stored(made))
        level += LEVELS
        sizes = bottom.where("place = 0").select("tree", "size")
        at = rounds[-1].where((F.col("level") == level) & ~F.col("top")).join(sizes, "tree")
        at = at.select("tree", "place", "size", "digest")
    return reduce(DataFrame.union, rounds)


def build(docs: DataFrame, fields: tuple[str, ...] = FIELDS, **carried: Column) -> Manifest:
    """The manifest of rows with the fields, doc_id and source; `carried` columns go along with the leaves."""
    columns = {"_doc": F.col("doc_id"), "_source": F.col("source"), "leaf": leaf(fields)} | carried
    rows = docs.select(*[c.alias(n) for n, c in columns.items()]).withColumnsRenamed({"_doc": "doc_id", "_source": "source"})
    placed = numbered(rows, ["source"], ["doc_id", "leaf"], "place")
    trees = numbered(placed.groupBy("source").agg(F.count("*").alias("size")), [], ["source"], "tree")
    trees = stored(trees)
    same = F.col("of_source").eqNullSafe(F.col("source"))
    of_tree = trees.select(F.col("source").alias("of_source"), "tree", "size")
    leaves = stored(placed.join(of_tree, same).drop("of_source"))

    largest, n_trees = trees.agg(F.max("size"), F.count("*")).first()
    nodes = climbed(leaves.select("tree", "place", "size", F.col("leaf").alias("digest")), largest or 1)
    tops = nodes.where("top").select(F.col("tree").alias("place"), "digest")
    lone = leaves.where("size = 1").select(F.col("tree").alias("place"), F.col("leaf").alias("digest"))
    subroots = stored(tops.union(lone).select(F.lit(TOP).cast("bigint").alias("tree"), "place", F.lit(n_trees).cast("bigint").alias("size"), "digest"))
    above = climbed(subroots, n_trees)
    level_0 = subroots.select("tree", F.lit(0).alias("level"), "place", "digest", (F.col("size") == 1).alias("top"))
    nodes = nodes.union(level_0).union(above)
    root = nodes.where(f"tree = {TOP} AND top").first()
    return Manifest(leaves, nodes, trees, root["digest"] if root else None)


def steps(places: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(level, known places, missing ones) up a tree: what the given leaves derive and what they lack for it."""
    known, level = np.unique(places), 0
    while width_at(size, level) > 1:
        runs = np.unique(known // FAN)
        members = (runs[:, None] * FAN + np.arange(FAN)).ravel()
        yield level, known, np.setdiff1d(members[members < width_at(size, level)], known)
        known, level = runs, level + 1


def missing_nodes(places: np.ndarray, tree: int, size: int, n_trees: int) -> list[tuple[int, int, int]]:
    """The coordinates (tree, level, place) that a set of leaves of one tree lacks up to the root, each once."""
    lacks = [(tree, level, int(p)) for level, _, lost in steps(places, size) for p in lost]
    return lacks + [(TOP, level, int(p)) for level, _, lost in steps(np.array([tree]), n_trees) for p in lost]


class Climb:
    """A block's known nodes of one tree: derives the interior once, then expands proofs and folds claims."""

    def __init__(self, leaves: dict[int, str], fetched: dict[tuple[int, int], str], size: int):
        self.levels: list[dict[int, str]] = [dict(leaves)]
        self.width = [width_at(size, 0)]
        while self.width[-1] > 1:
            level = len(self.levels) - 1
            here = self.levels[-1]
            here.update({p: d for (at, p), d in fetched.items() if at == level})
            above = {p // FAN for p in here if (level, p) not in fetched}
            self.levels.append({run: hashed(*[here[p] for p in self.run(level, run)]) for run in above})
            self.width.append(width_at(size, level + 1))
        self.top = self.levels[-1][0]
        self.tails: list[dict[int, str]] = [{} for _ in self.levels]

    def run(self, level: int, run: int) -> range:
        return range(run * FAN, min(run * FAN + FAN, self.width[level]))

    def proof(self, place: int, level: int = 0) -> str:
        """The siblings from a node up to the top, as one text; those of shared parents are put together once."""
        if level == len(self.levels) - 1:
            return ""
        if place not in self.tails[level]:
            beside = "".join(self.levels[level][p] for p in self.run(level, place // FAN) if p != place)
            self.tails[level][place] = beside + self.proof(place // FAN, level + 1)
        return self.tails[level][place]

    def folded(self, place: int, digest: str) -> str:
        """The top recomputed from another digest of a leaf and the original siblings."""
        for level in range(len(self.levels) - 1):
            if digest == self.levels[level][place]:
                return self.top
            run = self.run(level, place // FAN)
            digest = hashed(*[digest if p == place else self.levels[level][p] for p in run])
            place //= FAN
        return digest


def prove(manifest: Manifest, wanted: DataFrame) -> DataFrame:
    """The proofs of `wanted`, rows of manifest.leaves or some of them, with the digest to be tried as `claimed`.

    Adds subroot, root, proof_sha256 (siblings up to the root, left to right), folded_root and verified.
    """
    n_trees = manifest.trees.count()
    root = manifest.root
    of_block = F.floor(F.col("place") / FAN**LEVELS).alias("block")

    def lacking(block: pd.DataFrame) -> pd.DataFrame:
        tree, size = int(block["tree"].iloc[0]), int(block["size"].iloc[0])
        at = block["place"].to_numpy()
        rows = [(tree, at[0] // FAN**LEVELS, *c) for c in missing_nodes(at, tree, size, n_trees)]
        return pd.DataFrame(rows, columns=["of_tree", "of_block", "tree", "level", "place"])

    kind = "of_tree bigint, of_block bigint, tree bigint, level int, place bigint"
    needs = stored(wanted.select("tree", "size", "place").groupBy("tree", of_block).applyInPandas(lacking, kind))
    lowest = needs.where(f"tree <> {TOP}").agg(F.min("level")).first()[0]
    nodes = manifest.nodes.where((F.col("tree") == TOP) | (F.col("level") >= (lowest or 0))).drop("top")
    if lowest == 0:  # some leaves of a run are not wanted
        nodes = nodes.union(manifest.leaves.select("tree", F.lit(0), "place", "leaf"))
    fetched = needs.join(nodes, ["tree", "level", "place"])

    added = fresh(wanted, "subroot", "proof_sha256", "folded_root")
    kept = [c for c in wanted.columns]

    def expanded(key: tuple, block: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        own, top = {}, {}
        for tree, level, place, digest in zip(found["tree"], found["level"], found["place"], found["digest"]):
            (top if tree == TOP else own)[level, place] = digest
        if block.empty:
            return pd.DataFrame(columns=kept + added)
        places, tree, size = block["place"].tolist(), int(block["tree"].iloc[0]), int(block["size"].iloc[0])
        inner = Climb(dict(zip(places, block["leaf"])), own, size)
        outer = Climb({tree: inner.top}, top, n_trees)
        beyond = outer.proof(tree)
        block = block.copy()
        block[added[0]] = inner.top
        block[added[1]] = [hashed(inner.proof(p), beyond) for p in places]
        subroots = [inner.folded(p, c) for p, c in zip(places, block["claimed"])]
        block[added[2]] = [outer.top if s == inner.top else outer.folded(tree, s) for s in subroots]
        return block

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.schema.fields)
    schema += "".join(f", `{c}` string" for c in added)
    sides = wanted.groupBy("tree", of_block), fetched.groupBy(F.col("of_tree"), F.col("of_block"))
    proved = sides[0].cogroup(sides[1]).applyInPandas(expanded, schema)
    return proved.withColumn("root", F.lit(root)).withColumn("verified", F.col(added[2]) == F.lit(root))


def without_line_ends(docs: DataFrame) -> Column:
    """The text as tampered with: rows with an even crc32 of their id lose their line ends."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))

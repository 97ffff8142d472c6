"""Resampling, the Merkle manifest and sharding against brute force, their laws and odd inputs."""

import hashlib
import math
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import helpers as H  # noqa: E402

from tideline.llm import common, merkle, resampling, sharding  # noqa: E402


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{H.SF}/documents.parquet")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.read.parquet(f"{H.SF}/benchmark.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    return H.odd_documents(spark).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return H.odd_documents(spark, [])


# numbering


def test_numbers_are_gapless_in_each_group_whatever_its_size(spark):
    rows = spark.range(5000).select(F.expr("CASE WHEN id % 3 = 0 THEN NULL WHEN id % 50 = 1 THEN 'b' ELSE 'a' END AS g"), F.expr("id % 7 AS k"))
    placed = common.numbered(rows, ["g"], [F.col("k").desc()], "place").collect()
    for group in (None, "a", "b"):
        found = sorted((r["place"], r["k"]) for r in placed if r["g"] == group)
        assert [p for p, _ in found] == list(range(len(found))) and [k for _, k in found] == sorted((k for _, k in found), reverse=True)
    assert sorted(r["at"] for r in common.numbered(rows, [], ["k"], "at").collect()) == list(range(5000))


# 11 resampling


def resampled(docs, target):
    """(n_features, weight, score, rank) by id from the definition; ids are unique."""
    kept = "0123456789abcdefghijklmnopqrstuvwxyz"

    def buckets(text):
        low = "".join(c if c in kept or ord(c) > 127 else " " for c in (text or "").translate(H.LOWER))
        return [zlib.crc32(w.encode()) % 10000 for w in low.split(" ") if w]

    def totals(texts):
        out = [0] * 10000
        for text in texts:
            for b in buckets(text):
                out[b] += 1
        return out, sum(out)

    (s, s_all), (t, t_all) = totals(x for _, x in docs), totals(target)
    gains = [math.floor(1000 * math.log((t[b] + 1.0) * (s_all + 10000) / ((s[b] + 1.0) * (t_all + 10000)))) for b in range(10000)]
    rows = {}
    for doc_id, text in docs:
        found = buckets(text)
        weight = sum(gains[b] for b in found) // len(found) if found else 0
        score = None
        if doc_id is not None:
            h = int(hashlib.sha256(f"2024:{doc_id}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows[doc_id] = [len(found), weight, score, None]
    order = sorted((-r[2], i) for i, r in rows.items() if i is not None and r[0] >= 20)
    for rank, (_, i) in enumerate(order[: len(order) * 10 // 100]):
        rows[i][3] = rank + 1
    return {i: tuple(r) for i, r in rows.items()}


def as_rows(frame):
    return {r["doc_id"]: (r["n_features"], r["weight"], r["score"], r["rank"]) for r in frame.collect()}


def test_resampling_equals_brute_force(documents, benchmark):
    docs, target = [(r["doc_id"], r["text"]) for r in documents.collect()], [r["text"] for r in benchmark.collect()]
    want = resampled(docs, target)
    assert as_rows(resampling.resample(documents, benchmark)) == want
    drawn = resampling.drawn_documents(documents, benchmark)
    assert drawn.columns == documents.columns
    assert {r["doc_id"] for r in drawn.collect()} == {i for i, r in want.items() if r[3]}


def test_sums_over_bit_planes_are_exact():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 5, (7, resampling.BUCKETS)) * rng.integers(0, 1 << 20, (7, 1))
    gains = rng.integers(-9000, 30000, resampling.BUCKETS)
    planes = resampling.planes_of(np.maximum(gains, 0)[None]), resampling.planes_of(np.maximum(-gains, 0)[None])
    assert (resampling.sliced_sums(counts, *planes) == counts @ gains).all()
    assert (resampling.sliced_sums(np.zeros((2, resampling.BUCKETS), np.int64), *planes) == 0).all()


def test_texts_of_any_length_are_taken_in_slices():
    text = ("Wörd one2 " * 300_000 + "x" * 3_000_000 + " end").encode()
    found = np.concatenate(list(resampling.buckets_of(text)))
    want = [zlib.crc32(w.encode()) % 10000 for w in ("wörd", "one2")] * 300_000
    want += [zlib.crc32(b"x" * 3_000_000) % 10000, zlib.crc32(b"end") % 10000]
    assert found.tolist() == want
    assert [len(x) for x in resampling.buckets_of(b" ., ")] == [0] and list(resampling.buckets_of(b"")) == []


def test_resampling_odd_rows(odd, empty, benchmark):
    rows = resampling.resample(odd, benchmark).collect()
    assert len(rows) == len(H.ODD)
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert all((r["n_features"], r["weight"]) == (0, 0) and r["score"] is not None and r["rank"] is None for i in (1, 2, 3) for r in by_id[i])
    assert {r["n_features"] for r in by_id[None]} == {0, 60} and all(r["score"] is None and r["rank"] is None for r in by_id[None])
    assert len(by_id[9]) == 2 and len({r["score"] for r in by_id[9]}) == 1
    everyone = resampling.resample(odd, benchmark, percent=100).collect()
    order = sorted((-r["score"], r["doc_id"]) for r in everyone if r["doc_id"] is not None and r["n_features"] >= 20)
    assert [r["doc_id"] for r in sorted((r for r in everyone if r["rank"]), key=lambda r: r["rank"])] == [i for _, i in order]
    assert resampling.resample(empty, benchmark).count() == 0
    assert resampling.resample(odd, benchmark.limit(0)).count() == len(H.ODD)


# 12 Merkle manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    told = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in told])


def levels_of(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def path_of(levels, place):
    """(before, after) siblings a level."""
    out = []
    for level in levels[:-1]:
        start = place // 3 * 3
        out.append((level[start:place], level[place + 1 : start + 3]))
        place //= 3
    return out


def manifest_of(rows):
    """The rows of the contract from the definition, sorted."""
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        own = sorted((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"]), i) for i, r in enumerate(rows) if r["source"] == source)
        trees[source] = [x[3] for x in own], levels_of([x[2] for x in own])
    top = levels_of([trees[s][1][-1][0] for s in sources])
    out = []
    for at, source in enumerate(sources):
        order, levels = trees[source]
        for place, i in enumerate(order):
            row, text = rows[i], rows[i]["text"]
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            path = path_of(levels, place) + path_of(top, at)
            folded = leaf_of(row, text)
            for before, after in path:
                folded = digest(*before, folded, *after)
            proof = digest(*[s for before, after in path for s in before + after])
            out.append((row["doc_id"], levels[0][place], levels[-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def proved(docs, wanted=lambda leaves: leaves):
    manifest = merkle.build(docs, claimed=merkle.leaf(text=merkle.without_line_ends(docs)))
    rows = merkle.prove(manifest, wanted(manifest.leaves)).collect()
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[n] for n in names) for r in rows), key=repr)


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_manifest_equals_brute_force_with_blocks_of_any_size(documents, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    assert proved(documents) == manifest_of(documents.collect())


def test_proofs_of_some_leaves(documents, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 2)
    want = [r for r in manifest_of(documents.collect()) if r[0] % 5 == 0]
    assert proved(documents, lambda leaves: leaves.where("doc_id % 5 = 0")) == want


def test_missing_nodes_are_minimal():
    """Nothing is fetched that the leaves derive, nothing twice; a whole tree lacks nothing of its own."""
    assert merkle.missing_nodes(np.arange(100), 0, 100, 1) == []
    assert merkle.missing_nodes(np.array([0]), 0, 10, 1) == [(0, 0, 1), (0, 0, 2), (0, 1, 1), (0, 1, 2), (0, 2, 1)]
    lacks = merkle.missing_nodes(np.arange(9, 18), 1, 81, 5)
    assert lacks == [(1, 2, 0), (1, 2, 2), (1, 3, 1), (1, 3, 2), (merkle.TOP, 0, 0), (merkle.TOP, 0, 2), (merkle.TOP, 1, 1)]


def test_manifest_odd_rows(spark, odd, empty):
    assert proved(odd) == manifest_of(odd.collect())
    nothing = merkle.build(empty, claimed=F.lit("x"))
    assert nothing.root is None and merkle.prove(nothing, nothing.leaves).count() == 0
    alone = odd.where("doc_id = 4")
    assert proved(alone) == manifest_of(alone.collect())
    many = [(i, "one\ntwo" if i % 2 else None, f"s{i % 40}" if i % 40 else None) for i in range(200)]
    docs = spark.createDataFrame(many, "doc_id bigint, text string, source string").selectExpr("*", "'en' AS lang", "CAST(NULL AS bigint) AS n_chars")
    assert proved(docs) == manifest_of(docs.collect())


# 13 sharding


def sizes_of(rows):
    out = {}
    for r in rows:
        out.setdefault(r["shard"], []).append(r)
    return out


def test_shards_have_near_equal_bytes_and_gapless_places(documents):
    rows, texts = sharding.assign(documents).collect(), {r["doc_id"]: (r["text"] or "").encode() for r in documents.collect()}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {i: (len(t) + 16, zlib.crc32(t)) for i, t in texts.items()}
    shards = sizes_of(rows)
    assert sorted(shards) == list(range(40)) and {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)}
    assert all(sorted(r["slot"] for r in of) == list(range(len(of))) for of in shards.values())
    assert len({(r["virtual_slot"], r["shard"]) for r in rows}) == len({r["virtual_slot"] for r in rows})


def test_balance_moves_slots_until_shards_are_even():
    rng = np.random.default_rng(2)
    sizes = (rng.pareto(1.5, sharding.SLOTS) * 1000).astype(np.int64) + 16
    sizes[5] = sizes.sum() // 90  # a slot nearly half a share
    first = sharding.first_map()
    second = sharding.balanced(first, sizes)
    totals = sharding.loads(second, sizes)
    assert second.version == 2 and totals.sum() == sizes.sum()
    assert totals.max() - totals.min() <= 0.001 * totals.mean()
    again = sharding.balanced(second, sizes)
    assert (again.owner != second.owner).mean() < 0.02
    assert (second.owner == first.owner).mean() > 0.5  # an edit; a new deal would leave one in 40


def test_a_record_larger_than_a_share_is_alone():
    sizes = np.full(100, 10)
    sizes[7] = 100_000
    totals = sharding.loads(sharding.balanced(sharding.first_map(100, 4), sizes), sizes)
    assert sorted(totals) == [330, 330, 330, 100_000]


def test_growth_takes_slots_only_into_the_new_shard():
    sizes = np.random.default_rng(3).integers(16, 5000, sharding.SLOTS)
    old = sharding.balanced(sharding.first_map(), sizes)
    new = sharding.grown(old, sizes)
    moved = new.owner != old.owner
    assert new.shards == 41 and set(new.owner[moved]) == {40}
    totals = sharding.loads(new, sizes)
    assert abs(totals[40] - sizes.sum() / 41) < 0.02 * totals.mean() and totals.max() < 1.05 * totals.mean()


def test_maps_are_kept_by_version(spark, tmp_path):
    first = sharding.first_map(64, 4)
    second = sharding.balanced(first, np.arange(64))
    for slot_map in (first, second):
        sharding.save(spark, slot_map, str(tmp_path / "map"))
    assert sharding.load(spark, str(tmp_path / "map")).owner.tolist() == second.owner.tolist()
    assert sharding.load(spark, str(tmp_path / "map"), 1).owner.tolist() == first.owner.tolist()
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sharding.save(spark, first, str(tmp_path / "map"))


def test_documents_are_written_by_shard(spark, documents, tmp_path):
    slot_map = sharding.balanced_map(documents, shards=4)
    sharding.write_shards(documents, slot_map, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["doc_id"] for r in back.collect()) == sorted(r["doc_id"] for r in documents.collect())
    ours = {r["doc_id"]: r["shard"] for r in sharding.assign(documents, shards=4).collect()}
    assert {r["doc_id"]: r["shard_no"] for r in back.collect()} == ours


def test_sharding_odd_rows(spark, odd, empty):
    rows = sharding.assign(odd).collect()
    assert len(rows) == len(H.ODD)
    assert all(r["size"] == 16 and r["text_crc32"] == 0 for r in rows if r["doc_id"] in (1, 2))
    assert len({r["shard"] for r in rows if r["doc_id"] == 9}) == 1
    assert all(sorted(r["slot"] for r in of) == list(range(len(of))) for of in sizes_of(rows).values())
    assert sharding.assign(empty).count() == 0

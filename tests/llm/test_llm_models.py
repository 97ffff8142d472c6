"""The robust estimate against random starts in numpy, and the votes against counts by hand."""

import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import helpers as H  # noqa: E402

from tideline.llm import neighbours, rules  # noqa: E402

STATS = "lang string, source string, base_failed boolean, salt int, x0 double, x1 double, x2 double, x3 double, x4 double"


# 2 quality rules


def settled(x, mean, cov):
    """The log determinant where steps from this estimate end, each half exact."""
    floor, half, subset = np.diag(np.square(rules.FLOORS)), (len(x) + len(rules.FLOORS) + 1) // 2, None
    while True:
        d = np.einsum("ij,ij->i", x - mean, np.linalg.solve(cov, (x - mean).T).T)
        nearest = np.sort(np.argsort(d, kind="stable")[:half])
        if np.array_equal(nearest, subset):
            return np.linalg.slogdet(cov)[1]
        subset = nearest
        mean, cov = x[subset].mean(0), np.cov(x[subset].T, bias=True) + floor


def from_the_starts(x):
    floor = np.square(rules.FLOORS)
    m = np.sort(x, axis=0)[(len(x) - 1) // 2]
    d = np.sqrt((rules.DEVIATION * np.sort(np.abs(x - m), axis=0)[(len(x) - 1) // 2]) ** 2 + floor)
    z = (x - m) / d
    ends = [settled(x, m, np.diag(d**2))]
    for moved in (rules.TANH_SCALE * np.tanh(z), np.sqrt(5) * z / np.linalg.norm(z, axis=1, keepdims=True).clip(1e-6)):
        y = m + d * moved
        ends.append(settled(x, y.mean(0), np.cov(y.T, bias=True) + np.diag(floor)))
    return min(ends)


def from_random_starts(x, rng, tries=60):
    floor, ends = np.diag(np.square(rules.FLOORS)), []
    for _ in range(tries):
        few = x[rng.choice(len(x), 6, replace=False)]
        ends.append(settled(x, few.mean(0), np.cov(few.T, bias=True) + floor))
    return min(ends)


def pool_rows():
    """A pool with a tight third of junk, one with correlated heavy tails, one mostly of zeros."""
    rng = np.random.default_rng(11)
    mix = rng.normal(size=(5, 5))
    tight = np.vstack([rng.normal(size=(260, 5)) @ mix, rng.normal(size=(130, 5)) * 0.05 + 6])
    heavy = rng.standard_t(2, size=(300, 5)) @ mix
    zeros = rng.normal(size=(300, 5)) * (rng.random((300, 5)) < 0.2)
    return {"tight": tight, "heavy": heavy, "zeros": zeros}


def stats_of(spark, pools):
    rows = [("en", name, False, i % rules.SALTS, *map(float, x)) for name, xs in pools.items() for i, x in enumerate(xs)]
    return spark.createDataFrame(rows, STATS)


def test_the_estimate_equals_the_least_from_the_starts(spark):
    """Halves are taken by distance bin there, exactly here.

    In the pool with a third of junk in one spot some half around that spot has a smaller determinant
    than any that the starts lead to; that the starts stay with the bulk is wanted. Elsewhere random starts find nothing less.
    """
    pools, rng = pool_rows(), np.random.default_rng(12)
    got = {r["g_source"]: r for r in rules.estimates(stats_of(spark, pools)).collect()}
    assert set(got) == set(pools)
    for name, x in pools.items():
        assert got[name]["log_det"] == pytest.approx(from_the_starts(x), abs=0.1)
        if name != "tight":
            assert got[name]["log_det"] <= from_random_starts(x, rng) + 0.1
    assert np.linalg.norm([got["tight"][f"m{i}"] for i in rules.DIMS]) < 2


def test_salted_parts_equal_broadcast_ones(spark, monkeypatch):
    stats = stats_of(spark, {"tight": pool_rows()["tight"]})

    def verdicts():
        rows = rules.judged(stats, rules.estimates(stats)).select("x0", "distance", "kept").collect()
        return sorted((r["x0"], round(r["distance"], 6), r["kept"]) for r in rows)

    want = verdicts()
    monkeypatch.setattr(rules, "SMALL", 0)
    assert verdicts() == want


def test_each_statistic_alone_can_reject(spark):
    rng = np.random.default_rng(13)
    vocabulary = [f"{a}{b}" for a in ("an", "the", "ore", "li", "s") for b in ("ta", "mo", "rine", "d", "lk", "eau")]

    def fair(n=80):
        return list(rng.choice(vocabulary, n))

    planted = {
        "long words": " ".join(a + b for a, b in zip(fair(), fair())),
        "symbols": " ".join(w + "#" * (i % 3) for i, w in enumerate(fair())),
        "repeated words": " ".join(fair(60) + "so it goes on and on again now".split() * 6),
        "repeated lines": "\n".join(line for a, b in zip(fair(50), fair(50)) for line in ("ore", f"{a} {b}")),
        "upper case": " ".join(fair()).upper(),
    }
    for n_words, _, _, _, n_repeat_words in map(H.statistics, planted.values()):
        assert n_words >= 50 and 100 * n_repeat_words <= 50 * n_words, "the base rules let it through"
    rows = [(i, " ".join(fair())) for i in range(120)] + [(1000 + k, t) for k, t in enumerate(planted.values())]
    docs = spark.createDataFrame(rows, H.SCHEMA).withColumns({"lang": F.lit("en"), "source": F.lit("s")})
    kept = {r["doc_id"] for r in rules.verdicts(docs).where("kept").collect()}
    assert kept == set(range(120))


# 4 quality classifier


@pytest.fixture(scope="module")
def model(spark):
    return neighbours.train(*(spark.read.parquet(f"{H.SF}/{t}.parquet") for t in ("documents", "labels")))


def voted(text, model):
    """All labelled texts in order of likeness, then id, by whole numbers."""
    rarity, projection, labelled, votes = model
    vector = [int(v) for v in neighbours.placed(neighbours.terms(text), rarity, projection)]
    likeness = [sum(a * int(b) for a, b in zip(vector, row)) for row in labelled]
    first = sorted(range(len(votes)), key=lambda i: (-likeness[i], i))[: neighbours.NEIGHBOURS]
    weights = [(max(likeness[i], 0) / neighbours.STEPS**2) ** 8 + 1e-9 for i in first]
    return sum(w * votes[i] for w, i in zip(weights, first)) / sum(weights)


def test_votes_equal_brute_force(spark, model):
    documents = spark.read.parquet(f"{H.SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    for r in neighbours.with_scores(documents.select("doc_id", "text"), model, "s").collect():
        assert r["s"] == pytest.approx(voted(texts[r["doc_id"]], model), abs=1e-9)


def test_equal_texts_score_alike_in_any_block(spark, model):
    texts = [H.PLAIN, "", "one", H.EDITED, "漢字 é́ 👍🏽", "so so so so |"]
    rows = [(i, texts[i % 7 % len(texts)] if i % 5 else H.LONG[: 400 + i]) for i in range(1500)]
    scored = neighbours.with_scores(spark.createDataFrame(rows, H.SCHEMA).repartition(7), model, "s")
    assert scored.groupBy("text").agg(F.countDistinct("s").alias("n")).where("n > 1").count() == 0


def test_labelled_texts_that_tie_are_taken_by_id():
    rarity, projection = np.ones(neighbours.TERMS), np.ones((neighbours.TERMS, 1))
    votes = np.array([1.0] * 10 + [0.0] * 10)
    assert neighbours.vote(["a b"], (rarity, projection, np.full((20, 1), 4096.0), votes)) == [1]
    assert neighbours.vote(["a b"], (rarity, projection, np.full((20, 1), 4096.0), votes[::-1])) == [0]


def test_equal_pairs_are_one_term():
    counts = neighbours.terms("so so so\tit it goes")
    assert counts[-1] == np.log1p(3)
    assert np.expm1(counts[neighbours.GRAMS : -1]).sum() == pytest.approx(2)
    assert neighbours.terms("")[neighbours.GRAMS :].sum() == 0

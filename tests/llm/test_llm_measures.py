"""Fingerprints compared as stored, and the toxicity model against counts by hand."""

import random
import sys
from collections import Counter
from math import log
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import helpers as H  # noqa: E402

from tideline.llm import bpe, chat, fingerprints, toxicity  # noqa: E402
from tideline.llm.queries import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{H.SF}/documents.parquet")


# 10 fingerprints


def test_likeness_comes_from_the_two_stored_fingerprints(spark, documents):
    rows = fingerprints.compare_with_next(documents).orderBy(F.col("doc_id").desc()).collect()
    own = [r["fingerprint"] for r in rows]
    found = 0
    for r, following in zip(rows, [*own[1:], own[0]]):
        for other, near in ((r["edited_fingerprint"], r["near_edited"]), (following, r["near_next"])):
            got = fingerprints.compared(r["fingerprint"], other)
            found += got is not None
            assert got is None or got[2] == near
    assert found >= 0.99 * 2 * len(rows)


def test_stored_fingerprints_give_back_the_differing_digests(spark):
    texts = ["", "one", H.PLAIN, H.EDITED, H.LONG, "same line\n" * 3000, H.PLAIN + "\n" + H.LONG]
    pairs = [(k, fingerprints.fingerprint(a), fingerprints.fingerprint(b), a, b) for k, (a, b) in enumerate((x, y) for x in texts for y in texts)]
    rows = spark.createDataFrame([p[:3] for p in pairs] + [(99, None, pairs[0][1])], "k int, old string, new string")
    got = {r["k"]: r for r in fingerprints.stored_differences(rows, "old", "new").collect()}
    assert got[99]["likeness"] is None
    assert sum(got[k]["likeness"] is None for k, *_ in pairs) <= 1
    for k, _, _, a, b in pairs:
        if got[k]["likeness"] is not None:
            old, new = ({f"{d:016x}" for d in fingerprints.digests(t).tolist()} for t in (a, b))
            assert (set(got[k]["removed"]), set(got[k]["added"])) == (old - new, new - old)
            assert got[k]["likeness"] == (len(old & new) / len(old | new) if old | new else 1.0)


def test_digests_do_not_depend_on_the_texts_beside_or_the_slice(monkeypatch):
    texts = [H.PLAIN, "", "a b\n\nc", H.LONG[:5000], "é" * 300, "\n"]
    together = fingerprints.digests_of(texts)
    monkeypatch.setattr(fingerprints, "SLICE", 64)
    for i, text in enumerate(texts):
        assert together.of(i).tolist() == fingerprints.digests(text).tolist()


def test_sketches_grow_until_they_peel(monkeypatch):
    a, b = (fingerprints.digests(" ".join(f"{x}{i}" for i in range(4000))) for x in "xy")
    monkeypatch.setattr(fingerprints, "size_for", lambda n: np.full(np.shape(n), 32))
    gone, come = fingerprints.only_in(a, np.append(b, a[:5]))
    assert sorted(gone) == sorted(a[5:]) and sorted(come) == sorted(b)


def test_ranges_of_ids_with_repeats_and_nulls(spark):
    rows = [(None if i % 9 == 0 else i // 3, f"text {i} of many") for i in range(300)]
    docs = spark.createDataFrame(rows, H.SCHEMA)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = []
    for (doc_id, text), (_, after) in zip(order, [*order[1:], order[0]]):
        edited = text[: len(text) - len(text) // 3] + after[: len(text) // 3]
        want.append((doc_id, fingerprints.fingerprint(text), fingerprints.fingerprint(edited)))
    got = [(r["doc_id"], r["fingerprint"], r["edited_fingerprint"]) for r in fingerprints.compare_with_next(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


# 8 toxicity


def hashed(gram):
    """The hash of one n-gram in whole numbers."""
    h = 0x9E3779B9
    for c in gram:
        h = (h ^ ord(c)) * 0x01000193 & 0xFFFFFFFF
        h ^= h >> 15
    return ((h ^ len(gram)) * 0x85EBCA6B & 0xFFFFFFFF) >> (32 - toxicity.BITS)


def gram_set(text):
    text = f" {text.lower()} "
    return {hashed(text[i : i + n]) for n in toxicity.SIZES for i in range(len(text) - n + 1)}


@pytest.mark.parametrize("text", ["", "a", "Déjà vu 👍 vu vu vu", "x" * 40, "".join(random.Random(3).choice("ab cé") for _ in range(3000))])
def test_features_are_the_distinct_grams(monkeypatch, text):
    found = toxicity.features(text).tolist()
    assert len(found) == len(set(found)) and set(found) == gram_set(text)
    monkeypatch.setattr(toxicity, "BLOCK", 100)
    assert set(toxicity.features(text).tolist()) == gram_set(text)


def test_ratios_equal_counts_by_hand_and_margins_their_sum(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["mild", "word", "calm", "nasty" if k % 3 == 0 else "nice", "vile" if k % 3 == 0 else "warm"]) for _ in range(12)) for k in range(60)]
    toxic = np.array([int(k % 3 == 0) for k in range(60)])
    ratio = toxicity.log_count_ratio([toxicity.features(t) for t in texts], toxic)
    seen, by_label = Counter(), (Counter(), Counter())
    for text, label in zip(texts, toxic):
        seen.update(gram_set(text))
        by_label[label].update(gram_set(text))
    for gram in seen:
        want = log((by_label[1][gram] + 1) / (toxic.sum() + 2)) - log((by_label[0][gram] + 1) / ((1 - toxic).sum() + 2))
        assert ratio[gram] == pytest.approx(want if seen[gram] >= toxicity.MIN_TEXTS else 0)
    assert np.count_nonzero(ratio) <= len(seen)

    documents = spark.createDataFrame(list(enumerate(texts)), H.SCHEMA)
    labels = spark.createDataFrame([(k, int(t)) for k, t in enumerate(toxic)], "doc_id bigint, toxic int")
    weights, scale, shift = model = toxicity.train(documents, labels)
    for r in toxicity.score(documents.union(documents), model).collect():
        margin = scale * sum(float(weights[g]) for g in gram_set(texts[r["doc_id"]])) + shift
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-margin)), abs=1e-5)


# 6 chat formatting


def test_the_machine_emits_the_segments_and_is_in_the_plan_of_the_query(spark):
    plan = QUERIES["op6_chat_formatting"](spark, H.SF)._jdf.queryExecution().optimizedPlan().toString()
    assert ">user" in plan and ">assistant" in plan
    # The first answer is a draft that is not learned; later ones are.
    steps = (("start", "user", "asked"), ("asked", "assistant", "draft"), ("draft", "user", "again"), ("again", "assistant", "final"), ("final", "user", "again"))
    template = chat.INST._replace(steps=steps, last=("draft", "final"), loss_in={"draft": False}).check()
    turns = [(1, i, r, f"{r}{i}") for i, r in enumerate(["user", "assistant"] * 3)]
    turns += [(2, 0, "user", "q"), (2, 1, "user", "q"), (2, 2, "assistant", "lost")] + [(3, 0, "assistant", "x")]
    made = chat.format_conversations(spark.createDataFrame(turns, "conv_id int, turn int, role string, text string"), template)
    rows = {r["conv_id"]: r for r in made.select("*", chat.learned(F.col("segments"), template).alias("learned")).collect()}
    assert {k: r["learned"] for k, r in rows.items()} == {1: "assistant3assistant5", 2: "lost", 3: "x"}
    assert {k: r["valid"] for k, r in rows.items()} == {1: True, 2: False, 3: False}


def test_states_of_the_machine(spark):
    roles = [["user", "assistant", "user"], ["user", "user", "assistant"], [], ["system"], ["nobody", "user"]]
    frame = spark.createDataFrame([(r,) for r in roles], "roles array<string>")
    got = [r[0] for r in frame.select(chat.states_of(F.col("roles"), chat.INST)).collect()]
    lost = chat.LOST
    assert got == [["user", "assistant", "user"], ["user", lost, lost], [], ["system"], [lost, lost]]


# 3 byte-level BPE

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.mark.parametrize("run", [" " * 9000, "\n" * 9000, " \t" * 4500 + "\u3000", "\n" * 8999 + " "])
@pytest.mark.parametrize("text", ["a{}b", "a{}1", "a{}!", "x{}", "{}y", "{}", "it's{}漢{}\x1c"])
def test_long_runs_of_blanks_equal_the_library(run, text):
    encoder, text = bpe.encoding(RANKS, public_tokenizers.PATTERN), text.replace("{}", run)
    assert np.frombuffer(bpe.token_ids(encoder, text), "<u4").tolist() == encoder.encode_ordinary(text)


@pytest.mark.parametrize("blank", [" ", "\n"])
def test_millions_of_blanks_are_encoded_and_decoded(blank):
    encoder, run = bpe.encoding(RANKS, public_tokenizers.PATTERN), blank * 3_000_000
    for text in (run + "a", "a" + run + "1", "end" + run):
        ids = np.frombuffer(bpe.token_ids(encoder, text), "<u4")
        assert encoder.decode_bytes(ids.tolist()) == text.encode()


def test_bpe_equals_the_library_on_the_given_table(spark, documents):
    encoder = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    got = {r["doc_id"]: bytes(r["token_ids"]) for r in bpe.encode(documents, RANKS, public_tokenizers.PATTERN).collect()}
    assert got == {r["doc_id"]: np.array(encoder.encode_ordinary(r["text"] or ""), "<u4").tobytes() for r in documents.collect()}

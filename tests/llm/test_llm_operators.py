"""The training-data operators against brute force, exact round trips, held-out labels and odd inputs."""

import base64
import hashlib
import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import helpers as H  # noqa: E402

from tideline.llm import bpe, chat, common, fingerprints, hosts, lines, neardup, neighbours, packing, rules, toxicity  # noqa: E402
from tideline.llm.queries import ORACLES, QUERIES  # noqa: E402
from validation.check import connect, rows_of  # noqa: E402

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{H.SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{H.SF}/labels.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return [(r["doc_id"], r["text"]) for r in documents.collect()]


@pytest.fixture(scope="module")
def odd(spark):
    return H.odd_documents(spark).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return H.odd_documents(spark, [])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    frame, cursor = QUERIES[name](spark, H.SF), connect(H.SF).execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(frame.columns) == sorted(names)
    assert rows_of(frame.columns, frame.collect()) == rows_of(names, cursor.fetchall())


# 1 near-dedup


def test_near_dedup_equals_brute_force(documents, texts):
    want = H.near_components(texts)
    got = neardup.near_components(documents).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_dedup_finds_links_that_stars_miss(spark):
    """Chains of edits around a long shared passage: neighbours are alike, the ends and the first document are not."""
    shared = [f"shared{i}" for i in range(200)]
    rows = [(0, " ".join(shared + [f"own{i}" for i in range(120)]))]
    for chain in range(4):
        base = shared + [f"c{chain}w{i}" for i in range(100)]
        for step in range(8):
            rows.append((1 + chain * 8 + step, " ".join(base[:-1] + [f"end{chain}"])))
            for i in range(step * 12, step * 12 + 12, 6):
                base[200 + i] = f"new{chain}x{step}y{i}"
    docs = spark.createDataFrame(rows, H.SCHEMA)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_components(docs).collect()}
    assert got == H.near_components(rows)


def test_left_over_links_join_components_that_a_centre_hides(spark):
    """Two alike documents that meet only in a bucket whose centre is unlike both."""
    passage = [f"p{i}" for i in range(120)]
    rows = [(0, " ".join(passage)), (5, " ".join(passage + [f"a{i}" for i in range(90)])), (6, " ".join(passage + [f"a{i}" for i in range(80)]))]
    docs = spark.createDataFrame(rows, H.SCHEMA)
    classes = neardup.described(docs).withColumnRenamed("doc_id", "node")
    bucket = int(neardup.buckets_of(np.frombuffer(classes.where("node = 5").first()["signature"], "<u2").reshape(1, -1))[0, 0])
    members = spark.createDataFrame([(bucket, i) for i in (0, 5, 6)], "bucket bigint, node bigint")
    alone = spark.createDataFrame([], "node bigint, root bigint")
    links = neardup.left_over_links(members, classes, alone, docs).collect()
    assert [(r["a"], r["b"]) for r in links] == [(5, 6)]


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(10, 60)], "a bigint, b bigint")
    assert {r["node"]: r["root"] for r in neardup.components(chain).collect()} == {i: 10 for i in range(11, 61)}
    assert neardup.components(chain.where("a < 0")).count() == 0


def test_near_dedup_odd_rows(odd, empty):
    got = neardup.near_components(odd).collect()
    assert len(got) == len(H.ODD)
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert all(r["kept"] and r["component_id"] is None for r in got if r["doc_id"] is None)
    assert [by_id[i]["component_id"] for i in range(1, 12)] == [1, 2, 3, 4, 5, 6, 7, 7, 7, 10, 7]
    assert by_id[1]["n_shingles"] == by_id[3]["n_shingles"] == 0 and by_id[4]["n_shingles"] == 1
    kept = neardup.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 5, 6, 7, 10]
    assert neardup.near_components(empty).count() == 0


# 2 quality rules


def test_rules_count_as_brute_force(documents, texts):
    got = {r["doc_id"]: r for r in rules.verdicts(documents).collect()}
    for doc_id, text in texts:
        counts, row = H.statistics(text), got[doc_id]
        assert tuple(row[c] for c in rules.NUMBERS) == counts
        assert row["base_failed"] == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (row["kept"] and row["base_failed"])


def test_rules_reject_outliers_and_leave_the_rest(spark):
    rng = np.random.default_rng(5)
    vocabulary = [f"{a}{b}" for a in ("an", "the", "ore", "li", "s") for b in ("ta", "mo", "rine", "d", "lk", "eau")]
    fair = [" ".join(rng.choice(vocabulary, 80)) for _ in range(80)]
    junk = [" ".join(f"w{i}x{n}$$$%%" for n in range(90)) for i in range(8)] + [" ".join(f"SHOUT{i}{n}!!" for n in range(90)) for i in range(8)]
    rows = [(i, t) for i, t in enumerate(fair + junk)]
    docs = spark.createDataFrame(rows, H.SCHEMA).withColumns({"lang": F.lit("en"), "source": F.lit("s")})
    kept = {r["doc_id"] for r in rules.keep_regular(docs).collect()}
    assert kept == set(range(80))
    distances = {r["doc_id"]: r["distance"] for r in rules.verdicts(docs).collect()}
    assert min(distances[i] for i in range(80, 96)) > max(distances[i] for i in range(80))


@pytest.mark.parametrize("copies", [True, False])
def test_rules_reject_junk_that_is_a_third_of_a_pool(spark, copies):
    rng = np.random.default_rng(7)
    vocabulary = [f"{a}{b}" for a in ("an", "the", "ore", "li", "s") for b in ("ta", "mo", "rine", "d", "lk", "eau")]
    fair = [" ".join(rng.choice(vocabulary, 80)) for _ in range(120)]
    junk = [" ".join(f"w{0 if copies else i}x{n}$$$%%" for n in range(90)) for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(fair + junk)), H.SCHEMA).withColumns({"lang": F.lit("en"), "source": F.lit("s")})
    assert {r["doc_id"] for r in rules.keep_regular(docs).collect()} == set(range(120))


def test_rules_whiten_as_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 5)) @ rng.normal(size=(5, 5))
    frame = spark.createDataFrame([("p", *map(float, row)) for row in x], "pool string, x0 double, x1 double, x2 double, x3 double, x4 double")
    got = frame.join(rules.whitened(rules.moments(frame)), "pool").select("x0", rules.squared_distance().alias("d")).collect()
    cov = np.cov(x.T, bias=True) + np.diag(np.square(rules.FLOORS))
    want = [float((r - x.mean(0)) @ np.linalg.solve(cov, r - x.mean(0))) for r in x]
    assert np.allclose(sorted((r["x0"], r["d"]) for r in got), sorted(zip(x[:, 0], want)))


def test_rules_odd_rows(odd, empty):
    got = rules.verdicts(odd).collect()
    assert len(got) == len(H.ODD)
    assert {r["doc_id"] for r in got if not r["base_failed"]} == {None, 6, 7, 8, 9, 11}
    kept = rules.keep_regular(odd)
    assert kept.columns == odd.columns and kept.count() == sum(r["kept"] for r in got)
    assert rules.verdicts(empty).count() == 0 and rules.keep_regular(empty).count() == 0


# 3 byte-level BPE


def encoder():
    import tiktoken

    with open(RANKS, "rb") as lines_:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines_)}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library_and_decodes(odd, empty):
    plain = encoder()
    encoded = bpe.encode(odd, RANKS, public_tokenizers.PATTERN)
    rows = bpe.decode(encoded, RANKS, public_tokenizers.PATTERN).collect()
    want = sorted((np.array(plain.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for _, t in H.ODD)
    assert sorted((bytes(r["token_ids"]), bytes(r["decoded"])) for r in rows) == want
    assert all(r["n_tokens"] == len(r["token_ids"]) // 4 for r in rows)
    assert bpe.encode(empty, RANKS, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("size", [7, 64, 1000])
def test_bpe_pieces_are_safe(size):
    plain = encoder()
    text = "It's  a   12abc34 tést\n\n\n  of \t blanks 'll漢字漢字 !!!???   x" * 40 + " " * 300 + "end"
    cut = list(bpe.pieces(text, size))
    assert "".join(cut) == text and len(cut) > 2
    assert [i for p in cut for i in plain.encode_ordinary(p)] == plain.encode_ordinary(text)


# 4 and 8 classifiers


def held_out_table(spark, sf="/root/testdata/sf0.01"):
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


def test_quality_on_held_out_labels(spark):
    docs, labels = held_out_table(spark)
    rows = neighbours.score(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.93 * len(rows)
    assert sum(r["predicted"] for r in rows if r["quality"]) >= 0.98 * sum(r["quality"] for r in rows)


def test_toxicity_on_held_out_labels(spark):
    docs, labels = held_out_table(spark)
    rows = toxicity.score(docs, toxicity.train(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    toxic, clean = ([r["score"] for r in rows if r["toxic"] == k] for k in (1, 0))
    assert np.mean([a > b for a in toxic for b in clean]) >= 0.9
    assert sum(r["predicted"] for r in rows if not r["toxic"]) <= 0.03 * len(clean)


def test_labels_that_are_held_out_are_not_learned(spark):
    docs, labels = held_out_table(spark)
    turned = labels.withColumn("quality", F.when(neighbours.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    for a, b in zip(neighbours.train(docs, labels, 200), neighbours.train(docs, turned, 200)):
        assert np.array_equal(a, b)


def test_labels_of_documents_that_are_not_given_take_no_place(spark, documents):
    labels = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    ids = [r["doc_id"] for r in documents.where(~common.held_out()).select("doc_id").distinct().collect()]
    assert 50 < len(ids) < 5_000
    for limit, want in ((50, 50), (5_000, len(ids))):
        sample = common.training_texts(documents, labels, "quality", limit).select("doc_id").distinct()
        assert sample.count() == want


def test_scores_of_odd_rows(spark, odd, empty, documents, labels):
    model, toxic = neighbours.train(documents, labels), toxicity.train(documents, labels)
    for rows in (neighbours.with_scores(odd, model, "s"), neighbours.with_scores(odd, None, "s")):
        assert rows.columns == [*odd.columns, "s"] and rows.where("s between 0 and 1").count() == len(H.ODD)
    assert toxicity.score(odd, toxic).where("score between 0 and 1").count() == len(H.ODD)
    none = labels.limit(0)
    assert neighbours.keep_good(odd, none).count() == len(H.ODD) and neighbours.keep_good(empty, labels).count() == 0
    assert {r["predicted"] for r in toxicity.score(odd, toxicity.train(odd, none)).collect()} == {0}
    nulls = spark.createDataFrame([(None, 1, 1), (7, None, None), (7, 1, 0), (7, 0, 1)], "doc_id bigint, quality int, toxic int")
    assert neighbours.score(odd, nulls).count() == len(H.ODD)


# 5 line dedup


def test_lines_equal_brute_force(spark, odd, empty):
    common, other = "A line that many documents share.", "another line of at least twenty"
    rows = [(1, f"{common}\nx\n  {common.upper()}\t"), (2, f"y\n{common}"), (3, common), (4, f"{other}\n{other}"), (5, other), (6, "é" * 20 + "\nshort"), (7, "é" * 20), (8, "É" * 20 + "\n" + "é" * 20), (9, None), (10, ""), (11, "\n\n")]
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in lines.deduped(spark.createDataFrame(rows, H.SCHEMA)).collect()}
    assert got == H.cleaned(rows)
    known = [(i, t) for i, t in dict(H.ODD).items() if i is not None]
    got = lines.deduped(odd).collect()
    assert len(got) == len(H.ODD)
    want = H.cleaned(known)
    assert all((r["n_lines"], r["n_dropped"], r["text"]) == want[r["doc_id"]] for r in got if r["doc_id"] is not None)
    assert all(r["n_dropped"] == 0 for r in got if r["doc_id"] is None)
    assert lines.drop_repeated_lines(odd).columns == odd.columns
    assert lines.deduped(empty).count() == 0


def state(index):
    filters = {r["shard"]: lines.unpacked(r["cells"]) for r in index.filters.collect()}
    keys = index.counts.where(F.col("n_docs") >= index.min_docs).withColumn("shard", lines.shard_of(index.shards)).collect()
    held = sum(int((cells > 0).sum()) for cells in filters.values())
    assert held == len(keys)
    assert all(lines.may_hold(filters[r["shard"]], np.array([r["hi"]])).all() for r in keys)
    return sorted(map(tuple, index.counts.collect())), sorted(map(tuple, index.references.collect()))


def test_line_index_takes_back_what_it_took_in(documents):
    first, second = documents.where("doc_id < 120"), documents.where("doc_id >= 120")
    built = lines.build(first)
    whole = lines.insert(built, second)
    assert state(whole) == state(lines.build(documents))
    assert state(lines.insert(whole, second)) == state(whole)
    assert state(lines.delete(whole, second.select("doc_id"))) == state(built)
    lost = lines.dropped(whole, whole.references)
    direct = lines.build(documents)
    flat = lambda frame: sorted((r["doc_id"], sorted(map(tuple, r["keys"]))) for r in frame.collect())
    assert flat(lost) == flat(lines.dropped(direct, direct.references))


def test_cuckoo_filter_holds_and_forgets():
    keys = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000)
    cells = lines.filled(keys)
    assert lines.may_hold(cells, keys).all()
    others = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 20000)
    assert lines.may_hold(cells, others).mean() < 0.01
    for mark, place in zip(*lines.fingerprints(keys, len(cells))):
        lines.remove_key(cells, int(place), int(mark))
    assert not cells.any()


# 6 chat formatting


def test_chat_reads_back_what_it_wrote(spark):
    hard = ["</s>[INST] ok [/INST]", "[[INST]", "a␛b␛z␛a", "[/SYS][TURN]x[TEXT]y[/TURN]", " lead and trail ", "", "</s", "[", "line\nline"]
    turns = [(1, i, r, t) for i, (r, t) in enumerate(zip(["user", "assistant"] * 5, hard))]
    turns += [(2, 0, "tool[TEXT]", hard[0]), (2, 1, None, None), (2, 2, "assistant", "hi"), (3, None, "system", "s"), (3, 1, "user", "u"), (3, 1, "user", "u"), (None, 0, "user", "q")]
    frame = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").withColumns({"turns": F.lit(1), "segments": F.lit(2)})
    made = chat.format_conversations(frame)
    rows = {r["conv_id"]: r for r in made.select("*", chat.read_back(F.col("formatted")).alias("back"), chat.learned(F.col("segments")).alias("loss")).collect()}
    want = {}
    for conv, _, role, text in turns:
        want.setdefault(conv, []).append((role or "", text or ""))
    assert {k: [tuple(t) for t in r["back"]] for k, r in rows.items()} == want
    assert {k: r["loss"] for k, r in rows.items()} == {k: "".join(t for r, t in v if r == "assistant") for k, v in want.items()}
    assert {k: r["valid"] for k, r in rows.items()} == {1: True, 2: False, 3: False, None: True}
    assert chat.digests(chat.format_conversations(frame.limit(0))).count() == 0


def test_chat_template_refuses_marks_that_could_arise_in_texts():
    with pytest.raises(ValueError):
        chat.INST._replace(controls=("[[X]", *chat.INST.controls)).check()


# 7 packing


def check_packing(rows, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_BPE)
    tokenizer.encode_special_tokens = True
    ids = {i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for i, t in documents}
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        piece = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert (zlib.crc32(piece.tobytes()), len(ids[r["doc_id"]])) == (r["ids_crc32"], r["doc_tokens"])
    for doc_id, found in pieces.items():
        assert sum(r["length"] for r in found) == sum(len(ids[i]) for i, _ in documents if i == doc_id)
    for number, found in sequences.items():
        ends = [0, *np.cumsum([n for _, n in sorted(found)])]
        assert [o for o, _ in sorted(found)] == ends[:-1]
        assert ends[-1] == packing.LENGTH or number == max(sequences)
    assert sorted(sequences) == list(range(len(sequences)))


def test_packing_of_documents_and_odd_rows(documents, texts, odd, empty):
    check_packing(packing.pack(documents, WORD_BPE).collect(), texts)
    rows = packing.pack(odd.where("doc_id is not null"), WORD_BPE).collect()
    check_packing(rows, [(i, t) for i, t in H.ODD if i is not None])
    assert packing.pack(odd, WORD_BPE).where("doc_id is null").count() == 2
    assert packing.pack(empty, WORD_BPE).count() == 0
    piece = packing.pack(odd, WORD_BPE, with_ids=True).first()
    assert zlib.crc32(piece["ids"]) == piece["ids_crc32"]


def test_hilbert_neighbours_differ_by_one_step():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = packing.hilbert_key(grid, 3)
    assert sorted(keys) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(1) == 1).all()


# 9 url filters


def test_hosts_parse_and_rules(spark, labels):
    urls = ["http://WWW.Example.COM/en/x?y", "https://a.example.com/en/", "https://b.net:80/es/1", "x", None, "http://example.com", "//no", "http://com/#f", "http://notexample.com/en/", "a://b://c/d", "http://h.org/a\nb"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id bigint, url string").withColumns({"host": F.lit("x"), "upper": F.lit("x")})
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in hosts.judge(pages, labels.limit(0)).collect()}
    assert got[0] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert got[1] == ("a.example.com", "/en/", "example.com/en/", "block")
    assert got[2] == ("b.net:80", "/es/1", None, "allow")
    assert got[3] == got[4] == got[6] == ("", "", None, "allow")
    assert got[5][:3] == ("example.com", "", None) and got[7] == ("com", "/", "com/", "allow")
    assert got[8][2] == "com/" and got[9][:2] == ("b:", "//c/d") and got[10][1] == "/a\nb"
    assert hosts.judge(pages.limit(0), labels).count() == 0


def test_hosts_shrink_to_their_parents(spark):
    rows = [(f"good{i}.example.org", 1) for i in range(30) for _ in range(20)] + [("bad.example.org", 0)] * 40 + [("few.example.org", 0)] * 2 + [("new.example.org", None)]
    rows += [("only.shop.co.uk", 1)] * 5
    got = {r["host"]: r for r in hosts.reputations(spark.createDataFrame(rows, "host string, good int")).collect()}
    assert got["bad.example.org"]["upper"] < hosts.LEAST_GOOD < got["few.example.org"]["upper"]
    assert got["bad.example.org"]["mean"] < got["few.example.org"]["mean"] < got["new.example.org"]["mean"] < got["good1.example.org"]["mean"]
    pages = spark.createDataFrame([(i, f"http://{h}/x") for i, (h, _) in enumerate(rows)], "page_id bigint, url string")
    labels = spark.createDataFrame([(i, g) for i, (_, g) in enumerate(rows)], "doc_id bigint, quality int")
    verdicts = hosts.judge(pages, labels, ()).where("verdict = 'block'").select("host").distinct().collect()
    assert [r["host"] for r in verdicts] == ["bad.example.org"]
    host = spark.createDataFrame([("a.b.co.uk",), ("b.com",), ("",)], "h string")
    assert [tuple(r) for r in host.select(*hosts.suffix_and_domain(F.col("h"))).collect()] == [("co.uk", "b.co.uk"), ("com", "b.com"), ("", "")]


# 10 fingerprints


def test_fingerprints_equal_brute_force(documents, texts):
    ordered = sorted(texts, reverse=True)
    got = {r["doc_id"]: r for r in fingerprints.compare_with_next(documents).collect()}
    prints = {}
    for k, (doc_id, text) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)][1]
        edited = text[: len(text) - len(text) // 3] + after[: len(text) // 3]
        row, sets = got[doc_id], [set(fingerprints.digests(t).tolist()) for t in (text, edited, after)]
        assert (row["n_chars"], row["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        for name, other in (("near_edited", sets[1]), ("near_next", sets[2])):
            assert row[name] == (len(sets[0] & other) / len(sets[0] | other) if sets[0] | other else 1.0)
        assert prints.setdefault(text, row["fingerprint"]) == row["fingerprint"]
    assert np.mean([r["near_edited"] > r["near_next"] for r in got.values()]) > 0.97


def test_fingerprints_recover_the_differing_digests(spark, odd, empty):
    rows = odd.select("doc_id", F.col("text").alias("old"), F.lit(H.PLAIN).alias("new"), "likeness")
    for r in fingerprints.differences(rows, "old", "new").collect():
        old, new = ({f"{d:016x}" for d in fingerprints.digests(t).tolist()} for t in (r["old"] or "", H.PLAIN))
        assert (set(r["removed"]), set(r["added"])) == (old - new, new - old)
        assert r["_likeness"] == len(old & new) / len(old | new)
    assert fingerprints.differences(rows.limit(0), "old", "new").count() == 0
    assert fingerprints.compare_with_next(odd).count() == len(H.ODD)
    assert fingerprints.compare_with_next(empty).count() == 0
    one = fingerprints.compare_with_next(spark.createDataFrame([(1, "a b c")], H.SCHEMA)).first()
    assert one["near_next"] == 1.0 and one["edited_sha256"] == hashlib.sha256(b"a b a").hexdigest()

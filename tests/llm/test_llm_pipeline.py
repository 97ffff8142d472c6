"""The corpus pipeline stage by stage against brute force."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus_pipeline  # noqa: E402
import helpers as H  # noqa: E402

from tideline.llm import neighbours, rules  # noqa: E402
from tideline.llm.common import stored  # noqa: E402


def test_each_stage_does_its_work(spark):
    docs = spark.read.parquet(f"{H.SF}/documents.parquet")
    labels = spark.read.parquet(f"{H.SF}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "quality_classifier", "line_dedup", "near_dedup", "packing"]

    def ids(frame):
        return sorted(r["doc_id"] for r in frame.select("doc_id").collect())

    regular = stored(stages["quality_rules"](spark, docs, H.SF))
    assert ids(regular) == ids(rules.verdicts(docs).where("kept"))
    good = stored(stages["quality_classifier"](spark, regular, H.SF))
    assert ids(good) == ids(neighbours.score(regular, labels).where("score >= 0.3"))
    clean = stored(stages["line_dedup"](spark, good, H.SF))
    before = [(r["doc_id"], r["text"]) for r in good.collect()]
    after = {r["doc_id"]: (r["text"], r["n_chars"]) for r in clean.collect()}
    assert after == {i: (text, len(text)) for i, (_, _, text) in H.cleaned(before).items()}
    single = stored(stages["near_dedup"](spark, clean, H.SF))
    groups = H.near_components([(i, t) for i, (t, _) in after.items()])
    assert ids(single) == sorted(i for i, (_, root) in groups.items() if i == root)
    for frame in (regular, good, clean, single):
        assert frame.columns == docs.columns
    pieces = stages["packing"](spark, single, H.SF)
    assert sorted({r["doc_id"] for r in pieces.collect()}) == ids(single)
    whole = corpus_pipeline.run(spark, H.SF)
    assert sorted({(r["doc_id"], r["doc_tokens"]) for r in whole.collect()}) == sorted({(r["doc_id"], r["doc_tokens"]) for r in pieces.collect()})


def test_the_pipeline_of_odd_and_no_rows(spark):
    for rows in (None, []):
        docs = H.odd_documents(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, H.SF))
        assert docs.count() >= (1 if rows is None else 0)

"""The pipeline's stages, each against its operator's own result."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F
from strata.llm import mixing, neardup, quality, substringdedup
from strata.llm.storage import materialize, table

SMALL = "/root/testdata/sf0.001"


def test_stages_by_operator(spark, odd):
    for docs in (table(spark, SMALL, "documents"), odd):
        columns = docs.columns
        done = {}
        for name, stage in corpus_pipeline.STAGES:
            done[name] = (docs, materialize(stage(spark, docs, SMALL), f"test-{name}"))
            docs = done[name][1]
            if name != "tokens":
                assert docs.columns == columns
        ids = {n: Counter(r.doc_id for r in after.select("doc_id").collect()) for n, (_, after) in done.items()}
        before = {n: Counter(r.doc_id for r in b.select("doc_id").collect()) for n, (b, _) in done.items()}
        kept = {r.doc_id for r in quality.judged(done["quality"][0]).filter("kept").collect()}
        assert ids["quality"] == Counter({i: n for i, n in before["quality"].items() if i in kept})
        first = {r.doc_id for r in neardup.near_duplicates(done["near_dedup"][0]).filter("kept").collect()}
        assert set(ids["near_dedup"]) == first and all(n == 1 for i, n in ids["near_dedup"].items() if i is not None)
        source = done["substring_dedup"][0]
        spans = substringdedup.repeated_words(source).count()
        if not spans:
            assert ids["substring_dedup"] == before["substring_dedup"]
        copies = Counter()
        for r in mixing.mix(done["mixing"][0]).collect():
            copies[r.doc_id] += r.copies
        assert ids["mixing"] == +copies
        assert ids["tokens"] == ids["mixing"]


def test_run(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 100
    assert out.filter(F.col("n_tokens") <= 0).count() == 0

"""Every pipeline stage against brute force on its own input, and the whole on odd tables."""

from __future__ import annotations

import hashlib

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from strata.llm import toxicity  # noqa: E402

from .test_text_ops import brute_classes, brute_hits, brute_repeats  # noqa: E402

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_equal_brute_force(spark):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "minhash_near_dedup", "suffix_array_dedup", "benchmark_decontamination", "sentencepiece"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in stages.items():
        out = stage(spark, docs, SF).checkpoint()
        if name != "sentencepiece":
            assert out.columns == COLUMNS
        kept[name] = out
        before = {r["doc_id"]: r for r in docs.collect()}
        after = {r["doc_id"]: r for r in out.collect()}
        if name == "toxicity":
            net = toxicity.fit_toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            score = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, net).collect()}
            assert set(after) == {d for d, s in score.items() if s < 0.5} and 0 < len(after) < len(before)
            assert all(tuple(after[d]) == tuple(before[d]) for d in after)
        elif name == "minhash_near_dedup":
            home = brute_classes([(d, r["text"]) for d, r in before.items()])
            assert set(after) == set(home.values()) and len(after) < len(before)
            assert all(tuple(after[d]) == tuple(before[d]) for d in after)
        elif name == "suffix_array_dedup":
            want = brute_repeats([(d, r["text"]) for d, r in before.items()], 100)
            assert set(after) == set(before)
            for d, (n, gone, _, digest) in want.items():
                if gone == 0:
                    assert tuple(after[d]) == tuple(before[d])
                elif len(after[d]["text"].encode()) == n - gone:  # no character was cut in two
                    assert hashlib.sha256(after[d]["text"].encode()).hexdigest() == digest
                    assert after[d]["n_chars"] == len(after[d]["text"])
        elif name == "benchmark_decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
            want = brute_hits([(d, r["text"]) for d, r in before.items()], items, 10)
            assert set(after) == {d for d, w in want.items() if not w[4]}
        else:
            rows = out.collect()
            assert {r["doc_id"] for r in rows} == set(before) and all(r["exact"] for r in rows)
        docs = out


def test_pipeline_on_odd_and_empty_documents(spark):
    docs = spark.createDataFrame(
        [(None, None, None, None, None), (None, "some words", "en", "s", 10), (1, "", "en", None, 0), (2, None, "de", "s", None),
         (3, "one two three four five six", "en", "s", 27), (3, "one two three four five six", "en", "s", 27),
         (4, "One two three four five six!", "en", "s", 28)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for table in (docs, docs.limit(0)):
        out = table
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, out, SF).checkpoint()
        got = out.collect()
        ids = [r["doc_id"] for r in got if r["sample"] == 1]
        assert (len(ids) == 0) if table is not docs else (ids.count(3) == 1 and 4 not in ids and None in ids)


def test_run_is_the_stages_in_order(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and {"doc_id", "sample", "ids", "exact"} <= set(out.columns)

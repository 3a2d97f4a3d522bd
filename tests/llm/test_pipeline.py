from __future__ import annotations

import re

import corpus_pipeline
import numpy as np
from edge_cases import odd_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def test_stages_run_on_odd_rows(spark):
    docs = odd_documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == docs.columns
            assert out.count() > 0
            docs = out


def test_pipeline_keeps_words_and_sequences(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, SF)
        seen[name] = docs.collect()
    assert all(len(WORD.findall(r.text)) >= 50 for r in seen["quality_rules"])
    texts = [r.text for r in seen["exact_dedup"]]
    assert len(texts) == len(set(texts)) == len({r.text for r in seen["quality_rules"]})
    assert {r.doc_id for r in seen["simhash_near_dedup"]} <= {r.doc_id for r in seen["exact_dedup"]}
    pieces = corpus_pipeline.run(spark, SF).collect()
    sequences: dict = {}
    for r in pieces:
        sequences[r.sequence_id] = sequences.get(r.sequence_id, 0) + r.length
    assert max(sequences.values()) <= 1024
    assert sum(sequences.values()) / 1024 / len(sequences) > 0.95
    assert len(np.unique([r.sequence_id for r in pieces])) == len(sequences)

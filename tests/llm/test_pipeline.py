"""The pipeline's stages: what they keep, and that each works on what the one before kept."""

import corpus_pipeline
import numpy as np
from tokenizers import Tokenizer

from webloom.llm import decontam, gam, ngram_join, pii, queries

from .test_near_duplicates import brute

SF = "/root/testdata/sf0.001"


def test_pipeline_against_its_parts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = gam.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r.doc_id: r.score for r in gam.score(docs, model).collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if scores[r.doc_id] >= 0.3}
    texts = {i: texts[i] for i, n, c in brute(texts.items()) if i == c}
    matcher = decontam.Matcher([tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()])
    texts = {i: pii.replace(t, queries.SURROGATE_KEY.encode(), {})[0] for i, t in texts.items() if not matcher.matches(t)}
    lib = Tokenizer.from_file(queries.tokenizer("word_bpe_49k.json"))
    want = {i: np.array(lib.encode(t, add_special_tokens=False).ids).tolist() for i, t in texts.items()}
    got = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want and 0 < len(got) < docs.count()


def test_stages_keep_the_columns_and_stand_edge_cases(spark, edge_docs, empty_docs):
    for docs in (edge_docs, empty_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, SF).columns == docs.columns
        rows = docs
        for _, stage in corpus_pipeline.STAGES[1:]:
            rows = stage(spark, rows, SF)
        assert rows.columns[:2] == ["doc_id", "n_tokens"]
        assert rows.count() == (7 if docs is edge_docs else 0)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "near_duplicates", "decontamination", "personal_data", "tokens"]

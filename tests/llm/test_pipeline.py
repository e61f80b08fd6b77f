"""Each stage against a plain version, on its own input."""

import re

import corpus_pipeline
from avspark.llm import pii
from avspark.llm.common import stored
from tests.llm.test_ngram_join import want_components
from tests.llm.test_tokens import check_packing


def test_stages(spark, sf_dir, docs):
    texts = lambda df: {r.doc_id: r.text for r in df.collect()}
    steps = dict(corpus_pipeline.STAGES)
    assert len(steps) == 5
    before, after = docs, stored(steps["language_id"](spark, docs, sf_dir), "t")
    assert after.columns == docs.columns
    assert after.count() >= 0.99 * docs.count()  # clean documents stay
    before, after = after, stored(steps["exact_dedup"](spark, after, sf_dir), "t")
    first = {}
    for d, t in sorted(texts(before).items()):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), d)
    assert sorted(texts(after)) == sorted(first.values()) and after.columns == docs.columns
    before, after = after, stored(steps["ngram_jaccard_join"](spark, after, sf_dir), "t")
    want = [d for d, _, c in want_components(list(texts(before).items()), 5, 80) if d == c]
    assert sorted(texts(after)) == sorted(want) and after.columns == docs.columns
    before, after = after, stored(steps["pii"](spark, after, sf_dir), "t")
    assert texts(after) == {d: pii.masked_text(t) for d, t in texts(before).items()}
    assert all(r.n_chars == len(r.text) for r in after.collect()) and after.columns == docs.columns
    check_packing(steps["best_fit_packing"](spark, after, sf_dir).collect(), texts(after))


def test_stages_of_odd_and_no_rows(spark, odd_docs, no_docs):
    from pyspark.sql import functions as F

    for docs in (odd_docs.withColumn("source", F.lit("s")).withColumn("n_chars", F.col("n_chars").cast("long")), no_docs):
        for _name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, "")
            assert out.columns == corpus_pipeline.COLUMNS
            out.count()

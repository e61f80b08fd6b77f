"""Strings of special tokens inside texts, against the library as Tokenizer.from_file gives it."""

import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from avspark.llm import queries

TEXTS = [
    "one two", "a<|endoftext|> b", "<|endoftext|>", "x <|endoftext|>y  z", "<|startoftext|>it's <|endoftext|>\n\nnext",
    "<|endoftext|><|endoftext|> <|endoftext|>", "line\n<|endoftext|>\n <|ENDOFTEXT|> <|endoftext| >", "é<|endoftext|>́ 漢 ", None,
]


def ids_of(name):
    library = Tokenizer.from_file(public_tokenizers.path(name))
    return [[*library.encode(t or "", add_special_tokens=False).ids, 0] for t in TEXTS]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_special_tokens_keep_their_ids(spark, tmp_path):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(TEXTS)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want, start = [], 0
    for i, ids in enumerate(ids_of("byte_bpe_50k.json")):
        want.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(map(tuple, queries.op3_token_shards(spark, str(tmp_path)).collect())) == want
    want = [(i, len(ids), crc(ids)) for i, ids in enumerate(ids_of("word_bpe_49k.json"))]
    assert any(49407 in ids for ids in ids_of("word_bpe_49k.json"))
    for rows in (queries.op9_best_fit_packing(spark, str(tmp_path)),
                 dict(corpus_pipeline.STAGES)["best_fit_packing"](spark, docs, str(tmp_path))):
        assert sorted((r.doc_id, r.length, r.ids_crc32) for r in rows.collect()) == want

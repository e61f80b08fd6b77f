"""BPE, packing and shards against the libraries on whole texts."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from avspark.llm import bpe, bpe_job, packing, queries, shards
from tests.llm.conftest import ODD


def library(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def tik():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_rank_queue_takes_lowest_rank_then_lowest_position():
    rng = random.Random(1)
    queue, held = bpe.RankQueue(), []
    for _ in range(2000):
        if held and rng.random() < 0.45:
            assert queue.pop() == min(held)
            held.remove(min(held))
        else:
            held.append((rng.randrange(60000), rng.randrange(50)))
            queue.push(*held[-1])


def test_merge_equals_library_also_on_very_long_pieces(tik):
    coder = bpe.ByteBpe(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rng = random.Random(2)
    cases = ["a" * 20000, "ab" * 9000, "".join(rng.choice("etaoin") for _ in range(20000)), "é漢😀" * 500]
    for text in cases + [t or "" for _, t in ODD]:
        assert coder.encode(text) == tik.encode_ordinary(text)


def test_merge_makes_no_call_for_each_step_and_leaves_the_queue_empty(tik, monkeypatch):
    def called(*args):
        raise AssertionError("a call for each step")

    monkeypatch.setattr(bpe.RankQueue, "push", called)
    monkeypatch.setattr(bpe.RankQueue, "pop", called)
    coder = bpe.ByteBpe(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice("aabcdeé漢 ") for _ in range(rng.randrange(60)))
        assert coder.encode(text) == tik.encode_ordinary(text)
        assert coder.queue.top == 0 and not any(coder.queue.low) and not any(coder.queue.bucket)


def test_a_small_memo_gives_the_same_ids(monkeypatch, plain):
    import pyarrow as pa

    from avspark.llm import pieces

    texts = pa.array(list(plain.values()))
    path = public_tokenizers.path("word_bpe_49k.json")
    want = pieces.library_pieces(path, False)(texts)
    for limit in (10, 9000, 30000):
        monkeypatch.setattr(pieces, "MEMO_PIECES", limit)
        monkeypatch.setattr(pieces, "_cached", {})
        encode = pieces.library_pieces(path, False)
        got = [encode(texts.slice(i, 7)) for i in range(0, len(texts), 7)]
        assert (np.concatenate([g[0] for g in got]) == want[0]).all()
        assert (np.concatenate([g[1] for g in got]) == want[1]).all()


def test_op7(spark, sf_dir, plain, tik, odd_docs, no_docs):
    sha = lambda b: hashlib.sha256(b).hexdigest()
    rows = queries.op7_bpe_round_trip(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(plain)
    for r in rows:
        ids = tik.encode_ordinary(plain[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(np.array(ids, "<u4").tobytes()))
        assert r.decoded_sha256 == sha(plain[r.doc_id].encode())
    args = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    odd = bpe_job.encoded(odd_docs, *args).collect()
    want = [(d, tik.encode_ordinary(t or ""), (t or "").encode()) for d, t in ODD]
    assert sorted(map(str, want)) == sorted(str((r.doc_id, list(r.ids), bytes(r.decoded))) for r in odd)
    assert bpe_job.encoded(no_docs, *args).count() == 0


@pytest.mark.parametrize("limit,top", [(10, 10), (64, 30), (2048, 2048), (2048, 700)])
def test_pack_is_a_tight_partition(limit, top):
    rng = random.Random(limit)
    lengths = [rng.randint(1, top) for _ in range(3000)]
    bins = packing.pack(lengths, limit)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= limit for b in bins)
    if top <= limit // 2:
        assert len(bins) <= sum(lengths) / limit * 1.01 + 1


def test_pack_replaces_the_smallest_by_two_that_fit_tighter():
    # Greedy: 6 + 3, gap 1. Two-fit: 6 + 2 + 2 fills it.
    assert sorted(map(sorted, ([[6, 3, 2, 2][i] for i in b] for b in packing.pack([6, 3, 2, 2], 10)))) == [[2, 2, 6], [3]]


def check_packing(rows, texts):
    encode = library("word_bpe_49k.json")
    ids = {}
    for r in rows:
        ids.setdefault(r.doc_id, []).append(r)
    for doc_id, text in texts.items():
        want = encode(text) + [0]
        parts = sorted(ids[doc_id], key=lambda r: r.piece)
        assert [r.start for r in parts] == list(range(0, len(want), 2048))
        for i, r in enumerate(parts):
            part = want[r.start : r.start + r.length]
            assert (r.piece, r.length) == (i, min(2048, len(want) - r.start))
            assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return len(sequences), sum(r.length for r in rows)


def test_op9(spark, sf_dir, plain):
    n, total = check_packing(queries.op9_best_fit_packing(spark, sf_dir).collect(), plain)
    assert n <= -(-total // 2048) * 1.03 + 1


def test_packing_of_odd_rows(odd_docs, no_docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.packed_documents(odd_docs.where("doc_id is not null and doc_id <> 5"), path).collect()
    check_packing(rows, {d: t or "" for d, t in ODD if d not in (None, 5)})
    rows = packing.packed_documents(odd_docs, path, length=7, with_ids=True)
    whole = [r.ids for r in packing.sequences(rows).collect()]
    encode = library("word_bpe_49k.json")
    assert sorted(x for w in whole for x in w) == sorted(x for _, t in ODD for x in [*encode(t or ""), 0])
    assert max(map(len, whole)) <= 7
    assert packing.packed_documents(no_docs, path).count() == 0


def test_perfect_hash_is_minimal_and_rejects_strangers():
    keys = np.unique(np.random.default_rng(0).integers(-(1 << 62), 1 << 62, 20000))
    hashed = shards.PerfectHash.build(keys)
    assert sorted(hashed(keys)) == list(range(len(keys)))
    null = np.zeros(len(keys), bool)
    index = shards.Index(keys, null, np.arange(len(keys) + 1), 2)
    again = shards.Index.from_bytes(index.to_bytes())
    assert (again.rows(keys) == np.arange(len(keys))).all()
    assert (again.rows(keys + 1)[~np.isin(keys + 1, keys)] == -1).mean() > 0.999


def want_shards(rows, encode):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*encode(text or ""), 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_op3(spark, sf_dir, plain):
    rows = queries.op3_token_shards(spark, sf_dir).collect()
    assert sorted(map(tuple, rows)) == want_shards(plain.items(), library("byte_bpe_50k.json"))


def test_shards_of_odd_rows_many_shards_and_lookups(spark, odd_docs, no_docs, monkeypatch):
    path, encode = public_tokenizers.path("byte_bpe_50k.json"), library("byte_bpe_50k.json")
    folder, table = shards.write(odd_docs, path)
    rows = [tuple(r) for r in shards.read(spark, folder, table).collect()]
    assert sorted(rows, key=str) == sorted(want_shards(ODD, encode), key=str)
    for name in [r["name"] for r in table.collect()]:
        reader = shards.ShardReader(folder, name)
        for key, null in zip(reader.index.keys.tolist(), reader.index.null.tolist(), strict=True):
            if not null:
                assert reader.get(key).tolist() in [[*encode(t or ""), 0] for d, t in ODD if d == key]
        assert reader.get(99) is None
    folder, table = shards.write(no_docs, path)
    assert shards.read(spark, folder, table).count() == 0

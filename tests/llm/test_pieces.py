"""Texts split into pieces, against the library on whole texts."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from avspark.llm import common, pieces


@pytest.fixture(params=["byte_bpe_50k.json", "word_bpe_49k.json"])
def both(request, monkeypatch):
    """Texts to lists of ids, by pieces and by the library, and the pieces."""
    path = public_tokenizers.path(request.param)
    monkeypatch.setattr(pieces, "_cached", {})
    own = pieces.library_pieces(path, request.param.startswith("byte"), special_as_text=False)
    library = Tokenizer.from_file(path)

    def by_pieces(texts):
        ids, counts = own(pa.array(texts, pa.string()))
        return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]

    return by_pieces, lambda texts: [library.encode(t, add_special_tokens=False).ids for t in texts], own


def test_white_space_of_all_kinds(both):
    by_pieces, by_library, _ = both
    rng = random.Random(5)
    parts = ["\n", "\n", " ", "\t", "\r", "\x0b", "\0", "a", "Bc", "it's", "'", ".", "é", "é", "́", "漢", "ß", "12", "<|endoftext|>", "<", " ", "İ"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(25))) for _ in range(4000)] + ["\n", "a\n", "\na", "a\n\nb", "a\n\n\nb\nc"]
    assert by_pieces(texts) == by_library(texts)


def test_words_on_both_sides_of_a_newline_are_pieces_of_their_own(both):
    by_pieces, by_library, own = both
    texts = ["alpha beta.\nGamma delta\nalpha", "beta.\nalpha\nGamma  x", "a\n\nbeta.\nGamma"]
    assert by_pieces(texts) == by_library(texts)
    assert not any(k[1:-1].strip().count("\n") and not k.startswith("\n") for k in own.slot)


def test_each_missing_piece_is_encoded_once(both):
    by_pieces, by_library, own = both
    seen, encode = [], own.encode
    own.encode = lambda keys: seen.extend(keys) or encode(keys)
    texts = [f"w{i} é{i % 7} x{i % 5}\nw{i % 11}" for i in range(300)]
    for at in range(0, 300, 40):
        assert by_pieces(texts[at : at + 40]) == by_library(texts[at : at + 40])
    assert len(seen) == len(set(seen))


def test_memory_goes_back_after_each_batch(monkeypatch):
    calls = []

    class Pool:
        def release_unused(self):
            calls.append(len(got))

    monkeypatch.setattr(common.pa, "default_memory_pool", Pool)
    got = []
    for part in common.slices(iter([pa.RecordBatch.from_pydict({"text": ["ab", "cd", "ef"]}) for _ in range(3)]), size=4):
        got.append(part)
    assert [p.num_rows for p in got] == [2, 1] * 3 and calls == [2, 4, 6]


def test_a_worker_reads_a_tokenizer_once(monkeypatch):
    path, read = public_tokenizers.path("byte_bpe_50k.json"), []

    class Counted:
        @staticmethod
        def from_file(path):
            read.append(path)
            return Tokenizer.from_file(path)

    monkeypatch.setattr("tokenizers.Tokenizer", Counted)
    monkeypatch.setattr(pieces, "_cached", {})
    for _ in range(2):
        assert pieces.library_pieces(path, True).vocabulary == Tokenizer.from_file(path).get_vocab_size()
    assert read == [path]

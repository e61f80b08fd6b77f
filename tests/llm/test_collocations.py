"""Chunks, counts and scores against plain Python."""

import random
import re
from collections import Counter

import pytest

from avspark.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(rows):
    counts, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            total[lang] += len(words)
            own = counts.setdefault(lang, Counter())
            for m in range(1, 6):
                own.update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    return counts, total


def plain(rows, least, top):
    counts, total = plain_counts(rows)
    out = []
    for lang, own in counts.items():
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        inner = {}
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    part = p[i : i + size]
                    inner[part] = max(a, inner.get(part, 0))
        scored = []
        for p, a in candidates.items():
            if 100 * inner.get(p, 0) >= 100 * a:
                continue
            score, _, l, r = min((1000 * a * total[lang] // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            scored.append((score, a, " ".join(p), l, r))
        scored.sort(key=lambda s: (-s[0], -s[1], s[2].encode()))
        out += [(lang, i + 1, p, a, l, r, total[lang], score) for i, (score, a, p, l, r) in enumerate(scored[:top])]
    return sorted(out)


def result(found):
    return sorted(tuple(r) for r in found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    vocabulary = ["Alpha", "beta", "Γ", "delta", "Ünd", "x\x00y", "of", "the", "end here", "ÀB"]
    made = []
    for i in range(300):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(60))]
        text = "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "\r", ";x "]) for w in words)
        made.append((rng.choice(["en", "de", None, "en"]), text))
    passage = " ".join(rng.choice(vocabulary) for _ in range(400))   # long and shared
    made += [("en", f"{i % 3} {passage} {i % 5}") for i in range(20)]
    made += [("en", "word " * 3000), ("en", ""), (None, None), ("de", "...,,,"), ("", "lone lone lone"), *made[:4]]
    return made


def frame(spark, rows):
    return spark.createDataFrame([(lang, text, 1, "x") for lang, text in rows], "lang string, text string, n int, chunk string")


@pytest.mark.parametrize("least,top", [(3, 1000), (20, 10), (1, 50)])
def test_equals_plain(spark, rows, least, top):
    assert result(collocations.collocations(frame(spark, rows).repartition(5), least, top)) == plain(rows, least, top)


def test_counts_do_not_depend_on_filter_size_and_slices(spark, rows, monkeypatch):
    want = plain(rows, 5, 100)
    monkeypatch.setattr(collocations, "FILTER_BITS", 1 << 13)   # full of bits: passes nearly all
    monkeypatch.setattr(collocations, "_HELD", 50)
    assert result(collocations.collocations(frame(spark, rows), 5, 100)) == want


def test_chunks_cover_each_phrase_once(spark, rows):
    """Distinct chunks, weighted, hold each phrase as often as the texts do."""
    chunks = collocations.dictionary(frame(spark, rows)).collect()
    counts = {}
    for c in chunks:
        words = c.chunk.split(" ")
        for i in range(c.owned):
            for m in range(1, 6):
                if i + m <= len(words):
                    counts.setdefault(c.lang, Counter())[tuple(words[i : i + m])] += c.n
    want = {lang: own for lang, own in plain_counts(rows)[0].items() if own}
    assert counts == want
    long = [c for c in chunks if c.n >= 20 and c.owned > 4]
    assert long   # the shared passage was cut by its content into chunks that all its copies share


def test_no_rows(spark, no_docs):
    assert collocations.collocations(no_docs).collect() == []


def test_exact_beyond_64_bits(spark, monkeypatch):
    """Weights as large as a corpus: products pass 64 bits."""
    big = 10**13
    table = spark.createDataFrame([("en", "a b", 2, big + 7), ("en", "a c", 2, 3), ("en", "d", 1, 10**14)], "lang string, chunk string, owned int, n long")
    monkeypatch.setattr(collocations, "dictionary", lambda docs: table)
    n = 2 * (big + 7) + 6 + 10**14
    a, left, right = big + 7, big + 10, big + 7
    assert result(collocations.collocations(table)) == [("en", 1, "a b", a, left, right, n, 1000 * a * n // (left * right))]

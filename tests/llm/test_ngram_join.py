"""PartEnum signatures and the join against brute force."""

import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from avspark.llm import ngram_join, queries
from avspark.llm.components import components
from tests.llm.conftest import ODD


def gram_set(text, n=3):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) or frozenset([tuple(words)])


def want_components(rows, n, percent):
    sets = [(d, gram_set(t, n)) for d, t in rows]
    label = {d: d for d, s in sets}
    changed = True
    while changed:
        changed = False
        for a, x in sets:
            for b, y in sets:
                if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y) and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return sorted(((d, len(s), label[d]) for d, s in sets), key=str)


def test_features_equal_sets_of_grams():
    texts = ["A b  c d", "a B c d", "", "  ", "x", "x y", "é É é", "a b c a b c a b c", "q w e r\x0b t ", "L" * 5000 + " " + "l" * 5000 + " z"]
    got = ngram_join.features(pa.array(texts), 3)
    assert [len(g) for g in got] == [len(gram_set(t)) for t in texts]
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert len(np.intersect1d(got[i], got[j])) == len(gram_set(a) & gram_set(b))
    assert [g.tolist() for g in ngram_join.features(pa.array(["zz", *texts]).slice(1), 3)] == [g.tolist() for g in got]


@pytest.mark.parametrize("percent", [90, 80])
def test_bands_hold_every_partner(percent):
    method = ngram_join.PartEnum(percent)
    for size in [*range(1, 3000), 50_000, 99_999]:
        bands = method.bands(size)
        for other in {size, size + 1, size * 100 // percent}:
            if other * percent <= size * 100:
                assert method.bands(other)[0] in bands
                assert (size + other) * (100 - percent) // (100 + percent) <= method.most_different(method.bands(other)[0])


@pytest.mark.parametrize("percent", [90, 80])
def test_similar_sets_share_a_signature(percent):
    rng = random.Random(percent)
    method = ngram_join.PartEnum(percent)
    for _ in range(1500):
        size = rng.choice([1, 2, 5, 9, 10, 11, 19, 20, 40, 64, 100, 300])
        a = np.array(rng.sample(range(1 << 60), size), np.uint64)
        b = a.copy()
        for _ in range(rng.randrange(1 + size // 5)):
            if rng.random() < 0.5 and len(b) > 1:
                b = np.delete(b, rng.randrange(len(b)))
            else:
                b = np.append(b, np.uint64(rng.randrange(1 << 60)))
        shared = len(set(a.tolist()) & set(b.tolist()))
        if 100 * shared >= percent * (len(a) + len(b) - shared):
            assert np.intersect1d(method.signatures(a), method.signatures(b)).size
            # Also by what is left when the most frequent ones, in whatever order, are left out.
            often = np.random.default_rng(size).integers(0, 5, ngram_join.FREQUENCIES)
            kept = [method.signatures(x, often) for x in (a, b)]
            assert np.intersect1d(*kept).size
            spare = sum(method.parts(band)[3] for band in method.bands(size))
            assert len(kept[0]) == len(method.signatures(a)) - spare


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (105, 101), (200, 300)] + [(500, i) for i in range(501, 560)]
    got = dict(map(tuple, components(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert all(got[i] == 0 for i in range(41))
    assert (got[105], got[300], got[559]) == (100, 200, 500)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_copies_of_each_other(spark):
    """Many near copies, so that signatures have several members in different components."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(400)}" for _ in range(150)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(rng.randrange(7)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(rng.choice("abcdefgh") for _ in range(rng.choice([2, 3, 4, 12])))) for i in range(80)]
    got = ngram_join.linked(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == want_components(rows, 3, 90)


def test_shared_passage_and_dealt_signatures(spark):
    """A passage that most texts hold links none of them; copies stay found when signatures are dealt into parts."""
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(150):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([5, 60, 200]))]
        rows.append((2 * i, " ".join(words[:3] + passage + words[3:])))
        if i % 3 == 0:
            words[-1] = "changed"
            rows.append((2 * i + 1, " ".join(words[:3] + passage + words[3:])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = want_components(rows, 3, 90)
    for part_rows in (ngram_join.PART_ROWS, 3):
        assert sorted(map(tuple, ngram_join.linked(docs, part_rows=part_rows).collect()), key=str) == want


def test_odd_rows(odd_docs, no_docs):
    got = sorted(map(tuple, ngram_join.linked(odd_docs).collect()), key=str)
    want = want_components([(d, t) for d, t in ODD], 3, 90)
    assert got == want
    assert ngram_join.linked(no_docs).count() == 0
    assert ngram_join.one_of_each(odd_docs).columns == odd_docs.columns


def test_op6_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = con.sql(queries.OP6_SQL).fetchall()
    got = queries.op6_ngram_jaccard_join(spark, sf_dir)
    assert sorted(map(tuple, got.collect())) == sorted(want)

"""Nearest by inner product against plain Python integers."""

import math
import random

import pytest
from pyspark.sql import functions as F

from avspark.llm import topk

SCHEMA = "vec_id long, embedding array<double>, row int, v string"


def plain(rows, k):
    kept = []
    for i, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(1024 * x) for x in v]))
    out = []
    for at, (i, q) in enumerate(kept):
        if i is None or i % 100:
            continue
        scores = [(-sum(a * b for a, b in zip(q, v)), j is None, j or 0, j) for n, (j, v) in enumerate(kept) if n != at]
        out += [(i, rank + 1, j, -s) for rank, (s, _, _, j) in enumerate(sorted(scores, key=lambda s: s[:3])[:k])]
    return sorted(out, key=repr)


def result(spark, rows, k=10, **options):
    frame = spark.createDataFrame([(i, v, 7, "x") for i, v in rows], SCHEMA).repartition(3)
    found = topk.top_k(frame, F.col("vec_id") % 100 == 0, k, **options)
    assert found.columns == ["query_id", "rank", "id", "score"]
    return sorted(map(tuple, found.collect()), key=repr)


@pytest.fixture(scope="module")
def clustered():
    rng = random.Random(3)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    return [(i, [c + rng.gauss(0, 0.05) for c in centres[min(rng.randrange(9), 4)]]) for i in range(1200)]


def test_clusters(spark, clustered):
    assert result(spark, clustered) == plain(clustered, 10)


def test_small_groups_and_blocks(spark, clustered):
    """Many rings, groups and blocks, groups cut further."""
    rows = [(i if i % 3 else 100 * i, v) for i, v in clustered[:400]]
    assert result(spark, rows, 4, pivots=7, group_rows=5, block_rows=9) == plain(rows, 4)


def test_one_vector_is_a_third_of_all(spark, clustered):
    rows = clustered[:300] + [(100_000 + i, [0.25] * 6) for i in range(150)]
    assert result(spark, rows, 3, group_rows=2, block_rows=20) == plain(rows, 3)


def test_odd_rows(spark):
    rows = [(0, [1.0, -0.5]), (100, None), (200, [1.0, None]), (300, [math.nan, 1.0]), (400, [math.inf, 1.0]), (None, [3.0, 1.0]),
            (5, []), (6, [0.3]), (7, [1.0, -0.5]), (500, []), (8, [-1e-9, 0.0]), (9, [7.0, 2.0]), (600, [0.0, 0.0])]
    assert result(spark, rows, 20) == plain(rows, 20)


def test_huge_components(spark):
    rows = [(0, [1e9, 3.0]), (1, [1e9, -2.0]), (2, [-1e9, 2.5]), (100, [0.001, 0.5]), (3, [123456789.123, 5.5])]
    clip = lambda s: max(-(2**63), min(2**63 - 1, s))
    assert result(spark, rows, 5) == [(q, r, i, clip(s)) for q, r, i, s in plain(rows, 5)]


def test_few_and_no_rows(spark):
    assert result(spark, [(0, [1.0])]) == []
    assert result(spark, [(1, [1.0])]) == []
    assert result(spark, []) == []


def test_far_cells_are_not_sent(spark, clustered, monkeypatch):
    """Of tight clusters on the sphere, most blocks are ruled out by the bounds."""
    far = [(i, [x / math.hypot(*v) for x in v]) for i, v in clustered]
    seen = spark.sparkContext.accumulator(0)
    plainly = topk._exact_scores

    def counted(queries, data):
        seen.add(len(queries) * len(data))
        return plainly(queries, data)

    monkeypatch.setattr(topk, "_exact_scores", counted)
    assert result(spark, far, 3) == plain(far, 3)
    assert 0 < seen.value < 0.6 * 12 * 1200

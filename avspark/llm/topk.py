"""Exact top-k inner-product search as a Voronoi kNN join.

Components become integers (:data:`SCALE` times the value, rounded down), so scores are exact.
A vector s gets one more component, sqrt(M^2 - |s|^2), where M is the largest length there is; a
query gets 0 there. Then |q - s|^2 = |q|^2 + M^2 - 2 q.s, so the largest inner products are the
smallest distances and the triangle inequality holds:

1. *Group*: pivots are drawn from the vectors; queries and vectors belong to their nearest one. A
   pivot's queries are cut into groups of ``group_rows`` at most, by rings around the pivot.
2. *Bound*: a summary tells the distances from each pivot to its k + 1 nearest vectors. A query of
   group i is no farther from its k-th neighbour than bound_i = (radius of the group) + (the last of
   those distances); k + 1, because one of them may be the query itself.
3. *Replicate*: a vector goes to group i only if (its distance from pivot i) - (radius of the group)
   and (least radius of the group) - (that distance) are within bound_i.
4. *Solve*: vectors of one cell that came to one group are cut into blocks of about ``block_rows``, by
   hash. In a block, queries whose own bound the block's ring cannot meet are left out; the others
   get their k best. The best of a query's blocks are its result.

Tables on the driver are bounded: pivots, and (k + 1) distances of each. No task holds more than a
block and a group. If distances say nothing (points spread evenly in many dimensions), every vector
goes to every group: the result stays exact and the work is that of a full scan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from avspark.llm.common import stored

SCALE = 1024
#: Pivots: one for so many queries, within these limits.
QUERIES_A_PIVOT, LEAST_PIVOTS, MOST_PIVOTS = 256, 16, 256
GROUP_ROWS, BLOCK_ROWS = 2048, 16384
#: Queries that meet a block at once; bounds the matrix of scores.
_AT_ONCE = 256
#: Values handled at once when distances are taken.
_SLICE_VALUES = 1 << 20


def quantised(vectors: DataFrame, is_query: Column, id_column: str, vector_column: str) -> DataFrame:
    """(q, id, v, norm2, row): whole-number vectors; null or non-finite ones take no part."""
    v = F.col(vector_column).cast("array<double>")
    usable = F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = vectors.select(
        F.coalesce(is_query, F.lit(False)).cast("int").alias("q"), F.col(id_column).cast("long").alias("id"), v.alias("v")).where(usable)

    def rounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            values = np.floor(SCALE * lists.flatten().to_numpy(zero_copy_only=False))
            sizes = np.diff(lists.offsets.to_numpy())
            begins = np.concatenate([[0], np.cumsum(sizes)])
            squares = np.concatenate([[0.0], np.cumsum(values * values)])
            norm2 = squares[begins[1:]] - squares[begins[:-1]]
            if np.any(np.abs(values) >= 2.0**20):  # running sums may round: add up each vector alone
                norm2 = np.array([np.sum(values[a:b] ** 2) for a, b in zip(begins[:-1], begins[1:], strict=True)])
            # The values stay doubles: whole numbers, exact.
            yield pa.RecordBatch.from_arrays(
                [batch.column("q"), batch.column("id"), pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(values)), pa.array(norm2, pa.float64())],
                names=["q", "id", "v", "norm2"])

    return whole.mapInArrow(rounded, "q int, id long, v array<double>, norm2 double").withColumn(
        "row", F.monotonically_increasing_id())


def _matrix(lists, dims: int) -> np.ndarray:
    """Vectors as rows; one that is shorter than ``dims`` is filled up with zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    values = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(lists.offsets.to_numpy())
    if np.all(sizes == dims):
        return values.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims))
    out[np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(n) for n in sizes] or [[]]).astype(int)] = values
    return out


def _distances(x: np.ndarray, extra2: np.ndarray, pivots: np.ndarray, pivot_extra: np.ndarray) -> np.ndarray:
    """Distances of rows (``extra2``: square of their further component) from all pivots."""
    square = ((x * x).sum(1) + extra2)[:, None] + (pivots * pivots).sum(1) + pivot_extra**2
    square -= 2 * (x @ pivots.T + np.sqrt(extra2)[:, None] * pivot_extra)
    return np.sqrt(np.maximum(square, 0))


def _exact_scores(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Inner products as exact integers; beyond 64 bits they are clipped to that range."""
    reach = np.abs(queries).max(initial=0) * np.abs(data).max(initial=0) * max(1, data.shape[1])
    if reach < 2.0**53:
        return (queries @ data.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in queries], [[int(x) for x in row] for row in data]
    clip = lambda s: max(-(2**63), min(2**63 - 1, s))
    return np.array([[clip(sum(a * b for a, b in zip(q, d, strict=True))) for d in whole[1]] for q in whole[0]], np.int64)


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding",
    pivots: int | None = None, group_rows: int = GROUP_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_id, rank, id, score): the k largest inner products of each query row with all other rows.

    A row is a query where ``is_query`` holds. Ties go to the smaller id, rows without one last.
    Null vectors and those with a null or non-finite component take no part; shorter vectors count
    as filled up with zeros, an empty one as all zeros. Rows that repeat an id stay rows of their
    own: each query row has its result, and only itself is left out of it. Fewer than k other rows
    give fewer ranks; an empty table gives none. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    rows = stored(quantised(vectors, is_query, id_column, vector_column), "vectors")
    told = rows.agg(F.max("norm2").alias("m2"), F.max(F.size("v")).alias("dims"), F.sum("q").alias("n")).first()
    out = "query_id long, rank int, id long, score long"
    if not told["n"]:
        return spark.createDataFrame([], out)
    m2, dims, n_queries = told["m2"], max(1, told["dims"]), told["n"]
    wanted = pivots or min(MOST_PIVOTS, max(LEAST_PIVOTS, -(-n_queries // QUERIES_A_PIVOT)))
    drawn = rows.select("v", "norm2").orderBy(F.xxhash64("row")).limit(wanted).toArrow()
    p = _matrix(drawn.column("v"), dims)
    p_extra = np.sqrt(np.maximum(0, m2 - drawn.column("norm2").to_numpy()))
    slack = 1e-9 * (1 + m2) ** 0.5 + 1e-6  # far above the rounding of distances, far below their steps

    def nearest_to_pivots(batches):
        best = np.full((len(p), k + 1), np.inf)
        for batch in _slices(batches, dims):
            d = _distances(_matrix(batch.column("v"), dims), np.maximum(0, m2 - batch.column("norm2").to_numpy()), p, p_extra)
            best = np.sort(np.concatenate([best, d.T], 1), 1)[:, : k + 1]
        at, place = np.nonzero(np.isfinite(best))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(best[at, place])], names=["pivot", "d"])

    def grouped(batches):
        for batch in _slices(batches, dims):
            x = _matrix(batch.column("v"), dims)
            d = _distances(x, np.zeros(len(x)), p, p_extra)
            own = d.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), batch.column("v"), pa.array(own, pa.int32()), pa.array(d[np.arange(len(x)), own])],
                names=["row", "id", "v", "pivot", "d"])

    # Summary: the k + 1 nearest vectors of each pivot; tasks bring k + 1 each, one for each pivot stays.
    near = rows.select("v", "norm2").mapInArrow(nearest_to_pivots, "pivot int, d double")
    ranked = near.withColumn("place", F.row_number().over(Window.partitionBy("pivot").orderBy("d"))).where(F.col("place") <= k + 1)
    reach = dict(ranked.groupBy("pivot").agg(F.when(F.count("d") > k, F.max("d")).otherwise(float("inf")).alias("d")).collect())
    queries = stored(rows.where("q = 1").mapInArrow(grouped, "row long, id long, v array<double>, pivot int, d double"), "queries")
    # Rings of about group_rows queries around each pivot, by the distances' quantiles; a ring is
    # cut further by hash, as ties may fill it.
    counts = queries.groupBy("pivot").agg(F.count(F.lit(1)).alias("n")).collect()
    rings = {r["pivot"]: -(-r["n"] // group_rows) for r in counts}
    most = max(rings.values())
    if most > 1:
        marks = queries.groupBy("pivot").agg(F.percentile_approx("d", [i / most for i in range(1, most)], 10 * most).alias("cuts"))
        queries = queries.join(F.broadcast(marks), "pivot").withColumn(
            "ring", F.size(F.filter("cuts", lambda c: c < F.col("d")))).drop("cuts")
    else:
        queries = queries.withColumn("ring", F.lit(0))
    sizes = queries.groupBy("pivot", "ring").agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("low"), F.max("d").alias("high"))
    # One row for each group of queries: the driver holds as many as there are groups.
    groups = [
        (g, r["pivot"], r["ring"], -(-r["n"] // group_rows), r["low"], r["high"]) for g, r in enumerate(sizes.orderBy("pivot", "ring").collect())]
    table = spark.createDataFrame(
        [(g, pivot, ring, cut) for g, pivot, ring, cut, _, _ in groups], "grp long, pivot int, ring int, cuts int")
    queries = queries.join(F.broadcast(table), ["pivot", "ring"]).withColumn(
        "grp", F.col("grp") * F.lit(1 << 20) + F.pmod(F.xxhash64("row"), "cuts")).drop("cuts", "ring")
    g_pivot = np.array([g[1] for g in groups])
    g_low, g_high = np.array([g[4] for g in groups]) - slack, np.array([g[5] for g in groups]) + slack
    g_bound = g_high + np.array([reach[g[1]] for g in groups]) + slack
    g_cuts = np.array([g[3] for g in groups])

    def meets(d):
        """Which groups (columns) a vector may serve, from its distances to all pivots."""
        to = d[:, g_pivot]
        return (to - g_high <= g_bound) & (g_low - to <= g_bound)

    def served(batches):
        """How many vectors of each cell go to each group."""
        total = np.zeros((len(groups), len(p)), np.int64)
        for batch in _slices(batches, dims):
            d = _distances(_matrix(batch.column("v"), dims), np.maximum(0, m2 - batch.column("norm2").to_numpy()), p, p_extra)
            at, g = np.nonzero(meets(d))
            np.add.at(total, (g, d.argmin(1)[at]), 1)
        g, cell = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(g, pa.int32()), pa.array(cell, pa.int32()), pa.array(total[g, cell])], names=["grp", "cell", "n"])

    loads = rows.select("v", "norm2").mapInArrow(served, "grp int, cell int, n long").groupBy("grp", "cell").agg(F.sum("n").alias("n"))
    blocks = np.ones((len(groups), len(p)), np.int64)
    parts = []
    for r in loads.collect():  # groups x pivots at most
        blocks[r["grp"], r["cell"]] = -(-r["n"] // block_rows)
        parts.append((r["grp"] << 20, r["cell"], int(blocks[r["grp"], r["cell"]]), int(g_cuts[r["grp"]])))

    def replicated(batches):
        for batch in _slices(batches, dims):
            d = _distances(_matrix(batch.column("v"), dims), np.maximum(0, m2 - batch.column("norm2").to_numpy()), p, p_extra)
            cell = d.argmin(1)
            at, g = np.nonzero(meets(d))
            again = g_cuts[g]
            cut = np.arange(again.sum()) - np.repeat(np.cumsum(again) - again, again)
            at, g = np.repeat(at, again), np.repeat(g, again)
            row = batch.column("row").to_numpy()
            block = (row[at] * 2654435761 >> 7) % blocks[g, cell[at]]
            for begin in range(0, len(at), 8192):
                s = slice(begin, begin + 8192)
                take = batch.take(pa.array(at[s]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array((g[s].astype(np.int64) << 20) + cut[s]), pa.array(cell[at[s]], pa.int32()), pa.array(block[s], pa.int64()),
                     take.column("row"), take.column("id"), take.column("v"), pa.array(d[at[s], cell[at[s]]])],
                    names=["grp", "cell", "block", "row", "id", "v", "d"])

    sent = rows.select("row", "id", "v", "norm2").mapInArrow(
        replicated, "grp long, cell int, block long, row long, id long, v array<double>, d double")
    places = spark.createDataFrame(parts, "base long, cell int, n_blocks long, n_cuts long").select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_cuts") - 1)).alias("cut"), "base", "cell", "n_blocks").select(
        (F.col("base") + F.col("cut")).alias("grp"), "cell", "n_blocks")
    asked = queries.join(places, "grp").select(
        "grp", "cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).alias("block"), "row", "id", "v", "pivot", "d")

    def solved(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _none
        right = right.sort_by([("id", "ascending"), ("row", "ascending")])  # rows without id come last
        data, rows_, d = _matrix(right.column("v"), dims), right.column("row").to_numpy(), right.column("d").to_numpy()
        cell = right.column("cell")[0].as_py()
        asked_, at = _matrix(left.column("v"), dims), left.column("pivot").to_numpy()
        own = np.array([reach[i] for i in at]) + left.column("d").to_numpy() + 2 * slack
        here = _distances(asked_, np.zeros(len(asked_)), p[cell : cell + 1], p_extra[cell : cell + 1])[:, 0]
        open_ = np.flatnonzero((here - d.max() <= own) & (d.min() - here <= own))
        row_of, found = left.column("row").to_numpy(), []
        for begin in range(0, len(open_), _AT_ONCE):
            some = open_[begin : begin + _AT_ONCE]
            scores = _exact_scores(asked_[some], data)
            for q, score in zip(some.tolist(), scores, strict=True):
                keep = _best(score, rows_ != row_of[q], k)
                found.append((np.full(len(keep), q), keep, score[keep]))
        if not found:
            return _none
        q, keep, score = (pa.array(np.concatenate(part)) for part in zip(*found, strict=True))
        return pa.table({
            "query_row": left.column("row").take(q), "query_id": left.column("id").take(q), "row": right.column("row").take(keep),
            "id": right.column("id").take(keep), "score": score})

    best = asked.groupBy("grp", "cell", "block").cogroup(sent.groupBy("grp", "cell", "block")).applyInArrow(
        solved, "query_row long, query_id long, row long, id long, score long")
    place = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return best.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


_none = pa.table({c: pa.array([], pa.int64()) for c in ("query_row", "query_id", "row", "id", "score")})


def _best(score: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest allowed scores, earlier places first among equal ones."""
    at = np.flatnonzero(allowed)
    if len(at) > k:
        values = score[at]
        least = np.partition(values, len(values) - k)[len(values) - k]
        above = at[values > least]
        at = np.concatenate([above, at[values == least][: k - len(above)]])
    return at


def _slices(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    size = max(1, _SLICE_VALUES // max(dims, 64))
    for batch in batches:
        for begin in range(0, batch.num_rows, size):
            yield batch.slice(begin, size)

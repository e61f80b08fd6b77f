"""Best-fit packing of token pieces into sequences of a fixed length: best-two-fit.

A sequence is filled greedily with the longest piece that still fits. If a gap is left, its
smallest piece goes back when two unpacked pieces fill the widened gap more tightly; the pair
is the one with the largest sum. Pieces of equal length are alike, so the pool is a stack per
length, and two bit sets over lengths answer "longest that fits" and "pair with this sum" in a
few word operations.

Pieces are dealt by hash into groups of about ``group_pieces`` and each group is packed by
itself: memory is bounded, no hot key exists, and only one sequence for each group can stay
far from full for want of pieces. Texts are tokenised where they lie; only lengths move.

Defined results: null text is the empty text, which has the end id alone; an empty table gives
an empty result; repeated rows are packed as often as they occur; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from avspark.llm.common import slices, stored, texts

LENGTH = 2048
END_ID = 0
GROUP_PIECES = 100_000


def pack(lengths: list[int], limit: int) -> list[list[int]]:
    """Indexes of the pieces of each sequence, in order. No piece is longer than ``limit``."""
    pool: list[list[int]] = [[] for _ in range(limit + 1)]
    for i in range(len(lengths) - 1, -1, -1):
        pool[lengths[i]].append(i)
    present = mirror = 0  # bit x, and bit limit - x: pieces of length x are left
    for x in range(1, limit + 1):
        if pool[x]:
            present |= 1 << x
            mirror |= 1 << limit - x

    def take(x: int) -> int:
        nonlocal present, mirror
        i = pool[x].pop()
        if not pool[x]:
            present ^= 1 << x
            mirror ^= 1 << limit - x
        return i

    def give_back(x: int, i: int) -> None:
        nonlocal present, mirror
        present |= 1 << x
        mirror |= 1 << limit - x
        pool[x].append(i)

    def best_pair(most: int, over: int) -> tuple[int, int] | None:
        """Lengths of two pieces left with the largest sum in (over, most]."""
        least = (present & -present).bit_length() - 1
        for total in range(min(most, limit), max(over, 2 * least - 1), -1):
            both = present & (mirror >> limit - total)
            while both:
                x = both.bit_length() - 1
                if 2 * x != total or len(pool[x]) > 1:
                    return x, total - x
                both ^= 1 << x
        return None

    out = [[i] for i in pool[0]]
    while present:
        held: list[tuple[int, int]] = []
        room = limit
        while fits := present & (1 << room + 1) - 1:
            x = fits.bit_length() - 1
            held.append((x, take(x)))
            room -= x
        if room and present:
            small, i = held[-1]  # the greedy fill never takes a longer piece after a shorter
            if pair := best_pair(room + small, small):
                held.pop()
                held += [(x, take(x)) for x in pair]
                give_back(small, i)
        out.append([i for _, i in held])
    return out


def pieces_of(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID,
              with_ids: bool = False, special_as_text: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, row (tells repeated rows apart); with_ids: ids.
    ``special_as_text=False``: a special token's string inside a text gives the token's id, as
    the library does by default."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from avspark.llm.pieces import library_pieces

        encode = library_pieces(path, False, special_as_text)
        row = 0
        for batch in slices(batches):
            ids, counts = encode(batch.column("text"))
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, end_id).astype("<u4")
            counts = counts + 1
            n = -(-counts // length)
            of = np.repeat(np.arange(len(counts)), n)
            piece = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * length
            size = np.minimum(counts[of] - start, length)
            begin = (np.cumsum(counts) - counts)[of] + start
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * (a + b)]) for a, b in zip(begin, size, strict=True)]
            columns = [batch.column("doc_id").take(pa.array(of)), pa.array(piece.astype(np.int32)), pa.array(start),
                       pa.array(size), pa.array(crc, pa.int64()), pa.array(row + np.arange(len(of)))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "row"]
            row += len(of)
            if with_ids:
                cuts = np.append(begin, len(ids)).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(cuts), pa.array(ids.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, row long"
    return texts(docs).mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))


def packed(pieces: DataFrame, length: int = LENGTH, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """The rows of ``pieces`` (stored, so that it reads the same twice) with sequence_id and offset."""
    groups = max(1, -(-pieces.count() // group_pieces))
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "row"), F.lit(groups)))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "piece", "row"], ignore_index=True)
        bins = pack(rows["length"].tolist(), length)
        order = np.fromiter((i for b in bins for i in b), np.int64, len(rows))
        sizes = np.array([len(b) for b in bins])
        sequence = np.repeat(np.arange(len(bins)), sizes)
        lengths = rows["length"].to_numpy()[order]
        before = np.cumsum(lengths) - lengths
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        out = rows.iloc[order].drop(columns=["group", "row"])
        return out.assign(sequence_id=(int(key[0]) << 32) + sequence, offset=before - before[first])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema if f.name != "row")
    return dealt.groupBy("group").applyInPandas(run, schema + ", sequence_id long, offset long")


def packed_documents(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID,
                     with_ids: bool = False, special_as_text: bool = True) -> DataFrame:
    return packed(stored(pieces_of(docs, path, length, end_id, with_ids, special_as_text), "pieces"), length)


def sequences(packed_ids: DataFrame) -> DataFrame:
    """sequence_id and its ids (at most one sequence's length), from pieces packed with their ids."""
    rows = packed_ids.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return rows.select("sequence_id", F.flatten("parts.ids").alias("ids"))

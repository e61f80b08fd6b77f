"""Context-triggered piecewise hashing: signatures that survive local edits.

A rolling hash of the last seven bytes decides where chunks end; each chunk gives one
character. The block size, three times a power of two, is chosen so that about 64 chunks
arise, and a second signature is made at twice that size. Two fingerprints are compared at
each block size that they share, by edit distance.

Everything is array work over the bytes of one text: linear, and bounded by the text.

Defined results: null text is the empty text, whose fingerprint is ``3::``; two empty texts
are alike (1.0), an empty and another are not (0.0); equal texts have equal fingerprints;
rows that repeat an id are ordered by text; null ids come last in descending order; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from avspark.llm.common import slices, texts

CHUNKS = 64
LEAST_BLOCK = 3
WINDOW = 7
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_LETTERS = np.frombuffer(_ALPHABET.encode(), np.uint8)
_M = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_M, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse (mod 2^64), n of them at least."""
    while len(_powers[0]) < n:
        size = len(_powers[0])
        for k, base in enumerate((_M, _INVERSE)):
            step = np.uint64(pow(base, size, 1 << 64))
            _powers[k] = np.concatenate([_powers[k], _powers[k] * step])
    return _powers[0], _powers[1]


def fingerprint(text: str) -> str:
    """``block:signature:signature at twice the block``."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    n = len(data)
    if not n:
        return f"{LEAST_BLOCK}::"
    wide = data.astype(np.uint32)
    rolling = np.zeros(n, np.uint32)
    for back in range(min(WINDOW, n)):
        rolling[back:] += (wide[: n - back] + np.uint32(1)) * np.uint32(0x01000193 ** (back + 1) % (1 << 32))
    rolling ^= rolling >> np.uint32(15)
    rolling *= np.uint32(0x85EBCA6B)
    rolling ^= rolling >> np.uint32(13)
    power, inverse = _power(n)
    terms = (data.astype(np.uint64) + np.uint64(1)) * power[:n]

    def signature(block: int) -> str:
        ends = np.flatnonzero(rolling % np.uint32(block) == block - 1) + 1
        starts = np.concatenate([[0], ends[ends < n]])
        h = np.add.reduceat(terms, starts) * inverse[starts]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return _LETTERS[(h >> np.uint64(58)).astype(np.int64)].tobytes().decode()

    block = LEAST_BLOCK
    while block * CHUNKS < n:
        block *= 2
    first = signature(block)
    while block > LEAST_BLOCK and len(first) < CHUNKS // 2:
        block //= 2
        first = signature(block)
    return f"{block}:{first}:{signature(2 * block)}"


def edit_distance(a: str, b: str) -> int:
    """Insertions, deletions and replacements; bit-parallel, one step for each letter of b."""
    if not a or not b:
        return len(a) + len(b)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full, last, score = (1 << len(a)) - 1, 1 << len(a) - 1, len(a)
    up, down = full, 0
    for c in b:
        eq = where.get(c, 0)
        x = eq | down
        d = ((((eq & up) + up) ^ up) | eq | down) & full
        h_up, h_down = (down | ~(d | up)) & full, up & d
        score += bool(h_up & last) - bool(h_down & last)
        h_up = (h_up << 1 | 1) & full
        h_down = h_down << 1 & full
        up, down = (h_down | ~(x | h_up)) & full, h_up & x
    return score


def likeness(a: str, b: str) -> float:
    """0 to 1: the best of the block sizes that both have; 1 for equal fingerprints."""
    if a == b:
        return 1.0
    left, right = a.split(":"), b.split(":")
    best = 0.0
    for i in (1, 2):
        for j in (1, 2):
            if int(left[0]) * i == int(right[0]) * j and left[i] and right[j]:
                longest = max(len(left[i]), len(right[j]))
                best = max(best, 1 - edit_distance(left[i], right[j]) / longest)
    return round(best, 6)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = pa.array([fingerprint(t) for t in batch.column("text").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found], ["doc_id", "fingerprint"])

    return texts(docs).mapInArrow(run, "doc_id long, fingerprint string")


def next_to_each_other(docs: DataFrame, bucket_rows: int = 200, most_buckets: int = 100_000) -> DataFrame:
    """Runs of documents in descending id: bucket, is_next, doc_id, text, sorted in partitions.

    A bucket is an interval of ids and also gets, flagged, the document after its last (after
    the last of all: the first). No order over the whole table is made in one task. The driver
    sees one id for each bucket; beyond ``most_buckets`` buckets hold more rows, which are
    sorted on disk and streamed.
    """
    rows = texts(docs)
    low, high, n = rows.agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).first()
    low, high, n = low or 0, high or 0, n or 1
    count = max(1, min(most_buckets, n // bucket_rows))
    width = max(1, -(-(high - low + 1) // count))
    bucket = F.coalesce(F.expr(f"(doc_id - {low}) div {width}"), F.lit(-1))  # null ids come last
    rows = rows.withColumn("bucket", bucket)
    tops = rows.groupBy("bucket").agg(F.max("doc_id").alias("top")).orderBy(F.desc("bucket")).collect()
    heads = docs.sparkSession.createDataFrame(
        [(tops[i]["top"], tops[i - 1]["bucket"]) for i in range(len(tops))], "top long, goes_to long")
    both = rows.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("top")), "left")
    own = F.struct(F.col("bucket"), F.lit(False).alias("is_next"))
    other = F.struct(F.col("goes_to").alias("bucket"), F.lit(True).alias("is_next"))
    places = F.when(F.col("goes_to").isNull(), F.array(own)).otherwise(F.array(own, other))
    return (both.select(F.explode(places).alias("place"), "doc_id", "text")
            .select("place.bucket", "place.is_next", "doc_id", "text")
            .repartition("bucket")
            .sortWithinPartitions("bucket", "is_next", F.desc_nulls_last("doc_id"), "text"))


def edited_text(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many (or all) of another text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness: doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # (bucket, doc_id, text, fingerprint) of a document whose next is awaited
        for batch in slices(batches):
            out = []
            for bucket, is_next, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if is_next and (before is None or before[0] != bucket):
                    continue  # rows that repeat the id of the document already taken
                print_ = fingerprint(text)
                if before is not None:
                    _, own_id, own, own_print = before
                    edited = edited_text(own, text)
                    edited_print = fingerprint(edited)
                    out.append((own_id, len(own), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                                own_print, edited_print, likeness(own_print, edited_print), likeness(own_print, print_)))
                before = None if is_next else (bucket, doc_id, text, print_)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [()] * len(types), types, strict=True)], names)

    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")
    return next_to_each_other(docs).mapInArrow(run, schema)

"""Phrase collocations by prefix-free parsing.

A piece of text (between punctuation marks) is cut into chunks at *triggers*: a chunk boundary is at
each word whose window of :data:`WINDOW` words has a hash that :data:`TRIGGER` divides. The content
alone decides, so that equal passages give equal chunks wherever they stand. A chunk reaches over the
whole window of the boundary that ends it, so that neighbours overlap by WINDOW words, and *owns* the
words before that boundary: a phrase of up to WINDOW + 1 words lies inside the chunk that owns its
first word, and is counted there, once.

1. *Parse*: distinct chunks form a dictionary with their frequencies.
2. *Count*: words, then pairs, then longer phrases are counted inside distinct chunks, weighted. The
   words of a pair that stands ``least`` times do so too, and so do all pairs in a longer phrase: what
   is counted must pass a bit filter of the step before. The filter lets some others pass, never
   loses one; it grows with the phrases up to :data:`FILTER_BITS`, beyond which it only passes more.
   Hashes choose triggers and filter bits only: counts are of the phrases themselves, so they are exact.
3. *Score*: cuts are looked up, phrases that a longer one accounts for are dropped, each language's
   first ``top`` stay. Products are decimals of 38 digits.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from avspark.llm.common import slices, stored

WINDOW, TRIGGER = 4, 16
MAX_WORDS = WINDOW + 1
#: The filter: bits for each phrase, and the most bits there can be (8 MB).
BITS_A_PHRASE, FILTER_BITS = 16, 1 << 26
#: Text laid out at once (16 times as many bytes), and phrases in a task's counter before they are
#: sent on; both bound memory, not results.
_SLICE, _HELD = 1 << 20, 500_000
_LOWER_AND_CUT = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" b".,;:!?\x0a\x0b\x0c\x0d\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 10 + b" ")
_AROUND_CUT, _SPACES = re.compile(rb" *\n[ \n]*"), re.compile(rb"  +")
_FACTOR, _BASE = np.uint64(0x9E3779B97F4A7C15), 0x5851F42D4C957F2D
_powers: dict[str, np.ndarray] = {}


def _powers_to(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    if len(_powers.get("up", ())) < size:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(size, _SLICE), base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"][:size], _powers["down"][:size]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class _Layout:
    """Where the words of ``data`` begin and end; one space or line feed stands between words."""

    def __init__(self, data: bytes):
        text = np.frombuffer(data, np.uint8)
        cut = np.flatnonzero((text == 32) | (text == 10))
        self.data = data
        self.starts, self.ends = np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(text)]])
        ends_line = text[cut] == 10
        self.line = np.concatenate([[0], np.cumsum(ends_line)])
        self.line_starts = np.concatenate([[0], np.flatnonzero(ends_line) + 1])

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        """A hash of each word, from differences of one running polynomial."""
        text = np.frombuffer(self.data, np.uint8)
        up, down = _powers_to(len(text) + 1)
        sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
        return _mixed((sums[self.ends] - sums[self.starts]) * down[self.starts])

    def whole(self, n: int) -> np.ndarray:
        """At which places n words of one line stand."""
        last = max(0, len(self) - n + 1)
        return self.line[:last] == self.line[n - 1 : n - 1 + last]

    def phrases(self, places: np.ndarray, n: int) -> list[bytes]:
        data = self.data
        return [data[b:e] for b, e in zip(self.starts[places].tolist(), self.ends[places + n - 1].tolist(), strict=True)]


def _phrase_hashes(words: np.ndarray, n: int, lang: str) -> np.ndarray:
    """Hash of the n words from each place on at which n words stand."""
    found = np.full(max(0, len(words) - n + 1), zlib.crc32(lang.encode()), np.uint64)
    for i in range(n):
        found = found * _FACTOR + words[i : i + len(found)]
    return _mixed(found)


def _chunks(texts: list[bytes], lang: str) -> tuple[list[bytes], np.ndarray]:
    """The chunks of all pieces of the texts, and how many of its words each owns."""
    data = b"\n".join(texts).translate(_LOWER_AND_CUT)
    data = _SPACES.sub(b" ", _AROUND_CUT.sub(b"\n", data)).strip(b" \n")
    if not data:
        return [], np.empty(0, np.int64)
    at = _Layout(data)
    triggers = np.flatnonzero((_phrase_hashes(at.hashes(), WINDOW, lang) % np.uint64(TRIGGER) == 0) & at.whole(WINDOW))
    begins = np.union1d(at.line_starts, triggers)
    nexts = np.append(begins[1:], len(at))
    line_ends = np.append(at.line_starts[1:], len(at))[at.line[begins]]
    # A chunk that another of its line follows reaches over the whole window of that one's trigger.
    lasts = np.where(nexts < line_ends, nexts + WINDOW, line_ends) - 1
    return [data[b:e] for b, e in zip(at.starts[begins].tolist(), at.ends[lasts].tolist(), strict=True)], nexts - begins


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray]]:
    langs = batch.column("lang").dictionary_encode()
    codes = langs.indices.to_numpy()
    for code, lang in enumerate(langs.dictionary.to_pylist()):
        yield lang, np.flatnonzero(codes == code)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, size=_SLICE):
        for lang, rows in _by_language(batch):
            chunks, owned = _chunks(batch.column("text").take(pa.array(rows)).to_pylist(), lang)
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(lang, len(chunks)), pa.array(chunks, pa.binary()).cast(pa.string()), pa.array(owned, pa.int32())],
                names=["lang", "chunk", "owned"])


def dictionary(docs: DataFrame) -> DataFrame:
    """(lang, chunk, owned, n): distinct chunks, how many of their words they own, how often they stand.

    Null languages are ``und``, null texts empty.
    """
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    parsed = rows.mapInArrow(_parsed, "lang string, chunk string, owned int")
    return parsed.groupBy("lang", "chunk", "owned").agg(F.count(F.lit(1)).alias("n"))


def _places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each hash."""
    mask = np.uint64(bits - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) & mask).astype(np.int64)


def _filter_of(phrases: DataFrame, n: int) -> np.ndarray:
    """Bits of the phrases of n words, as bytes. The driver gets FILTER_BITS of them at most."""
    bits = 1 << 13
    for_each = BITS_A_PHRASE * phrases.count()
    while bits < min(for_each, FILTER_BITS):
        bits *= 2

    def set_bits(batches):
        mine = np.zeros(bits // 8, np.uint8)
        for batch in slices(batches, "phrase", _SLICE):
            for lang, rows in _by_language(batch):
                at = _Layout("\n".join(batch.column("phrase").take(pa.array(rows)).to_pylist()).encode())
                hashes = _phrase_hashes(at.hashes(), n, lang)[at.line_starts]
                for places in _places(hashes, bits):
                    np.bitwise_or.at(mine, places >> 3, np.left_shift(1, places & 7).astype(np.uint8))
        eights = mine.view(np.int64)
        used = np.flatnonzero(eights)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(eights[used])], names=["place", "bits"])

    merged = phrases.select("lang", "phrase").mapInArrow(set_bits, "place long, bits long").groupBy("place").agg(F.bit_or("bits").alias("bits"))
    table = merged.toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[table.column("place").to_numpy()] = table.column("bits").to_numpy()
    return out.view(np.uint8)


def _passing(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    one, two = ((bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1 for p in _places(hashes, len(bits) * 8))
    return (one & two).astype(bool)


def _counter(sizes: range, passing):
    """Counts phrases of ``sizes`` words in chunks; ``passing`` is the broadcast filter of the parts
    of ``sizes.start - 1`` words that each must consist of."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        bits = None if passing is None else passing.value

        def sent():
            for lang, counts in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(lang, len(counts)), pa.array(counts.keys(), pa.binary()).cast(pa.string()), pa.array(counts.values(), pa.int64())],
                    names=["lang", "phrase", "f"])
            held.clear()

        for batch in slices(batches, "chunk", _SLICE):
            for lang, rows in _by_language(batch):
                some = batch.take(pa.array(rows))
                at = _Layout(b"\n".join(some.column("chunk").to_pylist()))
                owned, weight = some.column("owned").to_numpy(), some.column("n").to_numpy()
                good = np.arange(len(at)) - at.line_starts[at.line] < owned[at.line]
                parts = None if bits is None else _passing(_phrase_hashes(at.hashes(), sizes.start - 1, lang), bits)
                counts = held.setdefault(lang, Counter())
                for n in range(1 if parts is None else sizes.start - 1, sizes.stop):
                    # From one size to the next, one more part has to pass.
                    whole = at.whole(n)
                    good = good[: len(whole)] & whole
                    if parts is not None:
                        last = n - sizes.start + 1
                        good &= parts[last : last + len(good)]
                    if n in sizes:
                        places = np.flatnonzero(good)
                        for phrase, f in zip(at.phrases(places, n), weight[at.line[places]].tolist(), strict=True):
                            counts[phrase] += f
            if sum(map(len, held.values())) >= _HELD:
                yield from sent()
        yield from sent()

    return count


def frequent_phrases(chunks: DataFrame, least: int = 100) -> DataFrame:
    """(lang, phrase, words, f): phrases of 1 to MAX_WORDS words that stand ``least`` times or more."""
    rows = chunks.withColumn("chunk", F.col("chunk").cast("binary"))
    levels, passing = [], None
    for sizes in (range(1, 2), range(2, 3), range(3, MAX_WORDS + 1)):
        counted = rows.mapInArrow(_counter(sizes, passing), "lang string, phrase string, f long").groupBy("lang", "phrase").agg(
            F.sum("f").alias("f")).where(F.col("f") >= least)
        level = stored(counted.withColumn("words", F.size(F.split("phrase", " "))), "phrases")
        levels.append(level)
        if sizes.stop > MAX_WORDS or level.isEmpty():
            break
        passing = chunks.sparkSession.sparkContext.broadcast(_filter_of(level, sizes.start))
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    return found.select("lang", "phrase", "words", "f")


def collocations(docs: DataFrame, least: int = 100, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's ``top`` best phrases of 2 to 5 words.

    a counts the phrase, l and r the two parts of its weakest cut, n all words of the language; score
    is floor(1000 a n / (l r)). A phrase inside a longer one that stands as often is dropped. Ties go by
    a, then by the phrase's bytes. Null languages are ``und``; null and empty texts have no words;
    repeated rows count each; an empty table gives no rows; other columns are not looked at. Counts
    may reach 10^15.
    """
    chunks = stored(dictionary(docs), "chunks")
    phrases = stored(frequent_phrases(chunks, least), "phrases")
    total = chunks.groupBy("lang").agg(F.sum(F.col("owned") * F.col("n")).alias("n"))
    candidates = phrases.where("words > 1").withColumnRenamed("f", "a")
    words = F.split("phrase", " ")
    part = lambda begin, size: F.array_join(F.slice("w", begin, size), " ")
    cuts = (
        candidates.withColumn("w", words).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
        .select("lang", "phrase", "words", "a", "k", part(F.lit(1), F.col("k")).alias("first"),
                part(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest")))
    lookup = lambda name, value: phrases.select("lang", F.col("phrase").alias(name), F.col("f").alias(value))
    scored = (
        cuts.join(lookup("first", "l"), ["lang", "first"]).join(lookup("rest", "r"), ["lang", "rest"]).join(total, "lang")
        .withColumn("score", F.expr("(cast(a * 1000 as decimal(18,0)) * cast(n as decimal(19,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(19,0)))")))
    weakest = scored.groupBy("lang", "phrase", "words", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("c")).select("lang", "phrase", "a", "n", "c.score", "c.l", "c.r")
    # A phrase that stands as often as one that holds it also does so with one word less: it is
    # enough to look at the two parts that lack one word.
    inside = (
        candidates.where("words > 2").withColumn("w", words)
        .select("lang", F.explode(F.array(part(F.lit(1), F.col("words") - 1), part(F.lit(2), F.col("words") - 1))).alias("phrase"),
                F.col("a").alias("longer"))
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    kept = weakest.join(inside, ["lang", "phrase"], "left").where("longer IS NULL OR longer < a")
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return kept.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

"""N-gram Jaccard join by PartEnum signatures, and the components of its links.

A document is its set of distinct word n-grams. For a pair with Jaccard similarity of at least
t, sizes differ by a bounded factor and the symmetric difference is at most
(1 - t) / (1 + t) * (|A| + |B|). Sizes are cut into bands, so that in each band that bound is
a number k. The feature domain is cut by hash into n1 parts, so that in one of them the sets
differ in at most k2 features, and each part into n2 smaller ones, of which all but k2 agree
there: a signature for each part and each choice of n2 - k2 of its smaller parts. Sets that
are similar enough share a signature for certain; then the sets themselves are compared.

Sets that are similar enough agree in more than one cell, by a number that the band fixes, so
each set may leave out as many of its signatures: the most frequent ones in an order that is
the same for all (as a prefix filter does), such as those of passages that many documents
share, or of empty cells. Frequencies are counted by hash in FREQUENCIES counters, a table of
fixed size; counters only decide the order, and into how many parts a signature that many
sets share is dealt, never what is found. Signatures have 48 bits, the number of the part
stands above them.

Equal sets are one class, represented by its smallest id. Sets that share a signature are not
compared pairwise: each is compared with one of them, links are joined into components, and
this is repeated with other sets while it finds links. Only sets that are then still in
different components are compared further, each such pair. So no link between components is
lost, while a large group of near copies costs about its size. Every pair first has to pass
two bounds that similar sets always keep: of their sizes, and of their parity sketches (a
feature flips one of SKETCH_BITS bits, so sketches differ in no more bits than sets differ in
features). Feature hashes have 64 bits, set hashes 128.

Defined results: null text and text without words is an empty set, linked with nothing; fewer
words than n give one feature; rows that repeat an id stand for one node; rows with a null id
are linked with nothing and have no component; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from avspark.llm.common import drop, slices, stored, texts
from avspark.llm.components import components

SKETCH_BITS = 512
_SKETCH = [f"s{i}" for i in range(SKETCH_BITS // 64)]
#: The same, longer, made only for sets of pairs: long sets differ in more bits than the other has.
WIDE_BITS = 4096
#: Counters of signature frequencies, sent to every task; a signature in more than PART_ROWS sets is dealt into parts.
FREQUENCIES = 1 << 17
PART_ROWS = 1 << 17
SIGNATURE_BITS = 48
_BLOCK = 1 << 10
_SMALL = 64
_SLICE = 2 << 20

_u = np.uint64
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_space = np.zeros(256, bool)
_space[[32, 9, 10, 11, 12, 13]] = True
_byte = np.random.default_rng(7).integers(0, 1 << 64, 256, np.uint64) | _u(1)
_STEP = 0x9E3779B97F4A7C15


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    x = x + _u((salt * _STEP + 0x632BE59BD9B4E019) % (1 << 64))
    x = (x ^ (x >> _u(30))) * _u(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _u(27))) * _u(0x94D049BB133111EB)
    return x ^ (x >> _u(31))


def word_hashes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word of all texts, in order, and the number of words of each text."""
    text = text.cast(pa.large_string())
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    if offsets[-1] == offsets[0]:
        return np.empty(0, np.uint64), np.zeros(len(text), np.int64)
    data = np.frombuffer(text.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    data = _lower[data]
    space = _space[data]
    first = ~space
    first[1:] &= space[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    first[begins] = ~space[begins]
    starts = np.flatnonzero(first)
    counts = np.diff(np.searchsorted(starts, offsets))
    if not len(starts):
        return np.empty(0, np.uint64), counts
    lengths = np.diff(np.append(starts, len(data)))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, lengths)
    power = np.ones(1, np.uint64)
    while len(power) < lengths.max():
        power = np.concatenate([power, power * _u(pow(_STEP, len(power), 1 << 64))])
    data = data[starts[0] :]
    terms = _byte[data] * power[place]
    terms[space[starts[0] :]] = 0
    return mix(np.add.reduceat(terms, starts - starts[0])), counts


def features(text: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    words, counts = word_hashes(text)
    grams = words[: len(words) - n + 1] if len(words) >= n else words[:0]
    for i in range(1, n):
        grams = mix(grams * _u(_STEP), i) + words[i : i + len(grams)]
    grams = mix(grams, n)
    out, at = [], 0
    for count in counts.tolist():
        if count >= n:
            out.append(np.unique(grams[at : at + count - n + 1]))
        elif count:
            whole = words[at : at + 1]
            for i in range(1, count):
                whole = mix(whole * _u(_STEP), 100 + i) + words[at + i : at + i + 1]
            out.append(mix(whole, 200 + count))
        else:
            out.append(words[:0])
        at += count
    return out


def parity(feature: np.ndarray, bits: int) -> np.ndarray:
    """The parity sketch of a set, as int64 words."""
    odd = np.bincount((mix(feature, 31) % _u(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


class PartEnum:
    """Signatures for Jaccard similarity of at least ``percent`` / 100."""

    def __init__(self, percent: int):
        self.percent = percent
        self.low = [1]  # where bands begin

    def _bands(self, size: int) -> None:
        while self.low[-1] <= size * 100 // self.percent:
            last = self.low[-1]
            self.low.append(max(last + 1, last * 10_000 // self.percent**2))

    def bands(self, size: int) -> list[int]:
        """The band of a set, and the next if larger partners may lie there."""
        self._bands(size)
        own = int(np.searchsorted(self.low, size, "right")) - 1
        return [own, own + 1] if size * 100 // self.percent >= self.low[own + 1] else [own]

    def most_different(self, band: int) -> int:
        """k: the largest symmetric difference of similar sets in the band."""
        self._bands(self.low[band] + 1)
        return 2 * (self.low[band + 1] - 1) * (100 - self.percent) // (100 + self.percent)

    def parts(self, band: int) -> tuple[int, int, int, int]:
        """n1, n2, k2, and how many signatures a set may leave out.

        With two smaller parts each, a signature is one of 2 * n1 cells, and at least
        2 * n1 - k of them agree. If all sets leave out the last 2 * n1 - k - 1 in one order,
        similar sets still share one: of the cells that agree, the first one in that order is
        among those that both keep.
        """
        k = self.most_different(band)
        if not k:
            return 1, 1, 0, 0
        if self.low[band] < _SMALL:
            return -(-(k + 1) // 2), 3, min(k, 1), 0
        n1 = -(-(k + 1 + k // 4) // 2)
        return n1, 2, 1, 2 * n1 - k - 1

    def signatures(self, feature: np.ndarray, frequency: np.ndarray | None = None) -> np.ndarray:
        """All signatures of a set that is not empty, or those that it keeps by ``frequency``."""
        out = []
        for band in self.bands(len(feature)):
            n1, n2, k2, spare = self.parts(band)
            cell = (feature % _u(n1)).astype(np.int64) * n2 + (mix(feature, 11) % _u(n2)).astype(np.int64)
            sums = np.zeros(n1 * n2, np.uint64)
            np.add.at(sums, cell, mix(feature, 12))
            sums = sums.reshape(n1, n2)
            total = sums.sum(1, dtype=np.uint64)
            # k2 is 0 or 1: a choice of n2 - k2 smaller parts leaves out none or one of them.
            kept = total[:, None] - sums if k2 else total[:, None]
            name = np.arange(kept.size, dtype=np.uint64).reshape(kept.shape) + _u(band << 40)
            marks = (mix(mix(kept, 13) + mix(name, 14)).ravel() >> _u(16)).view(np.int64)
            if spare and frequency is not None:
                marks = marks[np.lexsort((marks, frequency[marks % FREQUENCIES]))[: len(marks) - spare]]
            out.append(marks)
        return np.concatenate(out)


def measured(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, size, set_a, set_b (128-bit hash of the set), the sketch; and frequencies.

    A task's frequencies follow in rows of their own: ``block`` (else null) and ``counts``.
    """
    sketch = [pa.field(c, pa.int64()) for c in _SKETCH]
    schema = pa.schema([pa.field(c, pa.int64()) for c in ("doc_id", "size", "set_a", "set_b")] + sketch
                       + [pa.field("block", pa.int64()), pa.field("counts", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        method = PartEnum(percent)
        seen = np.zeros(FREQUENCIES, np.int64)
        for batch in slices(batches, size=_SLICE):
            sets = features(batch.column("text"), n)
            marks = [method.signatures(s) for s in sets if len(s)]
            if marks:
                np.add.at(seen, np.concatenate(marks) % FREQUENCIES, 1)
            total = lambda salt: pa.array(np.array([mix(s, salt).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64))
            bits = np.stack([parity(s, SKETCH_BITS) for s in sets])
            none = [pa.nulls(len(sets), schema.field(c).type) for c in ("block", "counts")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), total(21), total(22),
                 *(pa.array(np.ascontiguousarray(column)) for column in bits.T), *none], schema=schema)
        blocks = seen.reshape(-1, _BLOCK)
        there = np.flatnonzero(blocks.any(1))
        none = [pa.nulls(len(there), pa.int64()) for _ in range(4 + len(_SKETCH))]
        yield pa.RecordBatch.from_arrays(
            [*none, pa.array(there), pa.array([b.tolist() for b in blocks[there]], pa.list_(pa.int64()))], schema=schema)

    columns = ", ".join(f"{c} long" for c in ("doc_id", "size", "set_a", "set_b", *_SKETCH, "block"))
    return texts(docs).mapInArrow(run, f"{columns}, counts array<long>")


def _frequency_of(rows: DataFrame) -> np.ndarray:
    """The FREQUENCIES counters, summed over the tasks of ``measured``."""
    summed = (rows.where("block is not null").select("block", F.posexplode("counts").alias("at", "n")).where("n > 0")
              .groupBy((F.col("block") * _BLOCK + F.col("at")).alias("bucket")).agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(FREQUENCIES, np.int64)
    out[summed.column("bucket").to_numpy()] = summed.column("n").to_numpy()
    return out


def signed(docs: DataFrame, frequency: np.ndarray, n: int, percent: int, part_rows: int = PART_ROWS) -> DataFrame:
    """id and the signatures it keeps, each with the number of its part above SIGNATURE_BITS."""
    shared = docs.sparkSession.sparkContext.broadcast(frequency)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        method, often = PartEnum(percent), shared.value
        deal = np.minimum(often // part_rows, (1 << 14) - 1)
        for batch in slices(batches, size=_SLICE):
            batch = batch.filter(batch.column("doc_id").is_valid())
            sets = features(batch.column("text"), n) if batch.num_rows else []
            marks = [method.signatures(s, often) if len(s) else np.empty(0, np.int64) for s in sets]
            if not marks:
                continue
            sizes = [len(m) for m in marks]
            every = np.concatenate(marks)
            parts = deal[every % FREQUENCIES]
            of = mix(np.repeat(batch.column("doc_id").to_numpy().astype(np.int64).view(np.uint64), sizes), 41)
            part = np.where(parts > 0, (of % (parts + 1).astype(np.uint64)).astype(np.int64) + 1, 0)
            cuts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(cuts), pa.array(every + (part << SIGNATURE_BITS)))],
                ["id", "keys"])

    return texts(docs).mapInArrow(run, "id long, keys array<long>")


def may_be_similar(a: str, b: str, percent: int) -> Column:
    """Whether sizes and sketches (structs of that name) allow similar sets."""
    x, y = F.col(a), F.col(b)
    both = x["size"] + y["size"]
    differ = sum((F.bit_count(x[c].bitwiseXOR(y[c])) for c in _SKETCH[1:]), F.bit_count(x[_SKETCH[0]].bitwiseXOR(y[_SKETCH[0]])))
    return (F.least(x["size"], y["size"]) * 100 >= F.greatest(x["size"], y["size"]) * percent) & (
        differ * (100 + percent) <= both * (100 - percent))


_FILTER_WORDS = 1 << 16


def _filter_of(ids: DataFrame) -> np.ndarray:
    """A bit set of fixed size (4 million bits) in which the bit of every id is set."""
    bits = ids.select(F.pmod(F.xxhash64("id"), F.lit(_FILTER_WORDS * 63)).alias("bit"))
    rows = bits.groupBy(F.expr("bit div 63").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(bit % 63 AS int)))").alias("bits")).collect()
    out = np.zeros(_FILTER_WORDS, np.int64)
    for r in rows:
        out[r["word"]] = r["bits"]
    return out


def sets_of(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """(id, size, wide, features) for ids (column id), read from the texts again.

    A bit set of fixed size spares most other texts the work; some of them come through,
    more when there are many ids, and find no partner in the joins that follow.
    """
    bits = docs.sparkSession.sparkContext.broadcast(_filter_of(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = batch.column("bit").to_numpy()
            there = (bits.value[bit // 63] >> (bit % 63)) & 1
            chosen = batch.filter(pa.array(there.astype(bool)))
            for part in slices(iter([chosen]), size=_SLICE):
                sets = features(part.column("text"), n)
                cuts = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                wide = np.concatenate([parity(s, WIDE_BITS) for s in sets])
                each = np.arange(0, len(wide) + 1, WIDE_BITS // 64, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(each), pa.array(wide)),
                     pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(sets).view(np.int64)))],
                    ["id", "size", "wide", "features"])

    rows = texts(docs).where("doc_id is not null").withColumn("bit", F.pmod(F.xxhash64("doc_id"), F.lit(_FILTER_WORDS * 63)))
    return rows.mapInArrow(run, "id long, size long, wide array<long>, features array<long>")


def verified(pairs: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The stored pairs (a, b) whose sets are similar enough."""
    sets = stored(sets_of(docs, pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), n), "sets")
    small = lambda k: sets.select(F.col("id").alias(k), F.struct("size", "wide").alias(f"of_{k}"))
    differ = F.aggregate(F.zip_with("of_a.wide", "of_b.wide", lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                         F.lit(0), lambda total, x: total + x)
    both = F.col("of_a.size") + F.col("of_b.size")
    likely = stored(
        pairs.join(small("a"), "a").join(small("b"), "b")
        .where(differ * (100 + percent) <= both * (100 - percent)).select("a", "b").distinct(), "likely-pairs")
    # Of the sets, which may be long, only those of likely pairs move.
    of = lambda k: (sets.select(F.col("id").alias(k), F.col("features").alias(f"of_{k}"))
                    .join(likely.select(k).distinct(), k, "left_semi"))
    common_n = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - common_n
    right = stored(
        likely.join(of("a"), "a").join(of("b"), "b").where(100 * common_n >= percent * union).select("a", "b").distinct(), "similar-pairs")
    drop(sets, likely)
    return right


def linked(docs: DataFrame, n: int = 3, percent: int = 90, part_rows: int = PART_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id."""
    return _linked(docs, n, percent, part_rows)[0]


def _linked(docs: DataFrame, n: int, percent: int, part_rows: int = PART_ROWS) -> tuple[DataFrame, list[DataFrame]]:
    """What :func:`linked` returns, and the stored tables that it reads. Others go as soon as nothing reads them."""
    measures = stored(measured(docs, n, percent), "measured")
    frequency = _frequency_of(measures)
    rows = measures.where("block is null")
    classes = stored(
        rows.where("size > 0 and doc_id is not null").groupBy("size", "set_a", "set_b")
        .agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies")).where("copies > 1"), "set-classes")
    of_class = stored(
        rows.where("size > 0 and doc_id is not null").join(classes, ["size", "set_a", "set_b"])
        .select("doc_id", "first_id"), "set-members")
    drop(classes)
    copies = of_class.where("doc_id <> first_id").select("doc_id").distinct()
    sketch = rows.where("size > 0").select(F.col("doc_id").alias("id"), F.struct("size", *_SKETCH).alias("bound"))

    # The only time that all signatures move: those that no other set has end here.
    marks = signed(docs, frequency, n, percent, part_rows).join(copies.withColumnRenamed("doc_id", "id"), "id", "left_anti")
    run = Window.partitionBy("key").orderBy("id")
    members = (marks.select("id", F.explode("keys").alias("key"))
               .select("key", "id", F.first("id").over(run.rowsBetween(Window.unboundedPreceding, 0)).alias("a"),
                       F.lead("id").over(run).alias("next"))
               .where(f"a < id or next > id or key >= {1 << SIGNATURE_BITS}"))
    signature = F.col("key").bitwiseAND(F.lit((1 << SIGNATURE_BITS) - 1)).alias("signature")
    kept = stored(members.select(signature, (F.col("key") >= 1 << SIGNATURE_BITS).alias("dealt"), "id", "a"), "members")
    members = kept
    # A signature dealt into parts: the first sets of its parts meet the first of all.
    parts = members.where("dealt").groupBy("signature", "a").agg(F.lit(1).alias("one"))
    heads = parts.groupBy("signature").agg(F.min("a").alias("head"))
    across = parts.join(heads, "signature").where("a <> head").select(F.col("head").alias("a"), F.col("a").alias("b"))

    def bounded(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b, ...) that sizes and sketches allow."""
        return (pairs.join(sketch.select(F.col("id").alias("a"), F.col("bound").alias("of_a")), "a")
                .join(sketch.select(F.col("id").alias("b"), F.col("bound").alias("of_b")), "b")
                .where(may_be_similar("of_a", "of_b", percent)).select(*pairs.columns))

    pairs = members.where("id <> a").select("a", F.col("id").alias("b")).union(across).distinct()
    pairs = stored(bounded(pairs).distinct(), "pairs")
    tried, all_tried = pairs, [pairs]
    labels = _merged(verified(pairs, docs, n, percent))
    members = members.select("signature", "id")

    turn, last = 0, False
    while True:
        named = members.join(labels, "id", "left").select(
            "signature", "id", F.coalesce("component", "id").alias("component"))
        named = stored(named, "named-members")
        drop(kept)
        split = stored(
            named.groupBy("signature").agg(
                F.min("component").alias("low"), F.max("component").alias("high"),
                F.min_by("id", F.xxhash64("id", F.lit(turn))).alias("star"))
            .where("low < high").select("signature", "star"), "split-signatures")
        members = named.join(split, "signature")
        if last:
            # Sizes and sketches are tested as pairs are made.
            members = kept = stored(members.join(sketch, "id"), "last-members")
            drop(named, split)
            own = members.select("signature", F.col("id").alias("a"), F.col("component").alias("at"), F.col("bound").alias("of_a"))
            other = members.select("signature", F.col("id").alias("b"), F.col("component").alias("to"), F.col("bound").alias("of_b"))
            pairs = own.join(other, "signature").where((F.col("a") < F.col("b")) & may_be_similar("of_a", "of_b", percent))
        else:
            kept = members = stored(members, "members")
            drop(named, split)
            star = members.where("id = star").select("signature", F.col("id").alias("b"), F.col("component").alias("to")).distinct()
            pairs = members.select("signature", F.col("id").alias("a"), F.col("component").alias("at")).join(star, "signature")
        pairs = (pairs.where(F.col("at") != F.col("to"))
                 .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.least("at", "to").alias("at"), F.greatest("at", "to").alias("to"))
                 .distinct().join(tried, ["a", "b"], "left_anti"))
        pairs = stored(pairs if last else bounded(pairs), "pairs")
        all_tried.append(pairs)
        tested = pairs.count()
        found = 0
        if tested:
            right = verified(pairs.select("a", "b"), docs, n, percent)
            joined = stored(pairs.join(right, ["a", "b"]).select(F.col("at").alias("a"), F.col("to").alias("b")).distinct(), "joined")
            drop(right)
            found = joined.count()
            if found:
                merged = _merged(joined)
                moved = merged.select(F.col("id").alias("component"), F.col("component").alias("into"))
                every = labels.union(moved.select("component", "component")).distinct()
                before, labels = labels, stored(every.join(moved, "component", "left").select(
                    "id", F.coalesce("into", "component").alias("component")), "components")
                drop(before, merged)
            else:
                drop(joined)
        if last:
            break
        tried = tried.union(pairs.select("a", "b"))
        turn, last = turn + 1, found * 20 <= tested
        members = members.select("signature", "id")
    drop(kept, *all_tried)

    first = F.coalesce("first_id", "doc_id")
    # A class's members are at most as many as its copies; joins are between stored tables.
    named = rows.join(of_class.distinct(), "doc_id", "left").select("doc_id", "size", first.alias("id"))
    return (named.join(labels, "id", "left")
            .select("doc_id", F.col("size").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")), [measures, of_class, labels])


def _merged(links: DataFrame) -> DataFrame:
    """The components of stored links, stored; the links go."""
    found = components(links)
    drop(links)
    return found


def one_of_each(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """The rows of ``docs``, all columns, without those whose component has a smaller id."""
    found, tables = _linked(docs, n, percent)
    gone = stored(found.where("component_id < doc_id").select(F.col("doc_id").alias("__gone")).distinct(), "near-copies")
    drop(*tables)
    return docs.join(gone, docs["doc_id"].cast("long") == F.col("__gone"), "left_anti")

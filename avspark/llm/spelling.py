"""Spelling variants: exact neighbours at one edit by a dictionary of trie-node pairs.

The words span a trie, their reversals another. Each node has a number, so that a prefix and a suffix
of a word are two integers. For each place i of a word, the pair (prefix of i letters, suffix behind
letter i) says what is left when that letter is skipped, and (prefix of i letters, suffix from letter
i) is a place where one can be inserted. Two words are at one edit exactly if

* they have a skip pair in common (one letter replaced: the same depth of both nodes is the same
  place and the same length), or
* a skip pair of one is an insertion pair of the other (one letter more).

Joins are on two integers and need no check of letters. A skip pair is shared by as many words as the
alphabet has letters, at most, so no group of it can be hot. Nodes above :data:`JOINED` are numbered
by their letters, so that the few nodes near the roots, which hold most words, are never join keys.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from avspark.llm.common import slices, stored

#: Depth from which nodes are numbered by a table; above it their letters are the number.
JOINED = 3
#: Words in a task's counter before they are sent on; bounds memory, not results.
_HELD = 300_000
_LOWER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
_LOWER_BYTES = bytes.maketrans(bytes(_LOWER), bytes(_LOWER.values()))
_RUN = regex.compile("[a-zÀ-ÿ]+")


def _counted(drop_every: int, least_length: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def sent():
            return pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in slices(batches):
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                begin = zlib.crc32(f"{doc_id}:".encode()) if doc_id is not None else zlib.crc32(b":")
                for run, n in Counter(_RUN.findall(text.translate(_LOWER_BYTES).decode())).items():
                    if drop_every and len(run) >= least_length:
                        h = zlib.crc32(run.encode(), begin)
                        if h % drop_every == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1 :]
                    if len(run) >= least_length:
                        held[run] += n
            if len(held) >= _HELD:
                yield sent()
                held.clear()
        if held:
            yield sent()

    return count


def words(docs: DataFrame, least_length: int = 6, least_count: int = 5, drop_every: int = 0) -> DataFrame:
    """(word, n): runs of letters (Latin, A-Z in lower case) and how often they stand.

    ``drop_every`` plants misspellings: if it divides the crc32 of ``<doc_id>:<run>``, that run of the
    document loses the letter at crc32 % length. Null ids are empty in that key, null texts have no runs.
    """
    rows = docs.where(F.col("text").isNotNull()).select(
        F.col("doc_id").cast("string").alias("id"), F.col("text").cast("string").cast("binary").alias("text"))
    return (
        rows.mapInArrow(_counted(drop_every, least_length), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least_count))


def _letters(text: Column, size: Column) -> Column:
    """Number of a node above JOINED: its letters as digits; the root is 0."""
    code = lambda i: F.when(size > i, F.ascii(F.substring(text, i + 1, 1)).cast("long")).otherwise(0)
    number = code(0)
    for i in range(1, JOINED):
        number = number * 65536 + code(i)
    return number


def _numbered(rows: DataFrame, text: str, node: str) -> DataFrame:
    """``rows`` with the number of the trie node that each ``text`` leads to."""
    size = F.char_length(text)
    deep = rows.where(size >= JOINED)
    table = stored(
        deep.select(text).distinct().withColumn(node, F.lit(1 << 50) + F.monotonically_increasing_id()), "trie")
    near = rows.where(size < JOINED).withColumn(node, _letters(F.col(text), size)).drop(text)
    return near.unionByName(deep.join(table, text).drop(text))


def neighbours(vocabulary: DataFrame) -> DataFrame:
    """(id, other, other_n), both ways: words of ``vocabulary`` (id, word, n) at exactly one edit."""
    length = F.char_length("word")
    at = lambda last: F.explode(F.sequence(F.lit(0), last)).alias("i")
    fore = vocabulary.select("id", "n", "word", at(length)).select("id", "n", "i", F.substring("word", F.lit(1), F.col("i")).alias("part"))
    # A suffix from letter i ends the insertion pair of place i and the skip pair of place i - 1.
    back = vocabulary.select("id", "word", at(length)).select("id", "i", F.col("word").substr(F.col("i") + 1, length).alias("part"))
    prefixes = _numbered(fore, "part", "fore")
    suffixes = stored(_numbered(back, "part", "back"), "suffixes")
    prefixes = stored(prefixes, "prefixes")
    inserted = prefixes.join(suffixes, ["id", "i"]).select("fore", "back", "id", "n")
    skipped = prefixes.join(suffixes.withColumn("i", F.col("i") - 1), ["id", "i"]).select("fore", "back", "id", "n")
    inserted, skipped = stored(inserted, "insertions"), stored(skipped, "skips")
    other = skipped.select("fore", "back", F.col("id").alias("other"), F.col("n").alias("other_n"))
    replaced = skipped.join(other, ["fore", "back"]).where("id <> other").select("id", "other", "other_n")
    one_more = skipped.join(inserted.withColumnsRenamed({"id": "other", "n": "other_n"}), ["fore", "back"])
    longer = one_more.select("id", "n", "other", "other_n")
    return (
        replaced.unionByName(longer.select("id", "other", "other_n"))
        .unionByName(longer.select(F.col("other").alias("id"), F.col("id").alias("other"), F.col("n").alias("other_n")))
        # In a run of one letter several skips leave the same.
        .distinct())


def _roots(forms: DataFrame) -> DataFrame:
    """(id, root): where the forms of (id, form) lead to. Paths halve each round.

    A form is several times as frequent as its word, so that paths cannot close and are short: some
    log2 of the number of steps from the rarest to the most frequent word are the rounds.
    """
    ends = stored(forms.select("id", F.coalesce("form", "id").alias("root")), "roots")
    while True:
        via = ends.select(F.col("id").alias("root"), F.col("root").alias("further"))
        further = stored(
            ends.join(via, "root").select("id", F.col("further").alias("root"), (F.col("further") != F.col("root")).alias("moved")), "roots")
        if further.where("moved").isEmpty():
            return further.select("id", "root")
        ends = further.select("id", "root")


def variants(vocabulary: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each word of ``vocabulary`` (word, n).

    n_near counts the words at one edit (one letter inserted, deleted or replaced). The form is the
    most frequent of them, the first in code-point order of equally frequent ones, if it is at least
    ``ratio`` (2 or more) times as frequent; the root is where forms lead to, the word itself if it
    has none. Rows that repeat a word count together; null words go; an empty table gives no rows.
    """
    whole = vocabulary.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    # Ids rise with the words, so that the smaller id is the first in code-point order.
    listed = stored(whole.orderBy("word").withColumn("id", F.monotonically_increasing_id()), "words")
    near = neighbours(listed).groupBy("id").agg(
        F.count(F.lit(1)).alias("n_near"), F.max(F.struct(F.col("other_n").alias("n"), (-F.col("other")).alias("back"))).alias("best"))
    rated = listed.join(near, "id", "left").withColumn("fits", F.coalesce(F.col("best.n") >= ratio * F.col("n"), F.lit(False)))
    formed = stored(rated.select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("fits"), -F.col("best.back")).alias("form"), F.when(F.col("fits"), F.col("best.n")).alias("form_n")), "forms")
    names = lambda key, name: listed.select(F.col("id").alias(key), F.col("word").alias(name))
    return (
        formed.join(_roots(formed), "id").join(names("root", "root_word"), "root").join(names("form", "form_word"), "form", "left")
        .select("word", "n", "n_near", F.col("form_word").alias("form"), "form_n", F.col("root_word").alias("root")))


def groups(found: DataFrame) -> DataFrame:
    """(root, n_words, n): the groups that ``variants`` gives, with all their occurrences."""
    return found.groupBy("root").agg(F.count(F.lit(1)).alias("n_words"), F.sum("n").alias("n"))

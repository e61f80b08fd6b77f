"""Exact dedup: group by a 128-bit content hash, keep the smallest id, compare bytes inside groups.

Texts count as equal when they are identical after each run of ASCII white space became one
space. Only ids and hashes are grouped, so a hot group costs no more than a cold one; texts
move only for rows whose hash occurs twice, each to the row that its group keeps; a large group
meets copies of that row's text in parts of about ``GROUP_ROWS`` rows. Rows whose bytes differ from that row's (hash collisions) are grouped anew by their whole text.

Defined results: null text is the empty text; an empty table gives an empty result; rows that
repeat an id are rows like any other; a null id sorts after all others, so a group keeps it
only if it has no other; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from avspark.llm.common import drop, stored, texts


#: About as many rows of a group are compared with the kept row in one place.
GROUP_ROWS = 500


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space. A lone space needs no replacement."""
    return F.regexp_replace(text, r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def content_hash(text: Column) -> Column:
    """128 bits."""
    return F.unhex(F.md5(F.encode(text, "UTF-8")))


def exact_groups(docs: DataFrame, hashed: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    ``hashed`` may be replaced to force collisions; the result does not depend on it.
    """
    return _grouped(docs, hashed)[0]


def _grouped(docs: DataFrame, hashed: Callable[[Column], Column]) -> tuple[DataFrame, list[DataFrame]]:
    """What :func:`exact_groups` returns, and the stored tables that it reads."""
    rows = texts(docs).select("doc_id", normalised(F.col("text")).alias("text"))
    keyed = stored(
        rows.select("doc_id", hashed(F.col("text")).alias("hash"), F.sha2("text", 256).alias("text_sha256"))
        .withColumn("row", F.monotonically_increasing_id()), "exact-keys")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("keep")
    groups = stored(
        keyed.groupBy("hash").agg(first, F.count("*").alias("size")).where("size > 1"), "exact-groups")

    # The texts of rows in groups, beside the text of the row that the group keeps. The join is stored
    # before rows that repeat an id become one, so that a hot hash can be split in it.
    parts = F.ceil(F.col("size") / GROUP_ROWS).cast("int")
    in_groups = stored(keyed.join(groups, "hash").select(
        "doc_id", "hash", "text_sha256", F.col("keep.doc_id").eqNullSafe(F.col("doc_id")).alias("is_keeper"),
        parts.alias("parts"), F.pmod(F.xxhash64("doc_id", "text_sha256"), parts).cast("int").alias("part")),
        "exact-in-groups")
    members = in_groups.distinct()
    found = stored(
        rows.alias("r").join(
            members.alias("m"),
            F.col("r.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.sha2("r.text", 256) == F.col("m.text_sha256")))
        .select("m.*", "r.text"), "exact-members")
    keepers = stored(
        found.where("is_keeper").groupBy("hash").agg(F.min("text").alias("keep_text"), F.max("parts").alias("parts"))
        .select("hash", "keep_text", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")), "exact-keepers")
    differing = stored(
        found.join(keepers, ["hash", "part"]).where(F.col("text") != F.col("keep_text"))
        .select("doc_id", "hash", "text_sha256", "text").distinct(), "exact-collisions")
    drop(in_groups, found, keepers)

    # Almost always empty: rows that share the hash, not the bytes, of the row kept.
    apart = keyed.alias("k").join(
        differing.alias("d"),
        F.col("k.doc_id").eqNullSafe(F.col("d.doc_id")) & (F.col("k.hash") == F.col("d.hash"))
        & (F.col("k.text_sha256") == F.col("d.text_sha256"))).select("k.*", "d.text")
    own = stored(
        apart.groupBy("hash", "text").agg(
            first.alias("own"), F.count("*").alias("own_size"), F.first("text_sha256").alias("text_sha256"))
        .drop("text"), "exact-own-groups")
    drop(differing)
    lost = own.groupBy("hash").agg(F.sum("own_size").alias("lost"))
    sizes = stored(
        groups.join(lost, "hash", "left")
        .select("hash", "keep", (F.col("size") - F.coalesce("lost", F.lit(0))).alias("size")), "exact-sizes")
    drop(groups)
    keep = F.coalesce("own", "keep")
    return (
        keyed.join(sizes, "hash", "left").join(own, ["hash", "text_sha256"], "left")
        .select("doc_id", F.when(keep.isNull(), F.col("doc_id")).otherwise(keep["doc_id"]).alias("keep_id"),
                F.coalesce("own_size", "size", F.lit(1)).cast("long").alias("group_size"),
                F.coalesce(keep["row"] == F.col("row"), F.lit(True)).alias("kept"), "text_sha256")
    ), [keyed, sizes, own]


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that exact dedup keeps."""
    found, tables = _grouped(docs, content_hash)
    kept = stored(found.where("kept").select(
        F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")), "exact-kept")
    drop(*tables)
    # The table's own columns travel as one struct, so that none can clash with ours.
    tagged = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own"), F.col("doc_id").cast("long").alias("__id"),
        F.sha2(normalised(F.coalesce(F.col("text").cast("string"), F.lit(""))), 256).alias("__sha"))
    joined = tagged.alias("t").join(
        kept.alias("k"),
        F.col("t.__id").eqNullSafe(F.col("k.__id")) & (F.col("t.__sha") == F.col("k.__sha")), "left_semi")
    order = Window.partitionBy("__id", "__sha").orderBy("own.text")
    return joined.withColumn("__n", F.row_number().over(order)).where("__n = 1").select("own.*")

"""What several operators share: reading documents, shared folders, bounded Arrow slices."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from avspark.session import new_path

#: Text handled at once inside a task; bounds its memory, never its result.
SLICE_BYTES = 4 << 20
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with null texts as empty ones; other columns cannot clash with ours."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors.

    The write's shuffle files go when it is done, not when the driver next collects its garbage.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def drop(*tables: DataFrame) -> None:
    """Deletes what :func:`stored` wrote for these tables, which nothing may read any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def in_set(column: Column, values: list) -> Column:
    return column.isin(values) if values else F.lit(False)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``size`` bytes of text, one row at least.

    Arrow keeps memory that is free for later; workers share an executor's, so it goes back after each batch.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
        begin, held = 0, 0
        for row, own in enumerate(sizes):
            if held and held + own > size:
                yield batch.slice(begin, row - begin)
                begin, held = row, 0
            held += own
        yield batch.slice(begin)
        pa.default_memory_pool().release_unused()

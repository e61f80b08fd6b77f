"""Parquet and CSV tables, named views, and idempotent loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from avspark import schemas

_CSV = {"header": "true", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}


def to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast to a stored table's columns and types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_perf_flights(
    flights: DataFrame, path: str, rows_per_group: int = 200_000, partition_by: str | None = "year"
) -> None:
    """Snappy parquet, partitioned so that period filters skip whole folders.

    Rows are rebalanced on the partition column first: one writer per folder where the
    folder is small, several where it is large (AQE splits a year that holds most rows),
    so the job writes neither thousands of tiny files nor one huge one.
    """
    out = to_schema(flights, schemas.PERF_FLIGHTS)
    if partition_by:
        out = out.hint("rebalance", F.col(partition_by))
    writer = out.write.option("compression", "snappy").option(
        "parquet.block.row.count.limit", str(rows_per_group)
    )
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def perf_flights_view(spark: SparkSession, path: str, name: str = "flights") -> DataFrame:
    """Register stored flights as a view for SQL; no schema inference, no data read."""
    spark.read.schema(schemas.PERF_FLIGHTS).parquet(path).createOrReplaceTempView(name)
    return spark.table(name)


def write_flights_csv(flights: DataFrame, path: str) -> None:
    to_schema(flights, schemas.OPS_FLIGHTS).write.options(**_CSV).csv(path)


def read_flights_csv(spark: SparkSession, path: str) -> DataFrame:
    """Typed scan: the schema is declared, so the text is read once."""
    return spark.read.schema(schemas.OPS_FLIGHTS).options(**_CSV).csv(path)


def append_missing(source: DataFrame, target_path: str, key: str) -> None:
    """Add only rows whose key the target does not hold; running it twice adds nothing.

    Rows without a key cannot be told apart and are not added; of rows that repeat a key, one is.
    """
    spark = source.sparkSession
    source = source.where(source[key].isNotNull()).dropDuplicates([key])
    try:
        present = spark.read.parquet(target_path).select(key)
        source = source.join(present, key, "left_anti")
    except Exception as error:  # the target does not exist before the first load
        if "PATH_NOT_FOUND" not in str(error):
            raise
    source.write.mode("append").parquet(target_path)

import pytest
from pyspark.sql import functions as F

#: Awkward rows: null text and id, empty, repeats, ties, long texts, clashing columns.
ODD = [
    (3, "a  b\tc"), (1, "a b c"), (None, "a b c"), (7, None), (8, ""), (5, "x" * 30000), (5, "x" * 30000),
    (6, "Ünïcode … ſt K 😀 \x00 end"), (9, " lead  and trail \n\n"), (10, "<|endoftext|> a<|startoftext|>"),
    (11, "one two  three\x1cfour"), (12, "it's 12345 we'll"), (13, "word " * 3000),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = spark.createDataFrame(ODD, "doc_id long, text string")
    return rows.withColumns({"hash": F.lit(1), "row": F.lit("x"), "keep_id": F.lit(2.0), "bucket": F.lit(0),
                             "lang": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long")})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def plain(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}

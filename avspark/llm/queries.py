"""The registered queries of this subpackage, one for each operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from avspark.llm import (
    bpe_job, collocations, exact_dedup, fingerprints, language, licenses, line_dedup, ngram_join, packing, pii, shards, spelling, topk)
from avspark.llm.common import documents


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.repeated_lines(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"),
        F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"))


OP1_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS line_no
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), sets AS MATERIALIZED (
  SELECT doc_id, line_no, list_sort(list_distinct(list_filter(
    regexp_split_to_array(lower(line), '[\x20\x09-\x0D]+'), lambda x: x <> ''))) AS s FROM lines
), firsts AS MATERIALIZED (
  SELECT s, min((doc_id, line_no)) AS f, row_number() OVER (ORDER BY min((doc_id, line_no))) AS c, len(s) AS n
  FROM sets WHERE len(s) > 0 GROUP BY s
), words AS MATERIALIZED (SELECT c, n, unnest(s) AS w FROM firsts),
counted AS (SELECT c, n, w, count(*) OVER (PARTITION BY w) AS freq FROM words),
prefix AS MATERIALIZED (
  SELECT c, n, w FROM (SELECT *, row_number() OVER (PARTITION BY c ORDER BY freq, w) AS i FROM counted)
  WHERE i <= n - (n * 4 + 4) // 5 + 1
), pairs AS (
  SELECT DISTINCT a.c AS later, b.c AS earlier FROM prefix a JOIN prefix b ON a.w = b.w AND b.c < a.c
    AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
), gone AS (
  SELECT DISTINCT later FROM pairs JOIN firsts x ON x.c = later JOIN firsts y ON y.c = earlier
  WHERE 5 * len(list_intersect(x.s, y.s)) >= 4 * (x.n + y.n - len(list_intersect(x.s, y.s)))
), removed AS (
  SELECT s.doc_id, s.line_no FROM sets s JOIN firsts f ON s.s = f.s
  WHERE (s.doc_id, s.line_no) <> f.f OR f.c IN (SELECT later FROM gone)
)
SELECT d.doc_id, len(string_split(coalesce(d.text, ''), chr(10)))::BIGINT AS n_lines,
  count(r.line_no) AS n_removed, coalesce(string_agg(r.line_no, ',' ORDER BY r.line_no), '') AS removed
FROM documents d LEFT JOIN removed r ON r.doc_id = d.doc_id GROUP BY d.doc_id, d.text
"""


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared(documents(spark, sf_dir))


def op3_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, table = shards.write(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), special_as_text=False)
    return shards.read(spark, folder, table)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op4_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.with_spans(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"].isin(list(pii.BASE)))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in pii.BASE],
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
        *[count(k).alias(f"n_{k}") for k in pii.ADDED], F.size("spans").cast("long").alias("n_spans"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(documents(spark, sf_dir))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked(documents(spark, sf_dir))


OP6_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM words
), classes AS MATERIALIZED (
  SELECT s, min(doc_id) AS id, len(s) AS n FROM (SELECT doc_id, list_sort(s) AS s FROM sets) WHERE len(s) > 0 GROUP BY s
), grams AS (SELECT id, n, unnest(s) AS g FROM classes),
pairs AS (
  SELECT a.id AS a, b.id AS b FROM grams a JOIN grams b ON a.g = b.g AND a.id < b.id
    AND 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n)
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), links AS MATERIALIZED (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach AS (SELECT a AS id, a AS other FROM links UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a),
least_id AS (SELECT id, min(other) AS component FROM reach GROUP BY id)
SELECT d.doc_id, len(d.s)::BIGINT AS n_shingles, coalesce(l.component, c.id, d.doc_id) AS component_id
FROM sets d LEFT JOIN classes c ON list_sort(d.s) = c.s LEFT JOIN least_id l ON l.id = c.id
"""


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_job.encoded(
        documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, digests=True)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


OP8_SQL = r"""
WITH rows AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(text) AS text_sha256
FROM rows WINDOW same AS (PARTITION BY text)
"""


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), special_as_text=False)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language.fit(docs, ~held_out())
    told = language.identified(docs.select("doc_id", "text"), model)
    return told.select(
        "doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), F.col("lang_rejected").alias("rejected"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.words(documents(spark, sf_dir), drop_every=199))


# crc32 byte by byte; its table of 256 entries comes from the polynomial.
OP11_SQL = r"""
WITH RECURSIVE crc(i, k, c) AS (
  SELECT i, 0, i FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc WHERE k < 8
), steps AS (SELECT list(c ORDER BY i) AS t FROM crc WHERE k = 8),
runs AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_transform(range(1, octet_length(b) + 1), lambda i: ('0x' || substr(x, 2 * i - 1, 2))::BIGINT),
      lambda h, byte: xor(h >> 8, t[xor(h & 255, byte) + 1]), 4294967295)) AS h
  FROM (SELECT *, encode(coalesce(doc_id::VARCHAR, '') || ':' || run) AS b, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs), steps
), vocabulary AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN run[:(h % length(run))::INT] || run[(h % length(run))::INT + 2:] ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), skips AS MATERIALIZED (
  SELECT word, n, i, word[:i] || word[i + 2:] AS rest FROM (SELECT *, unnest(range(length(word))) AS i FROM vocabulary)
), near AS MATERIALIZED (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM skips a JOIN skips b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT s.word, s.n, v.word, v.n FROM skips s JOIN vocabulary v ON s.rest = v.word
  UNION SELECT v.word, v.n, s.word, s.n FROM skips s JOIN vocabulary v ON s.rest = v.word
), formed AS MATERIALIZED (
  SELECT v.word, v.n, coalesce(c.n_near, 0) AS n_near, CASE WHEN o.other_n >= 5 * v.n THEN o.other END AS form,
    CASE WHEN o.other_n >= 5 * v.n THEN o.other_n END AS form_n
  FROM vocabulary v LEFT JOIN (SELECT word, count(*) AS n_near FROM near GROUP BY word) c USING (word)
  LEFT JOIN (SELECT word, other, other_n FROM near
    QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) = 1) o USING (word)
), chain(word, root, form) AS (
  SELECT word, word, form FROM formed
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON c.form = f.word
)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, c.root FROM formed f JOIN chain c ON c.word = f.word AND c.form IS NULL
"""


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM (
    SELECT lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), grams AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM pieces, range(1, 6) t(m))
), phrases AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
candidates AS MATERIALIZED (SELECT lang, m, phrase, string_split(phrase, ' ') AS w, f AS a FROM phrases WHERE m > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.a, t.n, k, x.f AS l, y.f AS r,
    ((1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates) c
  JOIN phrases x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[:k], ' ')
  JOIN phrases y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')
  JOIN totals t ON t.lang = c.lang
), weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
parts AS (
  SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, m - s + 2)) AS i FROM candidates, range(2, 5) t(s) WHERE s < m) GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM weakest LEFT JOIN parts USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a
QUALIFY rank <= 2000
"""


def op13_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.top_k(vectors, F.col("vec_id") % 100 == 0).withColumnRenamed("id", "vec_id")


OP13_SQL = """
WITH vectors AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, d.vec_id, list_dot_product(q.v, d.v)::BIGINT AS score,
    row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.v, d.v) DESC, d.vec_id) AS rank
  FROM vectors q JOIN vectors d ON q.vec_id <> d.vec_id WHERE q.vec_id % 100 = 0)
WHERE rank <= 10
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_line_dedup, op2_document_fingerprints, op3_token_shards, op4_pii_spans, op5_license_scan, op6_ngram_jaccard_join, op7_bpe_round_trip, op8_exact_dedup,
        op9_best_fit_packing, op10_language_id, op11_spelling_variants, op12_phrase_collocations, op13_exact_top_k)
}
ORACLE: dict[str, str] = {
    "op1_line_dedup": OP1_SQL, "op6_ngram_jaccard_join": OP6_SQL, "op8_exact_dedup": OP8_SQL, "op11_spelling_variants": OP11_SQL,
    "op12_phrase_collocations": OP12_SQL, "op13_exact_top_k": OP13_SQL}

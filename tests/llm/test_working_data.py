"""Working tables and shuffle files go as soon as nothing reads them; what is stored is little."""

import os
import random
import time

from pyspark.sql import functions as F

from avspark.llm import common, exact_dedup, line_dedup, ngram_join
from avspark.session import work_dir
from tests.llm.test_line_and_license import got_removed, want_removed


def tables(spark):
    return set(os.listdir(work_dir(spark)))


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {files.apply(i).getName() for i in range(files.size())}
    return {n for n in names if n.startswith("shuffle_")}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(common._CLEANUP)
    rows = spark.range(2000).select(F.xxhash64("id").alias("h"), "id")
    table = common.stored(rows.groupBy("h").agg(F.max("id").alias("id")).join(rows.withColumnRenamed("id", "same"), "h"), "cleaned")
    for _ in range(50):  # they go beside the job
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert table.count() == 2000 and spark.conf.get(common._CLEANUP) == setting
    common.drop(table)
    assert not os.path.exists(table.stored_at)


def texts_with_copies(spark):
    rng = random.Random(5)
    rows = []
    for d in range(30):
        words = [f"w{rng.randrange(4000)}" for _ in range(60)]
        rows += [(3 * d, " ".join(words)), (3 * d + 1, " ".join(words)), (3 * d + 2, " ".join([*words[:-1], "end"]))]
    return spark.createDataFrame(rows, "doc_id long, text string")


def left_by(spark, work):
    """The labels of the tables that are left."""
    before = tables(spark)
    result = work()
    rows = result.collect()
    return rows, sorted(t.rsplit("-", 1)[0] for t in tables(spark) - before)


def test_joins_leave_only_what_their_result_reads(spark):
    docs = texts_with_copies(spark)
    rows, left = left_by(spark, lambda: ngram_join.one_of_each(docs))
    assert sorted(r.doc_id for r in rows) == [3 * d for d in range(30)] and left == ["near-copies"]
    rows, left = left_by(spark, lambda: ngram_join.linked(docs))
    assert all(r.component_id == r.doc_id // 3 * 3 for r in rows) and left == ["components", "measured", "set-members"]
    rows, left = left_by(spark, lambda: exact_dedup.without_copies(docs))
    assert sorted(r.doc_id for r in rows) == sorted(i for d in range(30) for i in (3 * d, 3 * d + 2)) and left == ["exact-kept"]
    rows, left = left_by(spark, lambda: exact_dedup.exact_groups(docs))
    assert len(rows) == 90 and left == ["exact-keys", "exact-own-groups", "exact-sizes"]


def test_lines_that_only_share_words_are_not_stored(spark, monkeypatch):
    """Sets of words are stored for lines that may have a similar one, not for all that share a key."""
    rng = random.Random(8)
    rows = [(d, " ".join(f"w{rng.randrange(300)}" for _ in range(40))) for d in range(300)]
    rows += [(300, rows[7][1] + " more")]
    stored, sizes = line_dedup.stored, {}
    def noted(df, label):
        out = stored(df, label)
        sizes[label] = max(sizes.get(label, 0), out.count())
        return out
    monkeypatch.setattr(line_dedup, "stored", noted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found, left = left_by(spark, lambda: line_dedup.repeated_lines(docs))
    assert {r.doc_id for r in found if r.removed} == {300} and left == ["removed-lines"]
    assert sizes["line-words"] < 30


def test_long_lines_against_brute_force(spark):
    """Of sizes where sketches are nearly full, at and around the bound."""
    rng = random.Random(13)
    rows = []
    for d in range(40):
        size = rng.choice([30, 90, 150, 400])
        base = [f"b{size}x{i}" for i in range(size)]
        for j in rng.sample(range(size), rng.randrange(size // 7)):
            base[j] = f"o{rng.randrange(10**6)}"
        rows.append((d, "\n".join([" ".join(base), " ".join(base[: size * rng.choice([80, 81, 90]) // 100])])))
    for percent in (80, 90):
        got = line_dedup.repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), percent)
        want = want_removed(rows, percent)
        assert got_removed(got) == want and 5 < sum(w.endswith("[1])") or w.endswith("[0])") or w.endswith("[0, 1])") for w in want)

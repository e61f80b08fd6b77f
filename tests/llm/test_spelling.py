"""Words, neighbours, forms and roots against plain Python."""

import re
import zlib
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from avspark.llm import queries, spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(rows, least_length=6, least_count=5, drop_every=199):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if drop_every and h % drop_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least_length:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least_count}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts, ratio=5):
    rows, forms = {}, {}
    for w, n in counts.items():
        near = [o for o in counts if one_edit(w, o)]
        best = min(near, key=lambda o: (-counts[o], o), default=None)
        forms[w] = best if best and counts[best] >= ratio * n else None
        rows[w] = (n, len(near), forms[w], counts[forms[w]] if forms[w] else None)
    def root(w):
        while forms[w]:
            w = forms[w]
        return w
    return {(w, *r, root(w)) for w, r in rows.items()}


def result(found):
    return {tuple(r) for r in found.select("word", "n", "n_near", "form", "form_n", "root").collect()}


def test_odd_documents(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    rows += [(i, "Straße STRASSE straßen Größen grössen ÀÉÎÕÜ×÷ abcdefg") for i in range(600)] + [(None, "abcdefg " * 9)]
    docs = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows[-601:], "doc_id long, text string"))
    for drop_every in (0, 7, 199):
        plain = plain_words(rows, drop_every=drop_every)
        counted = spelling.words(docs, drop_every=drop_every)
        assert {tuple(r) for r in counted.collect()} == set(plain.items())
        assert any(one_edit(w, "abcdefg") for w in plain) == (drop_every == 7)  # letters were taken out
        assert result(spelling.variants(counted)) == plain_variants(plain)
    assert spelling.variants(spelling.words(no_docs)).collect() == []


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.text("abÿ", min_size=1, max_size=5), st.integers(1, 200), min_size=1, max_size=60))
def test_short_alphabet(spark, counts):
    """Runs of one letter, words of one letter, long chains of forms, ties."""
    vocabulary = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert result(spelling.variants(vocabulary, 2)) == plain_variants(counts, 2)


def test_repeated_null_and_long_words(spark):
    long_word = "x" * 3000
    rows = [("abcdef", 3), ("abcdef", 4), (None, 9), ("abcdefg", 40), (long_word, 5), (long_word + "y", 90)]
    vocabulary = spark.createDataFrame([(w, n, 1) for w, n in rows], "word string, n long, id int")
    assert result(spelling.variants(vocabulary)) == plain_variants({"abcdef": 7, "abcdefg": 40, long_word: 5, long_word + "y": 90})


def test_groups(spark):
    vocabulary = spark.createDataFrame([("abcdef", 500), ("abcde", 80), ("abcd", 10), ("zzzzzz", 1)], "word string, n long")
    found = {r.root: (r.n_words, r.n) for r in spelling.groups(spelling.variants(vocabulary)).collect()}
    assert found == {"abcdef": (3, 590), "zzzzzz": (1, 1)}


def test_whole_table(spark, sf_dir, docs):
    plain = plain_words([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert result(queries.op11_spelling_variants(spark, sf_dir)) == plain_variants(plain)

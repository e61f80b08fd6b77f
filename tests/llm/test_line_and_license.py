"""Line dedup and the license scan against brute force."""

import random
import re

import duckdb

from avspark.llm import licenses, line_dedup, queries
from tests.llm.conftest import ODD


def want_removed(rows, percent=80):
    last = max([d for d, _ in rows if d is not None], default=0) + 1
    lines = []
    for d, t in rows:
        for i, line in enumerate((t or "").split("\n")):
            words = frozenset(w for w in re.split(r"[\x20\x09-\x0D]+", line.lower()) if w)
            lines.append(((last if d is None else d, i), words))
    gone = {place for place, x in lines for other, y in lines
            if x and y and other < place and 100 * len(x & y) >= percent * len(x | y)}
    return sorted(str((d, len((t or "").split("\n")), [i for i in range(len((t or "").split("\n"))) if (last if d is None else d, i) in gone])) for d, t in rows)


def got_removed(df):
    return sorted(str((r.doc_id, r.n_lines, list(r.removed))) for r in df.collect())


def test_lines_of_frequent_words_and_near_copies(spark):
    rng = random.Random(11)
    common, rows = [f"c{i}" for i in range(12)], []
    base = [f"w{i}" for i in range(25)]
    for d in range(60):
        lines = [" ".join(rng.choice(common) for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 9]))) for _ in range(6)]
        near = list(base)
        for _ in range(rng.randrange(5)):
            near[rng.randrange(25)] = f"x{rng.randrange(1000)}"
        lines += [" ".join(near), "", " ".join(rng.sample(base, 20)), "Same  LINE of words here"]
        rng.shuffle(lines)
        rows.append((d * 7, "\n".join(lines)))
    for percent in (80, 90):
        got = line_dedup.repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), percent)
        assert got_removed(got) == want_removed(rows, percent)


def test_lines_of_odd_rows(odd_docs, no_docs):
    assert got_removed(line_dedup.repeated_lines(odd_docs)) == want_removed(ODD)
    assert line_dedup.repeated_lines(no_docs).count() == 0
    out = line_dedup.without_repeats(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == len(ODD)


def test_removed_lines_leave_the_text(spark):
    rows = [(1, "a b c d e\nkeep one"), (2, "new\na b c d e\nnew\nlast"), (3, None)]
    out = line_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, out.collect())) == [(1, "a b c d e\nkeep one"), (2, "new\nlast"), (3, None)]


def test_op1_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    got = sorted(map(tuple, queries.op1_line_dedup(spark, sf_dir).collect()))
    assert got == sorted(con.sql(queries.OP1_SQL).fetchall())
    assert sum(r[2] for r in got) > 0


def words_of(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def want_scan(text):
    ws = words_of(text)
    starts, labels, score = [], set(), 0.0
    for label, phrase in licenses.PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(ws)) if ws[i : i + len(p)] == p]
        starts += at
        labels |= {label} if at else set()
    base = set(labels)
    step = max(len(p.split()) for p in [*licenses.PHRASES.values(), *licenses.TEMPLATES.values()])
    for label, template in licenses.TEMPLATES.items():
        t = set(template.split())
        best = max((len(t & set(ws[i : i + 2 * step])) for i in range(0, max(1, len(ws)), step)), default=0)
        if best * 100 >= licenses.CONTAINED * len(t):
            labels.add(label)
            score = max(score, round(best / len(t), 6))
    score = 1.0 if base else score
    return (len(ws), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), score)


def check_scan(df, rows):
    assert sorted((str((r[0], *r[1:])) for r in map(tuple, df.collect()))) == sorted(str((d, *want_scan(t))) for d, t in rows)


def test_op5(spark, sf_dir, plain, odd_docs, no_docs):
    check_scan(queries.op5_license_scan(spark, sf_dir), plain.items())
    check_scan(licenses.scanned(odd_docs), ODD)
    assert licenses.scanned(no_docs).count() == 0


def test_planted_licenses(spark):
    rng = random.Random(12)
    filler = lambda n: [rng.choice(["the", "of", "mit", "license", "by", "nc", "zz", "software"]) for _ in range(n)]
    rows = []
    for i in range(150):
        ws = filler(rng.randrange(150))
        text = rng.choice([*licenses.PHRASES.values(), *licenses.TEMPLATES.values(), ""]).split()
        if rng.random() < 0.5:
            text = [w for w in text if rng.random() < 0.93]
        at = rng.randrange(len(ws) + 1)
        ws[at:at] = [w.upper() if rng.random() < 0.2 else w for w in text]
        rows.append((i, rng.choice([" ", "-", "\n", ", "]).join(ws)))
    rows.append((900, "under the mİt license CC-BY-NC under THE MIT license, Apache License, Version 2.0"))
    rows.append((901, "cc by nc " * 3000))
    check_scan(licenses.scanned(spark.createDataFrame(rows, "doc_id long, text string")), rows)

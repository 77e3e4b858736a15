"""Quality rules: base counts against brute force, verdicts on labelled rows, odd inputs."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from cohortlens.llm import quality
from cohortlens.llm.common import NON_SPACE, Chunk, table

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string"


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    hit = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit), n < 50 or 100 * len(hit) > 50 * n)


def test_base_columns_and_verdict(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = quality.train(docs, labels)
    got = quality.score(docs, model, ["doc_id", "text"]).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(r.text)
    marks = {r.doc_id: r.quality for r in labels.collect()}
    good = [r.kept for r in got if marks.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r.kept for r in got if marks.get(r.doc_id) == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1


def test_ratio_against_brute_force(spark):
    rows = [(1, "good words here"), (2, "bad $$ $$ words"), (3, None)]
    model = quality.train(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int"))
    cells = {i: quality._grams(Chunk([t], NON_SPACE, lower=False))[1] for i, t in rows}
    target, raw = Counter(cells[1].tolist()), Counter(np.concatenate(list(cells.values())).tolist())
    b, nt, nr = quality.BUCKETS, sum(target.values()), sum(raw.values())
    assert (nt, nr) == (5, 12)
    want = {i: np.mean([np.log((target[k] + 1) / (nt + b)) - np.log((raw[k] + 1) / (nr + b)) for k in c]) if len(c) else 0.0
            for i, c in ((i, c.tolist()) for i, c in cells.items())}
    got = {r.doc_id: r.ratio for r in quality.score(spark.createDataFrame(rows, SCHEMA), model, ["doc_id"]).collect()}
    assert all(abs(got[i] - want[i]) < 1e-5 for i in want)


def test_best_cut():
    good, bad = np.zeros(quality.BINS), np.zeros(quality.BINS)
    good[600:] = 1
    bad[:500] = 1
    assert abs(quality.best_cut(good, bad) - (550 * quality.BIN - 6)) < 1e-9
    assert quality.best_cut(good, np.zeros(quality.BINS)) == quality.DEFAULT_CUT


def test_odd_rows(spark):
    long = "word " * 300_000
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, long), (5, "a b c a b c"), (5, "a b c a b c"), (None, "\x1c\xa0x é "), (7, "l\nl\n\n \nl")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("kept", F.lit("x")).withColumn("ratio", F.lit(2))
    model = quality.train(df, spark.createDataFrame([], "doc_id long, quality int"))
    got = quality.score(df, model, ["doc_id", "text"]).collect()
    assert len(got) == 8
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(r.text)
        assert r.base_failed and not r.kept
    none = spark.createDataFrame([], SCHEMA)
    assert quality.score(none, quality.train(none, spark.createDataFrame([], "doc_id long, quality int")), ["doc_id"]).count() == 0

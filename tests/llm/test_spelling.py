"""Spelling variants: brute force over all pairs, chunk keys that are dealt, runs cut into pieces, odd rows."""

from __future__ import annotations

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from cohortlens.llm import spelling

DOCS = "doc_id long, text string"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) == 1:
        return any(b[:i] + b[i + 1:] == a for i in range(len(b)))
    return len(a) == len(b) and sum(x != y for x, y in zip(a, b, strict=True)) == 1


def brute(counts):
    form = {}
    for w, n in counts.items():
        near = [v for v in counts if one_edit(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form[w] = (best if best and counts[best] >= 2 * n else None, len(near))
    out = set()
    for w, n in counts.items():
        root = w
        while form[root][0]:
            root = form[root][0]
        out.add((w, form[w][0], root, n, form[w][1], counts[form[w][0]] if form[w][0] else None))
    return out


def vocabulary(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


def check(spark, counts):
    got = spelling.variants(vocabulary(spark, counts)).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(got) == len(counts) and {tuple(r) for r in got} == brute(counts)


def words(rng, n):
    out = set()
    while len(out) < n:
        w = "".join(rng.choice("ab\u00e9") for _ in range(rng.randint(5, 9)))
        out.add(w)
        v = list(w)
        i = rng.randrange(len(v))
        rng.choice([lambda: v.pop(i), lambda: v.insert(i, rng.choice("ab\u00c0")), lambda: v.__setitem__(i, "b")])()
        if len(v) >= 5:
            out.add("".join(v))
    return sorted(out)


def test_against_brute_force(spark):
    rng = random.Random(11)
    check(spark, {w: rng.choice([3, 3, 4, 6, 7, 12, 30, 200]) for w in words(rng, 400)})


def test_dealt_chunks_lose_and_double_nothing(spark, monkeypatch):
    monkeypatch.setattr(spelling, "SPLIT", 7)
    rng = random.Random(12)
    check(spark, {w: rng.randint(3, 60) for w in words(rng, 300)})


def test_chains_and_ties(spark):
    check(spark, {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, "bbbbb": 96, "bbbbbc": 192, "bbbbcc": 384, "bbbccc": 768, "bbcccc": 1536})
    check(spark, {"color": 5, "colour": 10, "colors": 10, "colord": 10, "unrelated": 9, "ab" * 40: 3, "ab" * 40 + "c": 9})
    check(spark, {"\u00e9t\u00e9s\u00e9": 4, "\u00e9t\u00e9s\u00e8": 8, "etese": 9})


def test_runs_are_never_cut(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 7)
    rng = random.Random(4)
    texts = ["".join(rng.choice(["abc", "XYZ", "\u00e9", "\u00d7", " ", "\n", "1", "\U0001F600", "\u0142"]) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    texts += [None, "", "a" * 50_000, "Ab " * 60_000]
    got = spelling.runs(spark.createDataFrame(list(enumerate(texts)), DOCS).withColumn("run", F.lit("old")), ["doc_id"]).groupBy("doc_id", "run").count().collect()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    want = {(i, w): n for i, t in enumerate(texts) for w, n in Counter(re.findall("[a-z\u00c0-\u00ff]+", (t or "").translate(lower))).items()}
    assert {(r.doc_id, r.run): r["count"] for r in got} == want


def test_vocabulary_bounds(spark):
    words = spark.createDataFrame([("abcde",)] * 3 + [("abcdf",)] * 2 + [("abcd",)] * 9 + [("\u00e9\u00e9\u00e9\u00e9\u00e9",)] * 4 + [(None,)] * 5, "word string")
    assert {(r.word, r.n) for r in spelling.vocabulary(words).collect()} == {("abcde", 3), ("\u00e9\u00e9\u00e9\u00e9\u00e9", 4)}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(None, None), (1, "")], DOCS)
    assert spelling.variants(spelling.vocabulary(spelling.runs(docs, []), "run")).count() == 0
    assert spelling.variants(vocabulary(spark, {"alone": 3})).collect()[0].asDict() == {"word": "alone", "form": None, "root": "alone", "n": 3, "n_near": 0, "form_n": None}

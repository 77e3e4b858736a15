"""Language ID: brute-force word and n-gram scores, held-out accuracy, odd inputs."""

from __future__ import annotations

import math
import random
import re
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortlens.llm import langid
from cohortlens.llm.common import LETTERS, crc_mod, pieces, table

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string"


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    model = langid.train(docs.where(crc_mod("doc_id", 5) != 0))
    held = langid.predict(docs.where(crc_mod("doc_id", 5) == 0), model, carry=["doc_id", "lang"])
    right, n = held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert n > 100 and right > 0.95


def brute(train, text):
    """(label, score) by plain counting: words first, then the longest known n-grams of an unseen word."""
    words, grams = {}, {}
    cut = lambda w, k: [g for i in range(len(w) + 3 - k) if (g := f" {w} "[i:i + k]).strip()]
    split = lambda t: re.findall("(?:[a-z]|[^\x00-\x7f])+", (t or "").lower())
    for t, lang in train:
        if lang is not None and t is not None:
            for w in split(t):
                words.setdefault(lang, Counter())[w] += 1
                for k in range(1, 5):
                    grams.setdefault((k, lang), Counter()).update(cut(w, k))
    langs = sorted(words)
    if not langs or not any(unicodedata.category(c)[0] == "L" for c in text or ""):
        return "und", 0.0
    log = lambda n, c: max(math.log10(n / sum(c.values())), -7.0) if n else -7.0
    total = dict.fromkeys(langs, 0.0)
    for w in split(text):
        for k in range(5):
            units = [w] if k == 0 else cut(w, 5 - k)
            table = {x: words[x] if k == 0 else grams.get((5 - k, x), Counter()) for x in langs}
            known = [u for u in units if any(table[x][u] for x in langs)]
            if known:
                break
        for x in langs:
            total[x] += sum(log(table[x][u], table[x]) for u in known) / len(known) if known else -7.0
    best = max(langs, key=lambda x: (total[x], [-ord(c) for c in x]))
    return best, 1 / sum(10 ** (total[x] - total[best]) for x in langs)


@pytest.mark.parametrize("head", [1 << 18, 40, 0])
def test_posterior_against_brute_force(spark, monkeypatch, head):
    """Words from the broadcast head, from the join, and from n-grams give one posterior."""
    monkeypatch.setattr(langid, "HEAD", head)
    rng = random.Random(2)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(1, 6)))
    own = {"x": [word("abcd") for _ in range(60)], "y": [word("cdef") for _ in range(60)], "z": [word("\u03b1\u03b2c\u00e9") for _ in range(60)]}
    train = [(i, " ".join(rng.choices(own[x], k=rng.randint(0, 30))), x, "s") for i, x in enumerate("xyzxyzxxy" * 4)] + [(99, "qqq", None, "s"), (98, None, "x", "s")]
    texts = [" ".join(rng.choice([rng.choice(own[rng.choice("xyz")]), word("abcdef\u03b1\u00e9w"), "Zz", "12"]) for _ in range(rng.randint(0, 12))) for _ in range(150)]
    texts += [None, "", "\u00bd \u00b2 12", "\u2460", "\u0301", "\u03a9", "\u4e2d", "ab" * 30, "\u0394\u0391 CD", " ".join(own["y"]) * 40]
    model = langid.train(spark.createDataFrame(train, SCHEMA))
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model, carry=["doc_id"]).collect()}
    assert len(model.head.value.value) <= head and len(got) == len(texts)
    for i, t in enumerate(texts):
        label, score = brute([(r[1], r[2]) for r in train], t)
        assert abs(got[i][1] - score) < 1e-4 and (got[i][0] == label or abs(score - 0.5) < 1e-4 or abs(score - 1 / 3) < 1e-4), (t, got[i], label, score)


def test_long_texts_in_parts(spark, monkeypatch):
    rows = [(1, "the cat and the dog " * 40 + "x" * 900, "en", "s"), (2, "le chat et le chien " * 40, "fr", "s")]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = {r.word: r.scores for r in langid.train(docs).words.collect()}
    monkeypatch.setattr("cohortlens.llm.common.CHUNK_BYTES", 64)
    monkeypatch.setattr(pieces, "__defaults__", (64,))
    assert {r.word: r.scores for r in langid.train(docs).words.collect()} == want
    parts = list(pieces([r[1] for r in rows] + [None, ""], LETTERS, True, 64))
    assert sum(len(c.starts) for _, c in parts) == 201 + 200 and max(len(c.data) for _, c in parts) < 1000 and {i for o, _ in parts for i in o} == {0, 1, 2, 3}


def test_odd_rows(spark):
    rows = [(1, "the cat and the dog", "en", "s"), (2, "le chat et le chien", "fr", "s")]
    model = langid.train(spark.createDataFrame(rows, SCHEMA))
    odd = [(None, "the dog", None, None), (3, None, "en", "a"), (4, "", "en", "a"), (5, "123 !? 45 \u00bd\u00b2", "en", "a"),
           (6, "le chien " * 200_000, "fr", "a"), (6, "le chien " * 200_000, "fr", "a"), (7, "Ω", None, "a")]
    df = spark.createDataFrame(odd, SCHEMA).withColumn("lang_pred", F.lit("old")).withColumn("score", F.lit("old"))
    got = [(r.doc_id, r.lang_pred, r.score) for r in langid.predict(df, model).collect()]
    by = {d: (p, s) for d, p, s in got}
    assert len(got) == 7 and by[None][0] == "en" and by[6][0] == "fr"
    assert by[3] == by[4] == by[5] == ("und", 0.0)
    assert by[7][0] in model.langs
    kept = langid.keep_identified(df, model)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} >= {None, 6}
    assert {r.doc_id for r in kept.collect()} & {3, 4, 5} == set()


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    model = langid.train(none)
    assert langid.predict(none, model).count() == 0
    assert langid.predict(spark.createDataFrame([(1, "a", "x", "s")], SCHEMA), model).first().lang_pred == "und"


def test_vocabulary_grows_with_the_words(spark, monkeypatch):
    monkeypatch.setattr(langid, "HEAD", 50_000)  # most words are found by the join
    word = F.translate(F.substring(F.md5(F.concat_ws("|", "id", "i")), 1, 12), "0123456789", "ghijklmnop")
    docs = (spark.range(2000).withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(300)))).withColumn("w", word)
            .groupBy("id").agg(F.array_join(F.collect_list("w"), " ").alias("text"))
            .select(F.col("id").alias("doc_id"), "text", F.concat(F.lit("l"), F.col("id") % 5).alias("lang"), F.lit("s").alias("source")))
    model = langid.train(docs)
    assert model.words.count() > 590_000 and len(model.head.value.keys) <= 50_000
    # A language never learned: no word, no n-gram of it is known, so the posterior is even and the rows go.
    strange = spark.createDataFrame([(i, " ".join(chr(0x3B1 + (i * 7 + j * k) % 24) * 3 for j in range(30) for k in (1, 5)), None, "s") for i in range(50)], SCHEMA)
    assert {round(r.score, 6) for r in langid.predict(strange, model).collect()} == {0.2}
    assert langid.keep_identified(strange, model).count() == 0
    held = langid.predict(docs.limit(50), model, carry=["lang"])
    assert held.where("lang <> lang_pred").count() == 0

"""Decontamination: the query against SQL and against brute force; odd inputs."""

from __future__ import annotations

import hashlib
import re

import pytest
from compare import compare, duck
from pyspark.sql import functions as F

from cohortlens.llm import decontam
from cohortlens.llm.queries import ORACLES, op7_decontaminate

SF = "/root/testdata/sf0.01"
DOC, ITEM = "doc_id long, text string", "item_id long, text string"


def brute_words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    out = []
    for d, text in docs:
        w, hit, met = brute_words(text), set(), set()
        for i, t in items:
            v = brute_words(t)
            for win in ([v[s:s + 13] for s in range(len(v) - 12)] if len(v) >= 13 else [v] if v else []):
                for s in range(len(w) - len(win) + 1):
                    if w[s:s + len(win)] == win:
                        hit |= set(range(s, s + len(win)))
                        met.add(str(i) if i is not None else "null")
        out.append((d, len(w), len(hit), sorted(met), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def test_query_against_sql(spark):
    problems, n, _ = compare(op7_decontaminate(spark, SF), duck(SF), ORACLES["op7_decontaminate"])
    assert not problems and n == 1000
    assert op7_decontaminate(spark, SF).where("contaminated").count() > 0


@pytest.mark.parametrize("most, words", [(1 << 25, 1 << 12), (0, 1 << 12), (0, 1)])
def test_small_against_brute_force(spark, monkeypatch, most, words):
    """Broadcast and merge join; a bitmap of few bits, which passes nearly all shingles, changes nothing."""
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", most)
    monkeypatch.setattr(decontam, "BITMAP_WORDS", words)
    letters = [chr(97 + i) for i in range(20)]
    items = [(1, " ".join(letters[:15])), (2, "One two"), (3, "solo"), (4, None), (5, "..."), (6, " ".join(letters[1:15])),
             (7, "the the the the the the the the the the the the the the"), (7, "solo"), (None, "É é two")]
    docs = [(1, "x " + " ".join(letters) + " y"), (2, "one, TWO! one two"), (3, "a solo act " + "z " * 100), (4, None), (5, ""), (6, "the " * 40),
            (7, "Éé É é two"), (None, "solo"), (8, "solo"), (8, "solo"), (9, " ".join(letters[:13]) + " q " + " ".join(letters[2:15])),
            (10, "b c " * 50_000), (11, "--- 12 ")]
    df = spark.createDataFrame(docs, DOC).withColumn("items", F.lit(1)).withColumn("w", F.lit("x")).withColumn("win", F.lit(0))
    got = decontam.contamination(df, spark.createDataFrame(items, ITEM)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted([(r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in got], key=key) == sorted(brute(docs, items), key=key)
    kept = decontam.keep_clean(df, spark.createDataFrame(items, ITEM))
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((d for d, *_, bad in brute(docs, items) if not bad), key=str)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], DOC), spark.createDataFrame([(1, "a b")], ITEM)
    none_d, none_i = spark.createDataFrame([], DOC), spark.createDataFrame([], ITEM)
    assert [tuple(r)[2:5] for r in decontam.contamination(docs, none_i).collect()] == [(2, 0, [])]
    assert decontam.contamination(none_d, items).count() == 0
    assert decontam.keep_clean(docs, none_i).count() == 1 and decontam.keep_clean(none_d, none_i).count() == 0


def test_empty_digest(spark):
    row = op7_decontaminate(spark, SF).where("n_items = 0").first()
    assert row.items_sha256 == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("n_items", [1, 3_000])
def test_passes_do_not_grow_with_the_benchmark(spark, monkeypatch, n_items):
    """The documents are read three times whatever the items, windows joined by merge included."""
    plans, store = [], decontam.materialise

    def seen(df, *rest, **named):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, *rest, **named)

    monkeypatch.setattr(decontam, "materialise", seen)
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", 1 << 20)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = F.concat_ws(" ", *[F.md5(F.concat_ws(":", "id", F.lit(i))) for i in range(16)])
    out = decontam.contamination(docs, spark.range(n_items).select(F.col("id").alias("item_id"), text.alias("text")))
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert sum(p.count("documents.parquet") for p in plans) == 3

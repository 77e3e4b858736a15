"""The pipeline stage by stage against brute force, and on odd rows."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus_pipeline  # noqa: E402
from cohortlens.llm import langid  # noqa: E402
from cohortlens.llm.common import table  # noqa: E402
from test_decontam import brute_words  # noqa: E402
from test_mixing import brute_count  # noqa: E402
from test_shard import brute as brute_shards  # noqa: E402
from test_simhash import brute_components, brute_fingerprint  # noqa: E402

SF = "/root/testdata/sf0.01"


def contaminated(text, windows):
    w, hit = brute_words(text), set()
    for size, wins in windows.items():
        for s in range(len(w) - size + 1):
            if tuple(w[s:s + size]) in wins:
                hit |= set(range(s, s + size))
    return bool(hit) and 20 * len(hit) >= len(w)


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    texts = {r.doc_id: r for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "mixing", "sharding"]
    # 1. Every document with a letter and a clear winner stays.
    one = stages["language_id"](spark, docs, SF)
    model = langid.train(docs)
    clear = {r.doc_id for r in langid.predict(docs, model, carry=["doc_id"]).collect() if r.lang_pred != "und" and r.score >= langid.MIN_SCORE}
    first = {r.doc_id for r in one.collect()}
    assert one.columns == docs.columns and first == clear and len(first) > 950
    # 2. The smallest id of every component.
    two = stages["near_duplicates"](spark, one, SF)
    comp = brute_components([(d, brute_fingerprint(texts[d].text)) for d in sorted(first)])
    second = sorted(r.doc_id for r in two.collect())
    assert two.columns == docs.columns and second == sorted(set(comp.values()))
    # 3. No contaminated document.
    three = stages["decontamination"](spark, two, SF)
    windows = {}
    for (t,) in duckdb.sql(f"select text from '{SF}/benchmark.parquet'").fetchall():
        w = brute_words(t)
        for s in range(max(len(w) - 12, 1)):
            windows.setdefault(len(w[s:s + 13]), set()).add(tuple(w[s:s + 13]))
    third = sorted(r.doc_id for r in three.collect())
    assert three.columns == docs.columns and third == [d for d in second if not contaminated(texts[d].text, windows)] and len(third) < len(second)
    # 4. Poisson copies at the sources' rates.
    four = stages["mixing"](spark, three, SF)
    size = {}
    for d in third:
        size[texts[d].source] = size.get(texts[d].source, 0) + len(texts[d].text.encode()) + 1
    total, weight = sum(size.values()), sum(v ** 0.5 for v in size.values())
    want = sorted(d for d in third for _ in range(brute_count(size[texts[d].source] ** 0.5 / weight * total / size[texts[d].source], d, texts[d].text)))
    copies = four.collect()
    assert four.columns == docs.columns and sorted(r.doc_id for r in copies) == want
    # 5. Equal bytes in order of the id.
    five = stages["sharding"](spark, four, SF)
    got = sorted((r.doc_id, r["size"], r.shard, r.slot) for r in five.collect())
    assert got == brute_shards([(d, len(texts[d].text.encode()) + 1) for d in want], 16)
    # run() gives the same rows.
    assert sorted((r.doc_id, r["size"], r.shard, r.slot) for r in corpus_pipeline.run(spark, SF).collect()) == got


@pytest.fixture
def odd(spark):
    text = "the quick brown fox jumps over the lazy dog and runs far away from here today"
    rows = [(1, text, "en", "a", 1), (2, text, None, None, None), (None, text + " once", "en", "a", 1), (3, None, "en", "a", None), (4, "", "en", "a", 0), (5, "12 34", "en", "a", 5),
            (6, "le renard brun saute " * 50_000, "fr", "a", 9), (7, "ein brauner hund", "de", None, 1), (7, "ein brauner hund", "de", None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("clash") for c in ("size", "shard", "score", "lang_pred", "fingerprint", "n_copies", "w", "win", "rate", "key")})


def test_odd_rows_and_empty_tables(spark, odd):
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        rows = out.collect()
        if name != "sharding":
            assert out.columns == docs.columns, name
        assert stage(spark, docs.where("false"), SF).count() == 0, name
        if name == "language_id":
            assert sorted(r.doc_id or 0 for r in rows) == [0, 1, 2, 6, 7, 7]
        if name == "near_duplicates":
            assert sorted(r.doc_id or 0 for r in rows) == [0, 1, 6, 7]
        docs = spark.createDataFrame(rows, out.schema)

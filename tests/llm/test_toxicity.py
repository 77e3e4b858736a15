"""Toxicity: segments against brute force, held-out accuracy, odd inputs."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import toxicity
from cohortlens.llm.common import LETTERS, Chunk, crc_mod, pieces, table

SF = "/root/testdata/sf0.1"
SCHEMA = "doc_id long, text string, lang string"


def brute_segments(x):
    """Maximal scoring segments by the recursive definition: best segment, then both sides of it."""
    if not len(x):
        return []
    best = max(((sum(x[i:j]), -(j - i), i, j) for i in range(len(x)) for j in range(i + 1, len(x) + 1)), default=None)
    if best is None or best[0] <= 0:
        return []
    _, _, i, j = best
    return brute_segments(x[:i]) + [(best[0], i, j)] + [(s, a + j, b + j) for s, a, b in brute_segments(x[j:])]


def test_segments_against_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(300):
        x = rng.integers(-5, 5, rng.integers(0, 14)) + rng.random() * 0.01
        x = x + np.arange(len(x)) * 1e-4  # no ties
        got = [(round(s, 6), a, b) for s, a, b in toxicity.segments(x.astype(float))]
        assert got == [(round(s, 6), a, b) for s, a, b in brute_segments(list(x))]


def test_held_out(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = toxicity.train(toxicity.training_rows(docs), labels)
    out = toxicity.score(docs.where(crc_mod("doc_id", 4) == 2), model, ["doc_id"]).join(labels, "doc_id")
    rows = out.groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in rows}
    assert n[(1, 1)] >= 0.75 * (n[(1, 1)] + n.get((1, 0), 0))
    assert n[(0, 0)] >= 0.99 * (n[(0, 0)] + n.get((0, 1), 0))


def _model(spark):
    clean = [(i, f"word{chr(97 + i % 26)} quiet river stone meadow {chr(97 + i % 7)}gh lake", "en") for i in range(400)]
    bad = [(1000 + i, f"quiet vilewort stone vilewash word{chr(97 + i % 26)} lake", "en") for i in range(100)]
    labels = spark.createDataFrame([(i, 0) for i, _, _ in clean] + [(i, 1) for i, _, _ in bad] + [(None, 1), (5, None)], "doc_id long, toxic int")
    return toxicity.train(spark.createDataFrame(clean + bad, SCHEMA), labels)


def brute_counts(texts):
    """Documents of each class per unit: prefixes of 3 to 6 bytes (the whole word if shorter) and the word, by length."""
    out = Counter()
    for t, toxic in texts.items():
        words = set(re.findall("(?:[a-z]|[^\x00-\x7f])+", t.lower()))
        for w in words:
            out["w", w, toxic] += 1
        for k in toxicity.PREFIXES:
            for p in {w.encode()[:k] for w in words}:
                out[k, p, toxic] += 1
    return out


@pytest.mark.parametrize("batch, most, held", [(10_000, 1 << 20, 1 << 20), (1, 1 << 20, 1), (3, 16, 50)])
def test_counts_do_not_depend_on_batches(spark, monkeypatch, batch, most, held):
    """Copies with contradicting labels, long texts in parts, any batch size: every text counts once, toxic if any copy is."""
    monkeypatch.setattr(toxicity, "HELD", held)
    monkeypatch.setattr(pieces, "__defaults__", (most,))
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abc\u00e9") for _ in range(rng.randint(1, 8)))
    texts = [" ".join(word() for _ in range(rng.randint(0, 25))) for _ in range(60)]
    rows = [(i, texts[rng.randrange(60)] if i >= 60 else texts[i]) for i in range(200)] + [(500, None)]
    labels = [(i, rng.randint(0, 1)) for i in range(200) for _ in range(rng.choice([0, 1, 1, 2]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        marked = toxicity._labelled(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), "text", "toxic", "doc_id")
        model = toxicity._model(toxicity._counts(marked))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    toxic = {}
    for i, t in rows:
        for d, x in labels:
            if d == i:
                toxic[t] = max(toxic.get(t, 0), x)
    want = brute_counts(toxic)
    assert (model.n_clean, model.n_toxic) == (sum(v == 0 for v in toxic.values()), sum(v == 1 for v in toxic.values()))
    got = {int(k): (int(a), int(b)) for k, a, b in zip(model.keys, model.clean, model.toxic, strict=True)}
    keys = {u[:2] for u in want}
    assert len(got) == len(keys)
    for kind, unit in keys:
        chunk = Chunk([unit if kind == "w" else unit.decode("utf-8", "ignore")], LETTERS, lower=True)
        if kind != "w" and unit.decode("utf-8", "ignore").encode() != unit:
            continue  # a prefix that ends inside a character
        h = chunk.word_hashes()[0] if kind == "w" else chunk.prefix_hashes((kind,))[0][0]
        assert got[int(h)] == (want[kind, unit, 0], want[kind, unit, 1])


def test_unseen_units_fall_to_their_prior(spark):
    model = _model(spark)
    scores = model.token_scores(Chunk(["xqzzy vilexyz vilewort"], LETTERS, lower=True))
    assert scores[0] == max(-toxicity.DROP, -toxicity.DRIFT) and scores[2] >= scores[1] > scores[0]


def test_a_long_text_in_parts_scores_as_whole(spark, monkeypatch):
    model = _model(spark)
    df = spark.createDataFrame([(1, "quiet river " * 50 + "vilewort vilewash vileness " * 3 + "stone lake " * 50, "en")], SCHEMA)
    whole = toxicity.score(df, model, ["doc_id"]).first()
    monkeypatch.setattr(pieces, "__defaults__", (32,))
    parts = toxicity.score(df, model, ["doc_id"]).first()
    assert parts == whole and [(p.start_token, p.end_token) for p in whole.passages] == [(100, 109)]


def test_passages_and_odd_rows(spark):
    model = _model(spark)
    rows = [(1, "quiet river stone", "en"), (2, None, "en"), (3, "", None), (4, "stone " * 300_000, "en"), (None, "lake", "en"),
            (5, "river stone lake vilewort vileness vilewash meadow quiet", "en"), (5, "river stone lake vilewort vileness vilewash meadow quiet", "en")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("x")).withColumn("n", F.lit(1))
    got = toxicity.score(df, model, ["doc_id"]).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 7
    assert by[5].predicted == 1 and [(p.start_token, p.end_token) for p in by[5].passages] == [(3, 6)]
    assert by[2].score == by[3].score < 0.3 and by[2].passages == []
    assert by[1].predicted == by[4].predicted == by[None].predicted == 0


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(none, labels)
    assert model.empty and toxicity.score(none, model, ["doc_id"]).count() == 0
    assert toxicity.score(spark.createDataFrame([(1, "a", "b")], SCHEMA), model, ["doc_id"]).first().score == 0.0

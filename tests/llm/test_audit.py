"""Filter audit: brute force over orders, odd rows, one text or id in very many rows."""

from __future__ import annotations

import random
import re
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from cohortlens.llm import audit

DOCS = "doc_id long, text string, source string"
LABELS = "doc_id long, quality int, toxic int"
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def fails(rows):
    first = {}
    for d, t, _ in rows:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    for d, t, _ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        yield {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
               "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and d > first[t]}


def brute(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    out = {}
    marks = list(fails(rows))
    for part in {s or "" for _, _, s in rows}:
        own = [(m, d in good, d in toxic) for m, (d, _, s) in zip(marks, rows, strict=True) if (s or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        mine = {}
        for order in permutations("ABCDE"):
            left = list(own)
            for step, f in enumerate(order, 1):
                gone = [x for x in left if x[0][f]]
                left = [x for x in left if not x[0][f]]
                shapley[f] += len(gone)
                mine["".join(order), step] = [len(left), len(gone), sum(x[0][f] for x in own) - len(gone),
                                              sum(x[0][f] and sum(x[0].values()) == 1 for x in own), sum(g for _, g, _ in gone), sum(t for _, _, t in gone)]
        out |= {(part, o, s): (*v, shapley[o[s - 1]]) for (o, s), v in mine.items()}
    return out


def check(spark, rows, labels):
    got = audit.audit(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == 600 * len({s or "" for _, _, s in rows})
    assert {(r.part, r.filter_order, r.step): tuple(r[m] for m in MEASURES) for r in got} == brute(rows, labels)


def test_against_brute_force(spark):
    rng = random.Random(3)
    words = ["one", "Two", "THREE", "four", "fi#ve", "six", "\u00e9t\u00e9", "\u00a0x"] + [f"w{i}" for i in range(60)]
    texts = [rng.choice(" \n\t").join(rng.choice(words[:rng.choice([5, 20, 68])]) for _ in range(rng.choice([0, 10, 49, 50, 51, 90]))) for _ in range(120)]
    rows = [(rng.choice([i, i, i, i // 2, None]), rng.choice([*texts, *texts[:3] * 20, None, ""]), rng.choice(["a", "b", "", None])) for i in range(400)]
    labels = [(rng.randrange(400), rng.randint(0, 1), rng.choice([0, 1, None])) for _ in range(300)] + [(None, 1, 1)]
    check(spark, rows, labels)


def test_edges_and_repeated_rows(spark):
    body = " ".join(f"w{i}" for i in range(50))
    rows = [(1, body, "s"), (1, body, "s"), (1, body, "t"), (2, body, "t"), (None, body, "t"), (-5, " " + body, "t"), (3, None, None), (4, "", ""), (9, "A" * 300_000 + " b" * 200_000, "s"),
            (10, "x " * 65 + "y", "s"), (11, "\u2003\u00a0", "s")]
    check(spark, rows, [(1, 1, 0), (1, 0, 1), (2, 1, 1), (9, None, 1)])


def test_extra_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b", "s", 7, "x", "y")], DOCS + ", n int, part string, hash string")
    labels = spark.createDataFrame([(1, 1, 1)], LABELS).withColumn("part", F.lit("z"))
    got = audit.audit(docs, labels)
    assert got.count() == 600 and {r.part for r in got.select("part").distinct().collect()} == {"s"}
    assert audit.audit(docs.limit(0), labels).count() == 0
    assert audit.audit(docs, labels.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_labels_are_not_broadcast(spark, monkeypatch, tmp):
    """Copies of the labels stay out of the driver, however small the table looks."""
    plans = {}
    keep = audit.materialise
    monkeypatch.setattr(audit, "materialise", lambda df, name: (plans.update({name: df._jdf.queryExecution().executedPlan().toString()}), keep(df, name))[1])
    spark.createDataFrame([(1, 1, 0)], LABELS).write.parquet(f"{tmp}/labels")
    audit.cells(spark.createDataFrame([(1, "a b", "s")], DOCS), spark.read.parquet(f"{tmp}/labels"))
    assert "label_id" in plans["tagged"] and "SortMergeJoin" in plans["tagged"] and "Broadcast" not in plans["tagged"], plans["tagged"]


def test_contractions():
    t = np.random.default_rng(1).integers(0, 50, (3, 2, 2, 2, 2, 2))
    got = audit.contract(t)
    assert (got[:, audit._code([2] * 5)] == t.reshape(3, -1).sum(axis=1)).all()
    assert (got[:, audit._code([0, 1, 2, 0, 2])] == t[:, 0, 1, :, 0, :].sum(axis=(1, 2))).all()
    assert got.dtype == np.int64 and got.shape == (3, 243)

"""SimHash: fingerprints against Spark's XXH64 and a bit loop, links against brute force, odd inputs."""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from cohortlens.llm import simhash
from cohortlens.llm.common import table
from cohortlens.llm.queries import op8_simhash

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string"


def brute_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    """fps: list of (doc_id, fingerprint); smallest id reachable by links of at most 4 bits."""
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= 4:
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(fps):
        low[find(i)] = min(low.get(find(i), d), d)
    return {d: low[find(i)] for i, (d, _) in enumerate(fps)}


def test_query_against_brute_force(spark):
    docs = table(spark, SF, "documents").collect()
    fps = [(r.doc_id, brute_fingerprint(r.text)) for r in docs]
    want = brute_components(fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op8_simhash(spark, SF).collect()}
    assert got == {d: (f"{fp:016x}", want[d]) for d, fp in fps}
    assert len(set(want.values())) < len(want)


def test_hash_is_sparks_xxhash64(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "Ünï Code")], SCHEMA)
    for r in df.select("text", F.xxhash64("text").alias("h")).collect():
        assert r.h & (2 ** 64 - 1) == simhash.fingerprint(r.text.encode().split())


def test_links_are_exact_in_long_runs(monkeypatch):
    monkeypatch.setattr(simhash, "RUN", 8)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2 ** 63, 30, dtype=np.uint64)
    near = [b ^ np.uint64(sum(1 << int(x) for x in rng.choice(64, rng.integers(1, 6), replace=False))) for b in base for _ in range(6)]
    values = np.unique(np.concatenate([base, np.array(near, np.uint64)]))
    links = simhash.links_of_run(values, 0, 4)
    label = {int(v): int(v) for v in values}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for u, v in links:
        for a, b in zip(u.tolist(), v.tolist(), strict=True):
            label[max(find(a), find(b))] = min(find(a), find(b))
    want = brute_components([(int(v), int(v)) for v in values])
    assert {int(v): find(int(v)) for v in values} == want


def test_components_of_long_chains_and_stars(spark):
    chain = [(i + 1, i) for i in range(0, 60)]
    star = [(200, 100 + i) for i in range(50)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(chain + star, "u long, v long")).collect()}
    assert {got[i] for i in range(61)} == {got[0]} and len({got[100 + i] for i in range(50)} | {got[200]}) == 1
    assert got[0] != got[200]


def test_odd_rows(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(5, None), (4, ""), (9, " \n"), (7, text), (7, text), (8, text.upper()), (None, text), (3, "word " * 200_000), (2, "solo"), (2, "solo")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("component_id", F.lit(0)).withColumn("fingerprint", F.lit("x")).withColumn("root", F.lit("x"))
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect()]
    assert len(got) == 10
    by = {d: (f, c) for d, f, c in got}
    assert by[5] == by[4] == by[9] == (0, 4)
    assert by[7][1] == by[8][1] == by[None][1] == 7
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=lambda d: d or 0) == [2, 3, 4, 7]
    none = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0


def test_keep_one_tells_rows_of_one_id_apart(spark):
    a, b = "one two three four five six seven eight", "other words that are quite unlike those of the first"
    rows = [(1, a, "s"), (2, a, "s"), (2, b, "s"), (2, b, "s"), (2, b, "t"), (None, a, "s"), (None, b, "u"), (None, "solo text without a twin in the table", "s"),
            (None, "solo text without a twin in the table", "s")]
    df = spark.createDataFrame(rows, SCHEMA + ", source string").withColumn("m", F.create_map(F.lit("k"), "source"))
    got = [(r.doc_id, r.text, r.source) for r in simhash.keep_one(df).collect()]
    assert len(got) == 3 and (1, a, "s") in got and (None, rows[7][1], "s") in got
    assert {t for d, t, _ in got if d == 2} == {b}
    assert sorted(simhash.keep_one(df.repartition(5)).drop("m").collect(), key=str) == sorted(simhash.keep_one(df).drop("m").collect(), key=str)


def test_keep_one_of_many_equal_rows(spark):
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, F.col("id")).alias("doc_id"), F.when(F.col("id") % 3 < 2, "the same words in a third of all rows").otherwise(F.concat(F.lit("text number "), F.md5(F.col("id").cast("string")))).alias("text"))
    got = simhash.keep_one(df).groupBy("text").count().collect()
    want = brute_components([(i, brute_fingerprint(r.text)) for i, r in enumerate(df.select("text").distinct().collect())])
    assert sum(r["count"] for r in got) == len(got) == len(set(want.values()))

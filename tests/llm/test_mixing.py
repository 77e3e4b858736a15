"""Mixing: the query against SQL, counts against an inverted distribution, rates, odd rows."""

from __future__ import annotations

import hashlib
import math

import pytest
from compare import compare, duck
from pyspark.sql import functions as F

from cohortlens.llm import mixing
from cohortlens.llm.queries import ORACLES, op4_mix

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, source string, text string"


def brute_count(rate, doc_id, text, seed=17):
    pieces, n = max(math.ceil(rate / 16.0), 1), 0
    who = f"{'' if doc_id is None else doc_id}|{hashlib.md5((text or '').encode()).hexdigest()}"
    for j in range(1, pieces + 1):
        u = int(hashlib.md5(f"{seed}|{who}|{j}".encode()).hexdigest()[:13], 16) / 2 ** 52
        p = total = math.exp(-rate / pieces)
        k = 0
        while total < u and k < 81:
            k += 1
            p *= rate / pieces / k
            total += p
        n += k
    return n


def test_query_against_sql(spark):
    problems, n, _ = compare(op4_mix(spark, SF), duck(SF), ORACLES["op4_mix"])
    assert not problems and 800 < n < 1200


@pytest.mark.parametrize("bound", [100_000, 0])
def test_counts_weights_and_odd_rows(spark, monkeypatch, bound):
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", bound)
    rows = [(i, "a", "x" * 9) for i in range(900)] + [(1000 + i, "b", "y" * 99) for i in range(10)]
    rows += [(2000, None, None), (2001, None, ""), (None, "a", "z" * 9), (5000, "dropped", "t"), (5001, "b", "long " * 100_000), (3, "a", "x" * 9)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("copy_no", F.lit("clash")).withColumn("rate", F.lit(-1.0))
    weights = spark.createDataFrame([("a", 0.5), ("b", 0.25), ("b", 0.25), (None, 0.5), ("unknown", 4.0), ("dropped", None)], "source string, weight double")
    rate = {r.src: r.rate for r in mixing.rates(docs, weights, 90_000.0).collect()}
    by_source = {}
    for _, s, t in rows:
        by_source[s] = by_source.get(s, 0) + len(t or "") + 1
    # The weight of a source that is not in the corpus does not count.
    want = {s: w / 1.5 * 90_000.0 / by_source[s] for s, w in (("a", 0.5), ("b", 0.5), (None, 0.5))}
    assert rate["=dropped"] == 0.0 and all(abs(rate["null" if s is None else f"={s}"] - w) < 1e-9 * w for s, w in want.items())
    got = mixing.mix(docs, weights, 90_000.0)
    assert "clash" not in str(got.select("copy_no").first()) and "rate" in got.columns
    seen = {}
    for r in got.collect():
        seen.setdefault((r.doc_id, r.source), []).append((r.n_copies, r.copy_no))
    for i, s, t in set(rows) - {(5000, "dropped", "t"), (3, "a", "x" * 9)}:
        n = brute_count(want[s], i, t)
        own = seen.get((i, s), [])
        assert len(own) == n and sorted(c for _, c in own) == list(range(1, n + 1))
    assert len(seen[3, "a"]) > 1  # two equal rows draw apart
    assert max(want.values()) > 16  # drawn in pieces


def test_mean_rate(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("t").alias("text"))
    n = mixing.replicate(docs, spark.createDataFrame([("=s", 1.7)], "src string, rate double")).count()
    assert abs(n / 20_000 - 1.7) < 0.04


def test_order_is_shuffled_and_empty_tables(spark):
    got = [r.doc_id for r in mixing.mix(spark.range(500).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("t").alias("text"))).collect()]
    assert got != sorted(got)
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0


def test_rows_of_one_id_spread_over_tasks(spark):
    # A third of the rows has no id and another third one id, all with one text.
    docs = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.col("id")).when(F.col("id") % 3 == 1, 5).alias("doc_id"), F.lit("s").alias("source"), F.lit("t").alias("text"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = mixing.replicate(docs, spark.createDataFrame([("=s", 8.0)], "src string, rate double"))
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(sizes) > 4 and max(sizes) < 1.2 * sum(sizes) / len(sizes)


def test_equal_rows_draw_for_themselves(spark):
    docs = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, 5).alias("doc_id"), F.lit("s").alias("source"), F.when(F.col("id") % 4 < 2, "t").alias("text"))
    out = mixing.replicate(docs, spark.createDataFrame([("=s", 0.7)], "src string, rate double"))
    for r in out.groupBy("doc_id", "text").count().collect():
        assert abs(r["count"] / 5000 - 0.7) < 0.06
    assert out.groupBy("doc_id", "text").count().count() == 4
    assert sorted(r.shuffle_key for r in out.collect()) == sorted(r.shuffle_key for r in mixing.replicate(docs, spark.createDataFrame([("=s", 0.7)], "src string, rate double")).collect())

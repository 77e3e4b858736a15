"""Sharding: the law of equal bytes, gapless slots, order, hot keys, odd inputs."""

from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

from cohortlens.llm import shard
from cohortlens.llm.queries import op6_shard

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string"


def brute(rows, shards):
    """(key, size) rows in order: shard by first byte, slot by count."""
    total, at, out, slots = sum(s for _, s in rows), 0, [], {}
    for k, s in rows:
        j = min(at * shards // total, shards - 1)
        out.append((k, s, j, slots.setdefault(j, 0)))
        slots[j] += 1
        at += s
    return out


def test_query_against_brute_force(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op6_shard(spark, SF).collect()
    want = brute([(d, len(t.encode()) + 1) for d, t in sorted(docs.items())], 16)
    assert sorted((r.doc_id, r["size"], r.shard, r.slot) for r in got) == want
    assert all(r.text_crc32 == zlib.crc32(docs[r.doc_id].encode()) and r.law == "bytes" and r.grown_shard is None for r in got)
    sizes = {}
    for _, s, j, _ in want:
        sizes[j] = sizes.get(j, 0) + s
    mean, largest = sum(sizes.values()) / 16, max(s for _, s, _, _ in want)
    assert len(sizes) == 16 and max(abs(s - mean) for s in sizes.values()) <= largest


@pytest.mark.parametrize("ranges", [64, 1])
def test_hot_key_and_odd_rows(spark, monkeypatch, ranges):
    monkeypatch.setattr(shard, "RANGES_PER_SHARD", ranges)
    rows = [(7, f"text {i % 50}") for i in range(300)] + [(i, "x" * (i % 9)) for i in range(100, 400)]
    rows += [(None, "a"), (None, None), (1, None), (2, ""), (3, "é" * 5000), (7, "text 1"), (-5, "neg")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("slot", F.lit("x")).withColumn("k", F.lit(0)).withColumn("r", F.lit("x")).withColumn("first", F.lit("x")).withColumn("base_rows", F.lit("x"))
    got = shard.shard(df, 8).select("doc_id", "size", "shard", "slot").collect()
    assert len(got) == len(rows) and sorted(r["size"] for r in got) == sorted(len((t or "").encode()) + 1 for _, t in rows)
    total = sum(r["size"] for r in got)
    for j in {r.shard for r in got}:
        own = [r for r in got if r.shard == j]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / 8) <= 10_001
    # Shards are runs of the key order, nulls first.
    order = sorted(got, key=lambda r: (r.shard, r.slot))
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in order]
    assert keys == sorted(keys)


def test_overfull_ranges_are_subdivided(spark):
    rows = [(f"k{i % 3}", i, 1000) for i in range(2000)]
    narrow = spark.createDataFrame(rows, "k string, tie long, size long")
    cuts = shard.splitters(narrow, 4)
    spans = narrow.groupBy(shard._range_of(cuts, narrow).alias("r")).agg(F.sum("size").alias("s")).collect()
    assert max(r["s"] for r in spans) <= shard.OVERFULL * 2_000_000 / (4 * shard.RANGES_PER_SHARD)


def test_small_and_empty(spark):
    assert shard.shard(spark.createDataFrame([], SCHEMA), 4).count() == 0
    one = shard.shard(spark.createDataFrame([(1, "a")], SCHEMA), 4).first()
    assert (one["size"], one.shard, one.slot) == (2, 0, 0)
    words = shard.shard(spark.createDataFrame([("b", "x"), ("a", "x"), (None, "x")], "doc_id string, text string"), 3)
    assert sorted((r.doc_id or "", r.shard) for r in words.collect()) == [("", 0), ("a", 1), ("b", 2)]


def test_equal_rows_that_fill_ranges_are_spread(spark, monkeypatch):
    monkeypatch.setattr(shard, "RANGES_PER_SHARD", 8)
    hot = spark.range(30_000).select(F.lit(5_000).cast("long").alias("doc_id"), F.lit("the same text again").alias("text"), F.col("id").cast("string").alias("source"))
    null = spark.range(5_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), F.lit("n").alias("source"))
    rest = spark.range(1_000).select("id", F.concat(F.lit("words "), F.col("id").cast("string")).alias("text"), F.lit("s").alias("source"))
    docs = hot.union(null).union(rest).repartition(7)
    narrow = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("k"), F.xxhash64("text").alias("tie"), shard.size_of(F.col("text")).alias("size"))
    cuts = shard.splitters(narrow, 8)
    spans = narrow.groupBy(shard._range_of(cuts, narrow).alias("r")).agg(F.sum("size").alias("s"), F.count_distinct("k", "tie").alias("kinds")).collect()
    total = sum(r["s"] for r in spans)
    assert all(r["kinds"] == 1 for r in spans if r["s"] > shard.OVERFULL * total / 64)
    done = shard.shard(docs, 8)
    got = done.select("doc_id", "size", "shard", "slot", "source").collect()
    want = brute([(None, 1)] * 5_000 + [(i, len(f"words {i}") + 1) for i in range(1_000)] + [(5_000, 20)] * 30_000, 8)
    plain = [(-1 if k is None else k, s, j, t) for k, s, j, t in want]
    assert sorted((-1 if r.doc_id is None else r.doc_id, r["size"], r.shard, r.slot) for r in got) == sorted(plain)
    assert sorted(int(r.source) for r in got if r.source not in ("s", "n")) == list(range(30_000))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # it would put such small partitions together
    try:
        assert shard.shard(docs, 8).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 20_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_subdivision_goes_on_to_the_end(spark):
    # Sizes grow by orders: the first splitters and several rounds after them leave overfull ranges.
    rows = [(f"{i:06d}", i, 10 if i < 3000 else 10_000) for i in range(3100)]
    narrow = spark.createDataFrame(rows, "k string, tie long, size long")
    cuts = shard.splitters(narrow, 2)
    spans = narrow.groupBy(shard._range_of(cuts, narrow).alias("r")).agg(F.sum("size").alias("s"), F.count("*").alias("n")).collect()
    share = sum(r["s"] for r in spans) / (2 * shard.RANGES_PER_SHARD)
    assert all(r["s"] <= shard.OVERFULL * share or r["n"] == 1 for r in spans)

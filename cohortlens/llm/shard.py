"""Sharding by sampled splitters: size-weighted key samples, quantile boundaries, range partitions.

1. A narrow table (key, tie, size) is stored. Keys are sampled in proportion to
   size: a record of ``size`` bytes gives about ``size / stride`` sample points,
   the fraction settled by its hash, so at most ``ranges * OVERSAMPLE`` points
   (and one more per record larger than the stride) reach the driver, whatever
   the corpus.
2. Their quantiles are the splitters. A record's range is found by bisection.
   Ranges number ``RANGES_PER_SHARD`` per shard, more if a range would hold more
   than ``RANGE_BYTES``, at most ``MAX_RANGES``.
3. Exact bytes and rows are counted per range. A range holding more than
   ``OVERFULL`` times its share is subdivided: its own records are sampled anew
   and split at their quantiles, until it is not overfull or all of its records
   have one key and tie.
4. Ranges laid end to end give every record its place in the whole order; a
   record belongs to the shard in which its first byte falls when the total is
   cut into equal parts. So shard sizes differ from the mean by one record at
   most. The records themselves are shuffled once, by range.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise

OVERSAMPLE = 16
RANGES_PER_SHARD = 64
RANGE_BYTES = 256 << 20
MAX_RANGES = 1 << 19
MAX_POINTS = 1 << 20
OVERFULL = 4.0


def size_of(text: Column) -> Column:
    """UTF-8 bytes plus one; a null text has no bytes."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def _points(narrow: DataFrame, stride: float, seed: int) -> list[tuple]:
    """Sorted (key, tie) sample points, one for about every ``stride`` bytes."""
    u = F.pmod(F.xxhash64("k", "tie", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    n = F.floor(F.col("size") / F.lit(float(stride)) + u)
    rows = narrow.select("k", "tie", n.alias("n")).where("n > 0").groupBy("k", "tie").agg(F.sum("n").alias("n")).collect()
    return sorted(((r.k, r.tie), r.n) for r in rows)


def _quantiles(points: list[tuple], n: int) -> list[tuple]:
    """At most ``n - 1`` distinct splitters that cut the weighted points into ``n`` parts."""
    if not points or n < 2:
        return []
    weight = np.cumsum([w for _, w in points])
    at = np.searchsorted(weight, weight[-1] * np.arange(1, n) / n)
    return [points[i][0] for i in sorted(set(np.minimum(at, len(points) - 1).tolist()))]


def _range_of(cuts: list[tuple], df: DataFrame, key: str = "k", tie: str = "tie") -> Column:
    """Number of the range of every row: how many splitters are at or below its (key, tie)."""
    shared = df.sparkSession.sparkContext.broadcast(cuts)

    @F.pandas_udf("int")
    def find(k: pd.Series, t: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(shared.value, pair) for pair in zip(k.tolist(), t.tolist(), strict=True)], dtype="int32")

    return find(F.col(key), F.col(tie))


def _share(total: int, shards: int) -> float:
    """Bytes of one range if all were equal."""
    return max(total / min(max(shards * RANGES_PER_SHARD, -(-total // RANGE_BYTES)), MAX_RANGES), 1.0)


def splitters(narrow: DataFrame, shards: int) -> list[tuple]:
    """Splitters over (k, tie), none of whose ranges is overfull unless one key and tie fill it."""
    total = narrow.agg(F.sum("size")).first()[0] or 0
    share = _share(total, shards)
    stride = max(share / OVERSAMPLE, total / MAX_POINTS, 1.0)
    cuts, seed = _quantiles(_points(narrow, stride, 1), max(round(total / share), 1)), 1
    while True:
        seed += 1
        ranged = narrow.withColumn("r", _range_of(cuts, narrow))
        # Fewer than total / (OVERFULL * share) ranges can be overfull.
        full = (ranged.groupBy("r").agg(F.sum("size").alias("size"), F.min(F.struct("k", "tie")).alias("lo"), F.max(F.struct("k", "tie")).alias("hi"))
                .where((F.col("size") > OVERFULL * share) & (F.col("lo") != F.col("hi"))).collect())
        if not full:
            return cuts
        part = ranged.join(F.broadcast(narrow.sparkSession.createDataFrame([(s["r"],) for s in full], "r int")), "r", "left_semi").select("k", "tie", "size")
        heavy = [(h["k"], h["tie"]) for h in part.groupBy("k", "tie").agg(F.sum("size").alias("size")).where(F.col("size") > share).collect()]
        points = _points(part, stride / 4, seed)
        places = [p for p, _ in points]
        # (k, tie + 1) is the first place behind a heavy key and tie.
        more = set(heavy) | {(k, tie + 1) for k, tie in heavy}
        for s in full:
            own = points[bisect_left(places, tuple(s["lo"])):bisect_right(places, tuple(s["hi"]))]
            more |= set(_quantiles(own, int(4 * s["size"] / share) + 2)) | {tuple(s["hi"])}
        cuts = sorted(set(cuts) | more)


def shard(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", names: tuple[str, str, str] = ("size", "shard", "slot")) -> DataFrame:
    """``docs`` with size (bytes plus one), shard (0 to ``shards - 1``) and slot (gapless from 0 in each shard).

    Records are ordered by key (nulls first), then by the hash of the text;
    shards are runs of that order with equal bytes, give or take one record.
    Rows that repeat key and text are interchangeable; where they fill a range
    they are spread over tasks.
    Fewer records than shards leave shards empty.
    """
    size, shard_no, slot = names
    # A key of any type is compared as text of fixed width if it is integral, else as text.
    k = F.when(F.col(key).isNull(), "").otherwise(_sortable(docs, key))
    out = [c for c in docs.columns if c not in names]
    marked = docs.select(*[F.col(f"`{c}`") for c in out], size_of(F.col(text)).alias("__size"), k.alias("__k"), F.xxhash64(F.col(text)).alias("__tie"))
    narrow = materialise(marked.select(F.col("__k").alias("k"), F.col("__tie").alias("tie"), F.col("__size").alias("size")), "sizes")
    cuts = splitters(narrow, shards)
    ranged = materialise(narrow.withColumn("r", _range_of(cuts, narrow)), "ranges")
    one = (F.min("k") == F.max("k")) & (F.min("tie") == F.max("tie")) & (F.min("size") == F.max("size")) & (F.count("*") > 1)
    per_range = ranged.groupBy("r").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), one.alias("one")).collect()  # at most MAX_RANGES and the subdivided
    per_range.sort(key=lambda r: r["r"])
    share = _share(sum(r["bytes"] for r in per_range), shards)
    starts, at, rows = [], 0, 0
    for r in per_range:
        starts.append((r["r"], at, rows, r["one"] and r["bytes"] > OVERFULL * share))
        at, rows = at + r["bytes"], rows + r["n"]
    base = F.broadcast(docs.sparkSession.createDataFrame(starts, "__b int, __b_bytes long, __b_rows long, __hot boolean"))

    def shard_of(before: Column) -> Column:
        return F.least(F.floor(before.cast("decimal(38,0)") * shards / F.lit(max(at, 1)).cast("decimal(38,0)")), F.lit(shards - 1)).cast("int")

    def placed(df: DataFrame) -> DataFrame:
        """Rows of ordinary ranges with their row number and shard, by a window over their range."""
        w = Window.partitionBy("__r").orderBy("__k", "__tie", "__size")
        before = F.coalesce(F.sum("__size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("__b_bytes")
        return df.withColumns({"__row": F.row_number().over(w) - 1 + F.col("__b_rows"), "__shard": shard_of(before)})

    # A shard's first row starts at or behind its first byte: found among ordinary rows, and computed in a range of equal ones.
    based = ranged.select(F.col("r").alias("__r"), F.col("k").alias("__k"), F.col("tie").alias("__tie"), F.col("size").alias("__size")).join(base, F.col("__r") == F.col("__b"))
    first = {r["__shard"]: r["first"] for r in placed(based.where("not __hot")).groupBy("__shard").agg(F.min("__row").alias("first")).collect()}
    for r, (_, b_bytes, b_rows, hot) in zip(per_range, starts, strict=True):
        if hot:
            each = r["bytes"] // r["n"]
            for j in range(shards):
                i = max(0, -((b_bytes * shards - j * at) // (each * shards)))  # least i with (b_bytes + i * each) * shards >= j * at
                if i < r["n"] and min((b_bytes + i * each) * shards // at, shards - 1) == j:
                    first[j] = min(first.get(j, b_rows + i), b_rows + i)
    firsts = F.broadcast(docs.sparkSession.createDataFrame(sorted(first.items()), "__s int, __first long"))
    found = marked.withColumn("__r", _range_of(cuts, marked, "__k", "__tie")).join(base, F.col("__r") == F.col("__b"))
    done = placed(found.where("not __hot"))
    if any(hot for *_, hot in starts):
        kept = materialise(found.where("__hot").withColumn("__n", F.monotonically_increasing_id()), "hot-rows")
        task = F.shiftright("__n", 33)
        before = F.sum("__count").over(Window.partitionBy("__hr").orderBy("__ht").rowsBetween(Window.unboundedPreceding, -1))
        ahead = (kept.groupBy(F.col("__r").alias("__hr"), task.alias("__ht")).agg(F.count("*").alias("__count"))
                 .select("__hr", "__ht", F.coalesce(before, F.lit(0)).alias("__ahead")))
        numbered = kept.withColumn("__t", task).withColumn("__i", F.row_number().over(Window.partitionBy("__r", "__t").orderBy("__n")) - 1)
        place = F.col("__i") + F.col("__ahead")
        hot_rows = numbered.join(ahead, (F.col("__r") == F.col("__hr")) & (F.col("__t") == F.col("__ht")))
        done = done.unionByName(hot_rows.withColumns({"__row": place + F.col("__b_rows"), "__shard": shard_of(F.col("__b_bytes") + place * F.col("__size"))}).select(*done.columns))
    done = done.join(firsts, F.col("__shard") == F.col("__s"))
    return done.select(*[F.col(f"`{c}`") for c in out], F.col("__size").alias(size), F.col("__shard").alias(shard_no),
                       (F.col("__row") - F.col("__first")).cast("long").alias(slot))


def _sortable(docs: DataFrame, key: str) -> Column:
    """Text that sorts as the key does: integers shifted to be non-negative and padded, others as they print."""
    if docs.schema[key].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint"):
        return F.lpad((F.col(key).cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("string"), 20, "0")
    return F.concat(F.lit(" "), F.col(key).cast("string"))

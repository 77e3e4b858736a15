"""Mixing sources to target weights by Poisson replication. Native functions only.

A source's mean repetition rate is ``weight * target / size``: its share of the
target bytes over the bytes it has. Every document draws its number of copies
from the Poisson distribution with that mean by inverting the distribution
function at a uniform number made of the seed and the hash of its id and text,
so a rerun and a lost executor draw alike, and a rate of 1.3 repeats every
document once or more often in the mean without choosing any by hand. Rows that
repeat id and text also take the number of the row in the stored table, so each
draws for itself: an id, or a null, that holds a third of a source neither goes
nor is repeated as one. Documents are exploded by their count, and every copy is
dealt to a partition by the hash of its row and copy number, which shuffles
the whole output.

Rates above ``PIECE`` are drawn as a sum of independent Poisson numbers of equal
rates up to ``PIECE`` (such a sum is Poisson with the whole rate), so the table
of the distribution function stays short and nothing is cut off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, materialise

PIECE = 16.0
TERMS = 80  # P(X > 80) at a mean of 16 is below 1e-30
POWER = 0.5
SALTS = 64


def uniform(*parts: Column) -> Column:
    """Number in [0, 1) from 52 bits of the MD5 of the parts joined by ``|``."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def _size(text: str) -> Column:
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1


def _source(source: str) -> Column:
    """Sources as text; null sources are one source."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("null"))


def rates(docs: DataFrame, weights: DataFrame | None = None, target_bytes: float | None = None,
          source: str = "source", text: str = "text", power: float = POWER) -> DataFrame:
    """(src, rate): mean repetitions of every source in ``docs``.

    ``weights`` (source, weight) need not sum to one; sources without a row, a
    null or a negative weight get none. Left out, a source weighs its bytes to
    the power ``power``. ``target_bytes`` defaults to the bytes there are.
    """
    sizes = docs.groupBy(_source(source).alias("src")).agg(F.sum(_size(text)).cast("double").alias("bytes"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.pow("bytes", F.lit(power)))
    else:
        given = weights.groupBy(_source("source").alias("src")).agg(F.greatest(F.coalesce(F.sum("weight"), F.lit(0.0)), F.lit(0.0)).alias("weight"))
        sizes = sizes.join(given, "src", "left").fillna(0.0, ["weight"])
    sizes = materialise(sizes, "source-sizes")
    total = sizes.agg(F.sum("bytes").alias("b"), F.sum("weight").alias("w")).first()
    target = float(target_bytes if target_bytes is not None else total["b"] or 0.0)
    return sizes.select("src", (F.col("weight") / F.lit(float(total["w"] or 1.0)) * F.lit(target) / F.col("bytes")).alias("rate"))


def _distribution(rate: Column) -> Column:
    """Distribution function of a Poisson number of mean ``rate`` at 0, 1, ..., TERMS."""
    first = F.exp(-rate)
    start = F.struct(F.array(first).alias("cdf"), first.alias("p"), first.alias("sum"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * rate / k
        total = acc["sum"] + p
        return F.struct(F.concat(acc["cdf"], F.array(total)).alias("cdf"), p.alias("p"), total.alias("sum"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step)["cdf"]


def replicate(docs: DataFrame, rate: DataFrame, seed: int = 17, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``docs`` with n_copies, copy_no (1 to n_copies) and shuffle_key, one row per copy, globally shuffled.

    Every row draws for itself: from its id and text, and if other rows have both
    too from its number in the table as read. A null id or text hashes as the
    empty text. A rate of zero drops a source, as its weight demands.
    """
    clash = {"n_copies", "copy_no", "shuffle_key"}
    kept = [c for c in docs.columns if c not in clash]
    pieces = F.greatest(F.ceil(F.col("rate") / PIECE), F.lit(1)).cast("int")
    table = materialise(rate.select("src", pieces.alias("__pieces"), _distribution(F.col("rate") / pieces).alias("__cdf")).withColumnRenamed("src", "__src"), "rates")
    ident = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))
    body = F.md5(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary"))
    again = materialise(docs.select(ident.alias("__i"), body.alias("__b")).groupBy("__i", "__b").agg(F.count("*").alias("__n")).where("__n > 1").drop("__n"), "repeated")
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], _source(source).alias("__src"), ident.alias("__id"), body.alias("__body"),
                       F.monotonically_increasing_id().alias("__row"))
    number = F.lit(None).cast("long")
    if not again.isEmpty():
        rows = rows.join(again.withColumn("__again", F.lit(True)), (F.col("__id") == F.col("__i")) & (F.col("__body") == F.col("__b")), "left")
        number = F.when(F.col("__again"), F.col("__row"))
    # what makes a row: its id and text, and its number where that is not enough
    rows = rows.withColumn("__who", F.concat_ws("|", "__id", "__body", number))
    # A row of the table holds some 700 bytes: an eighth of the usual bound. Beyond it the join is salted, so a hot source spreads.
    if table.count() <= BROADCAST_ROWS // 8:
        drawn = rows.join(F.broadcast(table), "__src")
    else:
        salted = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        drawn = rows.withColumn("__salt", F.pmod(F.xxhash64("__who"), F.lit(SALTS)).cast("int")).join(salted, ["__src", "__salt"])
    n = F.aggregate(F.sequence(F.lit(1), F.col("__pieces")), F.lit(0),
                    lambda acc, j: acc + F.size(F.filter("__cdf", lambda c: c < uniform(F.lit(seed), F.col("__who"), j))))
    counted = drawn.withColumn("n_copies", n).where("n_copies > 0")
    copies = counted.withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
    keyed = copies.withColumn("shuffle_key", F.md5(F.concat_ws("|", F.lit("order"), F.lit(seed), F.col("__who"), F.col("copy_no"))))
    return (keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
            .select(*[F.col(f"`{c}`") for c in kept], "n_copies", "copy_no", "shuffle_key"))


def mix(docs: DataFrame, weights: DataFrame | None = None, target_bytes: float | None = None, seed: int = 17,
        key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``replicate`` at the rates that the weights demand."""
    return replicate(docs, rates(docs, weights, target_bytes, source, text), seed, key, source, text)

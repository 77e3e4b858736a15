"""Benchmark decontamination: prefix-filtered join of item windows and document words.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A window is
``WINDOW`` consecutive words of an item; a shorter item is one window. A window
is a set of positioned shingles (two words; one for a window of one word).
Since a window must be contained whole, its necessary prefix is one shingle:
the rarest by its count over all documents. A window whose rarest shingle
occurs nowhere cannot match and goes. Document shingles join the prefix
shingles; the shingle's place in the window fixes the candidate's start, which
must lie in the text with the window's whole length; the candidate is then
verified word by word.

Shingles are 64-bit hashes; equal hashes of different shingles cost a candidate
that the verification rejects. Whatever the size of the benchmark, the documents
are split into words three times: to count the benchmark's shingles, to
find candidates, and for the counts of the result. The first two keep only
shingles whose bit is set in a bitmap of ``BITMAP_WORDS`` 64-bit words (8 MB, the
one thing that every task gets). Candidates carry the at most 24 words that a
window around their shingle can take, never the document. Windows are broadcast
only if their measured bytes are within ``BROADCAST_BYTES``; otherwise candidates
and windows meet in a merge join by shingle, whose hot keys AQE splits. Native
functions only.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import hint_if_small, materialise

WINDOW = 13
BITMAP_WORDS = 1 << 20  # a power of two
BROADCAST_BYTES = 32 << 20
SHARE = 20  # contaminated if SHARE * hit words >= words
_NO_WORD = "".join(chr(i) for i in range(128) if not chr(i).isalnum())


def words(text: Column) -> Column:
    """Array of the words of a text; null has none."""
    spaced = F.translate(text, _NO_WORD + ascii_uppercase, " " * len(_NO_WORD) + ascii_lowercase)
    return F.coalesce(F.array_remove(F.split(spaced, " "), ""), F.array().cast("array<string>"))


def windows(items: DataFrame, key: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """(item_id, win) of every window of every item; items without words have none."""
    split = items.select(F.col(key).alias("item_id"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    at = F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(1))))
    return split.select("item_id", "w", at.alias("s")).select("item_id", F.slice("w", F.col("s"), F.lit(size)).alias("win")).distinct()


def _shingle(first: Column, second: Column | None = None) -> Column:
    return F.xxhash64(first) if second is None else F.xxhash64(first, second)


def _bit_word(sh: Column) -> Column:
    return F.shiftright(sh.bitwiseAND(BITMAP_WORDS * 64 - 1), 6).cast("int")


def _bitmap(shingles: DataFrame) -> Column:
    """One array of ``BITMAP_WORDS`` 64-bit words with a bit set for every ``sh``; stored, read as a scalar subquery."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("sh").bitwiseAND(63).cast("int"))
    zeros = shingles.sparkSession.range(BITMAP_WORDS).select(F.col("id").cast("int").alias("i"), F.lit(0).cast("long").alias("v"))
    filled = shingles.select(_bit_word(F.col("sh")).alias("i"), bit.alias("v")).unionByName(zeros).groupBy("i").agg(F.bit_or("v").alias("v"))
    leaves = filled.groupBy(F.shiftright("i", 10).alias("p")).agg(F.array_sort(F.collect_list(F.struct("i", "v")))["v"].alias("part"))
    one = leaves.agg(F.flatten(F.array_sort(F.collect_list(F.struct("p", "part")))["part"]).alias("bits"))
    return materialise(one, "bitmap").scalar()


def _bounded(stored: DataFrame) -> DataFrame:
    """Broadcast hint for a stored table of windows (column win) within ``BROADCAST_BYTES`` (24 more a word, 64 a row), else a merge join."""
    size = F.octet_length(F.concat_ws("", "win")).cast("long") + 24 * F.size("win") + 64
    fits = stored.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first().n <= BROADCAST_BYTES
    return F.broadcast(stored) if fits else stored.hint("merge")


def _hits(docs: DataFrame, keep: list, wanted: DataFrame) -> DataFrame:
    """(kept columns, w, pos, sh) of the document shingles whose bit is set by a stored table of windows (win, sh).

    A shingle is a word and its successor; where windows of one word are wanted, each word is one too.
    """
    bits = _bitmap(wanted)
    zipped = F.arrays_zip(F.col("w"), F.slice("w", F.lit(2), F.size("w")))
    at = docs.select(*keep, "w", F.posexplode(zipped).alias("pos", "s"))

    def told(sh: Column) -> Column:
        return F.call_function("shiftright", F.get(bits, _bit_word(sh)), sh.bitwiseAND(63).cast("int")).bitwiseAND(1) == 1

    pair, single = _shingle(F.col("s.w"), F.col("s")["1"]), _shingle(F.col("s.w"))
    paired = F.col("s")["1"].isNotNull() & told(pair)
    if wanted.where(F.size("win") == 1).isEmpty():
        return at.where(paired).select(*keep, "w", "pos", pair.alias("sh"))
    both = F.array_compact(F.array(F.when(paired, pair), F.when(told(single), single)))
    return at.where(paired | told(single)).select(*keep, "w", "pos", F.explode(both).alias("sh"))


def prefixes(docs: DataFrame, wins: DataFrame) -> DataFrame:
    """(win, off, sh): the rarest shingle of every distinct window, by count over ``docs`` (column w)."""
    last = F.greatest(F.size("win") - 1, F.lit(1))
    word = F.col("win")[F.col("off")]
    shingles = (wins.select("win").distinct().select("win", F.explode(F.sequence(F.lit(0), last - 1)).alias("off"))
                .select("win", "off", F.when(F.size("win") > 1, _shingle(word, F.get("win", F.col("off") + 1))).otherwise(_shingle(word)).alias("sh")))
    shingles = materialise(shingles, "shingles")
    # Shingles that occur nowhere are absent here: the least such shingle rules its window out.
    counts = _hits(docs, [], shingles).groupBy("sh").count()
    counts = materialise(counts.join(shingles.select("sh").distinct(), "sh", "left_semi"), "rarity")
    ranked = (shingles.join(hint_if_small(counts), "sh", "left")
              .groupBy("win").agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "off", "sh")).alias("r")))
    return ranked.where("r.n > 0").select("win", "r.off", "r.sh")


def matches(docs: DataFrame, prefix: DataFrame, keep: list[str], size: int = WINDOW) -> DataFrame:
    """(kept columns, start, len, win) of every occurrence of a window of the stored ``prefix`` in ``docs`` (column w)."""
    back = max(size - 2, 0)
    begin = F.greatest(F.col("pos") - back, F.lit(0))
    near = _hits(docs, keep, prefix).select(
        *keep, "pos", "sh", F.size("w").alias("n"), begin.alias("begin"), F.slice("w", begin + 1, F.lit(back + size)).alias("near"))
    start, length = F.col("pos") - F.col("off"), F.size("win")
    inside = (start >= 0) & (start + length <= F.col("n"))
    same = F.slice("near", F.greatest(start - F.col("begin"), F.lit(0)) + 1, length) == F.col("win")
    return near.join(_bounded(prefix), "sh").where(inside & same).select(*keep, start.alias("start"), length.alias("len"), "win")


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                  item_key: str = "item_id", item_text: str = "text", size: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: key, text_hash, n_words, n_hit, items (sorted strings) and contaminated.

    Null and empty texts have no words and are clean; rows that repeat key and
    text get the same result each; item ids that are null are listed as ``null``.
    """
    base = docs.select(F.col(key).alias("__key"), F.xxhash64(F.col(text)).alias("__hash"), F.col(text).alias("__text"))
    split = base.select("__key", "__hash", words(F.col("__text")).alias("w"))
    wins = materialise(windows(items, item_key, item_text, size), "windows")
    doc = ["__key", "__hash"]
    found = materialise(matches(split, materialise(prefixes(split, wins), "prefixes"), doc, size).distinct(), "matches")
    counted = base.select(*doc, F.size(words(F.col("__text"))).cast("long").alias("n_words"))
    no_items = F.array().cast("array<string>")
    # Words covered by the union of the matches: each start adds what reaches beyond all earlier ends.
    spans = found.groupBy(*doc, "start").agg(F.max("len").alias("len"))
    before = F.max(F.col("start") + F.col("len")).over(Window.partitionBy(*doc).orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    end = F.col("start") + F.col("len")
    hit = (spans.select(*doc, F.greatest(end - F.greatest("start", F.coalesce(before, F.lit(0))), F.lit(0)).alias("new"))
           .groupBy(*doc).agg(F.sum("new").cast("long").alias("n_hit")))
    listed = (found.select(*doc, "win").distinct().join(_bounded(wins), "win")
              .select(*doc, F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item")).distinct()
              .groupBy(*doc).agg(F.array_sort(F.collect_list("item")).alias("items")))
    told = hit.join(listed, (hit["__key"].eqNullSafe(listed["__key"])) & (hit["__hash"] == listed["__hash"])).select(
        hit["__key"].alias("__k"), hit["__hash"].alias("__h"), "n_hit", "items")
    out = counted.join(told, F.col("__key").eqNullSafe(F.col("__k")) & (F.col("__hash") == F.col("__h")), "left").select(
        F.col("__key").alias(key), F.col("__hash").alias("text_hash"), "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", no_items).alias("items"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words")))


def keep_clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` that are not contaminated; columns unchanged.

    The contaminated (key, text hash) pairs are few against the corpus and
    are broadcast if their counted rows are within the bound.
    """
    bad = contamination(docs, items, key, text).where("contaminated").select(F.col(key).alias("__key"), F.col("text_hash").alias("__hash")).distinct()
    bad = hint_if_small(materialise(bad, "contaminated"))
    mine = docs[key].eqNullSafe(bad["__key"]) & (F.xxhash64(docs[text]) == bad["__hash"])
    return docs.join(bad, mine, "left_anti")

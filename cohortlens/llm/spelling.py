"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

The shorter word of a pair (of two equally long ones, either) contributes two
disjoint chunks, its halves. One edit touches at most one of them; the other
stands in the other word, moved by one place at most: by none before the edit,
by the difference of the lengths behind it. So the other word contributes its
positional grams of the halves' lengths at those places (grams elsewhere stand
for no half). An equi-join on (length of the chunked word, which half,
characters) meets the pairs within shift one; the edit distance is verified
inside the join.

A chunk that more than ``SPLIT`` words share is dealt over a grid of keys: its
words over the rows and the grams that meet it over the columns, so a task
compares at most about ``SPLIT`` words with as many.
Chains of forms are followed by pointer doubling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

SPLIT = 2_000  # words sharing a chunk before its key is dealt
PIECE = 1 << 16  # code points of a text that are matched at once
# Fixed value: what the vocabulary's words consist of once A-Z are lower-cased.
LETTERS = r"a-zÀ-ÿ"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(docs: DataFrame, carry: list[str], text: str = "text", run: str = "run") -> DataFrame:
    """Every maximal run of letters of every whole text, A-Z lower-cased, with the columns ``carry``.

    A text is cut into pieces of some ``PIECE`` code points that end with a run,
    so no run is cut and a task holds one text and the runs of one piece. Null
    and empty texts have none.
    """
    kept = [F.col(f"`{c}`") for c in carry]
    pieces = F.regexp_extract_all(F.col(f"`{text}`").cast("string"), F.lit(f"(?s).{{1,{PIECE}}}[A-Z{LETTERS}]*+"), F.lit(0))
    piece = F.translate("__piece", _UPPER, _LOWER)
    return (docs.select(*kept, F.explode(pieces).alias("__piece"))
            .select(*kept, F.explode(F.regexp_extract_all(piece, F.lit(f"[{LETTERS}]+"), F.lit(0))).alias(run)))


def vocabulary(words: DataFrame, word: str = "word", min_chars: int = 5, min_count: int = 3) -> DataFrame:
    """Stored (word, n): the distinct words of at least ``min_chars`` code points that occur at least ``min_count`` times."""
    counted = words.where(F.length(word) >= min_chars).groupBy(F.col(word).alias("word")).agg(F.count("*").alias("n"))
    return materialise(counted.where(F.col("n") >= min_count), "vocabulary")


def _keys(length: Column, pieces: list[tuple[int, Column, Column, Column]]) -> Column:
    """Array of (length of the chunked word, half, gram) from (half, start, size, condition)."""
    made = [F.when(ok, F.struct(length.alias("l"), F.lit(half).alias("half"), F.substr(F.col("word"), start + 1, size).alias("gram")))
            for half, start, size, ok in pieces]
    return F.filter(F.array(*made), lambda x: x.isNotNull())


def chunks(vocab: DataFrame) -> DataFrame:
    """Two disjoint chunks of every word: its halves."""
    size = F.length("word")
    half = F.floor(size / 2).cast("int")
    yes = F.lit(True)
    return vocab.select("word", "n", F.explode(_keys(size, [(0, F.lit(0), half, yes), (1, half, size - half, yes)])).alias("k")).select("word", "n", "k.*")


def grams(vocab: DataFrame, min_chars: int) -> DataFrame:
    """Positional grams of every word that may stand for a half of an equally long word, or of one a code point shorter.

    A half before the edit keeps its place, one behind it moves by the
    difference of the lengths, 0 or 1; grams elsewhere stand for no half.
    """
    size = F.length("word")
    out = None
    for shorter in (0, 1):
        l = size - shorter  # noqa: E741
        half = F.floor(l / 2).cast("int")
        fits = l >= min_chars
        part = vocab.select("word", "n", F.explode(_keys(l, [(0, F.lit(0), half, fits), (1, half + shorter, l - half, fits)])).alias("k")).select("word", "n", "k.*")
        out = part if out is None else out.unionByName(part)
    return out


def near_pairs(vocab: DataFrame, min_chars: int = 5) -> DataFrame:
    """Stored (a, n_a, b, n_b): every unordered pair of distinct words exactly one edit apart, once."""
    key = ["l", "half", "gram"]
    short, long = chunks(vocab), grams(vocab, min_chars)
    # Chunks of very many words are dealt over a grid of keys. Usually there are none.
    hot = materialise(short.groupBy(*key).agg(F.count("*").alias("words")).where(F.col("words") > SPLIT), "hot_chunks")
    a, b, on = short, long, key
    if not hot.isEmpty():
        dealt = materialise(hot.join(long.join(hot.select(*key), key).groupBy(*key).agg(F.count("*").alias("others")), key)
                            .select(*key, F.ceil(F.col("words") / SPLIT).cast("int").alias("rows"), F.ceil(F.col("others") / SPLIT).cast("int").alias("columns")), "dealt")
        one = F.lit(1)

        def deal(side: DataFrame, own: str, other: str) -> DataFrame:
            mine, all_of = F.pmod(F.xxhash64("word"), F.coalesce(own, one)).cast("int"), F.explode(F.sequence(F.lit(0), F.coalesce(other, one) - 1))
            return side.join(dealt, key, "left").withColumn(f"in_{own}", mine).withColumn(f"in_{other}", all_of).drop("rows", "columns")

        a, b, on = deal(short, "rows", "columns"), deal(long, "columns", "rows"), [*key, "in_rows", "in_columns"]
    a = a.withColumnsRenamed({"word": "a", "n": "n_a"})
    b = b.withColumnsRenamed({"word": "b", "n": "n_b", **{c: f"b_{c}" for c in on}})
    same = [F.col(c) == F.col(f"b_{c}") for c in on]
    once = (F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))
    found = a.join(b, [*same, once, F.levenshtein("a", "b", 1) == 1])
    return materialise(found.select("a", "n_a", "b", "n_b").distinct(), "near_pairs")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word that has a form: pointer doubling, a chain of length c takes log2(c) rounds.

    Along a chain the counts at least double, so it has fewer than 64 words.
    """
    links = materialise(forms.where("form is not null").select("word", F.col("form").alias("to")), "links")
    while True:
        onward = links.select(F.col("word").alias("at"), F.col("to").alias("onward"))
        links = materialise(links.join(onward, F.col("to") == F.col("at"), "left")
                            .select("word", F.coalesce("onward", "to").alias("to"), F.col("onward").isNotNull().alias("moved")), "links")
        if links.where("moved").isEmpty():
            return links.select("word", F.col("to").alias("root"))


def variants(vocab: DataFrame, min_chars: int = 5, ratio: int = 2) -> DataFrame:
    """Every word of a stored vocabulary (word, n) with form, root, n_near and form_n.

    The form is the near word of largest count, ties to the smallest in
    code-point order, if that count is at least ``ratio`` (2 or more) times the
    word's own; else null. The root is where forms lead, the word itself
    without one. An empty vocabulary gives no row.
    """
    pairs = near_pairs(vocab, min_chars)
    both = (pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n"))
            .unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n"))))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    chosen = F.col("form_n") >= ratio * F.col("n")
    forms = (vocab.join(best, "word", "left").withColumn("form_n", -F.col("best.less"))
             .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                     F.when(chosen, F.col("best.near")).alias("form"), F.when(chosen, F.col("form_n")).alias("form_n")))
    forms = materialise(forms, "forms")
    return (forms.join(_roots(forms), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))

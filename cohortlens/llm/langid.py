"""Language identification: words first, character n-grams for unseen words.

Training counts, over every training document, how often each word and each
n-gram of 1 to 4 characters (word boundaries included) occurs per language. A
word known from training is scored by its per-language log10 relative
frequency; an unseen word backs off to its 4-grams, then 3-, 2- and 1-grams,
taking the mean over the n-grams of the first order of which any is known. A
document's score per language is the sum over its words.

A word is a maximal run of ASCII letters and non-ASCII characters of the
lower-cased text. Words are counted exactly in Spark; n-grams never leave their
word, so their counts come from the counted words. Both tables are stored and
grow with the distinct units.

Prediction has one plan at every size. The most frequent words, at most ``HEAD``
entries (word, language) of them, are broadcast: a bounded table that takes most
tokens. Documents are read once; a task adds up their head words and passes on
every other word with its count in the document. The distinct ones of those are
joined to the stored word table by the word itself; the rest of them is cut
into n-grams, which are joined to the stored n-gram table by a 64-bit key, one
order after the other. The scores go back to the documents by a join and a sum.
No table of unbounded size reaches the driver or a task.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BATCH_ROWS, LETTERS, Chunk, materialise, mix64, pieces

MAX_ORDER = 4
PENALTY = 7.0  # -log10 frequency given to a language in which the unit was never seen
UNDETERMINED = "und"
MIN_SCORE = 0.3  # a document below it is rejected by ``keep_identified``
HEAD = 1 << 18  # entries (word, language) of the broadcast table, some 24 bytes each
HELD = 200_000  # words or n-grams a task counts before it passes them on
BINS_PER_OCTAVE = 8  # of the counts among which the head's least count is chosen
_GRAM_BASE = np.uint64(0x9E3779B97F4A7C15)


def _grams(words: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the word, key) of every n-gram of ``order`` characters.

    An n-gram may hold one boundary at each end; between them are only
    characters of one word.
    """
    data = np.frombuffer((b" " + b" ".join(words) + b" ").decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.uint64)
    n = len(data) - order + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    inside = data != 32
    h, letters = np.full(n, order, np.uint64), np.zeros(n, np.int8)
    inner = np.ones(n, bool)
    with np.errstate(over="ignore"):
        for i in range(order):
            h = h * _GRAM_BASE + data[i:i + n] + np.uint64(1)
            letters += inside[i:i + n]
            if 0 < i < order - 1:
                inner &= inside[i:i + n]
    at = np.flatnonzero(inner & (letters > 0))
    owner = np.cumsum(~inside) - 1
    return owner[at], mix64(h[at])


def _count_words(batches):
    """Per task: (language, word, n) of all words, passed on every ``HELD`` distinct ones."""
    seen: dict[str, dict[bytes, int]] = {}

    def flush():
        for lang, own in seen.items():
            if own:
                words = [w.decode("utf-8") for w in own]
                yield pa.record_batch({
                    "lang": pa.array([lang] * len(words), pa.string()), "word": pa.array(words, pa.string()), "n": pa.array(list(own.values()), pa.int64())})
        seen.clear()

    for batch in batches:
        by_lang: dict[str, list[str]] = {}
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
            by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            for _, chunk in pieces(texts, LETTERS, lower=True):
                own = seen.setdefault(lang, {})
                _, first, n = np.unique(chunk.word_hashes(), return_index=True, return_counts=True)
                for word, k in zip(chunk.words(first), n.tolist(), strict=True):
                    own[word] = own.get(word, 0) + k
                if sum(map(len, seen.values())) >= HELD:
                    yield from flush()
    yield from flush()


def _count_grams(batches):
    """Per task: (language, order, key, n) of the n-grams of counted words."""
    for batch in batches:
        langs, words, n = batch.column("lang").to_numpy(zero_copy_only=False), batch.column("word").to_pylist(), batch.column("n").to_numpy()
        for lang in sorted(set(langs)):
            rows = np.flatnonzero(langs == lang)
            own = [words[i].encode("utf-8") for i in rows]
            for order in range(1, MAX_ORDER + 1):
                owner, keys = _grams(own, order)
                distinct, at = np.unique(keys, return_inverse=True)
                sums = np.zeros(len(distinct), np.int64)
                np.add.at(sums, at, n[rows][owner])
                yield pa.record_batch({
                    "lang": pa.array([lang] * len(distinct), pa.string()), "unit_order": pa.array(np.full(len(distinct), order, np.int32)),
                    "key": pa.array(distinct.view(np.int64)), "n": pa.array(sums)})


class Head:
    """The broadcast words: sorted 64-bit keys and, per key, the score in every language it was seen in."""

    def __init__(self, words: list[str], lang: np.ndarray, value: np.ndarray, n_langs: int):
        key = Chunk([" ".join(words)], LETTERS, lower=False).word_hashes() if words else np.empty(0, np.uint64)
        order = np.argsort(key, kind="stable")
        self.keys, self.first = np.unique(key[order], return_index=True)
        self.first = np.append(self.first, len(key))
        self.lang, self.value, self.n_langs = lang[order].astype(np.int32), value[order].astype(np.float32), n_langs

    def scores(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(is in the head, scores per language) of every key; zeros where it is not."""
        out = np.zeros((len(keys), self.n_langs), np.float32)
        if not len(self.keys):
            return np.zeros(len(keys), bool), out
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[at] == keys
        hit = np.flatnonzero(known)
        out[hit] = -PENALTY
        size = self.first[at[hit] + 1] - self.first[at[hit]]
        entry = np.repeat(self.first[at[hit]] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        out[np.repeat(hit, size), self.lang[entry]] = self.value[entry]
        return known, out


class Model:
    """Languages; stored tables ``words`` (word, scores) and ``grams`` (unit_order, key, scores); the broadcast ``head``."""

    def __init__(self, langs: list[str], words: DataFrame, grams: DataFrame, head):
        self.langs, self.words, self.grams, self.head = langs, words, grams, head

    def word_scores(self, words: DataFrame) -> DataFrame:
        """(word, scores) of distinct ``words`` (column word): the word's own, else the mean over its longest known n-grams."""
        known = words.join(self.words, "word")
        left = materialise(words.join(self.words, "word", "left_anti"), "unseen")
        parts = [known]
        for order in range(MAX_ORDER, 0, -1):
            if left.isEmpty():
                break
            cut = left.mapInArrow(_cut_grams(order), "word string, key long")
            own = cut.join(self.grams.where(F.col("unit_order") == order).select("key", "scores"), "key")
            mean = F.array(*[F.avg(F.col("scores")[j]) for j in range(len(self.langs))]).alias("scores")
            done = materialise(own.groupBy("word").agg(mean), "backed-off")
            parts.append(done)
            left = materialise(left.join(done, "word", "left_anti"), "unseen")
        nothing = F.array(*[F.lit(-PENALTY)] * len(self.langs))
        return reduce(DataFrame.unionByName, [*parts, left.select("word", nothing.alias("scores"))])


def _cut_grams(order: int):
    """Task: (word, key) of the n-grams of every word, repeats included."""
    def run(batches):
        for batch in batches:
            words = batch.column("word")
            owner, keys = _grams([w.encode("utf-8") for w in words.to_pylist()], order)
            yield pa.RecordBatch.from_arrays([words.take(pa.array(owner)), pa.array(keys.view(np.int64))], names=["word", "key"])
    return run


def _scored(counts: DataFrame, by: list[str], langs: list[str], totals: dict, order: Column) -> DataFrame:
    """One row per unit: log10 relative frequency in every language, -PENALTY where it was never seen."""
    def of(j: int, lang: str) -> Column:
        total = reduce(lambda acc, k: F.when(order == k, F.lit(float(totals[k, lang]))).otherwise(acc),
                       [k for k, own in totals if own == lang], F.lit(1.0))
        return F.greatest(F.coalesce(F.log10(F.col(f"n{j}") / total), F.lit(-PENALTY)), F.lit(-PENALTY))

    wide = counts.groupBy(*by).agg(*[F.sum(F.when(F.col("lang") == lang, F.col("n"))).alias(f"n{j}") for j, lang in enumerate(langs)])
    return wide.select(*by, F.array(*[of(j, lang) for j, lang in enumerate(langs)]).alias("scores"))


def _head(counts: DataFrame, langs: list[str], totals: dict) -> Head:
    """The words whose count over all languages is at least a cut such that they have at most ``HEAD`` entries."""
    per_word = counts.groupBy("word").agg(F.sum("n").alias("all"), F.count("*").alias("entries"))
    level = F.floor(F.log2("all") * BINS_PER_OCTAVE).cast("int")
    bins = sorted(((r.level, r.entries) for r in per_word.groupBy(level.alias("level")).agg(F.sum("entries").alias("entries")).collect()), reverse=True)
    held, cut = 0, None
    for at, entries in bins:
        if held + entries > HEAD:
            break
        held, cut = held + entries, at
    if cut is None:
        return Head([], np.empty(0, np.int32), np.empty(0), len(langs))
    frequent = per_word.withColumn("level", level).where(F.col("level") >= cut).select("word")
    rows = counts.join(frequent, "word").select("word", "lang", "n").toArrow()  # at most HEAD rows
    lang = pa.compute.index_in(rows.column("lang"), value_set=pa.array(langs)).to_numpy()
    total = np.array([float(totals[0, x]) for x in langs])
    value = np.maximum(np.log10(rows.column("n").to_numpy() / total[lang]), -PENALTY)
    return Head(rows.column("word").to_pylist(), lang, value, len(langs))


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Model from every row of ``docs`` with a language and a text. No row: a model without languages."""
    words = materialise(
        docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where("lang is not null and text is not null")
        .mapInArrow(_count_words, "lang string, word string, n long")
        .groupBy("lang", "word").agg(F.sum("n").alias("n")), "words", BATCH_ROWS)
    grams = materialise(
        words.mapInArrow(_count_grams, "lang string, unit_order int, key long, n long")
        .groupBy("lang", "unit_order", "key").agg(F.sum("n").alias("n")), "grams")
    totals = {(0, r.lang): r.n for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted({lang for _, lang in totals})
    if not langs:
        return Model([], words, grams, None)
    totals |= {(r.unit_order, r.lang): r.n for r in grams.groupBy("unit_order", "lang").agg(F.sum("n").alias("n")).collect()}
    own = {k: v for k, v in totals.items() if k[0] == 0}
    return Model(langs, materialise(_scored(words, ["word"], langs, own, F.lit(0)), "word-scores"),
                 materialise(_scored(grams, ["unit_order", "key"], langs, {k: v for k, v in totals.items() if k[0]}, F.col("unit_order")), "gram-scores"),
                 docs.sparkSession.sparkContext.broadcast(_head(words, langs, totals)))


_REST = pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())]))


def _scan(head, n_langs: int, kept: list[str]):
    """Task: per row the kept columns, sums over its head words, whether it has a letter, and its other words with counts."""
    def run(batches):
        for batch in batches:
            texts = batch.column("__text").to_pylist()
            sums = np.zeros((len(texts), n_langs))
            owners, words, counts = [], [], []
            for owner, chunk in pieces(texts, LETTERS, lower=True):
                keys, first, where = np.unique(chunk.word_hashes(), return_index=True, return_inverse=True)
                known, scores = head.value.scores(keys)
                np.add.at(sums, owner, chunk.per_text(scores[where]))
                strange = np.flatnonzero(~known)
                if not len(strange):
                    continue
                token = np.flatnonzero(~known[where])
                rank = np.cumsum(~known) - 1
                pair, n = np.unique(owner[chunk.owners()[token]] * len(strange) + rank[where[token]], return_counts=True)
                spelled = np.array([w.decode("utf-8") for w in chunk.words(first[strange])], object)
                owners.append(pair // len(strange))
                words.append(spelled[pair % len(strange)])
                counts.append(n)
            owner = np.concatenate(owners) if owners else np.empty(0, np.int64)
            order = np.argsort(owner, kind="stable")
            rest = pa.StructArray.from_arrays([pa.array((np.concatenate(words) if words else np.empty(0, object))[order], pa.string()),
                                               pa.array((np.concatenate(counts) if counts else np.empty(0, np.int64))[order], pa.int64())], names=["word", "n"])
            starts = np.searchsorted(owner[order], np.arange(len(texts) + 1))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(sums.tolist(), pa.list_(pa.float64())),
                 pa.array([bool(t) and any(map(str.isalpha, t)) for t in texts]), pa.ListArray.from_arrays(pa.array(starts, pa.int32()), rest)],
                names=[*kept, "__sums", "__letter", "__rest"])
    return run


def predict(docs: DataFrame, model: Model, text: str = "text", label: str = "lang_pred", score: str = "score",
            carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with the two columns ``label`` and ``score`` appended.

    ``score`` is the posterior of the winner over the learned languages (equal
    priors); ties go to the first language in order of name. A null text, one
    without a letter (a character of a Unicode letter category; numerals and
    marks are none), or a model without languages gives ``und`` and 0. Every
    row gets a row, repeated ones too. What is carried is stored once, so
    ``carry`` should leave out texts that are not needed.
    """
    langs = model.langs
    kept = [c for c in (docs.columns if carry is None else carry) if c not in (label, score)]
    if not langs:
        return docs.select(*[F.col(f"`{c}`") for c in kept], F.lit(UNDETERMINED).alias(label), F.lit(0.0).alias(score))
    src = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias("__text"))
    found = T.StructType.fromDDL("__sums array<double>, __letter boolean, __rest array<struct<word: string, n: bigint>>")
    schema = T.StructType([*docs.select(*[F.col(f"`{c}`") for c in kept]).schema, *found])
    read = materialise(src.mapInArrow(_scan(model.head, len(langs), kept), schema).withColumn("__uid", F.monotonically_increasing_id()), "read", BATCH_ROWS)
    rest = read.select("__uid", F.explode("__rest").alias("w")).select("__uid", "w.word", "w.n")
    scored = materialise(model.word_scores(rest.select("word").distinct()), "rest-scores")
    more = rest.join(scored, "word").groupBy("__uid").agg(F.array(*[F.sum(F.col("n") * F.col("scores")[j]) for j in range(len(langs))]).alias("__more"))
    totals = F.zip_with("__sums", F.coalesce("__more", F.array(*[F.lit(0.0)] * len(langs))), lambda a, b: a + b)
    top = F.array_max("__totals")
    spread = F.aggregate("__totals", F.lit(0.0), lambda acc, t: acc + F.exp((t - top) * float(np.log(10.0))))
    named = F.element_at(F.array(*[F.lit(x) for x in langs]), F.array_position("__totals", top).cast("int"))
    return (read.join(more, "__uid", "left").withColumn("__totals", totals)
            .select(*[F.col(f"`{c}`") for c in kept], F.when(F.col("__letter"), named).otherwise(UNDETERMINED).alias(label),
                    F.when(F.col("__letter"), 1.0 / spread).otherwise(0.0).alias(score)))


def keep_identified(docs: DataFrame, model: Model, min_score: float = MIN_SCORE, text: str = "text") -> DataFrame:
    """Rows of ``docs`` whose language is determined with at least ``min_score``; columns unchanged.

    A verdict depends on the text alone: the rejected texts are named by their
    MD5 and their rows left out, so the texts themselves are neither stored nor
    shuffled while the rejected are few.
    """
    digest = F.unhex(F.md5(F.col(f"`{text}`").cast("string").cast("binary")))
    told = predict(docs.where(F.col(f"`{text}`").isNotNull()).select(digest.alias("__digest"), F.col(f"`{text}`").alias("__body")), model, "__body", "__lang_pred", "__lang_score", ["__digest"])
    rejected = materialise(told.where((F.col("__lang_pred") == UNDETERMINED) | (F.col("__lang_score") < min_score)).select("__digest").distinct(), "rejected")
    return (docs.where(F.col(f"`{text}`").isNotNull()).withColumn("__digest", digest).join(rejected, "__digest", "left_anti")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))

"""Quality rules: n-gram log-likelihood ratio between a trusted target and the raw corpus.

Words are ``[^\\x20\\x09-\\x0D]+``. Unigrams and bigrams of words are hashed into
``BUCKETS`` cells; two multinomials over the cells are counted, one over the
trusted documents and one over every document of the corpus, both smoothed by
one pseudo count a cell. A document's ratio is the mean over its n-grams of
``ln p_target - ln p_raw``, so length plays no part. The verdict is
deterministic: kept if the ratio is at least the threshold. The threshold is
learned from the labelled documents that pass the base rules: ratios are
counted in bins of ``BIN``, and the cut with the fewest errors is taken, where
losing a good document weighs ``GOOD_WEIGHT`` times a bad one kept (the middle
of the best range of cuts). Without labels of both kinds it is ``DEFAULT_CUT``.

The base rules fail a text of fewer than 50 words, and one in which more than
half of the words lie in three-word windows found twice or more in the text.
Repeated windows are compared by 64-bit hashes within one text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NON_SPACE, Chunk, chunks, hint_if_small, materialise, mix64

BUCKETS = 1 << 17
BIN = 0.01
BINS = 1200  # ratios from -6 to 6; beyond, the outermost bin
GOOD_WEIGHT = 20.0
DEFAULT_CUT = -0.15
MIN_WORDS = 50
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_SPACES = " \t\n\x0b\x0c\r"


def _grams(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(text index, cell) of all word unigrams and bigrams."""
    h, owner = chunk.word_hashes(), chunk.owners()
    with np.errstate(over="ignore"):
        pairs = mix64(h[:-1] * np.uint64(0xD6E8FEB86659FD93) + h[1:])
    same = owner[:-1] == owner[1:]
    cells = np.concatenate([h, pairs[same]]) % np.uint64(BUCKETS)
    return np.concatenate([owner, owner[:-1][same]]), cells.astype(np.int64)


def _count(batches):
    """Per task: n-grams per cell over trusted documents and over all."""
    sums = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        trusted = np.array(batch.column("trusted").to_pylist(), bool)
        for start, chunk in chunks(batch.column("text").to_pylist(), NON_SPACE, lower=False):
            owner, cell = _grams(chunk)
            sums[1] += np.bincount(cell, minlength=BUCKETS)
            sums[0] += np.bincount(cell[trusted[start:start + len(chunk)][owner]], minlength=BUCKETS)
    hit = np.flatnonzero(sums[1])
    yield pa.record_batch({"cell": pa.array(hit.astype(np.int32)), "target": pa.array(sums[0, hit]), "raw": pa.array(sums[1, hit])})


def base_counts(chunk: Chunk, texts: list[str | None]) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of every text of the chunk."""
    begin = chunk.begin[:-1]
    chars = np.add.reduceat(chunk.inside & ((chunk.data & 0xC0) != 0x80), begin, dtype=np.int64)
    symbols = np.add.reduceat(_SYMBOLS[chunk.data], begin, dtype=np.int64)
    h, owner = chunk.word_hashes(), chunk.owners()
    repeated = np.zeros(len(h), bool)
    if len(h) > 2:
        with np.errstate(over="ignore"):
            k = np.uint64(0x9FB21C651E98DF25)
            windows = mix64((h[:-2] * k + h[1:-1]) * k + h[2:]) ^ mix64(owner[:-2].astype(np.uint64) + np.uint64(1))
        at = np.flatnonzero(owner[:-2] == owner[2:])
        order = at[np.argsort(windows[at], kind="stable")]
        equal = windows[order][1:] == windows[order][:-1]
        twice = np.zeros(len(order), bool)
        twice[1:] |= equal
        twice[:-1] |= equal
        for i in range(3):
            repeated[order[twice] + i] = True
    dup = []
    for text in texts:
        lines = [line for line in text.split("\n") if line.strip(_SPACES)] if text and "\n" in text else ()
        dup.append(len(lines) - len(set(lines)))
    return {"n_words": chunk.n_words.astype(np.int64), "word_chars": chars, "n_symbols": symbols,
            "n_dup_lines": np.array(dup, np.int64), "n_repeat_words": chunk.per_text(repeated.astype(np.int64)).astype(np.int64)}


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    n = counts["n_words"]
    return (n < MIN_WORDS) | (100 * counts["n_repeat_words"] > 50 * n)


def _measured(batches, ratio):
    """(batch, base counts, log-likelihood ratio) of every batch."""
    for batch in batches:
        texts = batch.column("__text").to_pylist()
        parts = []
        for start, chunk in chunks(texts, NON_SPACE, lower=False):
            counts = base_counts(chunk, texts[start:start + len(chunk)])
            owner, cell = _grams(chunk)
            n = np.bincount(owner, minlength=len(chunk))
            counts["ratio"] = np.bincount(owner, ratio[cell], len(chunk)) / np.maximum(n, 1)
            parts.append(counts)
        yield batch, {k: np.concatenate([p[k] for p in parts]) for k in parts[0]} if parts else None


class Model:
    """``ratio`` per cell and the threshold ``cut``."""

    def __init__(self, ratio: np.ndarray, cut: float = DEFAULT_CUT):
        self.ratio, self.cut = ratio, cut


def best_cut(good: np.ndarray, bad: np.ndarray) -> float:
    """Lower edge of the bin at which to cut; ``good``/``bad`` are counts per bin."""
    if not good.sum() or not bad.sum():
        return DEFAULT_CUT
    lost = np.concatenate([[0], np.cumsum(good)])  # good documents below a cut at the lower edge of each bin
    kept = bad.sum() - np.concatenate([[0], np.cumsum(bad)])
    cost = GOOD_WEIGHT * lost + kept
    best = np.flatnonzero(cost == cost.min())
    run = best[:1 + int(np.argmax(np.append(np.diff(best) > 1, True)))]  # the first unbroken range of best cuts
    return float((run[0] + run[-1]) / 2 * BIN - BINS * BIN / 2)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality", key: str = "doc_id") -> Model:
    """Multinomials over every document of ``docs``; trusted are those labelled 1 (of contradicting labels the smaller counts)."""
    spark = docs.sparkSession
    marks = materialise(labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("__id"))
                        .agg(F.min(F.col(label).cast("int")).alias("quality")), "quality-labels")
    rows = (docs.select(F.col(key).alias("__id"), F.col(text).alias("text")).where("text is not null")
            .join(hint_if_small(marks), "__id", "left"))
    got = (rows.select("text", F.coalesce(F.col("quality") == 1, F.lit(False)).alias("trusted"))
           .mapInArrow(_count, "cell int, target long, raw long")
           .groupBy("cell").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw")).toArrow())
    target, raw = np.zeros(BUCKETS), np.zeros(BUCKETS)
    cell = got.column("cell").to_numpy()
    target[cell], raw[cell] = got.column("target").to_numpy(), got.column("raw").to_numpy()
    if not target.sum():
        return Model(np.zeros(BUCKETS, np.float32))
    logs = [np.log(c + 1.0) - np.log(c.sum() + BUCKETS) for c in (target, raw)]
    model = Model((logs[0] - logs[1]).astype(np.float32))
    shared = spark.sparkContext.broadcast(model.ratio)

    def binned(batches):
        for batch, counts in _measured(batches, shared.value):
            if counts is None:
                continue
            ok = ~base_failed(counts)
            bins = np.clip(np.floor(counts["ratio"] / BIN) + BINS // 2, 0, BINS - 1).astype(np.int32)
            yield pa.record_batch({"quality": batch.column("quality").filter(pa.array(ok)), "bin": pa.array(bins[ok])})

    hist = (rows.where("quality is not null").select("quality", F.col("text").alias("__text"))
            .mapInArrow(binned, "quality int, bin int").groupBy("quality", "bin").count().collect())
    good, bad = np.zeros(BINS), np.zeros(BINS)
    for r in hist:
        (good if r["quality"] == 1 else bad)[r["bin"]] += r["count"]
    model.cut = best_cut(good, bad)
    return model


def score(docs: DataFrame, model: Model, carry: list[str], text: str = "text") -> DataFrame:
    """``carry`` columns plus the base counts, base_failed, ratio and kept of every document.

    A null or empty text has no words: it fails the base rules and is not kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.ratio, model.cut))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches):
        ratio, cut = shared.value
        for batch, counts in _measured(batches, ratio):
            if counts is None:
                continue
            failed = base_failed(counts)
            columns = [pa.array(counts[n]) for n in names]
            columns += [pa.array(failed), pa.array(counts["ratio"].astype(np.float64)), pa.array(~failed & (counts["ratio"] >= cut))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carry], *columns], names=[*carry, *names, "base_failed", "ratio", "kept"])

    kept = docs.select(*[F.col(f"`{c}`") for c in carry])
    schema = docs.select(*kept.columns).schema
    for n in names:
        schema = schema.add(n, "long")
    schema = schema.add("base_failed", "boolean").add("ratio", "double").add("kept", "boolean")
    return docs.select(*kept.columns, F.col(f"`{text}`").cast("string").alias("__text")).mapInArrow(run, schema)

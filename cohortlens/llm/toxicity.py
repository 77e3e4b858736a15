"""Toxicity: maximum-scoring segments of token log-odds, calibrated by extreme values.

1. Log-odds. Over labelled documents, count in how many toxic and clean ones
   each word and each word prefix (3 to 6 characters) occurs. The probability
   that a document holding the unit is toxic is a Dirichlet posterior whose
   prior is the posterior of the next shorter prefix (``PRIOR`` pseudo
   documents; the shortest has the base rate as prior), so an unseen word takes
   the log-odds of its longest known prefix. A token scores
   ``logit(posterior) - logit(base rate) - DRIFT``, never below ``-DROP``.
2. Segments. One linear scan (Ruzzo and Tompa) finds all maximal scoring
   segments of a document; each is a passage.
3. Calibration. The best segment of ``n`` tokens of clean text follows an
   extreme-value law with ``E = K n exp(-lambda S)``. Lambda and K are fitted on
   clean documents left out of the counts. A document's segments are taken
   together by the r-segment sum statistic of that law (the best r), and a
   logistic link from its square root to the label gives the score. A passage is significant if its
   own ``E`` is at most ``MAX_E``.

Units are told apart by a stored 64-bit key and counted exactly in Spark; the
table grows with the distinct units of the labelled sample, and a unit that is
not in it has no count. At most about ``MAX_LABELS`` labelled rows are used for
fitting, a share of the ids by their hash: the documented bound of the labelled
sample, and so of the table. A text counts once, however many labelled rows
repeat it, as toxic if any of them is; counts depend on no batch and no file.
Counting, scoring and segments run inside Spark tasks. Words are runs of ASCII letters and non-ASCII characters of
the lower-cased text.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LETTERS, Chunk, crc_mod, hint_if_small, materialise, mix64, pieces

HELD = 1 << 20  # units a task counts before it passes them on
PREFIXES = (3, 4, 5, 6)
PRIOR = 4.0
DRIFT = 2.0
DROP = 0.6
MAX_LABELS = 200_000
MAX_E = 0.01
THRESHOLD = 0.3
MIN_SEGMENT = 0.2  # weaker segments are left out of the calibration


def _units(chunk: Chunk) -> list[np.ndarray]:
    """Key of every word's prefixes (shortest first) and of the word itself."""
    return [*chunk.prefix_hashes(PREFIXES), chunk.word_hashes()]


class Model:
    """Sorted ``keys`` of units with the toxic and clean documents that hold each; ``rate`` the share of toxic ones."""

    def __init__(self, keys: np.ndarray, clean: np.ndarray, toxic: np.ndarray, n_clean: int, n_toxic: int):
        self.keys, self.clean, self.toxic = keys, clean.astype(np.float32), toxic.astype(np.float32)
        self.n_clean, self.n_toxic = n_clean, n_toxic
        self.empty = self.n_toxic == 0 or self.n_clean == 0
        self.rate = (self.n_toxic + 1.0) / (self.n_clean + self.n_toxic + 2.0)
        self.lam, self.k, self.slope, self.offset = 1.0, 0.1, 1.0, math.log(self.rate / (1 - self.rate))

    def calibrated_as(self, other: Model) -> Model:
        self.lam, self.k, self.slope, self.offset = other.lam, other.k, other.slope, other.offset
        return self

    @classmethod
    def of(cls, state: dict) -> Model:
        model = cls.__new__(cls)
        model.__dict__.update(state)
        return model

    def token_scores(self, chunk: Chunk) -> np.ndarray:
        if self.empty or not len(self.keys):
            return np.full(len(chunk.starts), -DROP)
        units = _units(chunk)
        _, first, where = np.unique(units[-1], return_index=True, return_inverse=True)  # each word of the chunk once
        p = np.full(len(first), self.rate)
        for h in units:
            own = h[first]
            at = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
            known = self.keys[at] == own
            n0, n1 = np.where(known, self.clean[at], 0), np.where(known, self.toxic[at], 0)
            p = (n1 + PRIOR * p) / (n0 + n1 + PRIOR)
        odds = np.log(p / (1 - p)) - math.log(self.rate / (1 - self.rate)) - DRIFT
        return np.maximum(odds, -DROP)[where]

    def bits(self, score, n):
        """``-ln E`` of segments scoring ``score`` in texts of ``n`` tokens."""
        return self.lam * np.asarray(score) - np.log(np.maximum(self.k * np.maximum(n, 1), 1.0))

    def significance(self, scores: list[float], n: int) -> float:
        """``-ln P`` of a text's segments together: the best over r of the r-segment sum statistic."""
        bits = self.bits(sorted(scores, reverse=True), n)
        bits = bits[bits > 1.0]
        if not len(bits):
            return 0.0
        total, r = np.cumsum(bits), np.arange(len(bits))
        factorials = np.cumsum(np.log(np.maximum(r, 1)))  # ln (r-1)!
        return float((total - r * np.log(total) + 2 * factorials + np.log(r + 1)).max())

    def probability(self, significance: np.ndarray) -> np.ndarray:
        """Calibrated probability of label 1."""
        if self.empty:
            return np.zeros(len(significance))
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * np.sqrt(significance) + self.offset, -700, 700)))


def segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, start, end) in order, by one linear scan.

    Ruzzo and Tompa: a candidate is merged to the left while a candidate with a
    smaller left sum and a smaller right sum exists. Only positive tokens open
    candidates; the sums before each come from one cumulative sum.
    """
    pos = np.flatnonzero(scores > 0)
    if not len(pos):
        return []
    total = np.cumsum(scores)
    left = (total[pos] - scores[pos]).tolist()
    right = total[pos].tolist()
    out: list[tuple[float, float, int, int]] = []  # left sum, right sum, start, end
    prev: list[int] = []  # nearest earlier candidate with a smaller left sum
    for lo, hi, at in zip(left, right, pos.tolist(), strict=True):
        start = at
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][0] >= lo:
                j = prev[j]
            if j < 0 or out[j][1] >= hi:
                out.append((lo, hi, start, at + 1))
                prev.append(j)
                break
            lo, start = out[j][0], out[j][2]
            del out[j:], prev[j:]
    return [(hi - lo, s, e) for lo, hi, s, e in out]


def _labelled(docs: DataFrame, labels: DataFrame, text: str, label: str, key: str) -> DataFrame:
    """(text, toxic, fold) of the labelled sample, every text once; it is small and counted, so the texts never shuffle."""
    # One label per id: the larger of contradicting ones. The sample takes a share of the ids by their hash.
    one = materialise(labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("__id"))
                      .agg(F.max(F.col(label).cast("int")).alias("toxic")), "labels")
    share = min(1.0, 0.95 * MAX_LABELS / max(one.count(), 1))
    few = hint_if_small(one.where(F.pmod(F.xxhash64("__id"), F.lit(1 << 30)) < int(share * (1 << 30))), MAX_LABELS)
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{key}`").alias("__id"), body.alias("text")).withColumn("__md5", F.unhex(F.md5(F.col("text").cast("binary"))))
    # Equal texts: the smallest id stands for all, with the larger of their labels; its fold goes by the text.
    named = materialise(rows.select("__id", "__md5").join(few, "__id").groupBy("__md5").agg(F.min("__id").alias("__id"), F.max("toxic").alias("toxic")), "texts")
    chosen = hint_if_small(named.withColumn("fold", F.pmod(F.xxhash64("__md5", F.lit(7)), F.lit(4))), MAX_LABELS)
    return rows.join(chosen, ["__id", "__md5"]).select("text", "toxic", "fold")


def _count_units(batches):
    """Per task: clean and toxic texts that hold each unit (fold and unit null: texts), passed on every ``HELD`` units."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    size, texts = 0, {}

    def flush():
        for fold, parts in held.items():
            keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            n = np.zeros((len(keys), 2), np.int64)
            np.add.at(n, at, np.concatenate([c for _, c in parts]))
            yield pa.record_batch({"fold": pa.array(np.full(len(keys), fold, np.int32)), "key": pa.array(keys.view(np.int64)), "n0": pa.array(n[:, 0]), "n1": pa.array(n[:, 1])})
        held.clear()

    for batch in batches:
        body, toxic = batch.column("text").to_pylist(), (batch.column("toxic").to_numpy() > 0).astype(np.int64)
        folds = (batch.column("fold").to_numpy() == 0).astype(np.int64)  # the held fold is 1 here
        for fold in (0, 1):
            own = np.flatnonzero(folds == fold)
            n = np.bincount(toxic[own], minlength=2)
            texts[fold] = texts.get(fold, np.zeros(2, np.int64)) + n
            seen: dict[int, np.ndarray] = {}  # units of a text whose parts lie in several chunks
            for owner, chunk in pieces([body[i] for i in own], LETTERS, lower=True):
                who = owner[chunk.owners()]
                tag = mix64(who.astype(np.uint64))
                for level, h in enumerate(_units(chunk)):
                    at = np.unique(h ^ tag, return_index=True)[1]  # once per text
                    h, of = h[at], who[at]
                    last = of == owner[-1]
                    if level in seen and seen[level][0] == owner[0]:
                        again = (of == owner[0]) & np.isin(h, seen[level][1])
                        h, of, last = h[~again], of[~again], last[~again]
                        before = seen[level][1] if owner[0] == owner[-1] else np.empty(0, np.uint64)
                    else:
                        before = np.empty(0, np.uint64)
                    seen[level] = (owner[-1], np.concatenate([before, h[last]]))
                    keys, back = np.unique(h, return_inverse=True)
                    c = np.zeros((len(keys), 2), np.int64)
                    np.add.at(c, (back, toxic[own][of]), 1)
                    held.setdefault(fold, []).append((keys, c))
                    size += len(keys)
                if size >= HELD:
                    yield from flush()
                    size = 0
    yield from flush()
    for fold, n in texts.items():
        yield pa.record_batch({"fold": pa.array([fold], pa.int32()), "key": pa.array([None], pa.int64()), "n0": pa.array(n[:1]), "n1": pa.array(n[1:])})


def _scan(batches, model):
    """(batch, tokens per text, segments per text) of every batch."""
    for batch in batches:
        texts = batch.column("__text").to_pylist()
        size, found, open_text, held = np.zeros(len(texts), np.int64), [[] for _ in texts], None, []

        def close(i, parts, found=found):
            scores = parts[0] if len(parts) == 1 else np.concatenate(parts)
            if (scores > 0).any():
                found[i] = segments(scores)

        for owner, chunk in pieces(texts, LETTERS, lower=True):
            scores = model.token_scores(chunk)
            np.add.at(size, owner, chunk.n_words)
            for part, i in enumerate(owner.tolist()):
                if i != open_text:
                    if open_text is not None:
                        close(open_text, held)
                    open_text, held = i, []
                held.append(scores[chunk.first[part]:chunk.first[part + 1]])
        if open_text is not None:
            close(open_text, held)
        yield batch, size, found


def _counts(rows: DataFrame) -> DataFrame:
    """Stored (fold, key, n0, n1) of labelled rows; fold 1 is the held one, a null key counts the texts."""
    return materialise(rows.mapInArrow(_count_units, "fold int, key long, n0 long, n1 long")
                       .groupBy("fold", "key").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "units")


def _model(counts: DataFrame) -> Model:
    """Model of stored counts; their number is bounded by the labelled sample."""
    got = counts.groupBy("key").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    texts = got.where("key is null").first()
    units = got.where("key is not null").toArrow()
    keys = units.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return Model(keys[order], units.column("n0").to_numpy()[order], units.column("n1").to_numpy()[order], texts.n0 if texts else 0, texts.n1 if texts else 0)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id") -> Model:
    """Fit the log-odds on three of four folds of the labelled texts and the calibration on the fourth."""
    spark = docs.sparkSession
    rows = _labelled(docs, labels, text, label, key)
    counts = _counts(rows)
    model = _model(counts.where("fold = 0"))
    if model.empty:
        return model
    shared = spark.sparkContext.broadcast(vars(model))

    def held(batches):
        for batch, size, found in _scan(batches, Model.of(shared.value)):
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(size), pa.array([[s[0] for s in segs if s[0] >= MIN_SEGMENT] for segs in found], pa.list_(pa.float64()))],
                names=["toxic", "n", "segs"])

    out = (rows.where("fold = 0").select("toxic", F.col("text").alias("__text"))
           .mapInArrow(held, "toxic int, n long, segs array<double>").toArrow())
    _calibrate(model, out.column("toxic").to_numpy(), out.column("n").to_numpy(), out.column("segs").to_pylist())
    return _model(counts).calibrated_as(model)  # the calibrated model then learns from all texts


def _calibrate(model: Model, toxic: np.ndarray, n: np.ndarray, segs: list[list[float]]) -> None:
    """Extreme-value parameters from clean documents (excesses over a threshold), then a ridge logistic link."""
    best = np.array([max(s, default=0.0) for s in segs])
    clean = (toxic == 0) & (n > 0)
    if clean.sum() >= 20:
        s = best[clean]
        u, top = np.quantile(s, 0.8), np.quantile(s, 0.98)  # contradicting labels lie beyond the upper one
        over = s > u
        if over.any():
            model.lam = float(np.clip(1.0 / max(float((np.minimum(s[over], top) - u).mean()), 1e-3), 0.3, 5.0))
            model.k = float(-math.log1p(-over.mean()) * math.exp(model.lam * u) / n[clean].mean())
    x = np.sqrt(np.array([model.significance(s, m) for s, m in zip(segs, n.tolist(), strict=True)], float))
    y = (toxic > 0).astype(float)
    if len(x) < 20 or y.min() == y.max():
        return
    mean, sd = float(x.mean()), max(float(x.std()), 1e-6)
    z = np.stack([(x - mean) / sd, np.ones(len(x))], axis=1)
    w, ridge = np.zeros(2), np.diag([0.01, 1e-3])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + ridge, z.T @ (y - p) - ridge @ w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    model.slope, model.offset = float(w[0] / sd), float(w[1] - w[0] * mean / sd)


def score(docs: DataFrame, model: Model, carry: list[str], text: str = "text") -> DataFrame:
    """``carry`` columns plus score (0 to 1), predicted, n_tokens, best_segment and passages.

    ``passages`` lists every significant segment as (start token, end token,
    score, e_value). A null or empty text scores 0 and has no passage. Every row
    gets a row; rows that repeat a text score alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    kind = pa.list_(pa.struct([("start_token", pa.int64()), ("end_token", pa.int64()), ("segment_score", pa.float64()), ("e_value", pa.float64())]))

    def run(batches):
        m = Model.of(shared.value)
        for batch, size, found in _scan(batches, m):
            p = m.probability(np.array([m.significance([s[0] for s in segs], n) for segs, n in zip(found, size.tolist(), strict=True)], float))
            passages = []
            for segs, n in zip(found, size.tolist(), strict=True):
                e = np.exp(-m.bits([s[0] for s in segs], n)) if segs else ()
                passages.append([{"start_token": a, "end_token": b, "segment_score": s, "e_value": float(v)}
                                 for (s, a, b), v in zip(segs, e, strict=True) if v <= MAX_E])
            best = np.array([max((s[0] for s in segs), default=0.0) for segs in found], float)
            columns = [pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32)), pa.array(size), pa.array(best), pa.array(passages, kind)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carry], *columns],
                                             names=[*carry, "score", "predicted", "n_tokens", "best_segment", "passages"])

    src = docs.select(*[F.col(f"`{c}`") for c in carry], F.col(f"`{text}`").cast("string").alias("__text"))
    kept = docs.select(*[F.col(f"`{c}`") for c in carry])
    schema = (", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", " if carry else "") + \
        "score double, predicted int, n_tokens long, best_segment double, passages array<struct<start_token: long, end_token: long, segment_score: double, e_value: double>>"
    return src.mapInArrow(run, schema)


def training_rows(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows whose crc32 of the id, modulo 4, is not 2."""
    return docs.where(crc_mod(key, 4) != 2)

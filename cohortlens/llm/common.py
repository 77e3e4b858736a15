"""Helpers shared by the document operators."""

from __future__ import annotations

import re
import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.session import scratch

# Task functions travel with the plan, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__package__])

# A narrow stored table is offered to a broadcast only after its rows are counted (some 16 to 50 bytes each).
BROADCAST_ROWS = 500_000


BATCH_ROWS = 1_000  # rows of texts that go to a Python worker at once, where a step asks for it


def materialise(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet under the shared checkpoint folder, read it back.

    The folder is the one the cluster names in ``spark.checkpoint.dir``, so a
    lost executor costs only the tasks it was running, never the table. It is
    deleted when the application ends. ``batch_rows`` bounds the Arrow batches
    of this write, for steps that send whole texts to Python.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    rows = spark.conf.get(_ARROW_ROWS)
    if batch_rows is not None:
        spark.conf.set(_ARROW_ROWS, str(min(batch_rows, int(rows)) if int(rows) > 0 else batch_rows))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_ARROW_ROWS, rows)
    return spark.read.schema(df.schema).parquet(path)


_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def hint_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a *stored* narrow table whose counted rows are within the bound."""
    return F.broadcast(df) if df.count() <= rows else df


def crc_mod(col: str, n: int) -> Column:
    """crc32 of the column's text, modulo ``n`` (null ids count as the empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % n


_BASE = np.uint64(0x9E3779B97F4A7C15)
CHUNK_BYTES = 1 << 20


def byte_class(separators: bytes) -> np.ndarray:
    """256 flags: bytes that belong to words when ``separators`` do not."""
    flags = np.ones(256, bool)
    flags[list(separators)] = False
    return flags


# ASCII that is no letter; the white space of the word rule [^\x20\x09-\x0D]+.
LETTERS = byte_class(bytes(i for i in range(128) if not chr(i).isalpha()))
NON_SPACE = byte_class(b" \t\n\x0b\x0c\r")


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit values (multiply and xor-shift)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


class Chunk:
    """Some whole texts as one UTF-8 buffer with the words of all of them located at once.

    ``starts``/``ends`` are byte positions of the words, ``first`` the index of
    every text's first word (one entry more than texts), ``begin`` the byte
    position of every text. Nothing here is per word in Python: tokenising and
    hashing are array operations over the buffer.
    """

    def __init__(self, texts: list[str | None], word_bytes: np.ndarray, lower: bool):
        raw = [(t.lower() if lower else t).encode("utf-8", "replace") if t else b"" for t in texts]
        self.data = np.frombuffer(b"\n" + b"\n".join(raw) + b"\n", np.uint8)
        self.begin = np.concatenate([[1], 1 + np.cumsum([len(r) + 1 for r in raw])]).astype(np.int64)
        self.inside = word_bytes[self.data]
        step = np.diff(self.inside.view(np.int8))
        self.starts = np.flatnonzero(step == 1) + 1
        self.ends = np.flatnonzero(step == -1) + 1
        self.first = np.searchsorted(self.starts, self.begin)

    def __len__(self) -> int:
        return len(self.begin) - 1

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first)

    def owners(self) -> np.ndarray:
        """Index of the text of every word."""
        return np.repeat(np.arange(len(self)), self.n_words)

    def words(self, at: np.ndarray) -> list[bytes]:
        """Bytes of the words number ``at``."""
        data = self.data.tobytes()
        return [data[a:b] for a, b in zip(self.starts[at].tolist(), self.ends[at].tolist(), strict=True)]

    def word_hashes(self) -> np.ndarray:
        """64-bit hash of every word: a polynomial over its bytes, mixed."""
        if not len(self.starts):
            return np.empty(0, np.uint64)
        size = self.ends - self.starts
        powers = np.cumprod(np.full(int(size.max()), _BASE))
        at = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(at, size)
        with np.errstate(over="ignore"):
            return mix64(np.add.reduceat((self.data[self.inside].astype(np.uint64) + np.uint64(1)) * powers[place], at))

    def prefix_hashes(self, lengths: tuple[int, ...]) -> list[np.ndarray]:
        """Hash of the first ``k`` bytes of every word (the whole word if shorter), for each ``k``."""
        size, h, out, power = self.ends - self.starts, np.zeros(len(self.starts), np.uint64), [], np.uint64(1)
        with np.errstate(over="ignore"):
            for j in range(max(lengths)):
                power = power * _BASE
                at = np.minimum(self.starts + j, len(self.data) - 1)
                h = h + np.where(size > j, (self.data[at].astype(np.uint64) + np.uint64(1)) * power, np.uint64(0))
                if j + 1 in lengths:
                    out.append(mix64(h + np.uint64(j + 1)))
        return out

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sum of per-word values (rows) for every text."""
        sums = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
        return sums[self.first[1:]] - sums[self.first[:-1]]


def chunks(texts: list[str | None], word_bytes: np.ndarray, lower: bool, most: int = CHUNK_BYTES):
    """(start index, Chunk) over runs of whole texts of about ``most`` bytes each; one longer text is a run of its own."""
    start = 0
    while start < len(texts):
        end, size = start, 0
        while end < len(texts) and (end == start or size + len(texts[end] or "") <= most):
            size += len(texts[end] or "")
            end += 1
        yield start, Chunk(texts[start:end], word_bytes, lower)
        start = end


def pieces(texts: list[str | None], word_bytes: np.ndarray, lower: bool, most: int = CHUNK_BYTES):
    """(text index of every part, Chunk of the parts) over all texts; a longer text than ``most`` comes in parts that cut no word.

    Parts of some texts share a chunk; a text's parts come in order. For what
    depends on words alone: memory is that of one chunk, however long a text.
    """
    breaks = re.compile("[" + re.escape("".join(chr(i) for i in range(128) if not word_bytes[i])) + "]")
    parts, owner, size = [], [], 0
    for i, text in enumerate(texts):
        at, n = 0, len(text or "")
        while at < n or (at == 0 == n):
            end = n
            if n - at > most:
                cut = breaks.search(text, at + most)
                end = cut.end() if cut else n
            if parts and size + end - at > most:
                yield np.array(owner), Chunk(parts, word_bytes, lower)
                parts, owner, size = [], [], 0
            parts.append(text[at:end] if text else None)
            owner.append(i)
            size += end - at
            if end >= n:
                break
            at = end
    if parts:
        yield np.array(owner), Chunk(parts, word_bytes, lower)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

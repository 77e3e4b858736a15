"""Interaction of filters: contingency tensors per part, contracted for every order and step.

Every document has one bit per filter (1: it fails). Per part the documents are
counted in a tensor of 2 x 2 x 2 x 2 x 2 cells, one axis a filter; the same for
the good and the toxic ones. Every figure of the audit is a contraction that
takes pass ``(1, 0)``, fail ``(0, 1)`` or all ``(1, 1)`` along each axis:

* kept after a step: pass along the filters so far, all along the others;
* removed at a step: fail along its filter, pass along those before, all after;
* redundant: all failures of the filter less those it removed;
* unique failures: fail along one axis, pass along the others.

One ``einsum`` gives all 3^5 choices for a batch of parts, so the 120 orders
cost no further pass over the documents. The texts are read once, for a narrow
table (part, id, four bits, SHA-256 of the text); counts are partial sums, so a
part or a text of any number of rows is no single task's.
"""

from __future__ import annotations

from itertools import permutations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

FILTERS = "ABCDE"
SALTS = 16  # copies of a marked label, so that one id with very many rows meets it in several tasks
_AXES = len(FILTERS)
_PASS, _FAIL, _ALL = range(3)
_TAKE = np.array([[1, 0], [0, 1], [1, 1]], np.int64)
_CHOICES = np.array(list(product(range(3), repeat=_AXES)))
_MEASURES = ("n", "good", "toxic")
# White space of the word rule and the symbols of condition D.
_SPACES = r"[\x20\x09-\x0D]+"
_SYMBOLS = r"[#$%&*|]"


def failures(text: Column, words: Column) -> list[Column]:
    """Conditions A to D on a text without nulls and its words: few words, repeated words, capitals, symbols."""
    n = F.size(words)
    return [n < 50, 100 * F.size(F.array_distinct(words)).cast("long") < 65 * n.cast("long"),
            100 * (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))).cast("long") > 5 * F.length(text).cast("long"), text.rlike(_SYMBOLS)]


def cells(docs: DataFrame, labels: DataFrame, part: str = "source", key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts per part and cell: part, cell (bit 16 for A to bit 1 for E), n, good, toxic; at most 32 rows a part.

    Condition E fails where a smaller key has the same text anywhere in ``docs``:
    rows without a key neither fail it nor make others fail it, and rows that
    share the smallest key of a text all pass. Texts are told apart by SHA-256.
    """
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    bits = sum((c.cast("int") * (1 << (_AXES - 1 - i)) for i, c in enumerate(failures(F.col("body"), F.col("words")))), F.lit(0))
    base = materialise(docs.select(F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), F.col(f"`{key}`").alias("id"), body.alias("body"))
                       .withColumn("words", F.array_remove(F.split("body", _SPACES), ""))
                       .select("part", "id", F.unhex(F.sha2(F.col("body"), 256)).alias("hash"), bits.alias("bits")), "bits")
    marked = (labels.groupBy(F.col("doc_id").alias("label_id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
              .where("label_id is not null and (good = 1 or toxic = 1)").withColumn("label_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    rows = base.groupBy("part", "id", "hash", "bits").agg(F.count("*").alias("n")).withColumn("salt", F.pmod(F.xxhash64("hash", "part"), F.lit(SALTS)).cast("int"))
    # The size of the labels is estimated without their copies, so a broadcast would bring many times that to the driver: merged instead.
    known = rows.where("id is not null").join(marked.hint("merge"), (F.col("id") == F.col("label_id")) & (F.col("salt") == F.col("label_salt")), "left")
    counts = [F.col("n"), *[(F.col("n") * F.coalesce(F.col(c), F.lit(0))).alias(c) for c in _MEASURES[1:]]]
    tagged = materialise(known.select("part", "id", "hash", "bits", *counts)
                         .unionByName(rows.where("id is null").select("part", "id", "hash", "bits", "n", F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("toxic"))), "tagged")
    sums = [F.sum(c).cast("long").alias(c) for c in _MEASURES]
    # Rows that pass E, found by (text, its smallest id): no task holds all rows of a text.
    first = tagged.where("id is not null").groupBy("hash").agg(F.min("id").alias("id"))
    passing = (tagged.join(first, ["hash", "id"], "left_semi").unionByName(tagged.where("id is null").select("hash", "id", *[c for c in tagged.columns if c not in ("hash", "id")]))
               .groupBy("part", "bits").agg(*sums))
    less = passing.select("part", (F.col("bits") + 1).alias("bits"), *[(-F.col(c)).alias(c) for c in _MEASURES])
    every = tagged.groupBy("part", (F.col("bits") + 1).alias("bits")).agg(*sums)
    return passing.unionByName(every).unionByName(less).groupBy("part", F.col("bits").alias("cell")).agg(*sums)


def _code(take: list[int]) -> int:
    return int(sum(t * 3 ** (_AXES - 1 - i) for i, t in enumerate(take)))


def _steps():
    """(order, step, axis, contraction kept, removed) of all orders."""
    for order in permutations(range(_AXES)):
        for k, axis in enumerate(order):
            before = [_PASS if a in order[:k] else _ALL for a in range(_AXES)]
            at = lambda own: _code([own if a == axis else before[a] for a in range(_AXES)])
            yield "".join(FILTERS[a] for a in order), k + 1, axis, at(_PASS), at(_FAIL)


def contract(tensor: np.ndarray) -> np.ndarray:
    """All 3^5 contractions of tensors (parts x 2 x 2 x 2 x 2 x 2): parts x choices."""
    return np.einsum("pabcde,sa,sb,sc,sd,se->ps", tensor, *(_TAKE[_CHOICES[:, i]] for i in range(_AXES)), optimize=True)


def _audit(batches):
    """Task: the rows of all orders and steps for each part of a batch."""
    order, step, axis, kept, removed = (list(x) for x in zip(*_steps(), strict=True))
    axis, kept, removed = np.array(axis), np.array(kept), np.array(removed)
    failing = np.array([_code([_FAIL if a == b else _ALL for b in range(_AXES)]) for a in range(_AXES)])
    alone = np.array([_code([_FAIL if a == b else _PASS for b in range(_AXES)]) for a in range(_AXES)])
    for batch in batches:
        parts, cells_of = batch.column("part").to_pylist(), batch.column("cells").to_pylist()
        counts = np.zeros((len(_MEASURES), len(parts), 1 << _AXES), np.int64)
        for p, own in enumerate(cells_of):
            for c in own:
                counts[:, p, c["cell"]] += [c[m] for m in _MEASURES]
        n, good, toxic = (contract(t.reshape(-1, *[2] * _AXES)) for t in counts)
        gone = n[:, removed]
        shapley = np.zeros((len(parts), _AXES), np.int64)
        np.add.at(shapley, (slice(None), axis), gone)
        columns = {"kept": n[:, kept], "removed": gone, "redundant": n[:, failing[axis]] - gone, "unique_fails": n[:, alone[axis]],
                   "good_lost": good[:, removed], "toxic_lost": toxic[:, removed], "shapley": shapley[:, axis]}
        yield pa.record_batch({"part": pa.array([p for p in parts for _ in order], pa.string()), "filter_order": pa.array(order * len(parts), pa.string()),
                               "step": pa.array(step * len(parts), pa.int32()), **{k: pa.array(v.ravel(), pa.int64()) for k, v in columns.items()}})


def audit(docs: DataFrame, labels: DataFrame, part: str = "source", key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per part, filter order (all 120) and step (1 to 5): kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    A null part is the empty one, a null text the empty text. A document is
    good or toxic if any label row of its key says so; rows without a key have
    no label. Repeated rows count each. An empty table gives no row. Columns
    beside the three named ones are not read.
    """
    packed = cells(docs, labels, part, key, text).groupBy("part").agg(F.collect_list(F.struct("cell", *_MEASURES)).alias("cells"))  # at most 32 a part
    return packed.mapInArrow(_audit, "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
                                     "good_lost long, toxic_lost long, shapley long")

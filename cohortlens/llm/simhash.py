"""SimHash near-duplicates: pigeonhole blocks, Hamming check, linked components.

Fingerprint. The text's ASCII letters are lower-cased and its words
``[^\\x20\\x09-\\x0D]+`` taken; each shingle of ``SHINGLE`` consecutive words
(repeats included, joined by one space; a shorter text is one shingle) is hashed
by XXH64 with seed 42; a bit of the fingerprint is 1 if set in over half of the
hashes. A text without words has fingerprint zero.

Blocks. The 64 bits are cut into ``blocks`` blocks. Two fingerprints that differ
in at most ``distance`` bits agree on at least ``blocks - distance`` blocks, so
they share the key of one choice of that many blocks. Only distinct
fingerprints are keyed (copies meet before); rows of one key meet in one sorted
run of a task, where all pairs within the distance are found and *connected*:
the task emits each linked fingerprint with the smallest of its linked group,
never the pairs. A long run is cut further by the blocks not yet used, which is
exact by the same argument.

Components. Links are contracted in Spark: every fingerprint hooks to its
smallest neighbour, pointers are jumped to the roots, links are renamed to
roots, until none is left. All steps are joins and partial aggregates over
tables in the shared folder; nothing reaches the driver but counts.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

SHINGLE = 4
DISTANCE = 4
BLOCKS = 7
RUN = 4096  # fingerprints of one key compared directly; a longer run is cut by further blocks
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BIT_BATCH = 1 << 15


def fingerprint(words: list[bytes], shingle: int = SHINGLE) -> int:
    """Fingerprint of a text's words (already lower-cased)."""
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, 42)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - shingle + 1
    h = np.fromiter((xxhash.xxh64_intdigest(line[a:b], 42) for a, b in zip(starts[:n].tolist(), ends[shingle - 1:].tolist(), strict=True)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, _BIT_BATCH):
        part = h[i:i + _BIT_BATCH]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, carry: list[str], text: str = "text", shingle: int = SHINGLE, name: str = "fingerprint") -> DataFrame:
    """``carry`` columns plus the fingerprint as a signed long. Null and empty texts have 0."""

    def run(batches):
        for batch in batches:
            texts = batch.column("__text").to_pylist()
            out = [fingerprint((t.encode("utf-8", "replace").translate(_LOWER).split() if t else []), shingle) for t in texts]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carry], pa.array(np.array(out, np.uint64).view(np.int64))], names=[*carry, name])

    kept = docs.select(*[F.col(f"`{c}`") for c in carry], F.col(f"`{text}`").cast("string").alias("__text"))
    schema = docs.select(*[F.col(f"`{c}`") for c in carry]).schema.add(name, "long")
    return kept.mapInArrow(run, schema)


def _bounds(blocks: int) -> list[tuple[int, int]]:
    """(first bit, width) of every block; widths differ by one at most."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _choices(distance: int, blocks: int) -> list[int]:
    """Bit masks of all choices of ``blocks - distance`` blocks."""
    bounds = _bounds(blocks)
    return [sum(((1 << w) - 1) << a for a, w in pick) for pick in combinations(bounds, blocks - distance)]


def _connect(values: np.ndarray, distance: int) -> np.ndarray:
    """Smallest member of the linked group of every value, by breadth-first search over a shrinking set."""
    label = values.copy()
    rest = np.arange(len(values))
    while len(rest):
        group = [rest[:1]]
        queue, rest = rest[:1].tolist(), rest[1:]
        while queue and len(rest):
            near = np.bitwise_count(values[rest] ^ values[queue.pop()]) <= distance
            found, rest = rest[near], rest[~near]
            queue += found.tolist()
            group.append(found)
        members = np.concatenate(group)
        label[members] = values[members].min()
    return label


def links_of_run(values: np.ndarray, mask: int, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(value, smaller linked value) arrays of one run of distinct values that agree on ``mask``."""
    if len(values) < 2:
        return []
    if len(values) <= RUN:
        label = _connect(values, distance)
        linked = label != values
        return [(values[linked], label[linked])] if linked.any() else []
    free = [b for b in range(64) if not mask >> b & 1]
    if len(free) <= 16:  # all values are within few bits: blocks of one bit each would not cut further
        label = _connect(values, distance)
        linked = label != values
        return [(values[linked], label[linked])]
    out = []
    n = distance + 2
    groups = [sum(1 << b for b in free[len(free) * i // n:len(free) * (i + 1) // n]) for i in range(n)]
    for pick in combinations(groups, n - distance):
        more = sum(pick)
        key = values & np.uint64(more)
        order = np.argsort(key, kind="stable")
        cuts = np.flatnonzero(np.diff(key[order])) + 1
        for part in np.split(order, cuts):
            out += links_of_run(np.sort(values[part]), mask | more, distance)
    return out


def _runs(distance: int, masks: list[int]):
    """Task over rows (choice, key, value) sorted by them: links of every run of equal (choice, key)."""

    def flush(choice: int, values: list[np.ndarray]):
        return links_of_run(np.concatenate(values), masks[choice], distance)

    def run(batches):
        open_key, open_values = None, []
        for batch in batches:
            choice = batch.column("choice").to_numpy()
            key = batch.column("key").to_numpy()
            value = batch.column("value").to_numpy().view(np.uint64)
            if not len(choice):
                continue
            cuts = np.flatnonzero((np.diff(key) != 0) | (np.diff(choice) != 0)) + 1
            starts = np.concatenate([[0], cuts])
            ends = np.concatenate([cuts, [len(key)]])
            links = []
            if open_key is not None and (int(choice[0]), int(key[0])) != open_key:
                links += flush(open_key[0], open_values)
                open_key, open_values = None, []
            first = 0
            if open_key is not None:
                open_values.append(value[:ends[0]])
                first = 1
                if len(starts) > 1:
                    links += flush(open_key[0], open_values)
                    open_key, open_values = None, []
            if first < len(starts):
                # Runs of two need one comparison each: all at once.
                size = ends - starts
                inner = np.arange(first, len(starts) - 1)
                two = starts[inner[size[inner] == 2]]
                near = np.bitwise_count(value[two] ^ value[two + 1]) <= distance
                a, b = value[two[near]], value[two[near] + 1]
                links.append((np.maximum(a, b), np.minimum(a, b)))
                for i in inner[size[inner] > 2].tolist():
                    links += links_of_run(value[starts[i]:ends[i]], masks[int(choice[starts[i]])], distance)
                last = starts[-1]
                open_key, open_values = (int(choice[last]), int(key[last])), [value[last:]]
            yield _link_batch(links)
        if open_key is not None:
            yield _link_batch(flush(open_key[0], open_values))

    return run


def _link_batch(links: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    cols = [np.concatenate([link[i] for link in links]) if links else np.empty(0, np.uint64) for i in (0, 1)]
    return pa.record_batch({"u": pa.array(cols[0].view(np.int64)), "v": pa.array(cols[1].view(np.int64))})


def links(values: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """Distinct (u, v), v smaller as an unsigned number: connects exactly what pairs within ``distance`` connect.

    ``values`` has one column ``value`` of distinct longs.
    """
    masks = _choices(distance, blocks)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = (values.select("value", F.posexplode(F.array(*[F.col("value").bitwiseAND(F.lit(m)) for m in signed])).alias("choice", "key"))
             .repartition("choice", "key").sortWithinPartitions("choice", "key", "value"))
    return keyed.mapInArrow(_runs(distance, masks), "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v): one root per connected component.

    Every round hooks each node to its smallest neighbour if that is smaller,
    jumps the pointers to the roots and renames the edges; at least the larger
    end of every edge disappears from its component's nodes.
    """
    edges = materialise(edges.select("u", "v"), "edges")
    rounds = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parent = materialise(both.groupBy("u").agg(F.min("v").alias("v"))
                             .select(F.col("u").alias("node"), F.least("u", "v").alias("root")), "parents")
        while True:
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("next"))
            jumped = materialise(parent.join(up, "root", "left")
                                 .select("node", F.coalesce("next", "root").alias("root"), (F.coalesce("next", "root") != F.col("root")).alias("moved")), "jump")
            moved = not jumped.where("moved").isEmpty()
            parent = jumped.select("node", "root")
            if not moved:
                break
        rounds.append(parent)
        edges = materialise(_renamed(_renamed(edges, parent, "u"), parent, "v").where("u <> v").distinct(), "edges")
    if not rounds:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    # A node's root of one round may have been hooked in a later one.
    total = rounds[0]
    for later in rounds[1:]:
        step = later.select(F.col("node").alias("root"), F.col("root").alias("next"))
        total = materialise(total.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "roots")
    return total


def _renamed(edges: DataFrame, parent: DataFrame, end: str) -> DataFrame:
    other = "v" if end == "u" else "u"
    to = parent.select(F.col("node").alias(end), F.col("root").alias("__to"))
    return edges.join(to, end, "left").select(F.coalesce("__to", end).alias(end), other).select("u", "v")


def roots(values: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """(value, root) of every distinct fingerprint of ``values`` (column value): one root per linked component."""
    found = components(links(values, distance, blocks))
    return values.join(found.withColumnRenamed("node", "value"), "value", "left").select("value", F.coalesce("root", "value").alias("root"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """(key, fingerprint long, component_id) of every row; ``component_id`` is the smallest key reachable over links.

    Rows with a null key take part in linking, and get the component's smallest
    non-null key (null if it has none). Equal fingerprints are linked.
    """
    marked = materialise(fingerprints(docs, [key], text, shingle, "__fp").withColumnRenamed(key, "__key"), "fingerprints")
    lowest = materialise(marked.groupBy("__fp").agg(F.min("__key").alias("lowest")), "distinct")
    grouped = lowest.join(roots(lowest.select(F.col("__fp").alias("value")), distance, blocks).withColumnRenamed("value", "__fp"), "__fp")
    linked = grouped.groupBy("root").agg(F.min("lowest").alias("component_id"))
    named = materialise(grouped.join(linked, "root").select("__fp", "component_id"), "named")
    return marked.join(named, "__fp").select(F.col("__key").alias(key), F.col("__fp").alias("fingerprint"), "component_id")


def _row_hash(docs: DataFrame) -> Column:
    """64-bit hash of all columns; columns that hold maps count as their JSON text."""
    return F.xxhash64(*[F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in docs.schema])


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component; columns unchanged.

    The row of the smallest key stays (rows without a key come last), among
    rows of one key the one whose columns have the smallest hash; of rows equal
    in every column one. Rows are named by (key, hash of all columns), so rows
    that share a key are told apart. The rows that go are named and left out:
    the texts are not shuffled while those are few.
    """
    own = {"__key": docs[key], "__hash": _row_hash(docs)}
    rows = materialise(fingerprints(docs.select(*[c.alias(n) for n, c in own.items()], F.col(f"`{text}`").alias("__body")), [*own], "__body", name="__fp")
                       .groupBy("__fp", "__key", "__hash").agg(F.count("*").alias("n")), "rows")
    rank = F.struct(F.col("__key").isNull().alias("none"), F.col("__key").alias("k"), F.col("__hash").alias("h"))
    best = materialise(rows.groupBy("__fp").agg(F.min(rank).alias("best")), "best")
    named = best.join(roots(best.select(F.col("__fp").alias("value"))).withColumnRenamed("value", "__fp"), "__fp")
    winners = named.groupBy("root").agg(F.min("best").alias("best")).select("best.k", "best.h")
    wins = winners["h"].eqNullSafe(rows["__hash"]) & winners["k"].eqNullSafe(rows["__key"])
    out = rows.join(winners, wins, "left_anti").select("__key", "__hash")
    repeated = materialise(rows.where("n > 1").join(winners, wins, "left_semi").select("__key", "__hash"), "repeated")
    gone = materialise(out.unionByName(repeated), "gone").withColumnsRenamed({"__key": "__k", "__hash": "__h"})
    marked = docs.withColumns(own)
    stay = marked.join(gone, (F.col("__hash") == F.col("__h")) & F.col("__key").eqNullSafe(F.col("__k")), "left_anti")
    if not repeated.isEmpty():
        again = repeated.withColumnsRenamed({"__key": "__k", "__hash": "__h"})
        stay = stay.unionByName(marked.join(again, (F.col("__hash") == F.col("__h")) & F.col("__key").eqNullSafe(F.col("__k")), "left_semi")
                                .dropDuplicates(["__key", "__hash"]))
    return stay.select(*[F.col(f"`{c}`") for c in docs.columns])

"""URL rules by a sort-merge range join: a sorted sweep with a stack of active nested rules.

A rule (host, path, verdict) fits its host and all subdomains if the url's path
starts with the rule's path; the longest rule wins.

1. A canonical key is the host with its labels reversed, a slash, then the path:
   ``com.example//en/``. A rule is the interval of all keys that its own key
   begins. A url is looked up under its host and the hosts above it, from one
   label up to as many as the deepest rule has; one more label extends the key,
   so the keys of a domain and of its subdomains lie together.
2. Keys are sampled by hash; their quantiles cut the order into segments. Keys are
   ordered by (key, row), so a key of any number of rows is spread over
   segments. A rule goes to every segment that its interval meets: intervals
   are nested, so a cut lies inside no more rules than one key has prefixes.
3. Each segment is sorted and swept once. The stack holds the rules whose
   intervals contain the current key, innermost on top; the innermost is the
   longest rule for that host. The longest over a url's hosts is its rule.

Only the stack and one batch are in memory, however many rules there are, and
no rule set is broadcast.
"""

from __future__ import annotations

from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

SEGMENT_ROWS = 250_000  # keys a segment should hold
MAX_SEGMENTS = 1 << 14  # bounds the splitters on the driver; larger segments only sort longer
OVERSAMPLE = 16  # sampled keys a segment
SPLITTER_BYTES = 256  # a splitter is a key's beginning of at most this length
_ROW = "segment int, key binary, uid long, chars int, host_chars int, rule string, verdict string"


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def _reversed(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(labels, "."), F.lit("/"), path).cast("binary")


def _splitters(probes: DataFrame, rows: int, segments: int) -> list[tuple[bytes, int]]:
    """At most ``segments - 1`` sorted (key, row): quantiles of keys sampled by hash."""
    stride = max(rows // (segments * OVERSAMPLE), 1)
    picked = probes.where(F.pmod(F.xxhash64("key", "uid"), F.lit(stride)) == 0)
    short = F.substr(F.col("key"), F.lit(1), F.lit(SPLITTER_BYTES))
    points = sorted((bytes(r.key), r.uid) for r in picked.select(
        short.alias("key"), F.when(F.octet_length("key") > SPLITTER_BYTES, -1).otherwise(F.col("uid")).alias("uid")).collect())
    return sorted({points[len(points) * i // segments] for i in range(1, segments)}) if points else []


def _deal(cuts: list[tuple[bytes, int]]):
    """Task: give every key its segment, and every rule all the segments that its interval meets."""
    def run(batches):
        for batch in batches:
            keys, uids = batch.column("key").to_pylist(), batch.column("uid").to_pylist()
            at, segment = [], []
            for i, (key, uid) in enumerate(zip(keys, uids, strict=True)):
                low = bisect_right(cuts, (key, uid))
                high = low if uid >= 0 else bisect_right(cuts, (key + b"\xff", 0))  # no UTF-8 text holds this byte
                for s in range(low, high + 1):
                    at.append(i)
                    segment.append(s)
            rows = batch.take(pa.array(at, pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(segment, pa.int32()), *rows.columns], names=["segment", *batch.schema.names])
    return run


def _sweep(batches):
    """Task: over sorted segments, the innermost rule around every url key."""
    segment, stack = None, []
    for batch in batches:
        segments, keys, uids, verdicts = (batch.column(c).to_pylist() for c in ("segment", "key", "uid", "verdict"))
        about = list(zip(*(batch.column(c).to_pylist() for c in ("chars", "host_chars", "rule")), strict=True))
        found = []
        for i, key in enumerate(keys):
            if segments[i] != segment:
                segment, stack = segments[i], []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if uids[i] < 0:
                stack.append((key, *about[i], verdicts[i]))
            elif stack:
                found.append((uids[i], *stack[-1][1:]))
        cols = list(zip(*found, strict=True)) if found else [[]] * 5
        yield pa.record_batch({"uid": pa.array(cols[0], pa.int64()), "chars": pa.array(cols[1], pa.int32()), "host_chars": pa.array(cols[2], pa.int32()),
                               "rule": pa.array(cols[3], pa.string()), "verdict": pa.array(cols[4], pa.string())})


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", carry: list[str] | None = None,
          names: tuple[str, str, str, str] = ("host", "path", "rule", "verdict")) -> DataFrame:
    """``pages`` (or its columns ``carry``) with host, path, rule (``host`` + ``path`` of the longest that fits, else null) and verdict.

    ``rules`` has host, path and verdict. A rule is as long as its host and path
    together, in code points; of equally long ones that of the longer host
    wins, and of two with one host and path the verdict that sorts last
    (``block`` before ``allow``). Hosts of rules are compared A-Z lower-cased;
    a rule with a null host, path or verdict fits nothing. A null url, or one
    without ``://``, has an empty host and path and gets the ``default``
    verdict unless a rule has an empty host and path. Every row gets a row,
    repeated ones too; columns named like the new ones are replaced.
    """
    host, path, rule, verdict = names
    kept = [c for c in (pages.columns if carry is None else carry) if c not in names]
    spark = pages.sparkSession
    text = F.col(f"`{url}`").cast("string")
    # The row number is stored once, so that all later steps speak of the same rows.
    stored = materialise(pages.select(*[F.col(f"`{c}`") for c in kept], host_of(text).alias("__host"), path_of(text).alias("__path"),
                                      F.monotonically_increasing_id().alias("__uid")), "urls")
    own = (rules.select(F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("h"), F.col("path").alias("p"), F.col("verdict").alias("v"))
           .where("h is not null and p is not null and v is not null").groupBy("h", "p").agg(F.max("v").alias("v")))
    own = materialise(own.select(
        _key(_reversed(F.col("h")), F.col("p")).alias("key"), F.lit(-1).cast("long").alias("uid"), (F.length("h") + F.length("p")).cast("int").alias("chars"),
        F.length("h").alias("host_chars"), F.concat("h", "p").alias("rule"), F.col("v").alias("verdict"), F.size(_reversed(F.col("h"))).alias("depth")), "rules")
    depth = own.agg(F.max("depth")).first()[0] or 0
    labels = _reversed(F.col("__host"))
    probes = (stored.select("__uid", "__path", labels.alias("labels"), F.explode(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(depth)))).alias("n"))
              if depth else stored.select("__uid", "__path", labels.alias("labels"), F.lit(0).alias("n")).where("false"))
    none = {"chars": "int", "host_chars": "int", "rule": "string", "verdict": "string"}
    probes = probes.select(_key(F.slice("labels", F.lit(1), F.col("n")), F.col("__path")).alias("key"), F.col("__uid").alias("uid"),
                           *[F.lit(None).cast(t).alias(c) for c, t in none.items()])
    rows = stored.count() * depth
    segments = int(min(max(-(-rows // SEGMENT_ROWS), 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))), MAX_SEGMENTS))
    cuts = _splitters(probes, rows, segments)
    best = (probes.unionByName(own.drop("depth")).mapInArrow(_deal(cuts), _ROW)
            .repartition("segment").sortWithinPartitions("segment", "key", "uid")
            .mapInArrow(_sweep, "uid long, chars int, host_chars int, rule string, verdict string")
            .groupBy(F.col("uid").alias("__uid")).agg(F.max(F.struct("chars", "host_chars", "rule", "verdict")).alias("__best")))
    return (stored.join(best, "__uid", "left")
            .select(*[F.col(f"`{c}`") for c in kept], F.col("__host").alias(host), F.col("__path").alias(path),
                    F.col("__best.rule").alias(rule), F.coalesce("__best.verdict", F.lit(default)).alias(verdict)))

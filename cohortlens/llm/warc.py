"""WARC archives: writing with revisit records, reading with boundary-chain verification.

Writing. Pages with equal payloads of at least ``MIN_REVISIT`` bytes share one
``response`` record, that of the smallest id; the others become ``revisit``
records that name it. Spark's text writer lays one record per row, so the
archive files are committed by Spark into the shared folder.

Reading. The archives are split by Spark at any byte: the text reader cuts them
at the magic line ``WARC/1.0`` + CR LF, wherever it occurs, payloads included.
Every piece is a *candidate* record: the task that reads it emits its offset and
the offset of its successor, computed from its own Content-Length. Offsets
within a split are made absolute by the sums of the splits before. Pointer
jumping from offset 0 of each file then keeps the reachable candidates only: a
magic inside a payload starts no record, since no chain leads to it. The first
jumps, those that stay inside a split, are made by the task itself; the chain
between the splits is jumped by joins of narrow tables, doubling each round.
A record whose payload holds the magic is put together from its pieces.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortlens.session import scratch

from .common import hint_if_small, materialise

MIN_REVISIT = 100
MAGIC = "WARC/1.0\r\n"
_CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def _clean(value: Column) -> Column:
    """Header values hold no line breaks: they are percent-coded, and so is the percent sign."""
    out = F.regexp_replace(value, "%", "%25")
    return F.regexp_replace(F.regexp_replace(out, "\r", "%0D"), "\n", "%0A")


def _line(name: str, value: Column) -> Column:
    """``name: value`` and a line end, nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(_CRLF)), F.lit(""))


def plan_records(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """(id, url, payload, digest, record_type, refers_to) of every page.

    A null payload is empty. Rows that repeat the smallest id of their payload
    are all responses; a payload of which no row has an id has no revisits.
    """
    base = pages.select(F.col(key).alias("id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("payload"))
    base = base.withColumn("digest", F.sha2(F.encode("payload", "UTF-8"), 256))
    # Only digests met more than once, and those are few; partial counts make a hot digest cheap.
    firsts = (base.where(F.octet_length("payload") >= MIN_REVISIT).groupBy("digest")
              .agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").select("digest", "first"))
    firsts = hint_if_small(materialise(firsts, "equal-payloads"))
    out = base.join(firsts, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id"))
    return out.select("id", "url", "payload", "digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                      F.when(revisit, F.col("first")).alias("refers_to"))


def write_archives(records: DataFrame, path: str) -> None:
    """One WARC record per row of ``plan_records``; every task writes one archive file.

    The block is an HTTP response: headers with the payload's length, then the
    payload, which a revisit leaves out.
    """
    size = F.octet_length("payload")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}Content-Length: "), size.cast("string"), F.lit(_CRLF * 2))
    block = F.when(F.col("record_type") == "response", F.concat(http, F.col("payload"))).otherwise(http)
    header = F.concat(
        F.lit(MAGIC), _line("WARC-Type", F.col("record_type")), _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), _clean(F.col("id").cast("string")), F.lit(">"))),
        _line("WARC-Target-URI", _clean(F.col("url"))),
        _line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), _clean(F.col("refers_to").cast("string")), F.lit(">"))),
        F.when(F.col("record_type") == "revisit", F.lit(f"WARC-Profile: {PROFILE}{_CRLF}")).otherwise(F.lit("")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.lit(f"Content-Type: application/http; msgtype=response{_CRLF}"),
        _line("Content-Length", F.octet_length(block).cast("string")), F.lit(_CRLF))
    records.select(F.concat(header, block, F.lit(_CRLF)).alias("value")).write.option("lineSep", _CRLF).text(path)


_CANDIDATE = ("file string, block long, rel long, next long, exit long, tin long, tout long, bytes long, "
              "whole boolean, record_type string, id string, url string, refers_to string, header_digest string, "
              "payload_bytes long, payload_digest string")


def parse_header(raw: bytes) -> tuple[int, dict[bytes, bytes]] | None:
    """(bytes up to and with the empty line, fields by lower-case name), or null without a valid Content-Length."""
    end = raw.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in raw[:end].split(b"\r\n"):
        name, _, value = line.partition(b":")
        fields[name.strip().lower()] = value.strip()
    size = fields.get(b"content-length", b"")
    return (end + 4, fields) if size.isdigit() and len(size) < 19 else None


def _payload(fields: dict[bytes, bytes], block: bytes) -> tuple[int, str]:
    """(bytes, SHA-256) of the full payload: of a revisit as its headers tell, else as counted in the block."""
    http_end, http = 0, {}
    if fields.get(b"content-type", b"").startswith(b"application/http"):
        found = parse_header(block)
        http_end, http = found if found else (max(block.find(b"\r\n\r\n") + 4, 0), {})
    if fields.get(b"warc-type") == b"revisit":
        return int(http.get(b"content-length", b"0")), fields.get(b"warc-payload-digest", b"").removeprefix(b"sha256:").decode()
    body = block[http_end:]
    return len(body), hashlib.sha256(body).hexdigest()


def _text(fields: dict[bytes, bytes], name: bytes, urn: bool = False) -> str | None:
    value = fields.get(name)
    if value is None:
        return None
    if urn:
        value = value.removeprefix(b"<urn:page:").removesuffix(b">")
    return value.decode("utf-8", "replace").replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%")


def _told(raw: bytes) -> tuple:
    """(header bytes, fields, Content-Length) of a piece, or nulls."""
    found = parse_header(raw)
    return (0, None, None) if found is None else (*found, int(found[1][b"content-length"]))


def _candidates(batches):
    """Candidates of every split: offset and successor inside the split, the chain's exit from it, header fields.

    The rows of one split arrive in order. ``exit`` is the first offset at or
    beyond the split's end that the chain through the candidate reaches, or null
    if the chain breaks before. ``tin``/``tout`` number the forest of chains, so
    that a candidate lies on the chain of an entry ``e`` of the same split if
    ``tin <= e.tin < tout``. One last row a split tells its bytes.
    """
    magic = len(MAGIC)
    key, rows, at = None, [], 0

    def close():
        n = len(rows)
        where = {r[0]: i for i, r in enumerate(rows)}
        up = [where.get(r[1], -1) for r in rows]  # a successor lies behind, so up[i] > i
        exits: list[int | None] = [None] * n
        size, tin, cursor, free = [1] * n, [0] * n, [0] * n, 0
        for i, p in enumerate(up):
            if p >= 0:
                size[p] += size[i]
        for i in range(n - 1, -1, -1):
            nxt, p = rows[i][1], up[i]
            if p >= 0:
                exits[i], tin[i] = exits[p], cursor[p]
                cursor[p] += size[i]
            else:
                exits[i] = nxt if nxt is not None and nxt >= at else None
                tin[i], free = free, free + size[i]
            cursor[i] = tin[i] + 1
        columns = [[key[0]] * (n + 1), [key[1]] * (n + 1), [r[0] for r in rows] + [None], [r[1] for r in rows] + [None], [*exits, None],
                   [*tin, None], [t + z for t, z in zip(tin, size, strict=True)] + [None], [None] * n + [at]]
        columns += [[r[j] for r in rows] + [None] for j in range(2, 10)]
        kinds = [pa.string(), *[pa.int64()] * 7, pa.bool_(), *[pa.string()] * 5, pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                          names=[f.split()[0] for f in _CANDIDATE.split(", ")])

    for batch in batches:
        for file, block, raw in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "raw")), strict=True):
            if key != (file, block):
                if key is not None:
                    yield close()
                key, rows, at = (file, block), [], 0
                if block == 0:  # what lies before the first magic of a file
                    at = len(raw)
                    continue
            head, fields, length = _told(raw)
            if fields is None:
                rows.append((at, None, False, *[None] * 7))
            else:
                whole = head + length + 4 <= len(raw)
                payload = _payload(fields, raw[head:head + length]) if whole else (None, None)
                rows.append((at, at + magic + head + length + 4, whole, _text(fields, b"warc-type"), _text(fields, b"warc-record-id", True),
                             _text(fields, b"warc-target-uri"), _text(fields, b"warc-refers-to", True),
                             fields.get(b"warc-payload-digest", b"").removeprefix(b"sha256:").decode("utf-8", "replace"), *payload))
            at += magic + len(raw)
    if key is not None:
        yield close()


def _located(batches):
    """(file, block, rel, raw) of every piece behind a magic."""
    key, at = None, 0
    for batch in batches:
        out = []
        for file, block, raw in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "raw")), strict=True):
            if key != (file, block):
                key, at = (file, block), 0
                if block == 0:
                    at = len(raw)
                    continue
            out.append((file, block, at, raw))
            at += len(MAGIC) + len(raw)
        names = ["file", "block", "rel", "raw"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)


def _assembled(batches):
    """Payload bytes and digest of records given as the pieces that lie between magics."""
    magic = MAGIC.encode()
    for batch in batches:
        sizes, digests = [], []
        for pieces in batch.column("pieces"):
            raw = magic.join(pieces.as_py())
            head, fields, length = _told(raw)
            size, digest = _payload(fields, raw[head:head + length]) if fields is not None else (None, None)
            sizes.append(size)
            digests.append(digest)
        yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("pos"), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())],
                                         names=["file", "pos", "bytes_", "digest_"])


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, raw) of every piece between magics, in file order within a split."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("raw"))


def reachable(candidates: DataFrame, bases: DataFrame) -> DataFrame:
    """Candidates (with absolute ``pos`` and ``succ``) on the chain from offset 0 of their file."""
    there = candidates.join(hint_if_small(bases), ["file", "block"])
    placed = materialise(there.withColumns({"pos": F.col("rel") + F.col("base"), "succ": F.col("next") + F.col("base"), "out": F.col("exit") + F.col("base")})
                         .drop("rel", "next", "exit", "bytes"), "placed")
    # Only the ends of chains can enter a split: the candidates that some split's chain leaves to, and offset 0.
    ends = placed.where("out is not null").select("file", F.col("out").alias("pos")).distinct()
    entry = placed.join(ends, ["file", "pos"], "left_semi").unionByName(placed.where("pos = 0")).select("file", "pos", "out", "block", "tin")
    entry = materialise(entry, "entries")
    jump = entry.select("file", F.col("pos").alias("from"), F.col("out").alias("to")).where("to is not null")
    reach = materialise(entry.where("pos = 0").select("file", "pos").distinct(), "reach")
    n = reach.count()
    while n:
        more = reach.join(jump.withColumnRenamed("from", "pos"), ["file", "pos"]).select("file", F.col("to").alias("pos"))
        reach = materialise(reach.union(more).distinct(), "reach")
        twice = jump.withColumnRenamed("from", "via").withColumnRenamed("to", "from2")
        jump = materialise(jump.join(twice.withColumnRenamed("via", "to"), ["file", "to"])
                           .select("file", "from", F.col("from2").alias("to")), "jump")
        now = reach.count()
        if now == n:
            break
        n = now
    on = entry.join(reach, ["file", "pos"], "left_semi").select("file", "block", F.col("tin").alias("e")).distinct()
    on = hint_if_small(materialise(on, "entered"))
    return placed.join(on, ["file", "block"]).where("tin <= e and e < tout").drop("e").dropDuplicates(["file", "pos"])


def _owners(parts: DataFrame, bases: DataFrame, split: DataFrame) -> DataFrame:
    """(file, block, rel, at, start) of every piece inside a record of ``split``, which do not overlap.

    A piece belongs to the last record that starts at or before it, if that has
    not ended: within a split by a window over positions, and what a split
    begins in is the last record started in the splits of the file before it.
    """
    span = F.struct(F.col("pos").alias("start"), F.col("succ"))
    last = split.groupBy("file", "block").agg(F.max(span).alias("own"))
    before = F.last("own", ignorenulls=True).over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = (bases.join(hint_if_small(last), ["file", "block"], "left").withColumn("entered", before)
              .where("own is not null or entered.succ > base").select("file", "block", "base", "entered"))
    blocks = materialise(blocks, "split-blocks")
    places = (parts.where("bytes is null").select("file", "block", "rel").join(hint_if_small(blocks), ["file", "block"])
              .select("file", "block", "rel", (F.col("rel") + F.col("base")).alias("at"), "entered", F.lit(None).cast("struct<start:bigint,succ:bigint>").alias("own")))
    starts = split.select("file", "block", F.lit(None).cast("long").alias("rel"), F.col("pos").alias("at"),
                          F.lit(None).cast("struct<start:bigint,succ:bigint>").alias("entered"), span.alias("own"))
    so_far = Window.partitionBy("file", "block").orderBy("at", F.col("rel").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    owner = F.coalesce(F.last("own", ignorenulls=True).over(so_far), F.col("entered"))
    return (places.unionByName(starts).withColumn("owner", owner).where("rel is not null and at < owner.succ")
            .select("file", "block", "rel", "at", F.col("owner.start").alias("start")))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(id, url, record_type, refers_to, header_digest, payload_bytes, payload_digest) of every record, ids as text.

    Only records on the unbroken chain from the start of their file are
    returned; a chain breaks at a header without a valid Content-Length or at a
    successor that is no record. Bytes and digest are those of the payload read,
    for a revisit those its headers tell.
    """
    parts = materialise(_pieces(spark, path).mapInArrow(_candidates, _CANDIDATE), "candidates")
    before = F.sum("bytes").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    bases = materialise(parts.where("bytes is not null").select("file", "block", F.coalesce(before, F.lit(0)).alias("base")), "bases")
    found = materialise(reachable(parts.where("bytes is null"), bases), "records")
    fields = ["id", "url", "record_type", "refers_to", "header_digest"]
    out = found.where("whole").select(*fields, "payload_bytes", "payload_digest")
    split = found.where("not whole").select("file", "block", "pos", "succ", *fields)
    if split.isEmpty():
        return out
    # Records that hold the magic inside: their pieces are fetched and joined, in order, per record.
    split = materialise(split, "split-records")
    matched = hint_if_small(materialise(_owners(parts, bases, split), "matched"))
    inside = _pieces(spark, path).mapInArrow(_located, "file string, block long, rel long, raw binary").join(matched, ["file", "block", "rel"])
    ordered = F.array_sort(F.collect_list(F.struct("at", "raw")))
    whole = inside.groupBy("file", F.col("start").alias("pos")).agg(ordered["raw"].alias("pieces"))
    told = whole.mapInArrow(_assembled, "file string, pos long, bytes_ long, digest_ string")
    more = split.join(told, ["file", "pos"]).select(*fields, F.col("bytes_").alias("payload_bytes"), F.col("digest_").alias("payload_digest"))
    return out.unionByName(more)


def archive(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write ``pages`` as archives into the shared folder and read them back; ids have the type of ``key``."""
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    write_archives(plan_records(pages, key, url, payload), path)
    kind = pages.select(key).schema[0].dataType
    return read_archives(spark, path).withColumns({"id": F.col("id").cast(kind), "refers_to": F.col("refers_to").cast(kind)}).withColumnRenamed("id", key)

"""Snapshot sources.

A snapshot is a ``Snapshot`` mapping dataset name -> DataFrame with the fixed
schema of ``cohortlens.schemas``; absent datasets are empty frames, so no
report needs "if the table exists" branches.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.schemas import AUDIT_SCHEMA, ENDPOINT_SCHEMAS, PLATFORM_SCHEMAS, SCHEMAS, SESSION_CSV_SCHEMA, SNAPSHOT_DATASETS


def conform(df: DataFrame, schema) -> DataFrame:
    """Select the schema's columns in order, cast; missing columns become null."""
    cols = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in cols else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], SCHEMAS[name])


@dataclass
class Snapshot:
    """Datasets by name: a frame, or a function that makes it, called when the dataset is first read."""
    spark: SparkSession
    frames: dict = field(default_factory=dict)
    present: set = field(default_factory=set)

    def __getitem__(self, name: str) -> DataFrame:
        if name in self.frames:
            frame = self.frames[name]
            return frame() if callable(frame) else frame
        return empty(self.spark, name)

    def has(self, name: str) -> bool:
        return name in self.present

    def with_frames(self, **frames) -> "Snapshot":
        f = dict(self.frames)
        p = set(self.present)
        for k, v in frames.items():
            if v is None:
                f.pop(k, None)
                p.discard(k)
            elif callable(v):
                f[k] = cache(lambda name=k, make=v: conform(make(), SCHEMAS[name]) if name in SCHEMAS else make())
                p.add(k)
            else:
                f[k] = conform(v, SCHEMAS[k]) if k in SCHEMAS else v
                p.add(k)
        return Snapshot(self.spark, f, p)


def from_frames(spark: SparkSession, **frames) -> Snapshot:
    return Snapshot(spark).with_frames(**frames)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the path (local, HDFS, object stores)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def load_snapshot(spark: SparkSession, base: str, date: str | None = None,
                  datasets=SNAPSHOT_DATASETS) -> Snapshot:
    """One day's datasets, ``<base>/<dataset>/ingest_date=<date>``.

    Without a date the newest day over *all* datasets is taken, and a dataset
    without a folder of that day is absent: days are never mixed. Undated
    ``<base>/<dataset>.parquet`` files are read only if no date is asked for
    and no dated folder exists at all. Exact dataset directory names, never a
    prefix glob (``cohort_members`` must not pick up ``cohort_members_ext``);
    the explicit schema avoids a footer scan for inference. Where the base has
    a manifest, a day whose ingest has not ended does not exist.
    """
    days = {ds: partition_values(spark, os.path.join(base, ds)) for ds in datasets}
    if path_exists(spark, os.path.join(base, MANIFEST)):  # landed by ``sinks.ingest_snapshot``: a day counts once its manifest is there
        complete = set(complete_days(spark, base))
        days = {ds: [d for d in own if d in complete] for ds, own in days.items()}
    day = date or max((d for ds in days.values() for d in ds), default=None)
    frames = {}
    for ds in datasets:
        if day is None:
            path = os.path.join(base, f"{ds}.parquet")
            found = path_exists(spark, path)
        else:
            path = os.path.join(base, ds, f"ingest_date={day}")
            found = day in days[ds]
        if found:
            frames[ds] = spark.read.schema(SCHEMAS[ds]).parquet(path)
    return from_frames(spark, **frames)


def complete_days(spark: SparkSession, base: str) -> list[str]:
    """Days whose ingest ended: the manifest of a day is written last, and committed as a whole."""
    root = os.path.join(base, MANIFEST)
    return [d for d in partition_values(spark, root) if path_exists(spark, os.path.join(root, f"ingest_date={d}", "_SUCCESS"))]


MANIFEST = "_manifest"  # hidden from data listings
AUDIT_DAY = "fecha"
_ISO_DAY = re.compile(r"\d{4}-\d{2}-\d{2}")


def partition_values(spark: SparkSession, path: str, column: str = "ingest_date") -> list[str]:
    """ISO dates of the ``<column>=<date>`` directories of ``path``, sorted; none if the path is absent.

    A listing of one directory level through the Hadoop file system: no file
    footer is opened. Staging folders and partitions that are no date
    (``__HIVE_DEFAULT_PARTITION__``) are not matched.
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(root) if st.isDirectory()]
    values = [n.removeprefix(f"{column}=") for n in names if n.startswith(f"{column}=")]
    return sorted(v for v in values if _ISO_DAY.fullmatch(v))


def latest_partition(spark: SparkSession, path: str, column: str = "ingest_date") -> str | None:
    """S3: newest ISO date partition of one dataset."""
    return max(partition_values(spark, path, column), default=None)


def latest_date_of(df: DataFrame):
    """S3 over a DataFrame already read: max partition value (scans the files)."""
    row = df.select(F.max(F.col("ingest_date").cast("string")).alias("d")).first()
    return row["d"] if row else None


def snapshot_inventory(spark: SparkSession, base: str, datasets=SNAPSHOT_DATASETS) -> DataFrame:
    """S3: per dataset and ingest date, files and kilobytes.

    The file source lists the folders (in parallel jobs where there are many)
    and yields one row per file; only path and length are read, no content.
    Hidden files and folders (``_`` or ``.``) are no data files.
    """
    wanted = ("dataset string, ingest_date string, files long, size_kb double")
    if not path_exists(spark, base):
        return spark.createDataFrame([], wanted)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base).select("path", "length")
    where = r"/([^/]+)/ingest_date=(\d{4}-\d{2}-\d{2})/"
    return (files.select(F.regexp_extract("path", where, 1).alias("dataset"), F.regexp_extract("path", where, 2).alias("ingest_date"), "length")
            .where(F.col("dataset").isin(list(datasets))).groupBy("dataset", "ingest_date")
            .agg(F.count("*").alias("files"), F.round(F.sum("length") / F.lit(1024.0), 1).alias("size_kb")))


def read_partner_meta(spark: SparkSession, path: str) -> DataFrame | None:
    """Optional metadata CSV, header, all-string schema."""
    if not path_exists(spark, path):
        return None
    return spark.read.schema(SCHEMAS["partner_meta"]).option("header", True).csv(path)


def read_sessions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Exported practice sessions (typed)."""
    return (spark.read.schema(SESSION_CSV_SCHEMA).option("header", True)
            .option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(path))


def normalise_employees(df: DataFrame) -> DataFrame:
    """Roster rows: null -> '', e-mail trimmed and lower-cased, empty e-mail dropped."""
    cols = SCHEMAS["employees"].fieldNames()
    out = df.select([
        (F.lower(F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))) if c == "email"
         else F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c)
        for c in cols
    ])
    return out.where(F.col("email") != "")


def read_employees(spark: SparkSession, path: str) -> DataFrame:
    reader = spark.read
    if path.endswith(".csv"):
        df = reader.schema(SCHEMAS["employees"]).option("header", True).csv(path)
    else:
        df = reader.parquet(path)
    return normalise_employees(df)


def read_endpoint(spark: SparkSession, path: str, endpoint: str) -> DataFrame:
    """Landed documents of a known endpoint, read with its schema."""
    return read_json_payload(spark, path, ENDPOINT_SCHEMAS[endpoint])


def read_platform_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Parquet dump ``<base>/<name>`` of a platform table, in the columns its projection reads."""
    wanted = T.StructType.fromDDL(PLATFORM_SCHEMAS[name])
    return conform(spark.read.parquet(os.path.join(base, name)), wanted)


def read_json_payload(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Landed API JSON documents (one array or object per file)."""
    r = spark.read.option("multiLine", True)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_source(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame | None, DataFrame | None]:
    """What landed for one source as (rows, faults); both null if nothing landed. A document with an exception is a fault."""
    if not path_exists(spark, path):
        return None, None
    landed = spark.read.schema(f"{schema}, exception string, message string").json(path)
    return landed.where("exception is null").drop("exception", "message"), landed.select("exception", "message")


BROADCAST_FILES = 100_000  # paths of a listing, some 200 bytes each
PAGE_FIELD = "_corrupt_record"


def read_pages(spark: SparkSession, path: str, rows: str, page: str = "page") -> DataFrame:
    """Landed result pages ``<path>/<page>=<number>/``, one JSON document a line: (page, rows, malformed).

    ``rows`` is the type of the document's ``rows`` field, as DDL. A document that
    does not parse has null rows and is ``malformed``; the page number comes from
    the folder, so a page without a readable document is known by number.
    """
    raw = (spark.read.schema(f"rows {rows}, {PAGE_FIELD} string, {page} bigint").option("columnNameOfCorruptRecord", PAGE_FIELD).json(path))
    return raw.select(F.col(page).alias("page"), "rows", F.col(PAGE_FIELD).isNotNull().alias("malformed"))


def read_proxy_logs(spark: SparkSession, path: str) -> DataFrame:
    """Raw proxy log files, line order kept: ``<path>/<pod>``, or ``<path>/pod=<pod>/<files in order of name>``.

    The order key is (file, byte offset of the split, position in the split):
    ``monotonically_increasing_id`` grows with the position inside a task and
    each split of a file is read in order by one task, so sorting by
    (file_block_start, id) restores the file order without reading a file in
    one task. The files of a pod are numbered by name, so rotated logs follow
    one another.
    """
    # A split holds at most as many lines as bytes, so block offset + position
    # in the split stays below the next split's offset: unique and monotone
    # within a file (dense numbering is not needed).
    place = F.col("_metadata.file_block_start") + F.pmod(F.monotonically_increasing_id(), F.lit(1 << 33))
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(F.col("_metadata.file_path").alias("file"), place.alias("place"), "value")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.col("path").alias("file"))
    folder = F.regexp_extract("file", r"/pod=([^/]+)/[^/]*$", 1)
    files = listed.select("file", folder.alias("pod")).where("pod <> ''")
    n = files.count()  # of a listing
    if not n:
        return lines.select(F.substring_index("file", "/", -1).alias("pod"), F.col("place").alias("line_no"), "value")
    numbered = files.withColumn("number", F.row_number().over(Window.partitionBy("pod").orderBy("file")) - 1).drop("pod")
    if n <= BROADCAST_FILES:
        numbered = F.broadcast(numbered)
    # a file has under 2^40 bytes
    return lines.join(numbered, "file").select(folder.alias("pod"), (F.col("number").cast("long") * F.lit(1 << 40) + F.col("place")).alias("line_no"), "value")


def read_audit_tail(spark: SparkSession, path: str, n: int = 20) -> DataFrame:
    """The last N valid JSON lines (malformed lines skipped).

    The log is partitioned by day (K7). Days are taken from the newest on, twice
    as many each time, until they hold N valid lines; older days are not opened.
    """
    schema = T.StructType([*AUDIT_SCHEMA, T.StructField(AUDIT_DAY, T.StringType())])
    log = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    days = partition_values(spark, path, AUDIT_DAY)[::-1]
    take, newest = 1, log
    while take < len(days):
        newest = log.where(F.col(AUDIT_DAY) >= days[take - 1])
        if newest.select(*AUDIT_SCHEMA.fieldNames()).limit(n).collect()[n - 1:]:
            break
        take, newest = 2 * take, log
    return newest.select(*AUDIT_SCHEMA.fieldNames()).orderBy(F.col("ts").desc_nulls_last(), "accion", "payload").limit(n)

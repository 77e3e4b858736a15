"""Sinks and the ingest pass."""

from __future__ import annotations

import datetime as dt
import json
import logging
import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions.rules import Rules
from cohortlens.operators.quality import multiset, profile_kpis, row_hash
from cohortlens.schemas import SESSION_SCHEMA
from cohortlens.session import checkpoint_dir
from cohortlens.sources.snapshot import AUDIT_DAY, MANIFEST, Snapshot, complete_days, conform, load_snapshot, path_exists

log = logging.getLogger(__name__)

MANIFEST_SCHEMA = ("dataset string, ingest_date string, rows_written long, rows_read long, files long, "
                   "bytes long, fingerprint long, hash_sum string, ok boolean")


# K1 + Q1 + Q3 + Q2 ------------------------------------------------------------------
class IngestError(RuntimeError):
    """A written dataset does not hold what was sent to it; ``result`` is its manifest row."""

    def __init__(self, result: dict):
        why = (f"{result['rows_written']} rows sent, {result['rows_read']} read back" if result["rows_written"] != result["rows_read"] else "a written file is empty")
        super().__init__(f"{result['dataset']}: {why}")
        self.result = result


def write_dataset(df: DataFrame, base: str, name: str, ingest_date: str) -> dict:
    """Write one dataset partition and reconcile it; a mismatch raises ``IngestError``.

    Rows written are counted by an ``observe`` metric during the write (no
    second pass over the source); the written partition is then read back
    once: rows, content fingerprint and size per file (partial aggregates),
    then totals over the files (xor and sum are associative, so they equal
    those of ``operators.quality.fingerprint``).
    """
    spark = df.sparkSession
    obs = Observation(f"rows_{name}")
    path = os.path.join(base, name)
    (df.withColumn("ingest_date", F.lit(ingest_date))
       .observe(obs, F.count(F.lit(1)).alias("rows"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .option("compression", "snappy").partitionBy("ingest_date").parquet(path))
    written = obs.get.get("rows", 0)
    part = spark.read.parquet(os.path.join(path, f"ingest_date={ingest_date}"))
    per_file = part.groupBy(F.col("_metadata.file_path").alias("f")).agg(*multiset(row_hash(part)), F.max("_metadata.file_size").alias("s"))
    r = per_file.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.bit_xor("fingerprint"), F.lit(0)).alias("fingerprint"),
                     F.coalesce(F.sum(F.col("hash_sum").cast("decimal(38,0)")).cast("string"), F.lit("0")).alias("hash_sum"), F.count("*").alias("n"), F.sum("s").alias("b"), F.min("s").alias("mn")).first()
    ok = (written == r["rows"]) and (r["n"] == 0 or (r["mn"] or 0) > 0)
    result = {"dataset": name, "ingest_date": ingest_date, "rows_written": written, "rows_read": r["rows"],
              "files": r["n"], "bytes": r["b"] or 0, "fingerprint": r["fingerprint"], "hash_sum": r["hash_sum"], "ok": bool(ok)}
    if not ok:
        raise IngestError(result)
    return result


def ingest_snapshot(snap: Snapshot, base: str, ingest_date: str) -> DataFrame:
    """Q6: write every present dataset (K1), reconcile (Q1/Q3), fingerprint (Q2); manifest out.

    The manifest is stored under ``<base>/_manifest/ingest_date=<date>`` after the
    last dataset, and only then does the day exist for ``load_snapshot``: a day
    that stopped half-way is never the newest. Ingesting a day again takes it
    back first.
    """
    spark = snap.spark
    root = os.path.join(base, MANIFEST)
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(root, f"ingest_date={ingest_date}"))
    fs = mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(mark, True)
    fs.mkdirs(mark.getParent())
    rows = [write_dataset(snap[ds], base, ds, ingest_date) for ds in sorted(snap.present)]
    manifest = spark.createDataFrame(rows, MANIFEST_SCHEMA)
    manifest.coalesce(1).write.mode("overwrite").parquet(mark.toString())
    return manifest


def read_manifest(spark: SparkSession, base: str, ingest_date: str | None = None) -> DataFrame:
    """Q6: manifest of a complete day, the newest one by default; empty if there is none."""
    day = ingest_date or max(complete_days(spark, base), default=None)
    if day is None:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(os.path.join(base, MANIFEST, f"ingest_date={day}"))


def ingest(snap: Snapshot, base: str, ingest_date: str, rules: Rules) -> dict[str, DataFrame]:
    """Q6: ``manifest`` of the written datasets and ``kpis`` of the day as read back; stops at the first mismatch."""
    manifest = ingest_snapshot(snap, base, ingest_date)
    return {"manifest": manifest, "kpis": profile_kpis(load_snapshot(snap.spark, base, ingest_date), rules)}


def read_sessions(spark: SparkSession, table: str) -> DataFrame:
    """The whole session store (no cap on its rows), typed as the session document."""
    stored = spark.read.parquet(table)
    return conform(stored, SESSION_SCHEMA)


# K2 -----------------------------------------------------------------------------------
def write_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """CSV with header; ``single_file`` only for small report tables."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


# K3 -----------------------------------------------------------------------------------
def materialise(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """CREATE OR REPLACE: a temp view, or a Parquet table when a path is given."""
    if path is None:
        df.createOrReplaceTempView(name)
        return df
    df.write.mode("overwrite").parquet(path)
    out = df.sparkSession.read.parquet(path)
    out.createOrReplaceTempView(name)
    return out


# K4 -----------------------------------------------------------------------------------
def report_package(reports: dict, out_dir: str, fmt: str = "parquet", first: str | None = None) -> list:
    """Write every report to its own folder; a failing one is logged and skipped.

    ``reports`` maps a name to a zero-argument callable returning a DataFrame.
    Returns the produced report names, the summary (``first``) first.
    """
    names = list(reports)
    if first in reports:
        names = [first] + [n for n in names if n != first]
    produced = []
    for n in names:
        try:
            df = reports[n]()
            target = os.path.join(out_dir, n)
            if fmt == "csv":
                write_csv(df, target, single_file=False)
            else:
                df.write.mode("overwrite").parquet(target)
            produced.append(n)
        except Exception as e:  # noqa: BLE001 - a broken report must not stop the package
            log.warning("report %s skipped: %s", n, e)
    return produced


# K5 -----------------------------------------------------------------------------------
SESSION_KEY = ["email", "fecha_inicio"]


def upsert_sessions(spark: SparkSession, new_docs: DataFrame, table: str, batch_seq: int, line: str | None = None) -> DataFrame:
    """Idempotent upsert of session documents by (email, start); the latest batch wins.

    Of rows of one batch that share a key the one of the largest ``line`` wins
    (a column of ``new_docs``, not stored), then the largest of all their columns
    as text, so a replay picks the same.

    The table is partitioned by start day; only days present in the new
    documents are rewritten (dynamic partition overwrite). The merged rows
    are checkpointed to the shared checkpoint folder first, so the overwrite
    never reads the files it replaces. A document without a start, or with one
    that is no date, belongs to the day ``undated`` and is kept like any other.
    """
    start = F.substring(F.col("fecha_inicio").cast("string"), 1, 10)
    day = F.when(start.rlike(r"^\d{4}-\d{2}-\d{2}$"), start).otherwise("undated")
    own = [c for c in new_docs.columns if c not in (*SESSION_KEY, line)]
    order = F.struct(F.col(f"`{line}`") if line else F.lit(0), F.to_json(F.struct(*[F.col(f"`{c}`") for c in own])))
    once = new_docs.groupBy(*SESSION_KEY).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in own]), order).alias("d"))
    new = (once.select(*SESSION_KEY, *[F.col(f"d.`{c}`").alias(c) for c in own])
           .withColumn("_seq", F.lit(batch_seq).cast("long")).withColumn("dia", day))
    if path_exists(spark, table):
        # days are read as text: a table of dates alone would otherwise be typed as dates
        old = spark.read.parquet(table).withColumn("dia", F.col("dia").cast("string"))
        days = new.select("dia").distinct()
        old = old.join(days, "dia", "left_semi")
        both = old.unionByName(new, allowMissingColumns=True)
    else:
        both = new
    cols = [c for c in both.columns if c not in SESSION_KEY + ["dia"]]
    merged = both.groupBy(*SESSION_KEY, "dia").agg(F.max_by(F.struct(*cols), F.col("_seq")).alias("d"))
    merged = merged.select(*SESSION_KEY, "dia", *[F.col(f"d.{c}").alias(c) for c in cols])
    checkpoint_dir(spark)
    merged = merged.checkpoint(eager=True)
    (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dia").parquet(table))
    return spark.read.parquet(table)


# K7 -----------------------------------------------------------------------------------
def audit(spark: SparkSession, path: str, action: str, payload: dict | None = None) -> bool:
    """Append one audit event (UTC time, action, JSON payload) to the folder of its day; never raises."""
    try:
        ts = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        row = [(ts, action, json.dumps(payload or {}, default=str, ensure_ascii=False))]
        spark.createDataFrame(row, "ts string, accion string, payload string").withColumn(AUDIT_DAY, F.substring("ts", 1, 10)).coalesce(1) \
            .write.mode("append").partitionBy(AUDIT_DAY).json(path)
        return True
    except Exception as e:  # noqa: BLE001
        log.warning("audit append failed: %s", e)
        return False

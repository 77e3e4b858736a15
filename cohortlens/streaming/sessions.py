"""Practice sessions as a stream with event time.

Log lines arrive as files; one query takes them in micro-batches
(``foreachBatch``). The event time of a line is its bracketed time. The
watermark of a batch is the largest event time of the batches before it less
``delay_s``; it never falls.

* A line older than the watermark is late: it goes to ``late/`` and counts for
  nothing else (``late_lines``). Every other line counts, in whatever order it
  arrives; line order within a pod is that of ``line_no``.
* Accepted logins and the latest activity of each address are order-free: every
  batch appends its own, and they are folded with ``max`` / ``max_by``.
* A sign-out needs the login before it on its address (J21). Login and sign-out
  lines wait in ``state/`` until the watermark has passed them, since an earlier
  login may still come; then the batch rebuild's block-segmented fill runs over
  the released lines and the carried pointers, as DataFrame windows. So one
  address holding a third of a landing is cut into blocks of lines, in a stream
  batch as in the batch rebuild, and no key is one task's.
* State is the pointer of each (pod, address), one row, and the lines inside the
  watermark. With ``ttl_s`` a pointer whose login is older than the watermark
  by that much expires: its row is gone, and a later sign-out closes nothing.

State is a folder per batch, written by Spark from the folder before it, so
batch N is a function of batch N-1 and its own lines: a replay overwrites its
own folders and nothing else. ``transformWithState`` is not used: it hands all
rows of a key to one task, and its TTL counts processing time.

``documents`` folds what has been appended, with the waiting lines resolved as
they stand, so it always equals the batch result over all lines that were not
late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions import rules as R
from cohortlens.operators import sessions as S
from cohortlens.sources.snapshot import path_exists

LOG_SCHEMA = "pod string, line_no long, value string"
SIGNOUT_SCHEMA = "pod string, email string, created string, out_line long, out_ts string"
LOGIN_SCHEMA = ("pod string, email string, created string, login_line long, src_ip string, user string, "
                "tenant string, groups array<string>, path string")
ACTIVITY_SCHEMA = "pod string, ip string, last_activity string"
LATE_SCHEMA = "pod string, line_no long, kind string, ip string, ts string, at long, watermark long"
# Lines that may still be reordered, and pointers: a pointer is the login line it came from.
TURN_SCHEMA = "pod string, ip string, line_no long, kind string, email string, created string, ts string, at long"
TURN = ["pod", "ip", "line_no", "kind", "email", "created", "ts", "at"]


def children(spark: SparkSession, path: str, prefix: str = "batch=") -> list[int]:
    """Numbers N of the folders ``<path>/batch=N``, sorted; a listing of one level."""
    if not path_exists(spark, path):
        return []
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(root)]
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix) and n.removeprefix(prefix).isdigit())


class StreamingSessions:
    def __init__(self, spark: SparkSession, base: str, rules: R.Rules, domain_map=None, delay_s: int = 3600,
                 ttl_s: int | None = None, block_lines: int = S.DEFAULT_BLOCK_LINES):
        """``base``: folder, shared by all executors, of what the query appends, its state and its checkpoint."""
        self.spark, self.base, self.rules, self.domain_map = spark, base.rstrip("/"), rules, domain_map
        self.delay_s, self.ttl_s, self.block = delay_s, ttl_s, block_lines

    # --- state: state/batch=N/{pointers,waiting,watermark}; the watermark is written last and marks N complete ---
    def _complete(self, below: int | None = None) -> int | None:
        done = [n for n in children(self.spark, f"{self.base}/state")
                if (below is None or n < below) and path_exists(self.spark, f"{self.base}/state/batch={n}/watermark/_SUCCESS")]
        return max(done, default=None)

    def _state(self, n: int | None, part: str, schema: str = TURN_SCHEMA) -> DataFrame:
        if n is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.base}/state/batch={n}/{part}")

    def watermark(self, n: int | None = None) -> int | None:
        """Epoch seconds of the watermark after batch ``n`` (the newest one), null before the first timed line."""
        row = self._state(self._complete() if n is None else n, "watermark", "watermark long").first()
        return row.watermark if row else None

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch; running it again gives the same folders."""
        before = self._complete(below=batch_id)
        mark = None if before is None else self.watermark(before)
        at = F.unix_seconds(F.try_to_timestamp("ts", F.lit(S.TS_FMT)))
        lines = S.parse_lines(batch, self.rules).where("accepted").withColumn("at", at).persist()
        try:
            newest = lines.agg(F.max("at")).first()[0]
            after = max((m for m in (mark, None if newest is None else newest - self.delay_s) if m is not None), default=None)
            old = F.lit(False) if mark is None else F.coalesce(F.col("at") < mark, F.lit(False))
            put = lambda df, part: df.write.mode("overwrite").parquet(f"{self.base}/{part}/batch={batch_id}")
            put(lines.where(old).select("pod", "line_no", "kind", "ip", "ts", "at", F.lit(mark).cast("long").alias("watermark")), "late")
            on_time = lines.where(~old)
            put(on_time.where("kind = 'login'").select("pod", "email", "created", F.col("line_no").alias("login_line"), F.col("ip").alias("src_ip"),
                                                       "user", "tenant", "groups", "path"), "logins")
            put(S.activity_max(on_time), "activity")
            turns = (on_time.where("ip is not null and kind in ('login', 'logout')").select(*TURN)
                     .unionByName(self._state(before, "waiting")))
            # A line without a readable time waits for nothing.
            passed = F.col("at").isNull() if after is None else F.col("at").isNull() | (F.col("at") < after)
            pointers = self._state(before, "pointers")
            released = turns.where(passed).unionByName(pointers)
            outs = S.signout_pointers(released, self.block)
            put(outs.select("pod", "email", "created", F.col("line_no").alias("out_line"), F.col("ts").alias("out_ts")), "signouts")
            last = released.where("kind = 'login'").groupBy("pod", "ip").agg(F.max_by(F.struct(*TURN[2:]), "line_no").alias("p")).select("pod", "ip", "p.*")
            if self.ttl_s is not None and after is not None:
                last = last.where(F.col("at").isNull() | (F.col("at") >= after - self.ttl_s))
            state = f"{self.base}/state/batch={batch_id}"
            last.write.mode("overwrite").parquet(f"{state}/pointers")
            turns.where(~passed).write.mode("overwrite").parquet(f"{state}/waiting")
            self.spark.createDataFrame([(after,)], "watermark long").coalesce(1).write.mode("overwrite").parquet(f"{state}/watermark")
        finally:
            lines.unpersist()
        self._forget(batch_id - 1)

    def _forget(self, below: int) -> None:
        """Drop states older than the one that a replay of the last batch starts from."""
        keep = self._complete(below=below + 1)
        for n in children(self.spark, f"{self.base}/state"):
            if keep is not None and n < keep:
                path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.base}/state/batch={n}")
                path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def run(self, source: DataFrame, available_now: bool = True, processing_time: str = "1 minute"):
        """Start the query over ``source``; it resumes from its checkpoint."""
        when = {"availableNow": True} if available_now else {"processingTime": processing_time}
        return (source.writeStream.foreachBatch(self.process).option("checkpointLocation", f"{self.base}/checkpoint")
                .trigger(**when).start())

    def _appended(self, part: str, schema: str) -> DataFrame:
        """What complete batches appended."""
        n = self._complete()
        if n is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(f"{schema}, batch int").parquet(f"{self.base}/{part}").where(F.col("batch") <= n).drop("batch")

    def late_lines(self) -> DataFrame:
        """Side output: the lines that came after the watermark had passed them, with that watermark."""
        return self._appended("late", LATE_SCHEMA)

    def documents(self) -> DataFrame:
        logins = self._appended("logins", LOGIN_SCHEMA)
        fields = ["login_line", "src_ip", "user", "tenant", "groups", "path"]
        last = logins.groupBy("pod", "email", "created").agg(F.max_by(F.struct(*fields), "login_line").alias("l"))
        n = self._complete()
        open_outs = S.signout_pointers(self._state(n, "waiting").unionByName(self._state(n, "pointers")), self.block).select(
            "pod", "email", "created", F.col("line_no").alias("out_line"), F.col("ts").alias("out_ts"))
        outs = self._appended("signouts", SIGNOUT_SCHEMA).unionByName(open_outs).groupBy("pod", "email", "created").agg(
            F.max("out_line").alias("out_line"), F.max_by("out_ts", "out_line").alias("out_ts"))
        activity = self._appended("activity", ACTIVITY_SCHEMA).groupBy("pod", "ip").agg(F.max("last_activity").alias("last_activity"))
        sessions = last.select("pod", "email", "created", "l.*").join(outs, ["pod", "email", "created"], "left")
        return S.dedupe_documents(S.pod_documents(sessions, activity, self.rules), self.domain_map)


def read_log_stream(spark: SparkSession, path: str, files_per_trigger: int | None = 1) -> DataFrame:
    """Landed log lines (pod, line_no, value) as a file stream, oldest files first.

    With ``files_per_trigger`` a batch holds that many files; with ``None`` a
    run takes everything landed so far as one batch.
    """
    r = spark.readStream.schema(LOG_SCHEMA)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.parquet(path)

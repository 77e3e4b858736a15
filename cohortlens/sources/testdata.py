"""Training-platform datasets derived by Spark from the TPC-H-like test tables.

These are the synthetic views of FIXTURES.md (``tr_*``), expressed with the
DataFrame API. They are test inputs; the library itself reads real snapshots
through ``cohortlens.sources.snapshot``.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.schemas import SCHEMAS
from cohortlens.sources.snapshot import Snapshot, conform, from_frames

HOUSE_ORG = "house"
TENANTS = ("students",)
AS_OF_ACCOUNTS = "2001-08-28"
AS_OF_SESSIONS = "2024-01-31"


def _epoch(c) -> F.Column:
    return F.unix_seconds(c.cast("timestamp"))


def _str(c) -> F.Column:
    return c.cast("string")


def _title(key: F.Column) -> F.Column:
    """Course / cohort title rule of the fixture."""
    kind = (F.when(key % 4 == 0, F.lit("Certification "))
            .when(key % 4 == 1, F.lit("Certificación "))
            .otherwise(F.lit("Training ")))
    topic = (F.when(key % 5 == 0, F.lit("Governance")).when(key % 5 == 1, F.lit("Data Processing"))
             .when(key % 5 == 2, F.lit("Intelligence")).when(key % 5 == 3, F.lit("Operaciones"))
             .otherwise(F.lit("General")))
    ver = F.when(key % 3 == 0, F.lit(" 14.6")).when(key % 3 == 1, F.lit(" 13.2")).otherwise(F.lit(""))
    lang = (F.when(key % 7 == 0, F.lit(" - ES")).when(key % 7 == 1, F.lit(" - EN"))
            .when(key % 7 == 2, F.lit(" - FR")).otherwise(F.lit("")))
    return F.concat(kind, topic, ver, lang)


class TestTables:
    """Lazy access to the parquet test tables of one scale factor (one read per table)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._cache = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]


def users(t: TestTables) -> DataFrame:
    c, n, o = t.customer, t.nation, t.orders
    span = o.groupBy("o_custkey").agg(_epoch(F.min("o_orderdate")).alias("t0"),
                                      _epoch(F.max("o_orderdate")).alias("t1"))
    j = (c.join(n, n.n_nationkey == c.c_nationkey)
         .join(span, span.o_custkey == c.c_custkey, "left"))
    key = F.col("c_custkey")
    return j.select(
        key.alias("id"),
        F.when(key % 50 == 7, F.concat(F.lit("u"), _str(key)))  # no hyphen: no partner can be derived
         .otherwise(F.concat(F.lit("u-"), _str(key), F.lit("-"), F.lower("n_name"))).alias("username"),
        F.when(key % 40 == 0, F.concat(F.lit("u"), _str(key), F.lit("@HOUSE.example")))
         .otherwise(F.concat(F.lit("u"), _str(key), F.lit("@"), F.lower("n_name"), F.lit(".example"))).alias("email"),
        F.col("c_mktsegment").alias("firstname"),
        F.col("c_name").alias("lastname"),
        F.col("t0").alias("timecreated"),
        F.col("t1").alias("lastaccess"),
        F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("suspended"),
    )


def courses(t: TestTables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("id"), _title(F.col("p_partkey")).alias("fullname"))


# 25 cohorts for every 2,000 parts and the 15,000 orders that go with them, so
# cohorts grow with the tables and members and courses per cohort do not.
COHORTS, PARTS_PER_BLOCK, ORDERS_PER_BLOCK = 25, 2000, 15000


def cohort_of(key: F.Column, per_block: int) -> F.Column:
    return (key % COHORTS + COHORTS * F.floor(key / per_block)).cast("long")


def cohorts(t: TestTables) -> DataFrame:
    k = F.col("id")
    ids = t.part.select(cohort_of(F.col("p_partkey"), PARTS_PER_BLOCK).alias("id")).distinct()
    return ids.select(k, _title(k).alias("name"), F.when(k % 6 == 5, 0).otherwise(1).alias("visible"))


def cohort_members_ext(t: TestTables) -> DataFrame:
    o = t.orders
    return (o.groupBy(cohort_of(F.col("o_orderkey"), ORDERS_PER_BLOCK).alias("cohortid"), F.col("o_custkey").alias("userid"))
            .agg(F.min(_epoch(F.col("o_orderdate"))).alias("timeadded")))


def enrol_cohort_course(t: TestTables) -> DataFrame:
    k = F.col("p_partkey")
    return t.part.select(k.alias("id"), cohort_of(k, PARTS_PER_BLOCK).alias("cohortid"), k.alias("courseid"))


def _lines(t: TestTables) -> DataFrame:
    l, o = t.lineitem, t.orders
    return l.join(o, o.o_orderkey == l.l_orderkey)


def user_enrolments(t: TestTables) -> DataFrame:
    """Enrolment rows with their creation time (several per user and course)."""
    return _lines(t).select(F.col("o_custkey").alias("userid"), F.col("l_partkey").alias("courseid"),
                            _epoch(F.col("o_orderdate")).alias("timecreated"))


def course_attempts(t: TestTables) -> DataFrame:
    """Per user and course: what three datasets take from the lines, in one pass over them.

    Every line is an attempt; those after the third of an order are not graded
    (null). Every line has a completion row; those before the third of an
    order are open (0).
    """
    graded, late = F.col("l_linenumber") <= 3, F.col("l_linenumber") >= 3
    # narrow before the join: above the broadcast limit its two sides are shuffled as they are selected here
    lines = t.lineitem.select("l_orderkey", "l_partkey", F.when(graded, F.col("l_quantity")).alias("quantity"),
                              late.alias("late"), _epoch(F.col("l_shipdate")).alias("shipped"))
    orders = t.orders.select("o_orderkey", "o_custkey", (F.col("o_orderstatus") == "F").alias("closed"))
    fin = F.col("closed") & F.col("late")
    return (lines.join(orders, F.col("o_orderkey") == F.col("l_orderkey"))
            .groupBy(F.col("o_custkey").alias("userid"), F.col("l_partkey").alias("courseid"))
            .agg((F.max("quantity") * 2).alias("graderaw"), F.max("shipped").alias("gradedategraded"),
                 F.max(F.when(fin, 1).otherwise(0)).alias("completed"),
                 F.max(F.when(fin, F.col("shipped")).otherwise(0)).alias("timecompleted")))


# Columns of the datasets that ``course_attempts`` holds.
ATTEMPTS = {
    "user_courses": ("userid", "courseid"),
    "user_grades": ("userid", "courseid", "graderaw", "gradedategraded"),
    "course_completions": ("userid", "courseid", "completed", "timecompleted"),
}


def attendance_sessions(t: TestTables) -> DataFrame:
    e = t.events
    return e.select(F.col("event_id").alias("id"), F.col("user_id").alias("userid"),
                    (F.col("event_id") % 200).alias("courseid"), _epoch(F.col("ts")).alias("login"),
                    F.floor(F.col("value") * 60).cast("long").alias("duration"))


def partner_meta(t: TestTables) -> DataFrame:
    n, r = t.nation, t.region
    k = F.col("n_nationkey")
    return (n.join(r, r.r_regionkey == n.n_regionkey).select(
        F.when(k < 20, F.lower("n_name")).otherwise(F.concat(F.lit("unlisted-"), F.lower("n_name"))).alias("partner"),
        F.when(k % 3 == 0, "Cliente").otherwise("Partner").alias("tipo"),
        F.col("r_name").alias("region"),
        F.when(k % 3 == 0, "true").when(k % 3 == 1, "false").otherwise("").alias("trajo_oportunidades"),
        F.when(k % 4 == 0, "true").when(k % 4 == 1, "false").otherwise("").alias("trajo_clientes"),
        F.when(k % 5 == 0, "true").otherwise("false").alias("paga_certificacion"),
        F.when(k % 5 == 0, F.concat(_str(k), F.lit("00.5"))).when(k % 5 == 1, "n/a").otherwise("").alias("total_pagado"),
    ))


def employees(t: TestTables) -> DataFrame:
    c, n = t.customer, t.nation
    k = F.col("c_custkey")
    return (c.join(n, n.n_nationkey == c.c_nationkey).select(
        _str(k).alias("id_vp"), F.col("c_mktsegment").alias("nombre"), F.col("c_name").alias("apellidos"),
        F.lower("n_name").alias("lugar_trabajo"),
        F.when(k % 40 == 0, F.concat(F.lit("u"), _str(k), F.lit("@house.example")))
         .otherwise(F.concat(F.lit("x"), _str(k), F.lit("@house.example"))).alias("email"),
        F.col("c_mktsegment").alias("departamento"),
        F.concat(F.lit("m"), _str(k % 7)).alias("manager"),
        F.concat(F.lit("rol"), _str(k % 4)).alias("rol"),
    ))


def proxy_log(t: TestTables) -> DataFrame:
    e = t.events
    uid = F.col("user_id")
    ip = F.concat(F.lit("10.0.0."), _str(uid % 40), F.lit(":4180 - "))
    who = F.concat(F.lit("u"), _str(uid), F.lit("@d"), _str(uid % 6), F.lit(".example "))
    f1 = F.date_format("ts", "yyyy/MM/dd HH:mm:ss")
    started = F.date_format("ts", "yyyy-MM-dd HH:00:00")  # logins of an hour share a session, on both pods
    lab = F.element_at(F.array(*[F.lit(x) for x in ("governance/one", "GenAI", "rocket", "")]), (uid % 4 + 1).cast("int"))
    stamp = F.concat(F.lit("["), f1, F.lit("]"))
    et = F.col("event_type")
    value = (
        F.when(et == "signup", F.concat(
            ip, who, stamp, F.lit(" [AuthSuccess] Authenticated: Session{user:u"), _str(uid),
            F.lit(" tenant:"), F.when(uid % 5 == 0, "other").otherwise("students"),
            F.lit(" created:"), started, F.lit(" groups:[g"), _str(uid % 3), F.lit(" all]} GET /lab/"), lab))
        .when(et == "error", F.concat(ip, stamp, F.lit(" GET /oauth2/sign_out 302")))
        .when(et == "purchase", F.concat(ip, stamp, F.lit(" GET /health 200")))
        .otherwise(F.concat(ip, who, stamp, F.lit(" GET /oauth2/auth"),
                            F.when(et == "view", " 202 ok").otherwise(" 401 no")))
    )
    return e.select(F.concat(F.lit("pod"), _str(F.col("event_id") % 2)).alias("pod"), F.col("event_id").alias("line_no"),
                    value.alias("value"))


def snapshot(spark: SparkSession, sf_dir: str) -> Snapshot:
    """The ten standard datasets of one test scale factor."""
    t = TestTables(spark, sf_dir)
    ext, attempts = cohort_members_ext(t), course_attempts(t)
    return from_frames(
        spark,
        users=users(t), courses=courses(t), cohorts=cohorts(t),
        cohort_members=ext.select("cohortid", "userid"), cohort_members_ext=ext,
        enrol_cohort_course=enrol_cohort_course(t), attendance_sessions=attendance_sessions(t),
        **{ds: attempts.select(*cols) for ds, cols in ATTEMPTS.items()},
    )


def materialised_snapshot(spark: SparkSession, sf_dir: str, base: str) -> Snapshot:
    """Derive each dataset once, when it is first read, write it as a snapshot under ``base``, read it back.

    Reports then start from stored Parquet, as in production, instead of
    re-deriving every dataset inside every plan, and a report lands the
    datasets it reads, not all ten. Datasets of the same rows share one table:
    the three of ``course_attempts``, and both lists of members.
    """
    from cohortlens.sources.snapshot import load_snapshot
    t = TestTables(spark, sf_dir)

    def land(ds: str, df: DataFrame) -> DataFrame:
        write_landed(conform(df, SCHEMAS[ds]), f"{base}/{ds}.parquet")
        return load_snapshot(spark, base, datasets=(ds,))[ds]

    @cache
    def attempts() -> DataFrame:
        path = f"{base}/course_attempts.parquet"
        df = course_attempts(t)  # in files already, by its own shuffle
        write_landed(df, path)
        return spark.read.schema(df.schema).parquet(path)

    @cache
    def ext() -> DataFrame:
        return land("cohort_members_ext", cohort_members_ext(t))

    flat = {"users": users, "courses": courses, "cohorts": cohorts, "enrol_cohort_course": enrol_cohort_course, "attendance_sessions": attendance_sessions}
    return from_frames(
        spark, cohort_members_ext=ext, cohort_members=lambda: ext().select("cohortid", "userid"),
        **{ds: lambda ds=ds, make=make: land(ds, landed(make(t))) for ds, make in flat.items()},
        **{ds: lambda cols=cols: attempts().select(*cols) for ds, cols in ATTEMPTS.items()},
    )


_FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_landed(df: DataFrame, path: str) -> None:
    """Write a dataset; its shuffle files go when it is written, not when the driver next collects its garbage."""
    spark = df.sparkSession
    old = spark.conf.get(_FILE_CLEANUP, None)
    spark.conf.set(_FILE_CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.unset(_FILE_CLEANUP) if old is None else spark.conf.set(_FILE_CLEANUP, old)


def landed(df: DataFrame) -> DataFrame:
    """A derived dataset as an extract lands it: several files, not one.

    Datasets projected from one small generator file would otherwise be a
    single file, i.e. a single-task scan; real landings (one file per
    extract task or per pod) are read in parallel. The number of files
    follows the size (AQE sizes the partitions of this shuffle).
    """
    return df.repartition(*[F.col(c) for c in df.columns])

"""Sinks, ingest reconciliation and snapshot sources."""

import json
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from cohortlens import sinks
from cohortlens.sources import snapshot as S
from cohortlens.sources import testdata as td


def test_ingest_roundtrip(spark, tmp):
    snap = td.snapshot(spark, SF_SMALL)
    m = sinks.ingest_snapshot(snap, tmp, "2024-05-01")
    rows = {r["dataset"]: r for r in m.collect()}
    assert set(rows) == set(snap.present)
    assert all(r["ok"] and r["rows_written"] == r["rows_read"] for r in rows.values())
    # the one-pass reconciliation fingerprint is the dataset fingerprint of the written rows
    from cohortlens.operators.quality import fingerprint
    back_users = spark.read.parquet(f"{tmp}/users/ingest_date=2024-05-01")
    assert rows["users"]["fingerprint"] == fingerprint(back_users).first()["fingerprint"]
    assert rows["users"]["files"] >= 1 and rows["users"]["bytes"] > 0
    # a second day, then the loader picks the latest date by default and exact names
    sinks.ingest_snapshot(snap.with_frames(users=snap["users"].limit(10)), tmp, "2024-05-02")
    back = S.load_snapshot(spark, tmp)
    assert back["users"].count() == 10
    assert back["cohort_members"].count() == snap["cohort_members"].count()
    assert "timeadded" not in back["cohort_members"].columns
    old = S.load_snapshot(spark, tmp, "2024-05-01")
    assert old["users"].count() == snap["users"].count()
    inv = S.snapshot_inventory(spark, tmp)
    assert inv.where(F.col("dataset") == "users").count() == 2
    # rewriting a day replaces it (dynamic partition overwrite)
    sinks.ingest_snapshot(snap.with_frames(users=snap["users"].limit(3)), tmp, "2024-05-01")
    assert S.load_snapshot(spark, tmp, "2024-05-01")["users"].count() == 3


def test_missing_dataset_is_empty(spark, tmp):
    snap = S.load_snapshot(spark, tmp)
    assert snap["users"].count() == 0 and not snap.has("users")
    assert snap["users"].columns[0] == "id"


def test_csv_materialise_and_package(spark, tmp):
    df = spark.range(5).withColumnRenamed("id", "n")
    sinks.write_csv(df, f"{tmp}/csv", single_file=True)
    assert spark.read.option("header", True).csv(f"{tmp}/csv").count() == 5
    t = sinks.materialise(df, "t_numbers", f"{tmp}/tbl")
    assert spark.table("t_numbers").count() == 5 and t.count() == 5

    def broken():
        raise ValueError("boom")
    produced = sinks.report_package({"b": lambda: df, "bad": broken, "summary": lambda: df}, f"{tmp}/pkg",
                                    first="summary")
    assert produced == ["summary", "b"]


def test_upsert_last_write_wins(spark, tmp):
    t = f"{tmp}/sessions"
    a = spark.createDataFrame([("a@x", "2024-01-01 10:00:00", "2024-01-01 10:30:00"),
                               ("b@x", "2024-01-02 10:00:00", "2024-01-02 10:30:00")],
                              "email string, fecha_inicio string, fecha_fin string")
    sinks.upsert_sessions(spark, a, t, 1)
    b = spark.createDataFrame([("a@x", "2024-01-01 10:00:00", "2024-01-01 11:00:00")],
                              "email string, fecha_inicio string, fecha_fin string")
    sinks.upsert_sessions(spark, b, t, 2)
    sinks.upsert_sessions(spark, b, t, 2)  # replay: same result
    got = {(r.email, r.fecha_fin) for r in spark.read.parquet(t).collect()}
    assert got == {("a@x", "2024-01-01 11:00:00"), ("b@x", "2024-01-02 10:30:00")}


def test_audit_and_tail(spark, tmp):
    p = f"{tmp}/audit"
    for i in range(3):
        assert sinks.audit(spark, p, "report", {"i": i})
    with open(os.path.join(p, "zz-bad.json"), "w") as f:
        f.write("{not json\n")
    tail = S.read_audit_tail(spark, p, 2).collect()
    assert len(tail) == 2 and all(json.loads(r.payload)["i"] in (0, 1, 2) for r in tail)


def test_proxy_log_reader_keeps_order(spark, tmp):
    d = f"{tmp}/logs"
    os.makedirs(d)
    for pod in ("pod-a", "pod-b"):
        with open(os.path.join(d, pod), "w") as f:
            f.write("\n".join(f"{pod} line {i}" for i in range(50)) + "\n")
    df = S.read_proxy_logs(spark, d)
    for pod in ("pod-a", "pod-b"):
        rows = [r.value for r in df.where(F.col("pod") == pod).orderBy("line_no").collect()]
        assert rows == [f"{pod} line {i}" for i in range(50)]


def test_employee_normalisation(spark):
    df = spark.createDataFrame([("1", None, "x", "y", "  A@B.C ", "d", "m", "r"), ("2", "n", "a", "l", "", "d", "m", "r")],
                               "id_vp string, nombre string, apellidos string, lugar_trabajo string, email string, "
                               "departamento string, manager string, rol string")
    out = S.normalise_employees(df).collect()
    assert len(out) == 1 and out[0].email == "a@b.c" and out[0].nombre == ""


def test_proxy_log_reader_keeps_order_across_splits(spark, tmp):
    """Large pod logs are read as many splits (and splits of several files share a
    task): line_no stays unique and in file order within each pod."""
    d = f"{tmp}/biglogs"
    os.makedirs(d)
    n = {"pod-a": 3000, "pod-b": 40, "pod-c": 1500}
    for pod, k in n.items():
        with open(os.path.join(d, pod), "w") as f:
            f.write("\n".join(f"{pod} line {i:05d} " + "x" * (i % 37) for i in range(k)) + "\n")
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = S.read_proxy_logs(spark, d)
        assert df.rdd.getNumPartitions() > 10
        rows = df.collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for pod, k in n.items():
        mine = sorted((r.line_no, r.value) for r in rows if r.pod == pod)
        assert len({ln for ln, _ in mine}) == k
        assert [v.split(" ")[2] for _, v in mine] == [f"{i:05d}" for i in range(k)]


def test_latest_partition_lists_directories_only(spark, tmp):
    """The newest ingest date comes from the directory names; staging, temporary
    and non-partition entries are ignored; no partition -> None."""
    base = f"{tmp}/ds"
    for d in ("ingest_date=2024-01-01", "ingest_date=2024-01-03", "ingest_date=2023-12-31",
              ".spark-staging-1", "_temporary", "other"):
        os.makedirs(os.path.join(base, d))
    open(os.path.join(base, "ingest_date=2099-01-01"), "w").close()  # a file, not a partition
    assert S.latest_partition(spark, base) == "2024-01-03"
    os.makedirs(f"{tmp}/empty")
    assert S.latest_partition(spark, f"{tmp}/empty") is None


def _land(spark, base, name, day, rows):
    from cohortlens.schemas import SCHEMAS
    spark.createDataFrame(rows, SCHEMAS[name]).write.parquet(f"{base}/{name}/ingest_date={day}")


def test_one_day_for_all_datasets(spark, tmp):
    """Users land on two days, courses on the first only: the load takes the newest day and courses are absent."""
    from cohortlens.sources.snapshot import latest_partition, load_snapshot, snapshot_inventory
    _land(spark, tmp, "cohorts", "2024-01-01", [(1, "a", 1)])
    _land(spark, tmp, "cohorts", "2024-01-02", [(1, "a", 1), (2, "b", 1)])
    _land(spark, tmp, "cohorts", "__HIVE_DEFAULT_PARTITION__", [(3, "c", 1)])
    _land(spark, tmp, "courses", "2024-01-01", [(1, "c")])
    _land(spark, tmp, "courses", "not-a-date", [(1, "c")])
    spark.createDataFrame([(9, "flat")], "id long, fullname string").write.parquet(f"{tmp}/courses.parquet")
    newest = load_snapshot(spark, tmp)
    assert newest["cohorts"].count() == 2 and not newest.has("courses") and newest["courses"].count() == 0
    first = load_snapshot(spark, tmp, "2024-01-01")
    assert first["cohorts"].count() == 1 and [r.fullname for r in first["courses"].collect()] == ["c"]
    assert load_snapshot(spark, tmp, "2020-01-01").present == set()
    assert latest_partition(spark, f"{tmp}/cohorts") == "2024-01-02"
    got = sorted((r.dataset, r.ingest_date) for r in snapshot_inventory(spark, tmp).collect())
    assert got == [("cohorts", "2024-01-01"), ("cohorts", "2024-01-02"), ("courses", "2024-01-01")]


def test_undated_files_only_without_dated_folders(spark, tmp):
    from cohortlens.sources.snapshot import load_snapshot
    spark.createDataFrame([(9, "flat")], "id long, fullname string").write.parquet(f"{tmp}/courses.parquet")
    assert load_snapshot(spark, tmp)["courses"].count() == 1
    assert not load_snapshot(spark, tmp, "2024-01-01").has("courses")


def test_upsert_keeps_rows_without_a_start(spark, tmp):
    from cohortlens.sinks import upsert_sessions
    schema = "email string, fecha_inicio string, user string"
    table = f"{tmp}/t"
    upsert_sessions(spark, spark.createDataFrame([("a@x", None, "a"), ("b@x", "2024-01-01 10:00:00", "b"), ("c@x", "garbage", "c")], schema), table, 1)
    upsert_sessions(spark, spark.createDataFrame([("d@x", None, "d"), ("b@x", "2024-01-01 10:00:00", "b2")], schema), table, 2)
    got = sorted((r.email, r.fecha_inicio, r.user) for r in spark.read.parquet(table).collect())
    assert got == [("a@x", None, "a"), ("b@x", "2024-01-01 10:00:00", "b2"), ("c@x", "garbage", "c"), ("d@x", None, "d")]


def test_ingest_stops_on_a_mismatch(spark, tmp, monkeypatch):
    import pytest

    from cohortlens import sinks

    class Lying(sinks.Observation):
        @property
        def get(self):
            return {"rows": 99}

    df = spark.createDataFrame([(1, "c")], "id long, fullname string")
    assert sinks.write_dataset(df, tmp, "courses", "2024-01-01")["ok"]
    monkeypatch.setattr(sinks, "Observation", Lying)
    with pytest.raises(sinks.IngestError, match="99 rows sent, 1 read back"):
        sinks.write_dataset(df, tmp, "courses", "2024-01-02")


def test_cluster_without_a_shared_folder_raises():
    import pytest

    from cohortlens.session import checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_no_roster_and_no_match(spark):
    from cohortlens.operators.compliance import Compliance
    from cohortlens.plans import catalog as C
    snap = C.context(spark, "/root/testdata/sf0.001").snap
    none = Compliance(snap, C.RULES, "no such course", "house")
    assert tuple(none.match_result().first()) == ("no such course", 0, False)
    assert tuple(none.headline().first()) == (0, 0, 0, 0.0)
    assert Compliance(snap, C.RULES, "governance", "house").match_result().first().encontrado


def test_report_package_follows_the_catalogue(spark, tmp):
    from cohortlens.plans import catalog as C
    from cohortlens.plans.package import report_catalogue, write_package
    m = C.context(spark, "/root/testdata/sf0.001").model
    cat = report_catalogue(m, "2001-08-28")
    some = {k: cat[k] for k in ("global_kpis", "partner_summary", "top_partners")} | {"broken": lambda: 1 / 0}
    got = [tuple(r) for r in write_package(m, "2001-08-28", tmp, reports=some).orderBy("position").collect()]
    assert [r[1] for r in got] == ["partner_summary", "global_kpis", "top_partners", "broken"] and [r[3] for r in got] == [True] * 3 + [False]
    assert spark.read.parquet(f"{tmp}/_manifest").count() == 4
    rows = cat["partner_summary"]().collect()
    assert rows == sorted(rows, key=lambda r: (-r.total_certificados, -r.total_altas, r.partner))


def test_ingest_returns_manifest_and_kpis(spark, tmp):
    from cohortlens.plans import catalog as C
    from cohortlens.sinks import ingest
    snap = C.context(spark, "/root/testdata/sf0.001").snap
    out = ingest(snap, tmp, "2024-03-01", C.RULES)
    assert out["manifest"].where("not ok").count() == 0 and out["manifest"].count() == len(snap.present)
    assert out["kpis"].first().total_users == snap["users"].count()


def test_options_of_the_decisions(spark):
    """Never as null; D10: one account per e-mail."""
    from cohortlens.functions import rules as R
    from cohortlens.operators.compliance import Compliance
    from cohortlens.operators.model import Model
    from cohortlens.operators.reports import inactive_partners
    from cohortlens.sources.snapshot import from_frames
    users = spark.createDataFrame([(1, "a-p", "x@house.e", "f", "l", 0, 0, 0), (2, "b-p", "X@house.e", "f", "l", 0, 0, 0), (3, "c-q", "q@e", "f", "l", 0, 0, 0), (4, "d-q", "r@e", "f", "l", 0, 900000000, 0)],
                                  "id long, username string, email string, firstname string, lastname string, timecreated long, lastaccess long, suspended int")
    rules = R.Rules(house_org="house")
    snap = from_frames(spark, users=users, courses=spark.createDataFrame([(5, "governance")], "id long, fullname string"),
                       user_courses=spark.createDataFrame([(1, 5), (2, 5)], "userid long, courseid long"))
    m = Model(snap, rules)
    assert {(r.partner, str(r.ultimo_acceso)) for r in inactive_partners(m, "2001-01-01").collect()} == {("house", "1970-01-01"), ("q", "1998-07-09")}
    assert {(r.partner, r.ultimo_acceso is None) for r in inactive_partners(m, "2001-01-01", never_as_null=True).collect()} == {("house", True), ("q", False)}
    staff = spark.createDataFrame([("1", "n", "a", "l", "x@house.e", "d", "m", "r")], "id_vp string, nombre string, apellidos string, lugar_trabajo string, email string, departamento string, manager string, rol string")
    assert Compliance(snap, rules, "governance", "house", staff).status.count() == 2
    assert [r.username_moodle for r in Compliance(snap, rules, "governance", "house", staff, one_account=True).status.collect()] == ["a-p"]


def test_readers_with_schemas(spark, tmp):
    import pathlib

    from cohortlens.operators import payload as pl
    from cohortlens.sinks import read_sessions, upsert_sessions
    from cohortlens.sources.snapshot import read_endpoint, read_platform_table
    pathlib.Path(f"{tmp}/g.json").write_text('{"usergrades": [{"userid": 1, "courseid": 2, "gradeitems": [{"id": 3, "itemtype": "course", "graderaw": 80}, {"id": 4, "itemtype": "mod", "graderaw": 10}]}]}')
    assert [(r.userid, r.itemid, r.graderaw, r.gradedategraded) for r in pl.flatten_grades(read_endpoint(spark, f"{tmp}/g.json", "grade_items")).collect()] == [(1, 3, 80.0, None)]
    spark.createDataFrame([(1, 2, 7, "more")], "userid int, cohortid int, timeadded int, extra string").write.parquet(f"{tmp}/cohort_members")
    assert [tuple(r) for r in pl.p1_cohort_members(read_platform_table(spark, tmp, "cohort_members")).collect()] == [("2_1", 2, 1, 7)]
    upsert_sessions(spark, spark.createDataFrame([("a@x", "2024-01-01 10:00:00", "a")], "email string, fecha_inicio string, user string"), f"{tmp}/t", 1)
    assert read_sessions(spark, f"{tmp}/t").first().fecha_inicio.hour == 10


def test_a_day_that_stopped_half_way_is_not_loaded(spark, tmp):
    from cohortlens.sources.snapshot import Snapshot
    users = spark.createDataFrame([(1, "a-b", "a@x")], "id long, username string, email string")
    snap = Snapshot(spark).with_frames(users=users, cohort_members=spark.createDataFrame([(1, 1)], "cohortid long, userid long"))
    base = f"{tmp}/days"
    real = sinks.write_dataset

    def stops(df, b, name, day):
        if name == "users":
            raise OSError("disk full")
        return real(df, b, name, day)

    def interrupted(day):
        sinks.write_dataset = stops
        try:
            sinks.ingest_snapshot(snap, base, day)
        except OSError:
            return
        finally:
            sinks.write_dataset = real
        raise AssertionError("should have stopped")

    interrupted("2024-05-01")  # the very first day
    assert not S.load_snapshot(spark, base).present and sinks.read_manifest(spark, base).count() == 0
    sinks.ingest_snapshot(snap, base, "2024-05-01")
    interrupted("2024-05-02")
    day = S.load_snapshot(spark, base)
    assert day.present == {"users", "cohort_members"} and {r.ingest_date for r in sinks.read_manifest(spark, base).collect()} == {"2024-05-01"}
    sinks.ingest_snapshot(snap, base, "2024-05-02")
    assert S.complete_days(spark, base) == ["2024-05-01", "2024-05-02"]
    interrupted("2024-05-02")  # a complete day that is ingested again is taken back first
    assert S.complete_days(spark, base) == ["2024-05-01"]


def test_fingerprint_sees_a_doubled_pair(spark):
    from cohortlens.operators.quality import fingerprint
    one = spark.createDataFrame([(1, 1.5, None), (2, 2.5, "x")], "id long, g double, s string")
    pair = spark.createDataFrame([(9, 9.0, "p")], one.schema)
    a, b = fingerprint(one).first(), fingerprint(one.union(pair).union(pair)).first()
    assert a.fingerprint == b.fingerprint and a.hash_sum != b.hash_sum
    assert fingerprint(one.orderBy(F.desc("id"))).first() == a and fingerprint(one.limit(0)).first().hash_sum == "0"


def test_sources_by_failure_class(spark, tmp):
    import pytest

    from cohortlens.operators import payload as pl
    schema = "cohortid bigint, userid bigint"
    land = lambda name, rows, ddl: spark.createDataFrame(rows, ddl).write.json(f"{tmp}/{name}")
    land("denied", [("Some_AccessException", "no")], "exception string, message string")
    land("broken", [("dml_read_exception", "boom")], "exception string, message string")
    land("good", [(1, 2), (1, 3)], schema)
    empty = spark.createDataFrame([], schema)
    ask = lambda *names: pl.first_answer([(n, *S.read_source(spark, f"{tmp}/{n}", schema)) for n in names], empty)
    rows, asked = ask("denied", "nowhere", "good", "broken")
    assert rows.count() == 2 and asked == [("denied", "denied"), ("nowhere", "absent"), ("good", "answered")]
    rows, asked = ask("denied", "nowhere")
    assert rows.columns == ["cohortid", "userid"] and rows.count() == 0
    with pytest.raises(pl.SourceFailed, match="dml_read_exception: boom"):
        ask("denied", "broken", "good")


def test_upsert_of_equal_keys_in_one_batch(spark, tmp):
    rows = [("a@x", "2024-01-01 10:00:00", f"u{i}", i) for i in (3, 9, 1)]
    df = spark.createDataFrame(rows, "email string, fecha_inicio string, user string, line_no long")
    for i, part in enumerate((df, df.orderBy("line_no"), df.orderBy(F.desc("line_no")))):
        out = sinks.upsert_sessions(spark, part.repartition(3), f"{tmp}/t{i}", 1, line="line_no")
        assert [r.user for r in out.collect()] == ["u9"] and "line_no" not in out.columns


def test_audit_tail_reads_the_newest_days(spark, tmp):
    lines = [(f"2024-05-{d:02d}", json.dumps({"ts": f"2024-05-{d:02d}T10:00:0{i}Z", "accion": "a", "payload": "{}"}) if i else "{cut") for d in range(1, 10) for i in range(3)]
    spark.createDataFrame(lines, "fecha string, value string").write.partitionBy("fecha").text(f"{tmp}/log")
    tail = S.read_audit_tail(spark, f"{tmp}/log", 5)
    assert [r.ts for r in tail.collect()] == [f"2024-05-{d:02d}T10:00:0{i}Z" for d, i in ((9, 2), (9, 1), (8, 2), (8, 1), (7, 2))]
    assert "PartitionFilters: [isnotnull(fecha" in tail._jdf.queryExecution().executedPlan().toString()
    assert S.read_audit_tail(spark, f"{tmp}/log", 100).count() == 18


def test_rotated_logs_follow_one_another(spark, tmp):
    for pod, files in (("a", [30, 2, 700]), ("b", [5])):
        at = 0
        for k, n in enumerate(files):
            folder = f"{tmp}/logs/pod={pod}"
            os.makedirs(folder, exist_ok=True)
            with open(f"{folder}/{k:03d}.log", "w") as f:
                f.writelines(f"{pod} {at + i}\n" for i in range(n))
            at += n
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        rows = S.read_proxy_logs(spark, f"{tmp}/logs").orderBy("pod", "line_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r.value for r in rows] == [f"a {i}" for i in range(732)] + [f"b {i}" for i in range(5)]
    assert len({(r.pod, r.line_no) for r in rows}) == 737

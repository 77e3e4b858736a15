import datetime
import os

from cohortlens.sources import testdata as td
from cohortlens.sources.snapshot import from_frames

DAY = datetime.datetime(2000, 1, 1)


def _tables(spark, path):
    """Twelve users, four of them without orders; repeated lines, null keys, quantities and dates."""
    at = lambda i: DAY + datetime.timedelta(days=i)
    rows = {
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(i, f"NATION_{i}", 0) for i in range(3)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
                     [(i, f"name {i}", i % 3, 5.0 - i, "seg") for i in range(12)] + [(None, "nobody", 1, 0.0, "seg")]),
        "part": ("p_partkey long", [(i,) for i in range(30)] + [(3,)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp",
                   [(i, None if i == 7 else i % 8, "F" if i % 2 else "O", None if i == 9 else at(i)) for i in range(40)] + [(None, 1, "F", at(1))]),
        "lineitem": ("l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_shipdate timestamp",
                     [(i % 40, None if i == 5 else i % 9, i % 5 + 1, None if i % 11 == 0 else float(i), None if i % 13 == 0 else at(i)) for i in range(200)]
                     + [(None, 1, 1, 9.0, at(2)), (3, 1, 1, 50.0, at(3)), (3, 1, 1, 50.0, at(3))]),
        "events": ("event_id long, ts timestamp, user_id long, event_type string, value double", [(i, at(i), i % 12, "view", 1.5 * i) for i in range(20)]),
    }
    for name, (schema, r) in rows.items():
        spark.createDataFrame(r, schema).write.parquet(f"{path}/{name}.parquet")


def test_a_dataset_lands_when_it_is_first_read_and_once(spark, tmp):
    _tables(spark, f"{tmp}/in")
    base = f"{tmp}/snapshot"
    landed = lambda: sorted(os.listdir(base)) if os.path.exists(base) else []
    snap = td.materialised_snapshot(spark, f"{tmp}/in", base)
    whole = td.snapshot(spark, f"{tmp}/in")
    assert snap.present == whole.present and landed() == []
    assert snap["users"] is snap["users"] and landed() == ["users.parquet"]
    copy = snap.with_frames(courses=None)
    assert not copy.has("courses") and copy["user_grades"] is snap["user_grades"]
    # grades, completions and courses of a user share one pass over the lines
    snap["user_courses"], snap["course_completions"]
    assert landed() == ["course_attempts.parquet", "users.parquet"]
    before = os.stat(f"{base}/course_attempts.parquet").st_mtime_ns
    for ds in sorted(whole.present):
        assert snap[ds].dtypes == whole[ds].dtypes, ds
        got, want = (sorted(map(repr, x.collect())) for x in (snap[ds], whole[ds]))
        assert got == want and got, ds
    assert landed() == [f"{x}.parquet" for x in ("attendance_sessions", "cohort_members_ext", "cohorts", "course_attempts", "courses", "enrol_cohort_course", "users")]
    assert os.stat(f"{base}/course_attempts.parquet").st_mtime_ns == before


def test_a_frame_given_as_a_function_is_made_once(spark):
    made = []

    def rows():
        made.append(1)
        return spark.createDataFrame([(1, "a course")], "id int, fullname string")

    snap = from_frames(spark, courses=rows)
    assert snap.has("courses") and not made
    assert snap.with_frames(cohorts=None)["courses"].dtypes == [("id", "bigint"), ("fullname", "string")]
    assert snap["courses"].count() == 1 and made == [1]


def test_shuffle_files_go_when_a_dataset_has_landed(spark, tmp):
    _tables(spark, f"{tmp}/in")
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    snap = td.materialised_snapshot(spark, f"{tmp}/in", f"{tmp}/snapshot")
    setting, before = spark.conf.get(td._FILE_CLEANUP, None), shuffled()
    snap["users"], snap["user_grades"], snap["cohort_members"]
    assert shuffled() <= before
    assert spark.conf.get(td._FILE_CLEANUP, None) == setting
    assert snap["user_grades"].count() > 0

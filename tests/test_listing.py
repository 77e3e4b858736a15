import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortlens.functions import rules as R
from cohortlens.operators import legacy as listings
from cohortlens.operators.legacy import Legacy
from cohortlens.sources.snapshot import from_frames

RULES = R.Rules(house_org="house", allowed_tenants=("students",))


def _legacy(spark):
    """Repeated users, courses, members, bridge rows and grades; null keys; members and courses without a row of their own."""
    frames = {
        "users": ("id long, username string, email string, timecreated long", [(i, f"u-{i}-org{i % 2}", f"u{i}@x.example", 100 * i) for i in (1, 2, 3, 3)] + [(None, "u", "e", 0)]),
        "courses": ("id long, fullname string", [(10, "ten"), (11, "eleven"), (11, "eleven"), (12, None), (None, "none")]),
        "cohorts": ("id long, name string, visible int", [(1, "Governance 14.6", 1), (2, "Governance 14.1", 1), (3, "Governance 13.2", 1)]),
        "cohort_members_ext": ("cohortid long, userid long, timeadded long", [(1, 1, 5), (1, 1, 6), (1, 2, 5), (2, 3, 5), (2, 9, 5), (3, 1, 5), (1, None, 5), (None, 1, 5)]),
        "enrol_cohort_course": ("id long, cohortid long, courseid long", [(1, 1, 10), (2, 1, 10), (3, 1, 11), (4, 2, 11), (5, 2, 12), (6, 2, 13), (7, 3, 10), (8, 1, None)]),
        "user_grades": ("userid long, courseid long, graderaw double, gradedategraded long", [(1, 10, 95.0, 7), (1, 10, 99.0, 8), (2, 11, 10.0, 7), (3, 12, 90.0, 9), (3, 11, None, 9)]),
    }
    snap = from_frames(spark, **{k: spark.createDataFrame(rows, schema) for k, (schema, rows) in frames.items()})
    return Legacy(snap, RULES, spark.createDataFrame([(1, 10, 500), (1, 10, 400), (3, 11, 900)], "userid long, courseid long, timecreated long"))


def test_listing_rows(spark):
    got = Counter((r.userid, r.cohort_name, r.courseid, r.aprobado, r.finalgrade) for r in _legacy(spark).enrolled_approved().collect())
    one, two = "Governance 14.6", "Governance 14.1"
    assert got == Counter({(1, one, 10, 1, 95.0): 1, (1, one, 10, 1, 99.0): 1, (1, one, 11, 0, None): 2, (2, one, 10, 0, None): 1, (2, one, 11, 0, None): 2,
                           (3, two, 11, 0, None): 4, (3, two, 12, 1, 90.0): 2})


def test_expanded_rows_are_not_shuffled_for_users_or_courses(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        legacy = _legacy(spark)
        plans = [x._jdf.queryExecution().executedPlan().toString() for x in (legacy.enrolled_approved(), legacy.student_grade_status(), legacy.student_grade_status("u1@"))]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    for plan in plans:
        above = plan[:re.search(r"Join \[cohortid#\d+L, _salt#\d+\]", plan).start()]
        assert "LeftOuter" in above and not re.search(r"Join \[(userid|courseid)#\d+L\], \[\w+#\d+L\], Inner", above), above


def _nodes(plan):
    yield plan
    for i in range(plan.children().size()):
        yield from _nodes(plan.children().apply(i))


def _wide(spark):
    """40 users in one cohort of 30 courses; user u has a grade and an enrolment in course u % 30 only."""
    frames = {
        "users": ("id long, username string, email string, timecreated long", [(i, f"u-{i}-org", f"u{i}@x", i) for i in range(40)]),
        "courses": ("id long, fullname string", [(i, f"course {i}") for i in range(30)]),
        "cohorts": ("id long, name string, visible int", [(1, "Governance 14.6", 1)]),
        "cohort_members_ext": ("cohortid long, userid long, timeadded long", [(1, i, 0) for i in range(40)]),
        "enrol_cohort_course": ("id long, cohortid long, courseid long", [(i, 1, i) for i in range(30)]),
        "user_grades": ("userid long, courseid long, graderaw double, gradedategraded long", [(i, i % 30, 90.0, 7) for i in range(40)]),
    }
    snap = from_frames(spark, **{k: spark.createDataFrame(rows, schema) for k, (schema, rows) in frames.items()})
    return Legacy(snap, RULES, spark.createDataFrame([(i, i % 30, 500) for i in range(40)], "userid long, courseid long, timecreated long"))


@pytest.mark.parametrize("name", ["student_grade_status", "enrolled_approved"])
def test_rows_without_a_fact_are_not_shuffled(spark, name):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = getattr(_wide(spark), name)()
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(rows) == 40 * 30 and sum(r.finalgrade == 90.0 for r in rows) == 40 == sum(r.userid % 30 == r.courseid and r.finalgrade == 90.0 for r in rows)
    exchanges = [n for n in _nodes(plan) if n.nodeName() == "Exchange"]
    sent = [n.metrics().apply("shuffleRecordsWritten").value() for n in exchanges if re.match(r"Exchange hashpartitioning\(userid#\d+L, courseid#\d+L, ", n.toString())]
    assert len(sent) >= 2 and max(sent) <= 45, sent  # facts, and the expanded rows that have one; all 1,200 before
    # both sides of the union read the same shuffles of members and courses
    assert sum("hashpartitioning(cohortid" in n.toString().splitlines()[0] and "_salt" in n.toString().splitlines()[0] for n in exchanges) == 2


@pytest.mark.parametrize("odd", ["one mark for all courses", "too many marks to carry"])
def test_marks_do_not_change_the_rows(spark, monkeypatch, odd):
    both = lambda: [sorted(map(repr, x.collect())) for x in (_legacy(spark).enrolled_approved(), _legacy(spark).student_grade_status(), _wide(spark).enrolled_approved())]
    want = both()
    if odd.startswith("one"):
        monkeypatch.setattr(listings, "_mark", lambda course: F.lit(7).cast("short"))
    else:
        monkeypatch.setattr(listings, "MOST_MARKS", 0)
    assert both() == want

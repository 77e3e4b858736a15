"""Nested API payloads and platform-table projections.

Payloads land as JSON documents (``sources.snapshot.read_json_payload``); each
flattening is ``explode`` over a bounded list inside one document, so no
group is ever gathered into one task.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# N1 -------------------------------------------------------------------------
def explode_members(payload: DataFrame) -> DataFrame:
    """(cohortid, userids[]) -> (cohortid, userid); a missing list gives no rows."""
    return payload.select("cohortid", F.explode("userids").alias("userid"))


# N2 -------------------------------------------------------------------------
def flatten_user_courses(payload: DataFrame) -> DataFrame:
    """(userid, courses[struct]) -> userid + the course fields."""
    return payload.select("userid", F.explode("courses").alias("c")).select("userid", "c.*")


# N3 -------------------------------------------------------------------------
GRADE_ITEM_FIELDS = ["id", "itemtype", "itemname", "graderaw", "gradeformatted", "gradedatesubmitted",
                     "gradedategraded"]


def flatten_grades(payload: DataFrame, course_items_only: bool = True) -> DataFrame:
    """usergrades[].gradeitems[] -> one row per graded item (graderaw not null), 9 columns.

    D17: when ``itemtype`` is present only course totals are kept.
    """
    ug = payload.select(F.explode("usergrades").alias("ug"))
    gi = ug.select(F.col("ug.userid").alias("userid"), F.col("ug.courseid").alias("courseid"),
                   F.explode("ug.gradeitems").alias("gi"))
    out = gi.select("userid", "courseid", *[F.col(f"gi.{f}").alias("itemid" if f == "id" else f)
                                            for f in GRADE_ITEM_FIELDS])
    out = out.where(F.col("graderaw").isNotNull())
    if course_items_only:
        out = out.where(F.coalesce(F.col("itemtype") == "course", F.lit(True)))
    return out


# N4 -------------------------------------------------------------------------
def flatten_completion(payload: DataFrame) -> DataFrame:
    return payload.select("userid", "courseid",
                          F.coalesce(F.col("completionstatus.completed"), F.lit(False)).alias("completed"),
                          F.col("completionstatus.timecompleted").alias("timecompleted"))


# N5 -------------------------------------------------------------------------
def users_from_rosters(payload: DataFrame) -> DataFrame:
    """(position, users[struct]) per roster page -> users deduplicated by id, first seen wins.

    Falsy ids (null, 0) are dropped. ``min_by`` on (position, index) is a
    partial aggregate: a user on many rosters costs one row per task.
    """
    ex = payload.select("position", F.posexplode("users").alias("idx", "u"))
    ex = ex.where(F.col("u.id").isNotNull() & (F.col("u.id") != 0))
    first = ex.groupBy(F.col("u.id").alias("id")).agg(F.min_by("u", F.struct("position", "idx")).alias("u"))
    return first.select("u.*")


# N6 -------------------------------------------------------------------------
def normalise_pairs(df: DataFrame) -> DataFrame:
    """(userid, courseid or id) pair; 0 counts as missing; rows without a course dropped."""
    course = F.coalesce(F.nullif(F.col("courseid"), F.lit(0)), F.nullif(F.col("id"), F.lit(0)))
    return df.select("userid", course.alias("courseid")).where(F.col("courseid").isNotNull())


# N7 -------------------------------------------------------------------------
def coalesce_sources(candidates) -> DataFrame | None:
    """First available source wins (bulk -> standard -> derived)."""
    for c in candidates:
        if c is not None:
            return c
    return None


def first_available(snap, names, columns) -> DataFrame | None:
    """N7 over a snapshot: the columns of the first named dataset that is present, else null."""
    return coalesce_sources([snap[n].select(*columns) if snap.has(n) else None for n in names])


# Exception classes that mean "this token may not call that function".
ACCESS_DENIED = ("accessexception", "webservice_access_exception", "access_exception")
# What a source answers instead of rows.
FAULT_SCHEMA = "exception string, message string"


class SourceFailed(RuntimeError):
    """A source answered with an error that no other source makes up for."""


def first_answer(sources, empty: DataFrame) -> tuple[DataFrame, list[tuple[str, str]]]:
    """N7 by failure class: the rows of the first source that answers, and what each source asked did.

    ``sources`` are (name, rows, faults): ``rows`` and ``faults`` are DataFrames of
    what landed for the source (``faults`` with exception and message), both null
    if nothing landed. A source that is absent or denies access is passed over;
    any other exception raises ``SourceFailed`` and later sources are not
    asked. If none answers the dataset is ``empty``.
    """
    asked = []
    for name, rows, faults in sources:
        if rows is None and faults is None:
            asked.append((name, "absent"))
            continue
        kind = F.lower(F.coalesce(F.col("exception"), F.lit("")))
        denied = [kind.contains(x) for x in ACCESS_DENIED]
        fault = None if faults is None else (faults.where("exception is not null").select("exception", "message", reduce(or_, denied).alias("denied"))
                                             .orderBy("denied", "exception", "message").first())
        if fault is None:
            return rows, [*asked, (name, "answered")]
        if not fault["denied"]:
            raise SourceFailed(f"{name}: {fault['exception']}: {fault['message']}")
        asked.append((name, "denied"))
    return empty, asked


# N8 -------------------------------------------------------------------------
def synth_cohorts(members: DataFrame) -> DataFrame:
    ids = members.select(F.col("cohortid").alias("id")).where(F.col("id").isNotNull()).distinct()
    return ids.select("id", F.concat(F.lit("cohort_"), F.col("id").cast("string")).alias("name"),
                      F.lit(1).alias("visible"), F.lit(True).alias("fallback"))


# N9 -------------------------------------------------------------------------
def page_check(pages: DataFrame, page_size: int) -> DataFrame:
    """Rows per landed page; only the last page may be short (``ok``)."""
    per = pages.groupBy("page").agg(F.count("*").alias("n_rows"))
    # the last page number as a scalar subquery (a global partial aggregate)
    j = per.withColumn("last", pages.agg(F.max("page")).scalar())
    return j.select("page", "n_rows", (F.col("page") == F.col("last")).alias("last_page"),
                    ((F.col("page") == F.col("last")) | (F.col("n_rows") == page_size)).alias("ok"))


def page_report(pages: DataFrame, page_size: int) -> DataFrame:
    """N9 over landed pages (page, rows array, malformed): every page up to the last with its rows and status.

    ``ok``; ``malformed`` (a document of the page does not parse); ``short`` (too
    few rows and not the last page); ``missing`` (no document landed).
    """
    per = pages.groupBy("page").agg(F.coalesce(F.sum(F.size("rows")), F.lit(0)).alias("n_rows"), F.max("malformed").alias("malformed"))
    expected = pages.agg(F.max("page").alias("last")).where("last is not null").select("last", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))).alias("page"))
    n = F.coalesce("n_rows", F.lit(0))
    status = (F.when(F.col("malformed").isNull(), "missing").when(F.col("malformed"), "malformed")
              .when((n < page_size) & (F.col("page") < F.col("last")), "short").otherwise("ok"))
    return expected.join(per, "page", "left").select("page", n.cast("long").alias("n_rows"), status.alias("status"))


# P1-P7 ------------------------------------------------------------------------
def p1_cohort_members(cm: DataFrame) -> DataFrame:
    return cm.select(F.concat_ws("_", "cohortid", "userid").alias("id"), "cohortid", "userid", "timeadded")


def p2_attendance(sessions: DataFrame, register: DataFrame) -> DataFrame:
    r = register.select(F.col("id").alias("rid"), F.col("course").alias("courseid"))
    return sessions.join(r, sessions.register == r.rid).select("id", "userid", "courseid", "login", "duration")


def p3_cohort_bridge(enrol: DataFrame) -> DataFrame:
    e = enrol.where((F.col("enrol") == "cohort") & F.col("customint1").isNotNull())
    return e.select("id", F.col("customint1").alias("cohortid"), "courseid")


def p4_users(users: DataFrame) -> DataFrame:
    u = users.where((F.col("deleted") == 0) & (F.col("id") > 1))
    return u.select("id", "username", "email", "firstname", "lastname", "timecreated", "lastaccess", "suspended")


def p5_active_enrolments(user_enrolments: DataFrame, enrol: DataFrame) -> DataFrame:
    ue = user_enrolments.where(F.col("status") == 0)
    e = enrol.where(F.col("status") == 0).select(F.col("id").alias("eid"), "courseid")
    j = ue.join(e, ue.enrolid == e.eid)
    # rows are keyed by user_course: several enrolment methods collapse to one
    return j.select("userid", "courseid").dropDuplicates(["userid", "courseid"])


def p6_completions(cc: DataFrame) -> DataFrame:
    t = F.coalesce(F.col("timecompleted"), F.lit(0))
    return cc.select("userid", "courseid", (t > 0).cast("int").alias("completed"), t.alias("timecompleted"))


def p7_final_grades(grades: DataFrame, items: DataFrame) -> DataFrame:
    i = items.where(F.col("itemtype") == "course").select(F.col("id").alias("iid"), "courseid")
    g = grades.where(F.col("finalgrade").isNotNull())
    j = g.join(i, g.itemid == i.iid)
    return j.select("userid", "courseid", F.col("finalgrade").alias("graderaw"),
                    F.col("timemodified").alias("gradedategraded"))

"""Fixed schema per dataset (a missing dataset is an empty frame of that schema)."""

from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampType,
)


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


L, S, D, I, B, T = LongType(), StringType(), DoubleType(), IntegerType(), BooleanType(), TimestampType()

SCHEMAS = {
    "users": _s(("id", L), ("username", S), ("email", S), ("firstname", S), ("lastname", S),
                ("timecreated", L), ("lastaccess", L), ("suspended", I)),
    "courses": _s(("id", L), ("fullname", S)),
    "cohorts": _s(("id", L), ("name", S), ("visible", I)),
    "cohort_members": _s(("cohortid", L), ("userid", L)),
    "cohort_members_ext": _s(("cohortid", L), ("userid", L), ("timeadded", L)),
    "enrol_cohort_course": _s(("id", L), ("cohortid", L), ("courseid", L)),
    "user_courses": _s(("userid", L), ("courseid", L)),
    "user_grades": _s(("id", L), ("userid", L), ("courseid", L), ("graderaw", D), ("gradedategraded", L)),
    "course_completions": _s(("userid", L), ("courseid", L), ("completed", I), ("timecompleted", L)),
    "attendance_sessions": _s(("id", L), ("userid", L), ("courseid", L), ("login", L), ("duration", L)),
    "partner_meta": _s(("partner", S), ("tipo", S), ("region", S), ("trajo_oportunidades", S),
                       ("trajo_clientes", S), ("paga_certificacion", S), ("total_pagado", S)),
    "employees": _s(("id_vp", S), ("nombre", S), ("apellidos", S), ("lugar_trabajo", S), ("email", S),
                    ("departamento", S), ("manager", S), ("rol", S)),
    "proxy_log": _s(("pod", S), ("line_no", L), ("value", S)),
}

# Practice-session document (K6).
SESSION_SCHEMA = StructType([
    StructField("email", S), StructField("user", S), StructField("partner", S), StructField("tenant", S),
    StructField("fecha_inicio", T), StructField("fecha_fin", T), StructField("last_seen", T),
    StructField("certificacion", S), StructField("groups", ArrayType(S)),
])

# Session export / CSV form.
SESSION_CSV_SCHEMA = _s(("partner", S), ("email", S), ("user", S), ("tenant", S), ("fecha_inicio", T),
                        ("fecha_fin", T), ("last_seen", T), ("duracion_h", D))

AUDIT_SCHEMA = _s(("ts", S), ("accion", S), ("payload", S))

SNAPSHOT_DATASETS = (
    "users", "courses", "cohorts", "cohort_members", "cohort_members_ext", "enrol_cohort_course",
    "user_courses", "user_grades", "course_completions", "attendance_sessions",
)

# Landed API documents (S7), one schema per endpoint: what a payload lacks reads as null.
_USER = "struct<id: bigint, username: string, email: string, firstname: string, lastname: string>"
ENDPOINT_SCHEMAS = {
    "cohort_members": "cohortid bigint, userids array<bigint>",
    "user_courses": "userid bigint, courses array<struct<id: bigint, fullname: string>>",
    "grade_items": "usergrades array<struct<userid: bigint, courseid: bigint, gradeitems: array<struct<id: bigint, itemtype: string, "
                   "itemname: string, graderaw: double, gradeformatted: string, gradedatesubmitted: bigint, gradedategraded: bigint>>>>",
    "completion_status": "userid bigint, courseid bigint, completionstatus struct<completed: boolean, timecompleted: bigint>",
    "roster": f"position bigint, users array<{_USER}>",
}

# Dumps of the platform's own tables (S11), as the source projections P1-P7 read them.
PLATFORM_SCHEMAS = {
    "cohort_members": "cohortid bigint, userid bigint, timeadded bigint",
    "attendance_sessions": "id bigint, userid bigint, register bigint, login bigint, duration bigint",
    "attendance_register": "id bigint, course bigint",
    "enrol": "id bigint, enrol string, customint1 bigint, courseid bigint, status int",
    "user": "id bigint, username string, email string, firstname string, lastname string, timecreated bigint, lastaccess bigint, suspended int, deleted int",
    "user_enrolments": "userid bigint, enrolid bigint, status int",
    "course_completions": "userid bigint, courseid bigint, timecompleted bigint",
    "grade_grades": "userid bigint, itemid bigint, finalgrade double, timemodified bigint",
    "grade_items": "id bigint, courseid bigint, itemtype string",
}

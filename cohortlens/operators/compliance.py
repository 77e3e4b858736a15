"""Course compliance for one partner.

The matching courses stay a DataFrame joined with a left-semi join (no id
list spliced into SQL); the employee roster is joined on the normalised
e-mail. The only driver-side step is the data-dependent choice of the
completion source (one LIMIT 1 probe), as in the original workflow.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import rules as R
from cohortlens.sources.snapshot import Snapshot, normalise_employees

# The state labels of the roster. Output column names are the reports' contract.
COMPLETED, PENDING, NOT_ENROLLED = "completado", "pendiente", "sin_inscribir"


class Compliance:
    def __init__(self, snap: Snapshot, rules: R.Rules, course_pattern: str, partner: str,
                 employees: DataFrame | None = None, one_account: bool = False):
        """``one_account``: an e-mail with several accounts counts as the one of smallest id (D10);
        by default each account gives the employee a row."""
        self.one_account = one_account
        self.snap, self.rules = snap, rules
        self.pattern = course_pattern.lower()
        self.partner = partner.lower()
        self.employees = normalise_employees(employees) if employees is not None else None

    def partner_cond(self, email="email", username="username"):
        if self.partner == self.rules.house_org.lower():
            return R.is_house(email, username, self.rules.house_org)
        return F.lower(R.last_token(username)) == F.lit(self.partner)

    @cached_property
    def matching_courses(self) -> DataFrame:
        """Literal, case-insensitive substring match on the course name."""
        c = self.snap["courses"]
        return c.where(F.lower("fullname").contains(self.pattern)).select("id", "fullname")

    def _in_matching(self, df: DataFrame) -> DataFrame:
        m = self.matching_courses.select(F.col("id").alias("_cid"))
        return df.join(m, df.courseid == m._cid, "left_semi")

    def _partner_users(self) -> DataFrame:
        u = self.snap["users"]
        return u.where(self.partner_cond())

    # U1 ----------------------------------------------------------------------
    @cached_property
    def enrolled_union(self) -> DataFrame:
        parts = []
        if self.snap.has("user_courses"):
            parts.append(self._in_matching(self.snap["user_courses"]).select("userid", "courseid"))
        if self.snap.has("course_completions"):
            parts.append(self._in_matching(self.snap["course_completions"]).select("userid", "courseid"))
        if not parts:
            raise ValueError("compliance needs course_completions or user_courses")
        u = parts[0]
        for p in parts[1:]:
            u = u.union(p)
        return u.distinct()

    # J11 ---------------------------------------------------------------------
    @cached_property
    def enrolled(self) -> DataFrame:
        e = self.enrolled_union
        u = self._partner_users()
        return (e.join(u, e.userid == u.id)
                .select(F.lower("email").alias("email"), F.col("id").alias("moodle_userid"), "username").distinct())

    # A13 ---------------------------------------------------------------------
    @cached_property
    def completion_source(self) -> str:
        if self.snap.has("user_grades"):
            g = self._in_matching(self.snap["user_grades"])
            if g.limit(1).count() > 0:
                return "grades"
        if self.snap.has("course_completions"):
            return "completions"
        return "none"

    @cached_property
    def completed(self) -> DataFrame:
        u = self._partner_users().select(F.col("id").alias("uid"), "email")
        src = self.completion_source
        if src == "grades":
            g = self._in_matching(self.snap["user_grades"]).where(F.col("graderaw").isNotNull())
            j = g.join(u, g.userid == u.uid)
            return j.groupBy(F.lower("email").alias("email")).agg(
                F.min(F.when(F.col("gradedategraded") > 0, R.epoch_ts("gradedategraded"))).alias("fecha_completado"),
                F.max(F.col("graderaw").cast("double")).alias("nota"))
        if src == "completions":
            cc = self._in_matching(self.snap["course_completions"]).where(F.col("completed") == 1)
            j = cc.join(u, cc.userid == u.uid)
            return j.groupBy(F.lower("email").alias("email")).agg(
                F.min(F.when(F.col("timecompleted") > 0, R.epoch_ts("timecompleted"))).alias("fecha_completado"),
                F.lit(None).cast("double").alias("nota"))
        return self.snap.spark.createDataFrame([], "email string, fecha_completado timestamp, nota double")

    # J12 ---------------------------------------------------------------------
    @cached_property
    def status(self) -> DataFrame:
        emp = self.employees
        en = self.enrolled
        if self.one_account:
            en = en.groupBy("email").agg(F.min_by("username", "moodle_userid").alias("username"))
        en = en.select(F.col("email").alias("en_email"), "username")
        co = self.completed.select(F.col("email").alias("co_email"), "fecha_completado", "nota")
        j = emp.join(en, emp.email == en.en_email, "left").join(co, emp.email == co.co_email, "left")
        estado = (F.when(F.col("co_email").isNotNull(), F.lit(COMPLETED))
                  .when(F.col("en_email").isNotNull(), F.lit(PENDING)).otherwise(F.lit(NOT_ENROLLED)))
        return j.select("nombre", "apellidos", "email", "rol", "departamento", "manager",
                        F.coalesce("username", F.lit("")).alias("username_moodle"), estado.alias("estado"),
                        "fecha_completado", "nota")

    # J13 ---------------------------------------------------------------------
    def by_status(self, estado: str) -> DataFrame:
        return self.status.where(F.col("estado") == estado)

    def not_enrolled(self) -> DataFrame:
        """Employees with neither an enrolment nor a completion (left anti join)."""
        seen = self.enrolled.select("email").union(self.completed.select("email"))
        emp = self.employees
        return emp.join(seen, "email", "left_anti").select("nombre", "apellidos", "email", "rol", "departamento",
                                                          "manager")

    # A14 ---------------------------------------------------------------------
    def by_group(self, col: str) -> DataFrame:
        s = self.status
        agg = s.groupBy(col).agg(
            F.count("*").alias("total"),
            F.count_if(F.col("estado") == COMPLETED).alias("completados"),
            F.count_if(F.col("estado") == PENDING).alias("pendientes"),
            F.count_if(F.col("estado") == NOT_ENROLLED).alias("sin_inscribir"))
        return agg.select("*", R.pct1("completados", "total").alias("pct_completado"))

    # W2 ----------------------------------------------------------------------
    def status_share(self) -> DataFrame:
        """Share of each status; the total is taken over the counted states, so the status runs once."""
        agg = self.status.groupBy("estado").agg(F.count("*").alias("empleados"))
        all_states = agg.agg(F.collect_list(F.struct("estado", "empleados")).alias("s"), F.sum("empleados").alias("total"))
        rows = all_states.select(F.explode("s").alias("s"), "total").select("s.estado", "s.empleados", "total")
        return rows.select("estado", "empleados", R.pct1(F.col("empleados"), F.col("total")).alias("pct_total"))

    # B19 ---------------------------------------------------------------------
    def match_result(self) -> DataFrame:
        """One row: the pattern, how many courses match it, and whether any does."""
        n = self.matching_courses.agg(F.count("*").alias("cursos"))
        return n.select(F.lit(self.pattern).alias("patron"), "cursos", (F.col("cursos") > 0).alias("encontrado"))

    # A16 ---------------------------------------------------------------------
    def headline(self) -> DataFrame:
        """Totals of the roster; without a roster, those of the enrolled accounts by e-mail."""
        if self.employees is None:
            return self._headline_of_enrolled()
        s = self.status.agg(
            F.count_if(F.col("estado") == COMPLETED).alias("completados"),
            F.count_if(F.col("estado") == PENDING).alias("pendientes"),
            F.count_if(F.col("estado") == NOT_ENROLLED).alias("sin_inscribir"))
        n = self.employees.agg(F.count("*").alias("total_empleados"))
        from cohortlens.operators.reports import one_row
        row = one_row([s, n])
        return row.select("*", F.coalesce(R.pct1("completados", "total_empleados"), F.lit(0.0))
                          .alias("tasa_completado"))

    def _headline_of_enrolled(self) -> DataFrame:
        done = self.completed.select("email", F.lit(True).alias("_done"))
        row = self.enrolled.select("email").distinct().join(done, "email", "left").agg(
            F.count_if(F.col("_done").isNotNull()).alias("completados"),
            F.count_if(F.col("_done").isNull()).alias("pendientes"), F.count("*").alias("total_inscritos"))
        return row.select("*", F.coalesce(R.pct1("completados", "total_inscritos"), F.lit(0.0)).alias("tasa_completado"))

    # J14 ---------------------------------------------------------------------
    def _completions_by_pair(self) -> DataFrame | None:
        if not self.snap.has("course_completions"):
            return None
        cc = self._in_matching(self.snap["course_completions"]).where(F.col("completed") == 1)
        return cc.select(F.col("userid").alias("c_uid"), F.col("courseid").alias("c_cid"),
                         F.when(F.col("timecompleted") > 0, R.epoch_ts("timecompleted")).alias("fecha_completado"))

    def detail(self) -> DataFrame:
        e = self.enrolled_union
        u = self._partner_users()
        rc = self.snap["courses"].select(F.col("id").alias("rc_id"), F.col("fullname").alias("curso"))
        j = e.join(u, e.userid == u.id).join(rc, e.courseid == rc.rc_id)
        comp = self._completions_by_pair()
        if comp is None:
            j = j.select("*", F.lit(None).cast("timestamp").alias("fecha_completado"),
                         F.lit(False).alias("completado"))
        else:
            j = j.join(comp, (j.userid == comp.c_uid) & (j.courseid == comp.c_cid), "left")
            j = j.select("*", F.col("c_uid").isNotNull().alias("completado"))
        return j.select("id", "username", "email", R.full_name("firstname", "lastname").alias("nombre_completo"),
                        "curso", "fecha_completado", "completado", R.active("suspended").alias("activo")
                        ).orderBy("curso", "email", "id")

    # A15 ---------------------------------------------------------------------
    def course_summary(self) -> DataFrame:
        e = self.enrolled_union
        u = self._partner_users().select(F.col("id").alias("uid"))
        rc = self.snap["courses"].select(F.col("id").alias("rc_id"), F.col("fullname").alias("curso"))
        j = e.join(u, e.userid == u.uid).join(rc, e.courseid == rc.rc_id)
        comp = self._completions_by_pair()
        if comp is None:
            agg = j.groupBy("curso").agg(F.count_distinct("userid").alias("total_inscritos"))
            return agg.select("curso", "total_inscritos", F.lit(0).cast("long").alias("completados"),
                              F.col("total_inscritos").alias("pendientes"), F.lit(0.0).alias("pct_completado"))
        j = j.join(comp.select("c_uid", "c_cid"), (j.userid == comp.c_uid) & (j.courseid == comp.c_cid), "left")
        flag = F.col("c_uid").isNotNull()
        per_user = j.groupBy("curso", "userid").agg(F.max(flag).alias("any_done"), F.max(~flag).alias("any_open"))
        agg = per_user.groupBy("curso").agg(F.count("*").alias("total_inscritos"),
                                            F.count_if("any_done").alias("completados"),
                                            F.count_if("any_open").alias("pendientes"))
        return agg.select("*", R.pct1("completados", "total_inscritos").alias("pct_completado"))

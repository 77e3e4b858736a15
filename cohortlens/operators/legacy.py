"""Reports of the legacy SQL corpus.

Cohort-level reports reach courses through the cohort->course bridge
(``enrol_cohort_course``). The bridge and the cohort table are dimension
sized; memberships and grades are facts, so facts are joined on the
composite (user, cohort) key after the fact has been narrowed by the bridge.
The pass mark of this corpus is the legacy one (D1).
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions import rules as R
from cohortlens.operators.joins import salted_join
from cohortlens.sources.snapshot import Snapshot

LISTING_VERSIONS = ("14.1", "14.6", "14.8")
MOST_MARKS = 1024  # course marks that a user carries into the listings; of more, one null mark stands for any
_PAIR = ["userid", "courseid"]


def _mark(course: str) -> F.Column:
    """Two bytes of a course id's hash."""
    return (F.xxhash64(course) % 32768).cast("short")


def _seen(facts: list) -> DataFrame:
    """Per user the marks of the courses with a row in any of the (userid, courseid) facts.

    Rows without any value are left out: joined, they are no different from
    none. A user has at most 65,535 marks, however many rows.
    """
    valued = [f.where(reduce(or_, [F.col(c).isNotNull() for c in f.columns if c not in _PAIR])) for f in facts]
    pairs = reduce(DataFrame.unionByName, [f.select("userid", _mark("courseid").alias("mark")) for f in valued])
    marks = pairs.groupBy("userid").agg(F.collect_set("mark").alias("marks"))
    return marks.select("userid", F.when(F.size("marks") <= MOST_MARKS, F.col("marks")).otherwise(F.array(F.lit(None).cast("short"))).alias("_seen"))


class Legacy:
    def __init__(self, snap: Snapshot, rules: R.Rules, user_enrolments: DataFrame | None = None):
        self.snap, self.rules = snap, rules
        self.user_enrolments = user_enrolments  # (userid, courseid, timecreated), any method
        self.mark = rules.legacy_pass_mark

    # shared pieces -------------------------------------------------------------
    def user_partner(self, email_only: bool = False) -> DataFrame:
        u = self.snap["users"]
        return u.select(F.col("id").alias("userid"), "username", "email", "timecreated", "suspended",
                        R.partner("email", "username", self.rules.house_org, not email_only).alias("partner"))

    def cohorts(self) -> DataFrame:
        c = self.snap["cohorts"]
        return c.select(F.col("id").alias("cohortid"), F.col("name").alias("cohort_name"), "visible")

    def bridge(self) -> DataFrame:
        return self.snap["enrol_cohort_course"].select("cohortid", "courseid")

    def members(self) -> DataFrame:
        return self.snap["cohort_members_ext"].select("cohortid", "userid", "timeadded")

    def course_grades(self, min_mark: float | None = None) -> DataFrame:
        g = self.snap["user_grades"].where(F.col("graderaw").isNotNull())
        if min_mark is not None:
            g = g.where(F.col("graderaw") >= F.lit(float(min_mark)))
        return g.select("userid", "courseid", F.col("graderaw").alias("finalgrade"),
                        F.col("gradedategraded").alias("timemodified"))

    def listing_cohorts(self, versions=LISTING_VERSIONS, categories: bool = True) -> DataFrame:
        c = self.cohorts()
        cond = R.any_contains("cohort_name", versions)
        if categories:
            cond = cond & R.any_contains("cohort_name", [p for _, p in self.rules.categories])
        return c.where(cond).select("cohortid", "cohort_name", R.category("cohort_name", self.rules).alias("cohort_group"))

    # A21 -------------------------------------------------------------------------
    def users_partner_cohort(self) -> DataFrame:
        j = self.user_partner().join(self.members(), "userid").join(self.cohorts(), "cohortid")
        return j.groupBy("partner", "cohort_name").agg(F.count("*").alias("total_altas"))

    # A22 -------------------------------------------------------------------------
    def users_month_partner(self) -> DataFrame:
        up = self.user_partner()
        return up.groupBy(R.month_key(R.epoch_ts("timecreated")).alias("mes"), "partner").agg(
            F.count("*").alias("total_altas"))

    # A23 -------------------------------------------------------------------------
    def hours_month_partner(self) -> DataFrame:
        """Whole hours per user-course-month first, then summed per partner and month."""
        s = self.snap["attendance_sessions"]
        per = s.groupBy("userid", "courseid", R.month_key(R.epoch_ts("login")).alias("mes")).agg(
            F.round(F.sum("duration").cast("double") / F.lit(3600.0), 0).alias("horas"))
        j = per.join(self.user_partner().select("userid", "partner"), "userid")
        return j.groupBy("mes", "partner").agg(F.sum("horas").alias("total_horas"))

    # A24 -------------------------------------------------------------------------
    def active_month_partner(self) -> DataFrame:
        s = self.snap["attendance_sessions"]
        per = s.select("userid", R.month_key(R.epoch_ts("login")).alias("mes")).distinct()
        j = per.join(self.user_partner().select("userid", "partner"), "userid")
        return j.groupBy("mes", "partner").agg(F.count("*").alias("usuarios_unicos"))

    # A25 -------------------------------------------------------------------------
    def _active_visible_members(self) -> DataFrame:
        up = self.user_partner(email_only=True).where(F.col("suspended") == 0)
        c = self.cohorts().where(F.col("visible") == 1)
        return up.join(self.members(), "userid").join(c, "cohortid")

    def enrolments_month(self) -> DataFrame:
        j = self._active_visible_members()
        return j.groupBy("partner", F.col("cohort_name").alias("cohorte"),
                         R.month_key(R.epoch_ts("timeadded")).alias("mes")).agg(F.count("*").alias("num_apuntados"))

    # A26 -------------------------------------------------------------------------
    def enrolments_by_type(self, version: str = "14.6", also: str = "Operaciones") -> DataFrame:
        j = self._active_visible_members()
        name = F.col("cohort_name")
        # The redundant (A AND (A OR B)) predicate of the original is kept; Catalyst simplifies it.
        j = j.where(name.contains(version) & (name.contains(version) | name.contains(also)))
        return j.groupBy("partner", R.month_key(R.epoch_ts("timeadded")).alias("mes"),
                         R.cohort_type("cohort_name").alias("tipo")).agg(
            F.count_distinct("email").alias("num_apuntados"))

    # A27 -------------------------------------------------------------------------
    def cohort_month_crosstab(self) -> DataFrame:
        """partner x (cohort_YYYY_MM) membership counts, long: (partner, cohorte_mes, n).

        The columns of the sheet are the cohort-months of *all* memberships;
        one that only suspended users joined has a row with a null partner and
        n = 0, so that no column is lost. Long rows have no column limit;
        ``crosstab_sheet`` lays chosen columns out side by side.
        """
        up = self.user_partner(email_only=True).select("userid", "partner", "suspended")
        j = up.join(self.members(), "userid").join(self.cohorts(), "cohortid")
        key = F.concat(F.col("cohort_name"), F.lit("_"), F.date_format(R.epoch_ts("timeadded"), "yyyy_MM"))
        active = F.col("suspended") == 0
        per = j.groupBy(key.alias("cohorte_mes"), "partner").agg(F.count_if(active).alias("n"))
        # per cohort-month: the partners with members, or one empty row where none has any
        cells = F.filter(F.collect_list(F.struct("partner", "n")), lambda c: c["n"] > 0)
        none = F.array(F.struct(F.lit(None).cast("string").alias("partner"), F.lit(0).cast("long").alias("n")))
        keyed = per.groupBy("cohorte_mes").agg(cells.alias("cells"))
        keyed = keyed.where(F.col("cohorte_mes").isNotNull() | (F.size("cells") > 0))
        return keyed.select(F.explode(F.when(F.size("cells") > 0, F.col("cells")).otherwise(none)).alias("c"), "cohorte_mes").select(
            "c.partner", "cohorte_mes", "c.n")

    def crosstab_sheet(self, columns: list) -> DataFrame:
        """The given cohort-months as columns, one row per partner; null where no membership."""
        cells = self.cohort_month_crosstab().where(F.col("n") > 0)
        return cells.groupBy("partner").pivot("cohorte_mes", columns).agg(F.first("n"))

    # A28 -------------------------------------------------------------------------
    def first_enrolment(self) -> DataFrame:
        ue = self.user_enrolments
        return ue.groupBy("userid", "courseid").agg(F.min("timecreated").alias("enrol_time_unix"))

    # W1 / J15 --------------------------------------------------------------------
    def cumulative_dedication(self) -> DataFrame:
        s = self.snap["attendance_sessions"]
        month = F.date_trunc("month", R.epoch_ts("login"))
        ded = s.groupBy("userid", "courseid", month.alias("mes")).agg(F.sum("duration").alias("secs"))
        up = self.user_partner().select("userid", "partner",
                                        F.date_trunc("month", R.epoch_ts("timecreated")).alias("alta_mes"))
        uc = self.members().join(self.cohorts(), "cohortid").select("userid", "cohortid", "cohort_name")
        j = (ded.join(self.bridge(), "courseid")
             .join(uc, ["userid", "cohortid"])
             .join(up, "userid"))
        # per user first, then plain counts: no Expand for the two distinct counts
        person = j.groupBy("partner", "cohort_name", "mes", "userid").agg(
            F.max(F.col("alta_mes") == F.col("mes")).alias("is_new"), F.sum("secs").alias("secs"))
        res = person.groupBy("partner", "cohort_name", "mes").agg(
            F.count_if("is_new").alias("num_altas"), F.sum("secs").alias("secs"), F.count("userid").alias("usuarios_unicos"))
        w = Window.partitionBy("partner", "cohort_name").orderBy("mes")  # default RANGE frame
        return res.select(
            "mes", "partner", "cohort_name", "num_altas",
            (F.col("secs").cast("double") / F.lit(3600.0)).alias("horas_dedicadas"), "usuarios_unicos",
            F.sum("num_altas").over(w).alias("acumulado_altas"),
            (F.sum("secs").over(w).cast("double") / F.lit(3600.0)).alias("acumulado_horas"),
            F.sum("usuarios_unicos").over(w).alias("acumulado_usuarios"))

    # J16 -------------------------------------------------------------------------
    def _passes(self, cohorts: DataFrame) -> DataFrame:
        """Passed course grades reached through a cohort that enrols the course."""
        ca = self.course_grades(self.mark)
        c = self.snap["courses"].select(F.col("id").alias("courseid"))
        br = self.bridge().join(cohorts, "cohortid")
        j = (ca.join(c, "courseid")
             .join(br, "courseid")
             .join(self.members().select("cohortid", "userid"), ["userid", "cohortid"])
             .join(self.user_partner().select("userid", "username", "email", "partner"), "userid"))
        return j

    def passes_by_cohort(self) -> DataFrame:
        j = self._passes(self.cohorts().select("cohortid", "cohort_name"))
        return j.groupBy("partner", "cohort_name").agg(F.count_distinct("userid").alias("total_aprobados"))

    def passes_by_category(self) -> DataFrame:
        j = self._passes(self.listing_cohorts(categories=False))
        return j.groupBy("partner", "cohort_group").agg(F.count_distinct("userid").alias("total_aprobados"))

    def certified_users(self) -> DataFrame:
        j = self._passes(self.listing_cohorts())
        return j.groupBy("partner").agg(F.count_distinct("userid").alias("estudiantes_certificados"))

    # J17 -------------------------------------------------------------------------
    def passed_listing(self) -> DataFrame:
        j = self._passes(self.listing_cohorts())
        return j.select("userid", "username", "email", "partner", "cohort_name", "cohort_group", "finalgrade",
                        R.epoch_ts("timemodified").alias("fecha_aprobado"))

    # (user, cohort, course) rows ---------------------------------------
    def _user_cohort_courses(self, cohorts: DataFrame, users: DataFrame, courses: DataFrame) -> DataFrame:
        """Distinct (userid, cohortid, courseid) of the chosen cohorts, with the user, cohort and course fields.

        Memberships are deduplicated per (user, cohort) and the bridge per
        (cohort, course) *before* the expansion, so the product is distinct by
        construction. Memberships meet the users and the bridge the cohorts and
        courses before it as well: the expanded rows, many times either side,
        need no shuffle for them. The expansion is salted by the user: a cohort
        holding a third of all members spreads over many tasks.
        """
        ids = cohorts.select("cohortid")
        mem = self.members().select("cohortid", "userid").join(ids, "cohortid", "left_semi").distinct()
        bridge = self.bridge().join(ids, "cohortid", "left_semi").select("cohortid", "courseid").distinct()
        return salted_join(mem.join(users, "userid"), bridge.join(cohorts, "cohortid").join(courses, "courseid"), "cohortid", "userid")

    def _listing(self, cohorts: DataFrame, users: DataFrame, facts: list) -> DataFrame:
        """Expanded rows + left joins of the (userid, courseid) facts + user,
        cohort and course fields.

        The expanded rows outnumber every fact by far, and few of them have
        one. Users therefore carry short marks of the courses they have a fact
        for into the expansion: rows of other courses leave it as they are,
        with nulls. Only the rest, and a few that share a mark, are shuffled,
        once for all facts.
        """
        facts = [f.where(F.col("userid").isNotNull() & F.col("courseid").isNotNull()) for f in facts]
        c = self.snap["courses"].select(F.col("id").alias("courseid"), F.col("fullname").alias("course_name"), _mark("id").alias("_mark"))
        seen = users.join(_seen(facts), "userid", "left").withColumn("_seen", F.coalesce("_seen", F.array().cast("array<short>")))
        rows = self._user_cohort_courses(cohorts, seen, c)
        maybe = F.coalesce(F.array_contains("_seen", F.col("_mark")), F.lit(True))  # null: too many courses to tell
        met, bare = (rows.where(m).drop("_seen", "_mark") for m in (maybe, ~maybe))
        for f in facts:
            met = met.join(f, _PAIR, "left")
        # The union keeps aliases that its first side passes through; named anew, both sides read the same two shuffles.
        met = met.select(*[F.col(c).alias(c) for c in met.columns])
        return met.unionByName(bare.withColumns({x.name: F.lit(None).cast(x.dataType) for f in facts for x in f.schema if x.name not in _PAIR}))

    def student_grade_status(self, email_filter: str | None = None) -> DataFrame:
        up = self.user_partner().select("userid", "username", "email", "partner")
        if email_filter is not None:  # B21: predicate only when the parameter is given
            up = up.where(F.lower("email").contains(email_filter.lower()))
        j = self._listing(self.listing_cohorts(), up, [self.course_grades()])
        return j.select("userid", "username", "email", "partner", "cohort_name", "cohort_group", "courseid",
                        "course_name", "finalgrade", R.epoch_ts("timemodified").alias("fecha_nota"),
                        R.approval_status("finalgrade", self.mark).alias("estado_aprobacion"))

    def enrolled_approved(self) -> DataFrame:
        up = self.user_partner().select("userid", "partner", "timecreated")
        ca = self.course_grades(self.mark).select("userid", "courseid", "finalgrade",
                                                   F.col("timemodified").alias("approved_time_unix"),
                                                   F.lit(True).alias("_ok"))
        j = self._listing(self.listing_cohorts(categories=False), up, [ca, self.first_enrolment()])
        return j.select(
            "partner", "userid", "cohort_name", "cohort_group", "courseid",
            F.col("course_name").alias("course_fullname"),
            F.when(F.col("_ok").isNotNull(), 1).otherwise(0).alias("aprobado"), "finalgrade",
            F.when(F.col("_ok").isNotNull(), R.epoch_ts("approved_time_unix")).alias("fecha_aprobado"),
            R.latest_epoch_ts("timecreated", "enrol_time_unix").alias("fecha_alta_o_matricula_mas_actual"))

    # J20 -------------------------------------------------------------------------
    def users_cohorts(self, partner: str, version: str = "14.6") -> DataFrame:
        u = self.snap["users"].where((F.col("suspended") == 0) &
                                     (R.last_token("username") == F.lit(partner)))
        c = self.cohorts().where(F.col("cohort_name").contains(version))
        # The original LEFT JOINs are made inner by the WHERE on the right side.
        j = u.join(self.members(), u.id == F.col("userid")).join(c, "cohortid")
        return j.select(
            "id", F.col("username").alias("login"), R.full_name("firstname", "lastname").alias("nombre_completo"),
            "email", R.display_ts(R.epoch_ts("timecreated")).alias("fecha_alta"),
            R.display_ts(R.epoch_ts("lastaccess")).alias("ultimo_acceso"),
            R.partner("email", "username", self.rules.house_org, check_username=False).alias("partner"),
            F.col("cohort_name").alias("cohorte"),
            R.display_ts(R.epoch_ts("timeadded")).alias("fecha_alta_cohorte"))

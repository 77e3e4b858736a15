"""Semantic layer: dimensions and facts.

``Model`` holds lazy DataFrames built from a ``Snapshot``. Facts are
pre-aggregated before they meet a dimension (attendance is grouped per
user/course/month before the user join), so the big side is reduced before
any shuffle join; dimension-sized frames are left to AQE's measured
broadcast.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import rules as R
from cohortlens.sources.snapshot import Snapshot


def dedupe_partner_meta(meta: DataFrame) -> DataFrame:
    """One row per partner, the one with most non-empty fields (ties: smallest values)."""
    cols = [c for c in meta.columns if c != "partner"]
    filled = sum(F.when(F.coalesce(F.col(c), F.lit("")) != "", 1).otherwise(0) for c in cols)
    rank_key = F.struct(
        (-filled).alias("neg_filled"),
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in cols],
    )
    # min_by over the partner group: a partial aggregate, no window sort.
    best = meta.groupBy("partner").agg(F.min_by(F.struct(*[F.col(c) for c in cols]), rank_key).alias("m"))
    return best.select("partner", *[F.col(f"m.{c}").alias(c) for c in cols])


class Model:
    def __init__(self, snapshot: Snapshot, rules: R.Rules, partner_meta: DataFrame | None = None,
                 partner_filter: str | None = None):
        self.snap = snapshot
        self.rules = rules
        self.partner_meta = partner_meta
        self.partner_filter = partner_filter

    # B18 ---------------------------------------------------------------------
    def for_partner(self, partner: str) -> "Model":
        """Restrict all five facts to one partner (case-insensitive); dimensions stay whole."""
        return Model(self.snap, self.rules, self.partner_meta, partner)

    def _pf(self, df: DataFrame) -> DataFrame:
        if self.partner_filter is None:
            return df
        return df.where(F.lower(F.col("partner")) == F.lit(self.partner_filter.lower()))

    # users with partner: the unfiltered base of every fact
    @cached_property
    def _users(self) -> DataFrame:
        u = self.snap["users"]
        return u.select(
            F.col("id").alias("userid"), "username", "email",
            R.full_name("firstname", "lastname").alias("nombre_completo"),
            R.partner("email", "username", self.rules.house_org).alias("partner"),
            R.epoch_ts("timecreated").alias("fecha_alta"),
            R.epoch_ts("lastaccess").alias("ultimo_acceso"),
            R.active("suspended").alias("activo"),
        )

    def _user_partner(self) -> DataFrame:
        return self._users.select("userid", "partner")

    # J1 ----------------------------------------------------------------------
    @cached_property
    def dim_partners(self) -> DataFrame:
        p = self._users.select("partner").distinct()
        if self.partner_meta is None:
            return p.select(
                "partner", F.lit(None).cast("string").alias("tipo"), F.lit(None).cast("string").alias("region"),
                F.lit(None).cast("boolean").alias("trajo_oportunidades"),
                F.lit(None).cast("boolean").alias("trajo_clientes"),
                F.lit(False).alias("paga_certificacion"), F.lit(None).cast("double").alias("total_pagado"),
            )
        m = dedupe_partner_meta(self.partner_meta)
        j = p.join(m, "partner", "left")
        return j.select(
            "partner", "tipo", "region",
            R.tri_bool("trajo_oportunidades").alias("trajo_oportunidades"),
            R.tri_bool("trajo_clientes").alias("trajo_clientes"),
            R.true_else_false("paga_certificacion").alias("paga_certificacion"),
            R.lenient_double("total_pagado").alias("total_pagado"),
        )

    # J2 ----------------------------------------------------------------------
    @cached_property
    def dim_cohortes(self) -> DataFrame:
        c = self.snap["cohorts"]
        return c.select(
            F.col("id").alias("cohort_id"), F.col("name").alias("cohort_name"),
            R.category("name", self.rules).alias("categoria"),
            R.version("name", self.rules.version_regex).alias("version"),
            R.language("name", self.rules.languages).alias("idioma"),
            F.col("visible").cast("boolean").alias("visible"),
        )

    # J3 ----------------------------------------------------------------------
    @cached_property
    def dim_cursos(self) -> DataFrame:
        c = self.snap["courses"]
        return c.select(
            F.col("id").alias("course_id"), F.col("fullname").alias("course_name"),
            R.is_certification("fullname", self.rules.cert_patterns).alias("es_certificacion"),
            R.category("fullname", self.rules).alias("categoria"),
            R.version("fullname", self.rules.version_regex).alias("version"),
            R.language("fullname", self.rules.languages).alias("idioma"),
        )

    # J4 ----------------------------------------------------------------------
    @cached_property
    def f_usuarios(self) -> DataFrame:
        return self._pf(self._users)

    # J5 ----------------------------------------------------------------------
    @cached_property
    def f_inscripciones(self) -> DataFrame:
        cm = self.snap["cohort_members_ext"]
        dc = self.dim_cohortes.select("cohort_id", "categoria", "version")
        j = cm.join(self._user_partner().withColumnRenamed("userid", "uid"), F.col("userid") == F.col("uid"))
        j = j.join(dc, F.col("cohortid") == F.col("cohort_id"))
        ts = R.epoch_ts("timeadded")
        return self._pf(j.select(
            "userid", "cohort_id", "partner", "categoria", "version",
            ts.alias("fecha_inscripcion"), R.month_key(ts).alias("mes_inscripcion"),
        ))

    # J6 ----------------------------------------------------------------------
    @cached_property
    def f_certificaciones(self) -> DataFrame:
        g = self.snap["user_grades"].where(F.col("graderaw").isNotNull())
        cert = self.dim_cursos.where(F.col("es_certificacion")).select("course_id")
        j = g.join(cert, g.courseid == cert.course_id)
        j = j.join(self._user_partner().withColumnRenamed("userid", "uid"), F.col("userid") == F.col("uid"))
        grade = F.col("graderaw").cast("double")
        return self._pf(j.select(
            "userid", "course_id", "partner", grade.alias("finalgrade"),
            R.passed(grade, self.rules.pass_mark).alias("aprobado"),
            R.epoch_ts("gradedategraded").alias("fecha_nota"),
        ))

    # J7 ----------------------------------------------------------------------
    @cached_property
    def f_actividad(self) -> DataFrame:
        s = self.snap["attendance_sessions"]
        agg = s.groupBy("userid", F.col("courseid").alias("course_id")).agg(
            F.min("login").alias("first_login"), F.max("login").alias("last_login"))
        j = agg.join(self._user_partner().withColumnRenamed("userid", "uid"), F.col("userid") == F.col("uid"))
        return self._pf(j.select(
            "userid", "course_id", "partner", F.lit(True).alias("tiene_actividad"),
            R.epoch_ts("first_login").alias("primer_acceso"), R.epoch_ts("last_login").alias("ultimo_acceso"),
        ))

    # J8 ----------------------------------------------------------------------
    @cached_property
    def f_dedicacion(self) -> DataFrame:
        """Hours per (user, course, partner, month), 2 decimals.

        Grouped by user/course/month *before* the user join: partner is a
        function of the user, so the result is the same and the join sees
        the reduced side.
        """
        s = self.snap["attendance_sessions"]
        agg = s.groupBy("userid", F.col("courseid").alias("course_id"),
                        R.month_key(R.epoch_ts("login")).alias("mes")).agg(F.sum("duration").alias("secs"))
        j = agg.join(self._user_partner().withColumnRenamed("userid", "uid"), F.col("userid") == F.col("uid"))
        return self._pf(j.select("userid", "course_id", "partner", "mes", R.hours2("secs").alias("horas")))

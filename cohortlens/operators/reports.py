"""Partner and certification reports.

Every per-partner measure is aggregated on its own fact and only the
aggregates (one row per partner or per partner-month) are joined, so no join
ever fans a fact out. Distinct counts with a condition are computed as a
pre-aggregation on (group, user) followed by plain counts: the first shuffle
is keyed by the user as well, which spreads a partner holding a third of all
users over many tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import rules as R
from cohortlens.operators.model import Model
from cohortlens.session import stored


def distinct_users(df: DataFrame, keys: list, flag=None, user: str = "userid",
                   total: str = "alumnos", flagged: str = "aprobados") -> DataFrame:
    """count(DISTINCT user) and count(DISTINCT CASE WHEN flag THEN user END) per keys."""
    if flag is None:
        return df.groupBy(*keys).agg(F.count_distinct(user).alias(total))
    per_user = df.where(F.col(user).isNotNull()).groupBy(*keys, user).agg(F.max(flag).alias("_f"))
    return per_user.groupBy(*keys).agg(F.count("*").alias(total), F.count_if(F.col("_f")).alias(flagged))


def discover(df: DataFrame, col) -> list:
    """Distinct non-null values of a low-cardinality key (pivot columns), sorted."""
    return [r[0] for r in df.select(col.alias("v") if not isinstance(col, str) else F.col(col).alias("v"))
            .where(F.col("v").isNotNull()).distinct().orderBy("v").collect()]


# A1 ---------------------------------------------------------------------------
def users_per_partner(m: Model) -> DataFrame:
    return m.f_usuarios.groupBy("partner").agg(F.count("*").alias("users"))


# A3 ---------------------------------------------------------------------------
TOTAL = "all"


def users_per_year(m: Model) -> DataFrame:
    """Stored (partner, yr, n, ultimo_acceso): distinct users by creation year, and of all years together (``yr`` is TOTAL).

    One aggregate over the users serves the discovery of the years and the
    result; it has a row per partner and year.
    """
    per_user = m.f_usuarios.groupBy("partner", "userid").agg(F.collect_set(R.year_key("fecha_alta")).alias("years"), F.max("ultimo_acceso").alias("ultimo_acceso"))
    years = F.explode(F.concat("years", F.array(F.lit(TOTAL)))).alias("yr")
    return stored(per_user.select("partner", "userid", "ultimo_acceso", years).groupBy("partner", "yr").agg(
        F.count("userid").alias("n"), F.max("ultimo_acceso").alias("ultimo_acceso")), "users-per-year")


def hours_per_year(m: Model) -> DataFrame:
    """Stored (partner, yr, c): hundredths of hours by year; for discovery and result alike."""
    d = m.f_dedicacion.groupBy("partner", F.substring("mes", 1, 4).alias("yr")).agg(F.sum(R.centi("horas")).alias("c"))
    return stored(d, "hours-per-year")


def _of_year(value: str, y: str):
    return F.coalesce(F.max(F.when(F.col("yr") == y, F.col(value))), F.lit(0))


def _altas(years: list) -> list:
    return [_of_year("n", y).alias(f"altas_{y}") for y in years]


def _horas(years: list) -> list:
    return [(_of_year("c", y) / F.lit(100.0)).alias(f"horas_{y}") for y in years]


def users_by_year_pivot(m: Model, years: list | None = None) -> DataFrame:
    """partner + altas_<year>: distinct users created that year (0 when none)."""
    per = users_per_year(m)
    years = [y for y in discover(per, "yr") if y != TOTAL] if years is None else years
    return per.groupBy("partner").agg(F.count("*").alias("_n"), *_altas(years)).drop("_n")


def hours_by_year_pivot(m: Model, years: list | None = None) -> DataFrame:
    """partner + horas_<year> (round 2, 0 when absent) for every partner with hours."""
    per = hours_per_year(m)
    years = discover(per, "yr") if years is None else years
    return per.groupBy("partner").agg(F.count("*").alias("_n"), *_horas(years)).drop("_n")


# A2 ---------------------------------------------------------------------------
def partner_summary(m: Model, altas_years: list | None = None, horas_years: list | None = None) -> DataFrame:
    users, hours = users_per_year(m), hours_per_year(m)
    if altas_years is None:
        altas_years = [y for y in discover(users, "yr") if y != TOTAL]
    if horas_years is None:
        horas_years = discover(hours, "yr")
    base = users.groupBy("partner").agg(_of_year("n", TOTAL).alias("total_altas"), F.max("ultimo_acceso").alias("ultimo_acceso"), *_altas(altas_years))
    cert = distinct_users(m.f_certificaciones, ["partner"], "aprobado", total="_n", flagged="total_certificados")
    ded_agg = hours.groupBy("partner").agg((F.sum("c") / F.lit(100.0)).alias("total_horas"), *_horas(horas_years))
    cm = m.snap["cohort_members_ext"]
    up = m.f_usuarios.select(F.col("userid").alias("uid"), "partner")
    ins = (cm.join(up, cm.userid == up.uid).groupBy("partner")
           .agg(F.count_distinct("userid").alias("total_inscritos")))

    out = base
    for part in (m.dim_partners, cert.select("partner", "total_certificados"), ded_agg, ins):
        right = part.withColumnRenamed("partner", "_p")  # a null partner is a group of its own and meets itself
        out = out.join(right, out["partner"].eqNullSafe(right["_p"]), "left").drop("_p")
    return out.select(
        "partner", "tipo", "region", "trajo_oportunidades", "trajo_clientes", "paga_certificacion",
        "total_pagado", "total_altas", *[f"altas_{y}" for y in altas_years],
        F.coalesce("total_inscritos", F.lit(0)).alias("total_inscritos"),
        F.coalesce("total_certificados", F.lit(0)).alias("total_certificados"),
        F.coalesce("total_horas", F.lit(0.0)).alias("total_horas"),
        *[F.coalesce(f"horas_{y}", F.lit(0.0)).alias(f"horas_{y}") for y in horas_years],
        R.no_tz("ultimo_acceso").alias("ultimo_acceso"),
    )


def order_partner_summary(df: DataFrame) -> DataFrame:
    """O1: presentation order of the summary sheet."""
    return df.orderBy(F.col("total_certificados").desc_nulls_last(), F.col("total_altas").desc(),
                      F.col("partner").asc_nulls_last())


# J10 --------------------------------------------------------------------------
def merge_on_keys(parts: list, keys: list) -> DataFrame:
    """Full outer join of per-key aggregates, as one union + one aggregation.

    Each part has unique keys and its own measure columns. Rows with a null
    key never match in an outer join, so they keep a part tag in the grouping
    key; all other keys merge. One shuffle instead of a chain of joins.
    """
    measures = [c for p in parts for c in p.columns if c not in keys]
    tagged = []
    for i, p in enumerate(parts):
        t = p.select(*keys, F.lit(i).alias("_part"),
                     *[(F.col(c) if c in p.columns else F.lit(None)).alias(c) for c in measures])
        tagged.append(t)
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    grp = u.withColumn("_tag", F.when(any_null, F.col("_part")))
    # Every measure comes from exactly one part, so max() just picks it.
    return grp.groupBy(*keys, "_tag").agg(*[F.max(c).alias(c) for c in measures]).drop("_tag")


def monthly_evolution(m: Model) -> DataFrame:
    fu, fi, fc, fd = m.f_usuarios, m.f_inscripciones, m.f_certificaciones, m.f_dedicacion
    altas = fu.groupBy("partner", R.month_key("fecha_alta").alias("mes")).agg(F.count("*").alias("altas"))
    inscritos = fi.groupBy("partner", F.col("mes_inscripcion").alias("mes")).agg(
        F.count_distinct("userid").alias("inscritos"))
    cert = distinct_users(fc.withColumn("mes", R.month_key("fecha_nota")), ["partner", "mes"], "aprobado",
                          total="_n", flagged="certificados").drop("_n")
    horas = fd.groupBy("partner", "mes").agg((F.sum(R.centi("horas")) / F.lit(100.0)).alias("horas"),
                                             F.count_distinct("userid").alias("usuarios_activos"))
    out = merge_on_keys([altas, inscritos, cert, horas], ["partner", "mes"])
    return out.select("partner", "mes", "altas", "inscritos", "certificados", "horas", "usuarios_activos")


# A6, A7 -----------------------------------------------------------------------
def partner_category(m: Model) -> DataFrame:
    fc = m.f_certificaciones.join(m.dim_cursos.select("course_id", "categoria"), "course_id")
    return distinct_users(fc, ["partner", "categoria"], "aprobado")


def partner_version(m: Model) -> DataFrame:
    dc = m.dim_cursos.where(F.col("version").isNotNull()).select("course_id", "version", "categoria", "course_name")
    fc = m.f_certificaciones.join(dc, "course_id")
    return distinct_users(fc, ["partner", "version", "categoria", "course_name"], "aprobado")


# J9 ---------------------------------------------------------------------------
def certified_detail(m: Model) -> DataFrame:
    fc = m.f_certificaciones.where(F.col("aprobado"))
    u = m.f_usuarios.select(F.col("userid").alias("uid"), "username", "nombre_completo", "email",
                            F.col("partner").alias("u_partner"))
    j = fc.join(u, fc.userid == u.uid).join(m.dim_cursos, "course_id")
    return j.select("userid", "username", "nombre_completo", "email", F.col("u_partner").alias("partner"),
                    "course_name", "categoria", "version", "idioma", "finalgrade", "aprobado",
                    R.no_tz("fecha_nota").alias("fecha_nota"))


# A8 ---------------------------------------------------------------------------
def inactive_partners(m: Model, as_of: str, days: int = 30, never_as_null: bool = False) -> DataFrame:
    """Partners whose latest access lies more than ``days`` back.

    A user who never came has access time 0, i.e. 1970 (D9); with
    ``never_as_null`` such users do not count, and a partner of which nobody
    ever came is listed with nulls.
    """
    if never_as_null:
        return _inactive_or_never(m, as_of, days)
    last = (m.f_usuarios.where(F.col("ultimo_acceso").isNotNull()).groupBy("partner")
            .agg(F.max("ultimo_acceso").alias("_last")))
    cutoff = F.lit(as_of).cast("date") - F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(days))
    d = F.to_date("_last")
    return (last.where(F.col("_last") < cutoff.cast("timestamp"))
            .select("partner", d.alias("ultimo_acceso"), R.days_since(d, as_of).alias("dias_sin_actividad")))


def _inactive_or_never(m: Model, as_of: str, days: int) -> DataFrame:
    came = F.when(F.unix_seconds("ultimo_acceso") > 0, F.to_date("ultimo_acceso"))
    last = m.f_usuarios.groupBy("partner").agg(F.max(came).alias("ultimo_acceso"))
    late = F.col("ultimo_acceso") < F.date_sub(F.lit(as_of).cast("date"), days)
    return last.where(late | F.col("ultimo_acceso").isNull()).select(
        "partner", "ultimo_acceso", R.days_since(F.col("ultimo_acceso"), as_of).alias("dias_sin_actividad"))


# A9 ---------------------------------------------------------------------------
def one_row(parts: list) -> DataFrame:
    """Combine one-row aggregates into one row (union + global max; no cross join)."""
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return u.agg(*[F.max(c).alias(c) for c in u.columns])


def global_kpis(m: Model) -> DataFrame:
    fu, fc, fd = m.f_usuarios, m.f_certificaciones, m.f_dedicacion
    users = fu.agg(F.count_distinct("partner").alias("partners"), F.count("*").alias("usuarios_totales"),
                   F.count_if(F.col("activo")).alias("usuarios_activos"))
    cert = fc.agg(F.count("*").alias("total_certificaciones"), F.count_if("aprobado").alias("aprobados"))
    cert = cert.select("*", F.coalesce(R.pct1("aprobados", "total_certificaciones"), F.lit(0.0))
                       .alias("tasa_aprobacion"))
    hours = fd.agg(F.coalesce(F.round(F.sum(R.centi("horas")) / F.lit(100.0), 0), F.lit(0.0))
                   .cast("long").alias("horas_totales"))
    dims = m.dim_cohortes.agg(F.count("*").alias("cohortes"))
    courses = m.dim_cursos.agg(F.count("*").alias("cursos"),
                               F.count_if(F.col("es_certificacion")).alias("cursos_certificacion"))
    ins = m.f_inscripciones.agg(F.count("*").alias("inscripciones"))
    ses = m.snap["attendance_sessions"].agg(F.count("*").alias("sesiones"))
    return one_row([users, cert, hours, dims, courses, ins, ses])


# A10 --------------------------------------------------------------------------
def top_partners(m: Model, n: int = 10) -> DataFrame:
    agg = m.f_certificaciones.groupBy("partner").agg(F.count_if("aprobado").alias("aprobados"),
                                                     F.count("*").alias("total"))
    top = agg.orderBy(F.col("aprobados").desc(), F.col("partner").asc_nulls_last()).limit(n)
    return top.select("partner", "aprobados", "total", R.pct1("aprobados", "total").alias("tasa"))


# A11 --------------------------------------------------------------------------
def category_pass_rate(m: Model) -> DataFrame:
    fc = m.f_certificaciones.join(m.dim_cursos.select("course_id", "categoria"), "course_id")
    agg = distinct_users(fc, ["categoria"], "aprobado")
    return agg.select("categoria", "alumnos", "aprobados", R.pct1("aprobados", "alumnos").alias("tasa"))


# A12 / J23 --------------------------------------------------------------------
def annual_evolution(m: Model) -> DataFrame:
    """Passes and hours per year; years from either side, zero-filled.

    A null year is a group of its own (D7), merged across both sides.
    """
    cert = m.f_certificaciones.groupBy(R.year_key("fecha_nota").alias("anio")).agg(
        F.count_if("aprobado").alias("aprobados"))
    horas = m.f_dedicacion.groupBy(F.substring("mes", 1, 4).alias("anio")).agg(
        F.round(F.sum(R.centi("horas")) / F.lit(100.0), 0).cast("long").alias("horas"))
    u = cert.unionByName(horas, allowMissingColumns=True)
    return u.groupBy("anio").agg(F.coalesce(F.max("aprobados"), F.lit(0)).alias("aprobados"),
                                 F.coalesce(F.max("horas"), F.lit(0)).alias("horas"))


# B33 --------------------------------------------------------------------------
def partner_kpi(m: Model, partner: str) -> DataFrame:
    """Users of one partner: one row, 0 when the partner is unknown."""
    got = m.f_usuarios.where(F.col("partner") == F.lit(partner))
    # a global aggregate always yields one row (0 for an unknown partner)
    return got.agg(F.count("*").alias("users")).select(F.lit(partner).alias("partner"), "users")

"""Snapshot profile, business alerts and thresholds.

Metrics are one-row aggregates per dataset combined without joins; alerts
and threshold rules are rows produced from that single row (``stack``), so
rule lists are data, not driver-side code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import rules as R
from cohortlens.operators.reports import one_row
from cohortlens.sources.snapshot import Snapshot


def _partner(rules: R.Rules) -> F.Column:
    return R.partner("email", "username", rules.house_org)


def users_profile(snap: Snapshot, rules: R.Rules) -> DataFrame:
    """Partners by users, top 15 (ties by name)."""
    u = snap["users"]
    agg = u.groupBy(_partner(rules).alias("partner")).agg(F.count("*").alias("n_usuarios"))
    return agg.orderBy(F.col("n_usuarios").desc(), F.col("partner").asc_nulls_last()).limit(15)


def cohort_category_profile(snap: Snapshot, rules: R.Rules) -> DataFrame:
    return snap["cohorts"].groupBy(R.category("name", rules).alias("categoria")).agg(F.count("*").alias("n"))


def cohort_version_profile(snap: Snapshot, rules: R.Rules) -> DataFrame:
    v = F.coalesce(R.version("name", rules.version_regex), F.lit(R.NO_VERSION_LABEL))
    return snap["cohorts"].groupBy(v.alias("version")).agg(F.count("*").alias("n"))


def course_category_profile(snap: Snapshot, rules: R.Rules) -> DataFrame:
    return snap["courses"].groupBy(R.category("fullname", rules).alias("categoria")).agg(F.count("*").alias("n"))


def grades_profile(snap: Snapshot, rules: R.Rules) -> DataFrame:
    g = snap["user_grades"].where(F.col("graderaw").isNotNull())
    return g.groupBy(R.passed("graderaw", rules.pass_mark).alias("aprobado")).agg(F.count("*").alias("n"))


def recent_joins(snap: Snapshot, months: int = 6) -> DataFrame:
    """Memberships per month, latest N months."""
    cm = snap["cohort_members_ext"].where(F.col("timeadded").isNotNull())
    agg = cm.groupBy(R.month_key(R.epoch_ts("timeadded")).alias("mes")).agg(F.count("*").alias("altas"))
    return agg.orderBy(F.col("mes").desc()).limit(months)


def no_partner_count(snap: Snapshot, rules: R.Rules) -> DataFrame:
    """Users that are not house org and have no '-' in the username."""
    u = snap["users"]
    cond = ~R.is_house("email", "username", rules.house_org) & ~F.col("username").contains("-")
    return u.agg(F.count_if(cond).alias("usuarios_sin_partner"))


def snapshot_counts(snap: Snapshot, rules: R.Rules) -> DataFrame:
    """Basic counts (0 when absent) and distinct partners."""
    u = snap["users"]
    parts = [
        u.agg(F.count("*").alias("total_users"), F.count_distinct(_partner(rules)).alias("n_partners")),
        snap["courses"].agg(F.count("*").alias("total_courses")),
        snap["cohorts"].agg(F.count("*").alias("total_cohorts")),
        snap["user_grades"].agg(F.count("*").alias("total_user_grades")),
    ]
    return one_row(parts)


def profile_kpis(snap: Snapshot, rules: R.Rules) -> DataFrame:
    """A18 headline numbers in one row."""
    u, co, cu = snap["users"], snap["cohorts"], snap["courses"]
    src = "cohort_members_ext" if snap.has("cohort_members_ext") else "cohort_members"
    cm = snap[src]
    g = snap["user_grades"]
    parts = [
        u.agg(F.count("*").alias("total_users"), F.count_distinct(_partner(rules)).alias("n_partners"),
              F.count_if(R.active_lenient("suspended")).alias("usuarios_activos")),
        co.agg(F.count("*").alias("total_cohorts")),
        cu.agg(F.count("*").alias("total_courses"),
               F.count_if(R.is_certification("fullname", rules.cert_patterns)).alias("cursos_certificacion")),
        cm.agg(F.count("*").alias("total_inscripciones"), F.count_distinct("userid").alias("usuarios_inscritos"),
               F.count_distinct("cohortid").alias("cohortes_inscritas")),
        g.agg(F.count("*").alias("total_grades"),
              F.count_if(F.col("graderaw") >= F.lit(float(rules.pass_mark))).alias("certificaciones_aprobadas")),
    ]
    return one_row(parts)


def business_alerts(snap: Snapshot, rules: R.Rules, partner_meta: DataFrame | None = None) -> DataFrame:
    """Q4: every rule with its value and whether it fires (filter ``disparada`` for the alert list)."""
    k = one_row([profile_kpis(snap, rules), no_partner_count(snap, rules)] + (
        [partner_meta.groupBy("partner").count().agg(F.count_if(F.col("count") > 1).alias("meta_duplicados"))]
        if partner_meta is not None else []))
    checks = [
        ("sin_usuarios", "total_users", F.col("total_users") == 0),
        ("sin_partners", "n_partners", F.col("n_partners") == 0),
        ("sin_cursos", "total_courses", F.col("total_courses") == 0),
        ("sin_cursos_certificacion", "cursos_certificacion",
         (F.col("cursos_certificacion") == 0) & (F.col("total_courses") > 0)),
        ("sin_cohortes", "total_cohorts", F.col("total_cohorts") == 0),
        ("usuarios_sin_partner", "usuarios_sin_partner", F.col("usuarios_sin_partner") > 0),
    ]
    if partner_meta is not None:
        checks.append(("partner_meta_duplicado", "meta_duplicados", F.col("meta_duplicados") > 0))
    rows = F.array(*[F.struct(F.lit(name).alias("alerta"), F.col(v).cast("long").alias("valor"),
                              cond.alias("disparada")) for name, v, cond in checks])
    return k.select(F.inline(rows))


def threshold_checks(snap: Snapshot, rules: R.Rules) -> DataFrame:
    """Q5: declared thresholds, enforced as rules."""
    k = profile_kpis(snap, rules)
    present = float(sum(1 for d in rules.expected_datasets if snap.has(d)))
    ratio = F.col("certificaciones_aprobadas").cast("double") / F.nullif(F.col("usuarios_activos").cast("double"),
                                                                         F.lit(0.0))
    checks = [
        ("min_users", F.col("total_users").cast("double"), F.lit(float(rules.min_users)),
         F.col("total_users") >= rules.min_users),
        ("min_partners", F.col("n_partners").cast("double"), F.lit(float(rules.min_partners)),
         F.col("n_partners") >= rules.min_partners),
        ("max_cert_ratio", ratio, F.lit(float(rules.max_cert_ratio)),
         F.coalesce(ratio <= F.lit(float(rules.max_cert_ratio)), F.lit(True))),
        ("expected_datasets", F.lit(present), F.lit(float(len(rules.expected_datasets))),
         F.lit(present >= len(rules.expected_datasets))),
    ]
    rows = F.array(*[F.struct(F.lit(n).alias("regla"), v.alias("valor"), t.alias("umbral"), ok.alias("ok"))
                     for n, v, t, ok in checks])
    return k.select(F.inline(rows))


def dataset_counts(snap: Snapshot, datasets) -> DataFrame:
    """Row count per dataset; null when the dataset is absent."""
    parts = []
    for ds in datasets:
        if snap.has(ds):
            parts.append(snap[ds].agg(F.count("*").alias("n")).select(F.lit(ds).alias("dataset"), "n"))
        else:
            parts.append(snap.spark.range(1).select(F.lit(ds).alias("dataset"), F.lit(None).cast("long").alias("n")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def compare_snapshots(base: Snapshot, target: Snapshot, datasets) -> DataFrame:
    """Base count, target count, delta (null when either side is absent)."""
    b = dataset_counts(base, datasets).withColumnRenamed("n", "base")
    t = dataset_counts(target, datasets).withColumnRenamed("n", "target")
    return b.join(t, "dataset").select("dataset", "base", "target", (F.col("target") - F.col("base")).alias("delta"))


def row_hash(df: DataFrame) -> Column:
    """52 bits of the MD5 of a row's columns as text, as a long; what a second engine can state too.

    A value is written as ``=`` and its text, a null as ``-``, joined by ``|``;
    fractions are written with six decimals.
    """
    def text(f):
        c = F.col(f"`{f.name}`")
        return F.coalesce(F.concat(F.lit("="), (c.cast("decimal(38,6)") if f.dataType.typeName() in ("double", "float") else c).cast("string")), F.lit("-"))
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[text(f) for f in df.schema.fields])), 1, 13), 16, 10).cast("long")


def multiset(h: Column) -> list[Column]:
    """Aggregates of row hashes that do not depend on order: count, xor, sum. The xor alone is blind to pairs of equal rows."""
    return [F.count("*").alias("rows"), F.coalesce(F.bit_xor(h), F.lit(0)).alias("fingerprint"),
            F.coalesce(F.sum(h.cast("decimal(38,0)")).cast("string"), F.lit("0")).alias("hash_sum")]


def fingerprint(df: DataFrame) -> DataFrame:
    """Q2 (re-aimed): order-insensitive content fingerprint, one pass, partial aggregates only."""
    return df.agg(*multiset(row_hash(df)))


def snapshot_fingerprints(snap: Snapshot, datasets) -> DataFrame:
    parts = [fingerprint(snap[d]).select(F.lit(d).alias("dataset"), "*") for d in datasets if snap.has(d)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

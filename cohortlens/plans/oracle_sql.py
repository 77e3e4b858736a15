"""Oracle SQL per query key (DuckDB dialect); see ``plans.oracle`` for the CTEs."""

from __future__ import annotations

from cohortlens.schemas import SCHEMAS, SNAPSHOT_DATASETS
from cohortlens.plans.oracle import (CENTI, EPOCH, HOURS2, HOUSE, PCT1, TS, category_sql, cert_sql, language_sql,
                                     partner_sql, version_sql, with_ctes)

ALTAS_YEARS = ["1995", "1996", "1997", "1998", "1999", "2000", "2001"]
HORAS_YEARS = ["2024"]

SQL: dict = {}


def sql(name: str, body: str, extra: dict | None = None):
    SQL[name] = with_ctes(body, extra)


sql("partner_rule", f"""select id, username, email, {partner_sql()} as partner,
 {partner_sql(check_username=False)} as partner_email_only from tr_users""")

sql("category_rule", f"""select id, {category_sql('fullname')} as categoria, {version_sql('fullname')} as version,
 {language_sql('fullname')} as idioma, {cert_sql('fullname')} as es_certificacion,
 (lower(fullname) LIKE '%certificación%' OR lower(fullname) LIKE '%certification%') as es_certificacion_estricta
 from tr_courses""")

for key, view in [("dim_partners", "dim_partners"), ("dim_cohorts", "dim_cohortes"), ("dim_courses", "dim_cursos"),
                  ("fact_users", "f_usuarios"), ("fact_enrolments", "f_inscripciones"),
                  ("fact_certifications", "f_certificaciones"), ("fact_activity", "f_actividad"),
                  ("fact_hours", "f_dedicacion")]:
    sql(key, f"select * from {view}")

sql("users_per_partner", "select partner, count(*) as users from f_usuarios group by partner")


def _per_year(years, kind: str, value: str, name: str) -> str:
    return "".join(f", {value} filter (kind = '{kind}' and year = '{y}') as {name}_{y}" for y in years)


def _summary(house_only: bool, altas_years, horas_years) -> str:
    """One pass over the marks of a partner: every fact row is a mark of some kind."""
    own = f"lower(partner) = '{HOUSE}'" if house_only else "true"
    cents = CENTI("horas")
    years = "".join(f", altas_{y}" for y in altas_years) + "".join(f", coalesce(cents_{y}, 0) / 100.0::DOUBLE as horas_{y}" for y in horas_years)
    return f"""
with marks as (
  select partner, 'joined' as kind, userid as who, strftime(fecha_alta, '%Y') as year, 0 as cents, ultimo_acceso as seen from f_usuarios
  union all select org, 'member', id, null, 0, null from accounts where id in (select userid from tr_cohort_members_ext)
  union all select partner, 'passed', userid, null, 0, null from f_certificaciones where aprobado
  union all select partner, 'hours', null, left(mes, 4), {cents}, null from f_dedicacion),
tally as (
  select partner, count(distinct who) filter (kind = 'joined') as total_altas, max(seen) as ultimo_acceso,
   count(distinct who) filter (kind = 'member') as total_inscritos, count(distinct who) filter (kind = 'passed') as total_certificados,
   coalesce(sum(cents), 0) / 100.0::DOUBLE as total_horas{_per_year(altas_years, 'joined', 'count(distinct who)', 'altas')}{_per_year(horas_years, 'hours', 'sum(cents)', 'cents')}
  from marks where {own} group by partner having bool_or(kind = 'joined'))
select t.partner, d.tipo, d.region, d.trajo_oportunidades, d.trajo_clientes, d.paga_certificacion, d.total_pagado,
 total_altas, total_inscritos, total_certificados, total_horas, ultimo_acceso{years}
from tally t left join dim_partners d on d.partner is not distinct from t.partner"""


def pivot_sqls(altas_years, horas_years, house_altas_years) -> dict:
    """The year-pivot statements for a given set of data years (columns are discovered from data)."""
    out = {
        "partner_summary": _summary(False, altas_years, horas_years),
        "partner_filtered_summary": _summary(True, house_altas_years, horas_years),
        "users_by_year_pivot": "select partner" + "".join(f", count_if(joined = '{y}') as altas_{y}" for y in altas_years)
        + " from (select partner, userid, strftime(fecha_alta, '%Y') as joined from f_usuarios group by all) group by partner",
        "hours_by_year_pivot": "select partner" + "".join(
            f", sum(case when left(mes, 4) = '{y}' then {CENTI('horas')} else 0 end) / 100.0::DOUBLE as horas_{y}"
            for y in horas_years) + " from f_dedicacion group by partner",
    }
    return {k: with_ctes(v) for k, v in out.items()}


# Years present in the sf0.01 test tables.
HOUSE_ALTAS_YEARS = ["1995", "1996", "2001"]
SQL.update(pivot_sqls(ALTAS_YEARS, HORAS_YEARS, HOUSE_ALTAS_YEARS))

def _years(year: str, rows: str) -> str:
    return f"select unnest(list_sort(list_distinct(list({year})))) from {rows}"


_JOINED = "strftime(fecha_alta, '%Y')"
YEAR_DISCOVERY = {"altas": _years(_JOINED, "f_usuarios"), "horas": _years("left(mes, 4)", "f_dedicacion"),
                  "house": _years(f"case when lower(partner) = '{HOUSE}' then {_JOINED} end", "f_usuarios")}


def discovered_pivot_sqls(con) -> dict:
    """Pivot statements with the years of whatever tables ``con`` has registered (tests on other scales)."""
    ys = {k: [r[0] for r in con.execute(with_ctes(v)).fetchall()] for k, v in YEAR_DISCOVERY.items()}
    return pivot_sqls(ys["altas"], ys["horas"], ys["house"])


_EVENTS = f"""
  select partner, strftime(fecha_alta, '%Y-%m') as mes, 'joined' as kind, userid as who, false as ok, 0 as cents from f_usuarios
  union all select partner, mes_inscripcion, 'member', userid, false, 0 from f_inscripciones
  union all select partner, strftime(fecha_nota, '%Y-%m'), 'graded', userid, aprobado, 0 from f_certificaciones
  union all select partner, mes, 'hours', userid, false, {CENTI('horas')} from f_dedicacion"""
# A kind without a mark in the month stays null.
sql("monthly_evolution", f"""
select partner, mes, nullif(count(*) filter (kind = 'joined'), 0) as altas, nullif(count(distinct who) filter (kind = 'member'), 0) as inscritos,
 case when bool_or(kind = 'graded') then count(distinct who) filter (ok) end as certificados,
 sum(cents) filter (kind = 'hours') / 100.0::DOUBLE as horas, nullif(count(distinct who) filter (kind = 'hours'), 0) as usuarios_activos
from ({_EVENTS}) group by partner, mes""")

# Students are counted after each one's grades of a group are folded into "has passed".
_GRADED = "(select c.partner, c.userid, c.aprobado, k.* from f_certificaciones c, dim_cursos k where k.course_id = c.course_id)"
for _name, _cols, _cond in [("partner_category", "partner, categoria", "true"),
                            ("partner_version", "partner, version, categoria, course_name", "version is not null")]:
    sql(_name, f"""select {_cols}, count(*) as alumnos, count_if(passed) as aprobados
 from (select {_cols}, userid, bool_or(aprobado) as passed from {_GRADED} where {_cond} group by all) group by all""")

sql("certified_detail", """
select userid, username, nombre_completo, email, partner, course_name, categoria, version, idioma, finalgrade, aprobado, fecha_nota
from f_usuarios join (select userid, course_id, finalgrade, aprobado, fecha_nota from f_certificaciones where aprobado) using (userid)
join dim_cursos using (course_id)""")

sql("inactive_partners", """
select partner, seen::DATE as ultimo_acceso, (DATE '2001-08-28' - seen::DATE)::BIGINT as dias_sin_actividad
from (select partner, ultimo_acceso as seen, row_number() over (partition by partner order by ultimo_acceso desc) as nth
      from f_usuarios where ultimo_acceso is not null)
where nth = 1 and seen + INTERVAL 30 DAY < TIMESTAMP '2001-08-28'""")

sql("global_kpis", f"""
select (select count(distinct partner) from f_usuarios) as partners,
 (select count(*) from f_usuarios) as usuarios_totales,
 (select count(*) from f_usuarios where activo) as usuarios_activos,
 (select count(*) from f_certificaciones) as total_certificaciones,
 (select count(*) from f_certificaciones where aprobado) as aprobados,
 (select coalesce({PCT1('count(*) filter (where aprobado)', 'count(*)')}, 0.0::DOUBLE) from f_certificaciones) as tasa_aprobacion,
 (select cast(coalesce(round(sum({CENTI('horas')}) / 100.0::DOUBLE), 0) as bigint) from f_dedicacion) as horas_totales,
 (select count(*) from dim_cohortes) as cohortes,
 (select count(*) from dim_cursos) as cursos,
 (select count(*) from dim_cursos where es_certificacion) as cursos_certificacion,
 (select count(*) from f_inscripciones) as inscripciones,
 (select count(*) from tr_attendance_sessions) as sesiones""")

sql("top_partners", f"""
with tally as (select partner, sum(aprobado::INT)::BIGINT as aprobados, count(*) as total from f_certificaciones group by partner)
select *, {PCT1('aprobados', 'total')} as tasa from tally
where (aprobados, coalesce(partner, '')) in (
  select (aprobados, coalesce(partner, '')) from tally qualify row_number() over (order by -aprobados, partner nulls last) <= 10)""")

sql("category_pass_rate", f"""
select categoria, count(*) as alumnos, count_if(passed) as aprobados, {PCT1('count_if(passed)', 'count(*)')} as tasa
from (select categoria, userid, bool_or(aprobado) as passed from {_GRADED} group by all) group by categoria""")

sql("annual_evolution", f"""
with c as (select strftime(fecha_nota, '%Y') as anio, count(*) filter (where aprobado) as aprobados from f_certificaciones group by 1),
h as (select left(mes, 4) as anio, cast(round(sum({CENTI('horas')}) / 100.0::DOUBLE) as bigint) as horas from f_dedicacion group by 1)
select coalesce(c.anio, h.anio) as anio, coalesce(c.aprobados, 0) as aprobados, coalesce(h.horas, 0) as horas
from c full outer join h on c.anio is not distinct from h.anio""")


# --- compliance ------------------------------------------------------------------
COMPLIANCE = {
    "chosen": "select id, fullname from tr_courses where contains(lower(fullname), 'governance')",
    "staff": f"select * from tr_users where contains(lower(email), '{HOUSE}') or contains(lower(username), '{HOUSE}')",
    "pairs": """select userid, courseid from (from tr_user_courses select userid, courseid union from tr_course_completions select userid, courseid)
 where courseid in (select id from chosen)""",
    "in_course": "select lower(email) as email, id as moodle_userid, username from staff where id in (select userid from pairs)",
    "done": f"""select lower(email) as email, min({TS('gradedategraded')}) filter (gradedategraded > 0) as fecha_completado, max(graderaw)::DOUBLE as nota
 from tr_user_grades, staff where staff.id = userid and graderaw is not null and courseid in (select id from chosen) group by 1""",
    "roster": "select * replace (lower(trim(email)) as email) from (select coalesce(COLUMNS(*), '') from tr_employees) where trim(email) <> ''",
    # The best state an e-mail has reached: 1 completed, 2 enrolled; 3 for neither.
    "reached": "select email, min(step) as step from (select email, 1 as step from done union all select email, 2 from in_course) group by email",
    "standing": """select nombre, apellidos, roster.email, rol, departamento, manager, coalesce(in_course.username, '') as username_moodle,
 ['completado', 'pendiente', 'sin_inscribir'][coalesce(step, 3)] as estado, fecha_completado, nota
 from roster left join reached using (email) left join in_course using (email) left join done using (email)""",
    "finished": f"""select userid, courseid, case when timecompleted > 0 then {TS('timecompleted')} end as fecha_completado
 from tr_course_completions where completed = 1""",
    "progress": """select s.*, chosen.fullname as curso, f.fecha_completado, f.userid is not null as completado
 from pairs p join staff s on s.id = p.userid join chosen on chosen.id = p.courseid left join finished f using (userid, courseid)""",
}

for _key, _from in [("enrolled_union", "pairs"), ("course_enrolled", "in_course"), ("course_completed", "done"), ("compliance_status", "standing")]:
    sql(_key, f"from {_from} select *", COMPLIANCE)
sql("compliance_not_enrolled", """select nombre, apellidos, email, rol, departamento, manager from roster
 where email not in (select email from reached)""", COMPLIANCE)
for _key, _col in [("compliance_by_group", "rol"), ("compliance_by_department", "departamento")]:
    sql(_key, f"""select *, {PCT1('completados', 'total')} as pct_completado from (
 select {_col}, count(*) as total, count_if(estado = 'completado') as completados, count_if(estado = 'pendiente') as pendientes,
 count_if(estado = 'sin_inscribir') as sin_inscribir from standing group by {_col})""", COMPLIANCE)
sql("status_share", f"""select estado, count(*) as empleados, {PCT1('count(*)', '(select count(*) from roster)')} as pct_total
 from standing group by estado""", COMPLIANCE)
sql("compliance_headline", f"""select *, coalesce({PCT1('completados', 'total_empleados')}, 0.0::DOUBLE) as tasa_completado from (
 select count_if(estado = 'completado') as completados, count_if(estado = 'pendiente') as pendientes,
 count_if(estado = 'sin_inscribir') as sin_inscribir, count(*) as total_empleados from standing)""", COMPLIANCE)
sql("compliance_headline_no_roster", f"""select *, coalesce({PCT1('completados', 'total_inscritos')}, 0.0::DOUBLE) as tasa_completado from (
 select count_if(email in (select email from done)) as completados, count_if(email not in (select email from done)) as pendientes, count(*) as total_inscritos
 from (select distinct email from in_course))""", COMPLIANCE)
sql("compliance_detail", """select id, username, email, firstname || ' ' || lastname as nombre_completo, curso, fecha_completado, completado,
 suspended = 0 as activo from progress""", COMPLIANCE)
sql("compliance_course_summary", f"""select *, {PCT1('completados', 'total_inscritos')} as pct_completado from (
 select curso, count(*) as total_inscritos, count_if(some_done) as completados, count_if(some_open) as pendientes
 from (select curso, id, bool_or(completado) as some_done, bool_or(not completado) as some_open from progress group by curso, id) group by curso)""", COMPLIANCE)


# --- legacy corpus ------------------------------------------------------------------
P2 = partner_sql(check_username=False)
_VERSIONS = "list_bool_or([contains(cohort_name, v) for v in ['14.1', '14.6', '14.8']])"
LEG = {
    "who": f"select id as userid, username, email, timecreated, suspended, {partner_sql()} as partner, {P2} as mail_partner from tr_users",
    "groups_": f"select id as cohortid, name as cohort_name, visible, {category_sql('name')} as cohort_group from tr_cohorts",
    # Cohorts of the listed versions; the second also needs a category of its own.
    "listed": f"select * from groups_ where {_VERSIONS}",
    "listed_categories": "select * from listed where cohort_group <> 'Otros'",
    "joined": "select cohortid, userid, min(timeadded) as timeadded, count(*) as times from tr_cohort_members_ext group by all",
    "marks": "select userid, courseid, graderaw as finalgrade, gradedategraded from tr_user_grades where graderaw is not null",
    "opened": "select cohortid, courseid, count(*) as times from tr_enrol_cohort_course group by all",
    # A pass counts for every cohort of the user that opens the course.
    "passes": """select m.userid, m.courseid, m.finalgrade, m.gradedategraded, cohortid, username, email, partner
 from marks m natural join who natural join joined natural join opened
 where finalgrade >= 60 and courseid in (select id from tr_courses)""",
    "tr_user_enrolments": f"select o_custkey as userid, l_partkey as courseid, {EPOCH('o_orderdate')} as timecreated from lineitem, orders where o_orderkey = l_orderkey",
    "active_members": f"""select mail_partner as partner, email, cohort_name, visible, {TS('timeadded')} as joined_at
 from who natural join tr_cohort_members_ext natural join groups_ where suspended = 0""",
}

sql("users_partner_cohort", """select partner, cohort_name, count(*) as total_altas
 from tr_cohort_members natural join who natural join groups_ group by all""", LEG)
sql("users_month_partner", f"""select strftime({TS('timecreated')}, '%Y-%m') as mes, partner, count(*) as total_altas
 from who group by all""", LEG)
sql("hours_month_partner", f"""select mes, partner, sum(h) as total_horas from who natural join (
 select userid, courseid, strftime({TS('login')}, '%Y-%m') as mes, round(sum(duration) / 3600.0::DOUBLE) as h from tr_attendance_sessions group by all)
 group by all""", LEG)
sql("active_month_partner", f"""select strftime({TS('login')}, '%Y-%m') as mes, partner, count(distinct userid) as usuarios_unicos
 from tr_attendance_sessions natural join (select userid, partner from who) group by all""", LEG)
sql("enrolments_month", """select partner, cohort_name as cohorte, strftime(joined_at, '%Y-%m') as mes, count(*) as num_apuntados
 from active_members where visible = 1 group by all""", LEG)
sql("enrolments_by_type", """select partner, strftime(joined_at, '%Y-%m') as mes,
 if(contains(lower(cohort_name), 'certificación'), 'Certificados', 'Training') as tipo, count(distinct email) as num_apuntados
 from active_members where visible = 1 and contains(cohort_name, '14.6') group by all""", LEG)
sql("cohort_month_crosstab", f"""
with counted as (select partner, cohort_name || '_' || strftime(joined_at, '%Y_%m') as cohorte_mes, count(*) as n from active_members group by all),
known as (select distinct cohort_name || '_' || strftime({TS('timeadded')}, '%Y_%m') as cohorte_mes
 from tr_cohort_members_ext natural join groups_ where userid in (select userid from who))
select partner, cohorte_mes, n from counted
union all select null, cohorte_mes, 0 from known where cohorte_mes is not null and cohorte_mes not in (select cohorte_mes from counted where cohorte_mes is not null)""", LEG)
sql("first_enrolment", "select userid, courseid, min(timecreated) as enrol_time_unix from tr_user_enrolments group by all", LEG)
sql("cumulative_dedication", f"""
with monthly as (
 select userid, courseid, date_trunc('month', {TS('login')}) as mes, sum(duration) as secs from tr_attendance_sessions group by all),
person as (
 select partner, cohort_name, mes, userid, bool_or(date_trunc('month', {TS('timecreated')}) = mes) as is_new, sum(secs) as secs
 from monthly natural join (select cohortid, courseid from tr_enrol_cohort_course) natural join (select cohortid, userid from tr_cohort_members)
 natural join groups_ natural join (select userid, partner, timecreated from who) group by all),
grid as (select partner, cohort_name, mes, count_if(is_new) as num_altas, sum(secs)::BIGINT as secs, count(*) as usuarios_unicos from person group by all),
upto as (
 select g.partner, g.cohort_name, g.mes, sum(e.num_altas)::BIGINT as a, sum(e.secs)::BIGINT as s, sum(e.usuarios_unicos)::BIGINT as u
 from grid g join grid e on e.partner is not distinct from g.partner and e.cohort_name = g.cohort_name and e.mes <= g.mes group by all)
select mes, partner, cohort_name, num_altas, secs / 3600.0::DOUBLE as horas_dedicadas, usuarios_unicos,
 a as acumulado_altas, s / 3600.0::DOUBLE as acumulado_horas, u as acumulado_usuarios
from grid join upto using (partner, cohort_name, mes)""", LEG)
for _name, _by, _in, _count in [("passes_by_cohort", "partner, cohort_name", "groups_", "total_aprobados"),
                                ("passes_by_category", "partner, cohort_group", "listed", "total_aprobados"),
                                ("certified_users", "partner", "listed_categories", "estudiantes_certificados")]:
    sql(_name, f"select {_by}, count(distinct userid) as {_count} from passes natural join {_in} group by all", LEG)
sql("passed_listing", f"""select userid, username, email, partner, cohort_name, cohort_group, finalgrade, {TS('gradedategraded')} as fecha_aprobado
 from passes natural join listed_categories""", LEG)
_LISTING = """(select userid, cohortid, courseid, fullname as course_name from (select cohortid, userid from joined) natural join (select cohortid, courseid from opened)
 join tr_courses c on c.id = courseid)"""
sql("student_grade_status", f"""
select userid, username, email, partner, cohort_name, cohort_group, courseid, course_name, finalgrade, {TS('gradedategraded')} as fecha_nota,
 if(finalgrade is null, 'Sin nota', if(finalgrade < 60, 'No aprobado', 'Aprobado')) as estado_aprobacion
from {_LISTING} natural join listed_categories natural join who left join marks using (userid, courseid)""", LEG)
SQL["student_grade_status_by_email"] = f"select * from ({SQL['student_grade_status']}) where contains(lower(email), 'house')"
sql("enrolled_approved", f"""
select partner, userid, cohort_name, cohort_group, courseid, course_name as course_fullname, (ok is not null)::INT as aprobado, ok.finalgrade,
 {TS('ok.gradedategraded')} as fecha_aprobado, {TS('greatest(who.timecreated, first_seen)')} as fecha_alta_o_matricula_mas_actual
from {_LISTING} natural join listed natural join who
left join (select userid, courseid, {{'finalgrade': finalgrade, 'gradedategraded': gradedategraded}} as ok from marks where finalgrade >= 60) using (userid, courseid)
left join (select userid, courseid, min(timecreated) as first_seen from tr_user_enrolments group by all) using (userid, courseid)""", LEG)
_SHOWN = "'%d/%m/%Y %H:%M'"
sql("users_cohorts", f"""select id, username as login, firstname || ' ' || lastname as nombre_completo, email,
 strftime({TS('timecreated')}, {_SHOWN}) as fecha_alta, strftime({TS('lastaccess')}, {_SHOWN}) as ultimo_acceso,
 {P2} as partner, cohort_name as cohorte, strftime({TS('timeadded')}, {_SHOWN}) as fecha_alta_cohorte
 from tr_users, tr_cohort_members_ext x, groups_
 where suspended = 0 and username[-length('-nation_7'):] = '-nation_7' and x.userid = id and x.cohortid = groups_.cohortid and contains(cohort_name, '14.6')""", LEG)


# --- practice sessions ------------------------------------------------------------------
def _rx(p: str) -> str:
    return f"nullif(regexp_extract(value, '{p}', 1), '')"


PATH_CERT = """case when lower(path) like '%governance%' then 'Governance' when lower(path) like '%intelligence%' then 'Intelligence'
 when lower(path) like '%discovery%' then 'Data Processing' when lower(path) like '%virtualizer%' then 'Data Processing'
 when lower(path) like '%rocket%' then 'Operaciones' when lower(path) like '%genai%' then 'AI' end"""
DMAP = "(CASE dom WHEN 'd0.example' THEN 'PartnerZero' WHEN 'd1.example' THEN 'partnerone' ELSE split_part(dom, '.', 1) END)"
SES = {
    "parsed0": f"""select pod, line_no,
 case when contains(value, '[AuthSuccess]') then 'login' when contains(value, '/oauth2/auth') and contains(value, ' 202 ') then 'activity'
      when contains(value, 'sign_out') then 'logout' end as kind,
 {_rx(r'^(\d+\.\d+\.\d+\.\d+):')} as ip, {_rx(r'\[(\d{4}/\d{2}/\d{2} \d{2}:\d{2}:\d{2})\]')} as ts_raw,
 {_rx(r'(\S+@\S+) \[\d{4}/\d{2}/\d{2}')} as email, {_rx(r'\btenant:(\w+)')} as tenant, {_rx(r'\buser:(\S+)')} as user_raw,
 {_rx(r'\bcreated:(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})')} as created, {_rx(r'\bgroups:\[([^\]]+)\]')} as groups_raw,
 {_rx(r'\b(?:GET|POST|PUT|PATCH|DELETE|HEAD|OPTIONS) (\S+)')} as path
 from tr_proxy_log""",
    "parsed": """select pod, line_no, kind, ip,
 coalesce(strftime(try_strptime(ts_raw, '%Y/%m/%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S'), ts_raw) as ts,
 email, tenant, coalesce(user_raw, split_part(email, '@', 1)) as "user", created,
 case when groups_raw is null then [] else list_filter(string_split_regex(trim(groups_raw), '\\s+'), lambda x: x <> '') end as groups,
 path, ts_raw,
 case when kind = 'login' then coalesce(email is not null and tenant is not null and created is not null and tenant in ('students'), false)
      else (ip is not null and ts_raw is not null) end as accepted
 from parsed0 where kind is not null""",
    "acc": "select * from parsed where accepted",
    "pod_sessions": """select pod, email, created, line_no as login_line, ip as src_ip, "user", tenant, groups, path from (
 select *, row_number() over (partition by pod, email, created order by line_no desc) as rn from acc where kind = 'login') where rn = 1""",
    "ptr": """select pod, ip, line_no, kind, ts,
 last_value(case when kind = 'login' then email end ignore nulls) over w as p_email,
 last_value(case when kind = 'login' then created end ignore nulls) over w as p_created
 from acc where (kind = 'login' and ip is not null) or kind = 'logout'
 window w as (partition by pod, ip order by line_no rows between unbounded preceding and current row)""",
    "so": """select pod, p_email as email, p_created as created, max(line_no) as out_line, arg_max(ts, line_no) as out_ts
 from ptr where kind = 'logout' and p_email is not null group by 1, 2, 3""",
    "act": "select pod, ip, max(ts) as last_activity from acc where kind = 'activity' group by 1, 2",
    "pod_docs": f"""select s.pod, s.email, s."user", s.tenant, s.created as fecha_inicio,
 case when so.out_line > s.login_line then so.out_ts
      else coalesce(strftime(try_strptime(s.created, '%Y-%m-%d %H:%M:%S') + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S'), s.created) end as fecha_fin,
 case when a.last_activity is not null then greatest(s.created, a.last_activity) else s.created end as last_seen,
 {PATH_CERT.replace('path', 's.path')} as certificacion, s.groups, s.login_line, so.out_line, so.out_ts
 from pod_sessions s left join so on so.pod = s.pod and so.email = s.email and so.created = s.created
 left join act a on a.pod = s.pod and a.ip = s.src_ip""",
    "docs": f"""select email, fecha_inicio, pod, "user", tenant, fecha_fin, last_seen, certificacion, groups, n_pods,
 {DMAP.replace('dom', "list_last(string_split(email, '@'))")} as partner from (
 select *, row_number() over (partition by email, fecha_inicio order by pod) as rn,
 count(*) over (partition by email, fecha_inicio) as n_pods from pod_docs) where rn = 1""",
    "ts_sessions": """select email, "user", partner, tenant, try_strptime(fecha_inicio, '%Y-%m-%d %H:%M:%S') as fecha_inicio,
 try_strptime(fecha_fin, '%Y-%m-%d %H:%M:%S') as fecha_fin, try_strptime(last_seen, '%Y-%m-%d %H:%M:%S') as last_seen,
 certificacion, groups from docs""",
    "det": f"""select partner, email, "user", tenant, fecha_inicio, fecha_fin, last_seen,
 case when try_strptime(last_seen, '%Y-%m-%d %H:%M:%S') is not null and try_strptime(fecha_inicio, '%Y-%m-%d %H:%M:%S') is not null
 then {HOURS2("greatest(epoch(try_strptime(last_seen, '%Y-%m-%d %H:%M:%S')) - epoch(try_strptime(fecha_inicio, '%Y-%m-%d %H:%M:%S')), 0)")} end as duracion_h
 from docs""",
}
sql("log_events", """select pod, line_no, kind, ip, ts, email, tenant, "user", created, array_to_string(groups, ' ') as groups, accepted
 from parsed""", SES)
sql("practice_sessions", """select email, "user", partner, tenant, fecha_inicio, fecha_fin, last_seen, certificacion,
 array_to_string(groups, ' ') as groups from ts_sessions""", SES)
sql("session_signout", """select s.pod, s.email, s.created as fecha_inicio, so.out_ts as fecha_fin
 from pod_sessions s join so on so.pod = s.pod and so.email = s.email and so.created = s.created where so.out_line > s.login_line""", SES)
sql("session_last_seen", "select * from act", SES)
sql("session_dedupe", "select email, fecha_inicio, pod, n_pods from docs", SES)
sql("practice_detail", "select * from det", SES)
sql("session_duration", "select email, fecha_inicio, duracion_h from det", SES)
sql("practice_summary", f"""select partner, count(*) as sesiones, count(distinct email) as alumnos,
 round(coalesce(sum({CENTI('duracion_h')}), 0)::DOUBLE / 10.0::DOUBLE) / 10.0::DOUBLE as horas_totales,
 coalesce(max(fecha_inicio), '') as ultima_sesion from det group by partner""", SES)
sql("sessions_histogram", "select date_trunc('day', fecha_inicio) as bucket, count(*) as sesiones from ts_sessions group by 1", SES)
sql("sessions_top_partners", """select partner, count(*) as sesiones from ts_sessions where partner is not null group by 1
 order by sesiones desc, partner asc limit 10""", SES)
sql("sessions_tenant", """select tenant, count(*) as sesiones from ts_sessions where tenant is not null group by 1
 order by sesiones desc, tenant asc limit 5""", SES)
sql("sessions_certification", """select coalesce(certificacion, 'Sin certificación detectada') as certificacion, count(*) as sesiones
 from ts_sessions group by 1 order by sesiones desc, certificacion asc limit 10""", SES)
sql("sessions_cardinality", """select partner, count(*) as sesiones, count(distinct email) as alumnos from ts_sessions
 where partner is not null group by 1 order by sesiones desc, partner asc limit 20""", SES)
sql("sessions_last_30d", """select email, partner, fecha_inicio from ts_sessions
 where fecha_inicio >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 30 DAY""", SES)
sql("email_domain_partner", f"""select email, dom as domain, {DMAP} as partner from (
 select distinct email, case when contains(email, '@') then list_last(string_split(email, '@')) else email end as dom
 from parsed where email is not null)""", SES)
sql("path_certification", f"select pod, line_no, path, {PATH_CERT} as certificacion from parsed0 where path is not null", SES)


sql("session_upsert", """select email, fecha_inicio, if(contains(email, '1@'), 'again', "user") as "user" from docs
 union all select distinct email, null, 'undated' from docs""", SES)
sql("snapshot_one_day", """select 'users' as dataset, true as present, count(*) as n from tr_users
 union all select 'courses', false, 0""")


# --- rule B9 ---------------------------------------------------------------------------
sql("approval_status", """select userid, courseid, graderaw,
 case when graderaw is null then 'Sin nota' when graderaw >= 60 then 'Aprobado' else 'No aprobado' end as estado_aprobacion,
 graderaw >= 70 as aprobado
 from (select userid, courseid, case when userid % 17 = 0 then null else graderaw end as graderaw from tr_user_grades)""")

# --- quality ------------------------------------------------------------------------------
PU = partner_sql()
sql("snapshot_counts", f"""select (select count(*) from tr_users) as total_users,
 (select count(distinct {PU}) from tr_users) as n_partners, (select count(*) from tr_courses) as total_courses,
 (select count(*) from tr_cohorts) as total_cohorts, (select count(*) from tr_user_grades) as total_user_grades""")
sql("profile_partners", f"""select {PU} as partner, count(*) as n_usuarios from tr_users group by 1
 order by n_usuarios desc, partner asc nulls last limit 15""")
sql("profile_cohort_category", f"select {category_sql('name')} as categoria, count(*) as n from tr_cohorts group by 1")
sql("profile_cohort_version", f"""select coalesce({version_sql('name')}, '(sin versión)') as version, count(*) as n
 from tr_cohorts group by 1""")
sql("profile_course_category", f"select {category_sql('fullname')} as categoria, count(*) as n from tr_courses group by 1")
sql("profile_grades", "select graderaw >= 70 as aprobado, count(*) as n from tr_user_grades where graderaw is not null group by 1")
KPIS = f"""select (select count(*) from tr_users) as total_users, (select count(distinct {PU}) from tr_users) as n_partners,
 (select count(*) from tr_users where suspended = 0 or suspended is null) as usuarios_activos,
 (select count(*) from tr_cohorts) as total_cohorts, (select count(*) from tr_courses) as total_courses,
 (select count(*) from tr_courses where {cert_sql('fullname')}) as cursos_certificacion,
 (select count(*) from tr_cohort_members_ext) as total_inscripciones,
 (select count(distinct userid) from tr_cohort_members_ext) as usuarios_inscritos,
 (select count(distinct cohortid) from tr_cohort_members_ext) as cohortes_inscritas,
 (select count(*) from tr_user_grades) as total_grades,
 (select count(*) from tr_user_grades where graderaw >= 70) as certificaciones_aprobadas"""
NOPART = f"""(select count(*) from tr_users where not (lower(email) like '%{HOUSE}%' or lower(username) like '%{HOUSE}%')
 and not contains(username, '-'))"""
sql("profile_kpis", KPIS)
sql("recent_joins", f"""select strftime({TS('timeadded')}, '%Y-%m') as mes, count(*) as altas from tr_cohort_members_ext
 where timeadded is not null group by 1 order by mes desc limit 6""")
sql("dq_no_partner", f"select {NOPART} as usuarios_sin_partner")
sql("business_alerts", f"""with k as ({KPIS}, {NOPART} as usuarios_sin_partner,
 (select count(*) from (select partner from tr_partner_meta group by partner having count(*) > 1)) as meta_duplicados)
select 'sin_usuarios' as alerta, total_users as valor, total_users = 0 as disparada from k
union all select 'sin_partners', n_partners, n_partners = 0 from k
union all select 'sin_cursos', total_courses, total_courses = 0 from k
union all select 'sin_cursos_certificacion', cursos_certificacion, cursos_certificacion = 0 and total_courses > 0 from k
union all select 'sin_cohortes', total_cohorts, total_cohorts = 0 from k
union all select 'usuarios_sin_partner', usuarios_sin_partner, usuarios_sin_partner > 0 from k
union all select 'partner_meta_duplicado', meta_duplicados, meta_duplicados > 0 from k""")
sql("threshold_checks", f"""with k as ({KPIS})
select 'min_users' as regla, total_users::DOUBLE as valor, 100.0::DOUBLE as umbral, total_users >= 100 as ok from k
union all select 'min_partners', n_partners::DOUBLE, 1.0::DOUBLE, n_partners >= 1 from k
union all select 'max_cert_ratio', certificaciones_aprobadas::DOUBLE / nullif(usuarios_activos::DOUBLE, 0.0::DOUBLE), 1.0::DOUBLE,
 coalesce(certificaciones_aprobadas::DOUBLE / nullif(usuarios_activos::DOUBLE, 0.0::DOUBLE) <= 1.0, true) from k
union all select 'expected_datasets', 10.0::DOUBLE, 10.0::DOUBLE, true from k""")
CUT = "cast(floor(epoch(TIMESTAMP '1999-01-01 00:00:00')) as bigint)"
sql("snapshot_compare", f"""
select dataset, base, target, target - base as delta from (
 select 'users' as dataset, (select count(*) from tr_users where timecreated < {CUT}) as base, (select count(*) from tr_users) as target
 union all select 'courses', (select count(*) from tr_courses), (select count(*) from tr_courses)
 union all select 'cohorts', (select count(*) from tr_cohorts), (select count(*) from tr_cohorts)
 union all select 'user_grades', (select count(*) from tr_user_grades where gradedategraded < {CUT}), (select count(*) from tr_user_grades)
 union all select 'attendance_sessions', cast(null as bigint), (select count(*) from tr_attendance_sessions))""")

# --- payload flattening and projections ----------------------------------------------------
sql("n1_cohort_members", "select cohortid, userid from tr_cohort_members")
sql("n2_user_courses", "select uc.userid, c.id as courseid, c.fullname from tr_user_courses uc join tr_courses c on c.id = uc.courseid")
sql("n3_grade_items", """select userid, courseid, courseid as itemid, 'course' as itemtype, cast(null as varchar) as itemname, graderaw,
 cast(null as varchar) as gradeformatted, cast(null as bigint) as gradedatesubmitted, gradedategraded
 from (select userid, courseid, case when userid % 17 = 0 then null else graderaw end as graderaw, gradedategraded from tr_user_grades)
 where graderaw is not null""")
sql("n4_completion_status", """select userid, courseid, coalesce(case when completed = 1 then true end, false) as completed, timecompleted
 from tr_course_completions""")
sql("n5_roster_users", """select id, username || '@' || (select min(courseid) from tr_user_courses where userid = id) as username, email, firstname, lastname
 from tr_users where id <> 0 and id in (select userid from tr_user_courses)""")
sql("n6_pair_keys", """select userid, coalesce(nullif(cid, 0), nullif(id, 0)) as courseid from (
 select userid, case when courseid % 7 = 0 then 0 else courseid end as cid, case when courseid % 11 = 0 then 0 else courseid end as id
 from tr_user_courses) where coalesce(nullif(cid, 0), nullif(id, 0)) is not null""")
sql("n7_source_fallback", "select cohortid, userid from tr_cohort_members_ext")
sql("n8_synth_cohorts", """select id, 'cohort_' || cast(id as varchar) as name, 1 as visible, true as fallback
 from (select distinct cohortid as id from tr_cohort_members where cohortid is not null)""")
sql("n9_pages", """select page, n_rows, page = max(page) over () as last_page,
 (page = max(page) over ()) or n_rows = 500 as ok from (
 select cast(floor((id - 1) / 500) as bigint) as page, count(*) as n_rows from tr_users group by 1)""")
sql("p1_cohort_members", """select cast(cohortid as varchar) || '_' || cast(userid as varchar) as id, cohortid, userid, timeadded
 from tr_cohort_members_ext""")
sql("p2_attendance_register", f"""select event_id as id, user_id as userid, ((event_id % 200) * 7) % 200 as courseid,
 {EPOCH('ts')} as login, cast(floor(value * 60) as bigint) as duration from events""")
ENROL = """(select p_partkey as id, case when p_partkey % 10 = 9 then 'manual' else 'cohort' end as enrol,
 case when p_partkey % 10 = 8 then null else p_partkey % 25 + 25 * (p_partkey // 2000) end as customint1, p_partkey as courseid,
 case when p_size > 45 then 1 else 0 end as status from part)"""
sql("p3_cohort_bridge", f"select id, customint1 as cohortid, courseid from {ENROL} where enrol = 'cohort' and customint1 is not null")
sql("p4_users", "select * from tr_users where id % 13 <> 0 and id > 1")
sql("p5_active_enrolments", f"""select distinct o.o_custkey as userid, e.courseid from lineitem l join orders o on o.o_orderkey = l.l_orderkey
 join {ENROL} e on e.id = l.l_partkey where l.l_linenumber <= 5 and l.l_linestatus = 'O' and e.status = 0""")
sql("p6_completions", """select userid, courseid, cast(coalesce(nullif(timecompleted, 0), 0) > 0 as integer) as completed,
 coalesce(nullif(timecompleted, 0), 0) as timecompleted from tr_course_completions""")
sql("p7_final_grades", """select g.userid, g.courseid, g.graderaw, g.gradedategraded from tr_user_grades g
 where g.userid % 17 <> 0 and g.courseid % 3 <> 0 and g.graderaw is not null""")

SQL["log_from_files"] = SQL["practice_sessions"]
sql("landed_json_pages", """
with p as (select floor((id - 1) / 20)::BIGINT as page, id from tr_users),
came as (select * from p where page % 10 <> 7 and not (page % 10 = 5 and id % 20 = 1)),
per as (select page, count(*) as n from came group by page)
select g.page, if(g.page % 10 = 3, 0, coalesce(n, 0))::BIGINT as n_rows,
 case when n is null then 'missing' when g.page % 10 = 3 then 'malformed' when n < 20 and g.page < last then 'short' else 'ok' end as status
from (select unnest(range(max(page) + 1)) as page, max(page) as last from came) g left join per on per.page = g.page""")
sql("source_classes", """select * from (values ('denied', 'bulk'), ('absent', 'standard')) v(outcome, source), (select 0::BIGINT as n, 0::BIGINT as cohorts)
 union all select 'answered', 'members', count(*), count(distinct cohortid) from tr_cohort_members_ext""")


def _row_hash(dataset: str) -> str:
    """52 bits of the MD5 of a row: every value as '=' and its text, fractions with six decimals, '-' for null."""
    # the derived grades have no id
    shown = ["'-'" if (dataset, f.name) == ("user_grades", "id") else f"coalesce('=' || {f'cast({f.name} as decimal(38,6))' if f.dataType.typeName() == 'double' else f.name}::VARCHAR, '-')" for f in SCHEMAS[dataset].fields]
    return f"('0x' || substr(md5(concat_ws('|', {', '.join(shown)})), 1, 13))::BIGINT"


def _multiset(dataset: str) -> str:
    return f"""select '{dataset}' as dataset, count(*) as rows, coalesce(bit_xor(h), 0) as fingerprint, coalesce(sum(h), 0)::VARCHAR as hash_sum
 from (select {_row_hash(dataset)} as h from tr_{dataset})"""


sql("snapshot_fingerprint", " union all ".join(_multiset(d) for d in SNAPSHOT_DATASETS))
sql("ingest_manifest", " union all ".join(f"""select dataset, '2024-05-01' as ingest_date, rows as rows_written, rows as rows_read, fingerprint, hash_sum, true as ok,
 rows as rows_loaded, true as same from ({_multiset(d)})""" for d in ("users", "cohort_members")))
sql("snapshot_inventory", " union all ".join(f"""select '{d}' as dataset, '{day}' as ingest_date, count(distinct id // 1000) as files,
 round(sum(length('{d}:' || id) + 1) / 1024.0::DOUBLE, 1) as size_kb from tr_{d} where {keep}"""
                                             for d in ("users", "courses") for day, keep in (("2024-05-01", "id % 3 > 0"), ("2024-05-02", "true"))))
sql("audit_tail", """select strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as ts, event_type as accion, event_id::VARCHAR as payload from events
 where event_id % 9 <> 0 order by events.ts desc, accion, payload limit 20""")
# The widths an automatic interval chooses from; the narrowest that needs at most 50 buckets.
sql("sessions_histogram_auto", """select make_timestamp(t // w * w * 1000000) as bucket, w as width_s, count(*) as sesiones
 from (select cast(floor(epoch(fecha_inicio)) as bigint) as t from ts_sessions where fecha_inicio is not null),
 (select coalesce(min(w) filter (hi // w - lo // w < 50), max(w)) as w
  from (values (60::BIGINT), (300), (600), (1800), (3600), (10800), (43200), (86400), (604800), (2592000)) v(w),
   (select min(cast(floor(epoch(fecha_inicio)) as bigint)) as lo, max(cast(floor(epoch(fecha_inicio)) as bigint)) as hi from ts_sessions))
 group by 1, 2""", SES)
sql("sessions_cardinality_sketch", """select partner, count(*) as sesiones, count(distinct email) as exact, true as within_3pct
 from ts_sessions where partner is not null group by 1""", SES)

SQL["practice_sessions_stream"] = SQL["practice_sessions"]
# Four line ranges land one after the other, one line in seven a range later; three days of watermark.
LATE = {**SES, "landed": """select a.*, (line_no - lo) // step + if(line_no % 7 = 3, 1, 0) as landing, try_strptime(ts, '%Y-%m-%d %H:%M:%S') as seen_at
 from parsed a, (select min(line_no) as lo, (max(line_no) - min(line_no)) // 4 + 1 as step from tr_proxy_log) where accepted""",
        "marks": """select l.landing, max(e.seen_at) - INTERVAL 3 DAY as mark from (select distinct landing from landed) l
 left join landed e on e.landing < l.landing group by 1""",
        "timed": "select l.*, coalesce(seen_at < mark, false) as late from landed l join marks using (landing)",
        "acc": "select * from timed where not late"}
LATE = {k: LATE[k] for k in ("parsed0", "parsed", "landed", "marks", "timed", "acc", *[k for k in SES if k not in ("parsed0", "parsed", "acc")])}
sql("practice_sessions_on_time", """select email, "user", partner, tenant, fecha_inicio, fecha_fin, last_seen, certificacion,
 array_to_string(groups, ' ') as groups from ts_sessions""", LATE)
sql("stream_late_lines", """select kind, count(*) as n, count(distinct (pod, ip)) as addresses, max(line_no) as last_line from timed where late group by 1""", LATE)
sql("partner_kpi", """select 'nation_3' as partner, coalesce((select count(*) from f_usuarios where partner = 'nation_3'), 0) as users""")

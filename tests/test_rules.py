"""Rule tables (B1-B27) evaluated as Spark Columns."""

import pytest
from pyspark.sql import functions as F

from cohortlens.functions import rules as R

# username, email, expected partner (house token "house")
PARTNER_CASES = [
    ("ann-acme", "ann@acme.example", "acme"),
    ("x-foo-corp", "x@corp.example", "corp"),
    ("annlee", "ann@acme.example", "annlee"),
    ("x-house", "x@other.example", "house"),
    ("x-partner", "x@house.example", "house"),
    ("x-partner", "x@HOUSE.EXAMPLE", "house"),
    ("x-HOUSE", "x@other.example", "house"),
    ("x-partner", "x@beta.house.example", "house"),
    ("house.admin", "x@other.example", "house"),
    ("user-", "x@other.example", ""),
    ("maría-acme", "m@acme.example", "acme"),
]


def test_partner_rule(spark):
    df = spark.createDataFrame(PARTNER_CASES, "username string, email string, expected string")
    got = df.select("expected", R.partner("email", "username", "house").alias("p")).collect()
    for r in got:
        assert r["p"] == r["expected"]



def test_partner_rule_email_only_values(spark):
    df = spark.createDataFrame([("house-acme", "x@other.example"), ("a-b", "a@house.example")], "username string, email string")
    got = [r[0] for r in df.select(R.partner("email", "username", "house", check_username=False)).collect()]
    assert got == ["acme", "house"]


@pytest.mark.parametrize("name,cat,ver,lang,cert", [
    ("Certification Governance 14.6 - ES", "Governance", "14.6", "ES", True),
    ("Certificación Data Processing 13.2", "Data Processing", "13.2", None, True),
    ("Training Intelligence - EN", "Intelligence", None, "EN", False),
    ("Training Operaciones 12.1 - es", "Operaciones", None, None, False),
    ("General 14.6.1", "Otros", "14.6", None, False),
])
def test_course_rules(spark, name, cat, ver, lang, cert):
    r = spark.range(1).select(F.lit(name).alias("n")).select(
        R.category("n").alias("c"), R.version("n").alias("v"), R.language("n").alias("l"),
        R.is_certification("n").alias("x")).first()
    assert (r.c, r.v, r.l, r.x) == (cat, ver, lang, cert)


def test_strict_certification(spark):
    r = spark.range(1).select(R.is_certification(F.lit("Certificacion sin acento"), R.CERT_PATTERNS_STRICT).alias("s"),
                              R.is_certification(F.lit("Certificacion sin acento")).alias("d")).first()
    assert (r.s, r.d) == (False, True)


def test_approval_and_pass(spark):
    df = spark.createDataFrame([(None,), (60.0,), (59.9,), (70.0,)], "g double")
    got = [tuple(r) for r in df.select(R.approval_status("g", 60), R.passed("g", 70)).collect()]
    assert got == [("Sin nota", None), ("Aprobado", False), ("No aprobado", False), ("Aprobado", True)]


def test_tri_state_and_lenient(spark):
    df = spark.createDataFrame([("true", "12.5"), ("false", "n/a"), ("", ""), (None, None)], "b string, n string")
    got = [tuple(r) for r in df.select(R.tri_bool("b"), R.true_else_false("b"), R.lenient_double("n")).collect()]
    assert got == [(True, True, 12.5), (False, False, None), (None, False, None), (None, False, None)]


def test_session_time_rules(spark):
    df = spark.createDataFrame([("2024-01-02 10:00:00", "2024-01-02 11:30:00", "2024/01/02 10:00:00"),
                                ("bad", "2024-01-02 11:30:00", "2024/13/40 99:00:00"),
                                ("2024-01-02 10:00:00", "2024-01-02 09:00:00", "x")], "a string, b string, t string")
    got = [tuple(r) for r in df.select(R.default_end("a"), R.session_hours("a", "b"), R.log_time("t")).collect()]
    assert got[0] == ("2024-01-02 10:30:00", 1.5, "2024-01-02 10:00:00")
    assert got[1] == ("bad", None, "2024/13/40 99:00:00")
    assert got[2] == ("2024-01-02 10:30:00", 0.0, "x")


def test_full_name_and_latest(spark):
    df = spark.createDataFrame([("a", "b", 5, None), ("a", None, 5, 9)], "f string, l string, x long, y long")
    got = [tuple(r) for r in df.select(R.full_name("f", "l"), F.unix_seconds(R.latest_epoch_ts("x", "y"))).collect()]
    assert got == [("a b", 5), (None, 9)]


def test_pct_and_hours(spark):
    r = spark.range(1).select(R.pct1(F.lit(1), F.lit(8)).alias("p"), R.pct1(F.lit(1), F.lit(0)).alias("z"),
                              R.hours2(F.lit(5400)).alias("h")).first()
    assert (r.p, r.z, r.h) == (12.5, None, 1.5)


def test_rules_json_roundtrip():
    r = R.Rules(house_org="house", allowed_tenants=("students",))
    assert R.Rules.from_json(r.to_json()) == r


def test_rules_from_the_yaml_form():
    text = """
partner:
  acme_patterns: ["%acme%"]
certification:
  pass_threshold: 65
  course_name_patterns: ["%exam%", "%certific%"]
categories:
  - {name: Cloud, pattern: "%cloud%"}
  - {name: Rest, pattern: null}
version: {regex: "(2[0-9])"}
language: {suffixes: {PT: " - PT"}}
validation: {min_users: 7, expected_datasets: [users]}
"""
    r = R.Rules.from_yaml(text, allowed_tenants=("t",))
    assert (r.house_org, r.pass_mark, r.cert_patterns) == ("acme", 65.0, ("exam", "certific"))
    assert (r.categories, r.category_default, r.version_regex) == ((("Cloud", "cloud"),), "Rest", "(2[0-9])")
    assert (r.languages, r.min_users, r.min_partners, r.expected_datasets, r.allowed_tenants) == ((("PT", " - PT"),), 7, R.MIN_PARTNERS, ("users",), ("t",))
    assert R.Rules.from_yaml("", house_org="x") == R.Rules(house_org="x")

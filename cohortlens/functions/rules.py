"""Business rules as Column builders and the rule set (Q7).

Each function returns a ``Column`` so the rule stays inside Catalyst and
whole-stage codegen; no Python UDF is involved.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, asdict
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's rules) ---------------------------
# Category: ordered first match of a lower-case substring of the name, else "Otros".
CATEGORY_RULES = (
    ("Governance", "governance"),
    ("Data Processing", "data processing"),
    ("Intelligence", "intelligence"),
    ("Operaciones", "operaciones"),
)
CATEGORY_DEFAULT = "Otros"
# Version: first match of this pattern, '' -> null.
VERSION_REGEX = r"(1[34]\.[0-9])"
# Language from a case-sensitive name suffix.
LANGUAGE_SUFFIXES = (("ES", " - ES"), ("EN", " - EN"), ("FR", " - FR"))
# Certification course: lower(name) contains one of these (rule-file form) ...
CERT_PATTERNS = ("certificaci", "certification")
# ... or, strict form, the accented word only.
CERT_PATTERNS_STRICT = ("certificación", "certification")
# Keyword found in a request path -> certification practised (ordered first match).
PATH_CERT_MAP = (
    ("governance", "Governance"),
    ("intelligence", "Intelligence"),
    ("discovery", "Data Processing"),
    ("virtualizer", "Data Processing"),
    ("rocket", "Operaciones"),
    ("genai", "AI"),
)
PASS_MARK = 70.0
PASS_MARK_LEGACY = 60.0
DEFAULT_SESSION_MINUTES = 30
MISSING_CERT_LABEL = "Sin certificación detectada"
NO_VERSION_LABEL = "(sin versión)"
# Validation thresholds of the rule file.
MIN_USERS = 100
MIN_PARTNERS = 1
MAX_CERT_RATIO = 1.0
EXPECTED_DATASETS = (
    "users", "courses", "cohorts", "cohort_members", "user_courses",
    "user_grades", "course_completions", "cohort_members_ext",
    "attendance_sessions", "enrol_cohort_course",
)
# -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rules:
    """Rule set as data (Q7). ``house_org`` is the in-house organisation token."""

    house_org: str
    pass_mark: float = PASS_MARK
    legacy_pass_mark: float = PASS_MARK_LEGACY
    categories: tuple = CATEGORY_RULES
    category_default: str = CATEGORY_DEFAULT
    version_regex: str = VERSION_REGEX
    languages: tuple = LANGUAGE_SUFFIXES
    cert_patterns: tuple = CERT_PATTERNS
    path_cert_map: tuple = PATH_CERT_MAP
    allowed_tenants: tuple = ()
    session_minutes: int = DEFAULT_SESSION_MINUTES
    min_users: int = MIN_USERS
    min_partners: int = MIN_PARTNERS
    max_cert_ratio: float = MAX_CERT_RATIO
    expected_datasets: tuple = EXPECTED_DATASETS

    @staticmethod
    def from_json(text: str) -> "Rules":
        d = json.loads(text)
        for k in ("categories", "languages", "path_cert_map"):
            if k in d:
                d[k] = tuple(tuple(x) for x in d[k])
        for k in ("cert_patterns", "allowed_tenants", "expected_datasets"):
            if k in d:
                d[k] = tuple(d[k])
        return Rules(**d)

    @staticmethod
    def from_yaml(text: str, **more) -> "Rules":
        """Q7: the rule file's own form; ``more`` overrides or adds fields it does not have.

        Patterns are LIKE patterns that match anywhere (``%text%``); the category
        without a pattern is the default. The list of the house organisation's
        patterns is the one under ``partner`` whose name ends with ``_patterns``.
        A section that is missing keeps the defaults.
        """
        import yaml  # only here: the rest of the library runs without it
        doc = yaml.safe_load(text) or {}
        part = lambda name: doc.get(name) or {}
        anywhere = lambda p: p.strip("%")
        out: dict = {}
        house = [p for k, v in part("partner").items() if k.endswith("_patterns") for p in v]
        if len({anywhere(p) for p in house}) > 1:
            raise ValueError("the rules know one house organisation")
        if house:
            out["house_org"] = anywhere(house[0])
        cert = part("certification")
        if "pass_threshold" in cert:
            out["pass_mark"] = float(cert["pass_threshold"])
        if "course_name_patterns" in cert:
            out["cert_patterns"] = tuple(anywhere(p) for p in cert["course_name_patterns"])
        categories = doc.get("categories") or []
        if categories:
            out["categories"] = tuple((c["name"], anywhere(c["pattern"])) for c in categories if c.get("pattern"))
            out["category_default"] = next((c["name"] for c in categories if not c.get("pattern")), CATEGORY_DEFAULT)
        if "regex" in part("version"):
            out["version_regex"] = part("version")["regex"]
        if "suffixes" in part("language"):
            out["languages"] = tuple(part("language")["suffixes"].items())
        checks = part("validation")
        out |= {k: checks[k] for k in ("min_users", "min_partners", "max_cert_ratio") if k in checks}
        if "expected_datasets" in checks:
            out["expected_datasets"] = tuple(checks["expected_datasets"])
        return Rules(**(out | more))

    def to_json(self) -> str:
        return json.dumps(asdict(self))


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# B1 / B2 -----------------------------------------------------------------------
def last_token(username) -> Column:
    """Text after the last '-' (whole string without '-'; '' after a trailing '-')."""
    return F.substring_index(_c(username), "-", -1)


def is_house(email, username, house_org: str, check_username: bool = True) -> Column:
    t = house_org.lower()
    cond = F.lower(_c(email)).contains(t)
    if check_username:
        cond = cond | F.lower(_c(username)).contains(t)
    return cond


def partner(email, username, house_org: str, check_username: bool = True) -> Column:
    """B1 partner rule (B2 with ``check_username=False``)."""
    return F.when(is_house(email, username, house_org, check_username), F.lit(house_org.lower())).otherwise(
        last_token(username)
    )


# B3-B7 -------------------------------------------------------------------------
def category(name, rules: Rules | None = None) -> Column:
    cats = rules.categories if rules else CATEGORY_RULES
    default = rules.category_default if rules else CATEGORY_DEFAULT
    low = F.lower(_c(name))
    expr = None
    for label, pat in cats:
        expr = (F.when(low.contains(pat), F.lit(label)) if expr is None
                else expr.when(low.contains(pat), F.lit(label)))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def version(name, regex: str = VERSION_REGEX) -> Column:
    return F.nullif(F.regexp_extract(_c(name), regex, 1), F.lit(""))


def language(name, suffixes=LANGUAGE_SUFFIXES) -> Column:
    expr = None
    for code, suf in suffixes:
        expr = (F.when(_c(name).endswith(suf), F.lit(code)) if expr is None
                else expr.when(_c(name).endswith(suf), F.lit(code)))
    return expr  # no .otherwise -> null


def is_certification(name, patterns=CERT_PATTERNS) -> Column:
    low = F.lower(_c(name))
    return reduce(or_, [low.contains(p) for p in patterns])


def cohort_type(name) -> Column:
    """Certification vs training cohort, case-insensitive."""
    return F.when(F.lower(_c(name)).contains("certificación"), F.lit("Certificados")).otherwise(F.lit("Training"))


# B8-B11 ------------------------------------------------------------------------
def passed(grade, mark: float = PASS_MARK) -> Column:
    return _c(grade) >= F.lit(float(mark))


def approval_status(grade, mark: float = PASS_MARK_LEGACY) -> Column:
    g = _c(grade)
    return (F.when(g.isNull(), F.lit("Sin nota"))
            .when(g >= F.lit(float(mark)), F.lit("Aprobado"))
            .otherwise(F.lit("No aprobado")))


def tri_bool(text) -> Column:
    """'true' -> True, 'false' -> False, else null (B10 first form)."""
    t = _c(text)
    return F.when(t == "true", F.lit(True)).when(t == "false", F.lit(False)).otherwise(F.lit(None).cast("boolean"))


def true_else_false(text) -> Column:
    return F.coalesce(_c(text) == "true", F.lit(False))


def lenient_double(text) -> Column:
    return F.nullif(_c(text), F.lit("")).try_cast("double")


# B12-B17, B28, B30-B32 ---------------------------------------------------------
def epoch_ts(epoch) -> Column:
    return F.timestamp_seconds(_c(epoch))


def month_key(ts) -> Column:
    return F.date_format(_c(ts), "yyyy-MM")


def year_key(ts) -> Column:
    return F.date_format(_c(ts), "yyyy")


def full_name(first, last) -> Column:
    return F.concat(_c(first), F.lit(" "), _c(last))


def active(suspended) -> Column:
    return _c(suspended) == 0


def active_lenient(suspended) -> Column:
    return (_c(suspended) == 0) | _c(suspended).isNull()


def latest_epoch_ts(a, b) -> Column:
    return F.timestamp_seconds(F.greatest(_c(a), F.coalesce(_c(b), F.lit(0))))


def display_ts(ts) -> Column:
    return F.date_format(_c(ts), "dd/MM/yyyy HH:mm")


def days_since(d, as_of: str) -> Column:
    return F.datediff(F.lit(as_of).cast("date"), _c(d)).cast("long")


def no_tz(ts) -> Column:
    return _c(ts).cast("timestamp_ntz")


# exact rounding helpers (same double result in every SQL dialect) --------------
def hours2(seconds) -> Column:
    """round(seconds/3600, 2) computed as round(seconds/36)/100 in doubles."""
    return F.round(_c(seconds).cast("double") / F.lit(36.0), 0) / F.lit(100.0)


def centi(hours) -> Column:
    """Hours with 2 decimals -> integer hundredths, so sums are exact."""
    return F.round(_c(hours) * F.lit(100.0), 0).cast("long")


def pct1(num, den) -> Column:
    """round(100*num/den, 1); null when den is 0 or null."""
    d = F.nullif(_c(den).cast("double"), F.lit(0.0))
    return F.round(F.lit(1000.0) * _c(num).cast("double") / d, 0) / F.lit(10.0)


# B22-B27 -----------------------------------------------------------------------
def email_domain(email) -> Column:
    e = _c(email)
    return F.when(e.contains("@"), F.substring_index(e, "@", -1)).otherwise(e)


def path_certification(path, cert_map=PATH_CERT_MAP) -> Column:
    low = F.lower(_c(path))
    expr = None
    for key, label in cert_map:
        expr = (F.when(low.contains(key), F.lit(label)) if expr is None
                else expr.when(low.contains(key), F.lit(label)))
    return expr


def default_end(created_text, minutes: int = DEFAULT_SESSION_MINUTES) -> Column:
    """created + N minutes as 'yyyy-MM-dd HH:mm:ss'; unparsable text is kept."""
    ts = F.try_to_timestamp(_c(created_text), F.lit("yyyy-MM-dd HH:mm:ss"))
    plus = F.date_format(ts + F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(minutes)),
                         "yyyy-MM-dd HH:mm:ss")
    return F.coalesce(plus, _c(created_text))


def session_hours(start_text, last_seen_text) -> Column:
    """max(last_seen - start, 0)/3600 rounded to 2; null when unparsable."""
    fmt = F.lit("yyyy-MM-dd HH:mm:ss")
    a = F.unix_timestamp(F.try_to_timestamp(_c(start_text), fmt))
    b = F.unix_timestamp(F.try_to_timestamp(_c(last_seen_text), fmt))
    diff = b - a  # null when either side is unparsable (greatest would turn it into 0)
    return F.when(diff.isNotNull(), hours2(F.greatest(diff, F.lit(0))))


def log_time(text) -> Column:
    """B27: 'YYYY/MM/DD HH:MM:SS' -> 'YYYY-MM-DD HH:MM:SS', unparsable kept."""
    ts = F.try_to_timestamp(_c(text), F.lit("yyyy/MM/dd HH:mm:ss"))
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), _c(text))


def any_contains(col, needles, case_insensitive: bool = True) -> Column:
    """OR of substring tests (literal match, no LIKE wildcards)."""
    c = F.lower(_c(col)) if case_insensitive else _c(col)
    return reduce(or_, [c.contains(n.lower() if case_insensitive else n) for n in needles])

"""Practice-lab sessions rebuilt from auth-proxy logs (SURVEY §2.7, L1-L4, J21, J22, W3;
dashboard aggregates A17, A29-A33; rules B22-B27).

The original is one sequential pass with three dictionaries. Here it is a set
computation, all built-in operators and no Python UDF:

* classify and parse every line with regexes (L1);
* a session is the *last* accepted login line of its (email, created) key in
  its pod (max_by, a partial aggregate);
* the "IP pointer" of a sign-out line is the key of the latest accepted login
  on the same pod and IP before it. It is a forward fill, computed as a
  segmented scan so that one IP holding a third of all lines is still split
  over many tasks: lines are cut into blocks of ``block_lines`` line numbers,
  each block fills forward inside itself (window over pod, ip, block) and
  takes a carry-in from the last login of the earlier blocks (window over the
  per-block summaries, one row per block);
* a sign-out closes a session only if it comes after that session's last
  login line (a repeated login resets the end): last sign-out per key, one
  partial aggregate, compared with the session's last login line;
* last activity is a whole-log max per (pod, ip) (J22);
* across pods, the first pod in pod order wins for a key (W3).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions import rules as R

# The line format of the proxy log and the time format of the session store.
RE_IP = r"^(\d+\.\d+\.\d+\.\d+):"
RE_TS = r"\[(\d{4}/\d{2}/\d{2} \d{2}:\d{2}:\d{2})\]"
RE_EMAIL = r"(\S+@\S+) \[\d{4}/\d{2}/\d{2}"
RE_TENANT = r"\btenant:(\w+)"
RE_USER = r"\buser:(\S+)"
RE_CREATED = r"\bcreated:(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})"
RE_GROUPS = r"\bgroups:\[([^\]]+)\]"
RE_PATH = r"\b(?:GET|POST|PUT|PATCH|DELETE|HEAD|OPTIONS) (\S+)"
TS_FMT = "yyyy-MM-dd HH:mm:ss"
DEFAULT_BLOCK_LINES = 1 << 20


def _x(pattern: str) -> Column:
    return F.nullif(F.regexp_extract("value", pattern, 1), F.lit(""))


# L1 ---------------------------------------------------------------------------
def parse_lines(log: DataFrame, rules: R.Rules) -> DataFrame:
    """Classify each line (first match wins) and extract its fields."""
    v = F.col("value")
    kind = (F.when(v.contains("[AuthSuccess]"), F.lit("login"))
            .when(v.contains("/oauth2/auth") & v.contains(" 202 "), F.lit("activity"))
            .when(v.contains("sign_out"), F.lit("logout")))
    p = log.select("pod", "line_no", kind.alias("kind"), _x(RE_IP).alias("ip"), _x(RE_TS).alias("ts_raw"),
                   _x(RE_EMAIL).alias("email"), _x(RE_TENANT).alias("tenant"), _x(RE_USER).alias("user_raw"),
                   _x(RE_CREATED).alias("created"), _x(RE_GROUPS).alias("groups_raw"), _x(RE_PATH).alias("path"))
    p = p.where(F.col("kind").isNotNull())
    tenants = list(rules.allowed_tenants)
    accepted = F.when(
        F.col("kind") == "login",
        F.col("email").isNotNull() & F.col("tenant").isNotNull() & F.col("created").isNotNull()
        & F.coalesce(F.col("tenant").isin(tenants) if tenants else F.lit(False), F.lit(False)),
    ).otherwise(F.col("ip").isNotNull() & F.col("ts_raw").isNotNull())
    groups = F.when(F.col("groups_raw").isNull(), F.array().cast("array<string>")).otherwise(
        F.filter(F.split(F.trim("groups_raw"), r"\s+"), lambda g: g != ""))
    return p.select(
        "pod", "line_no", "kind", "ip", R.log_time("ts_raw").alias("ts"), "email", "tenant",
        F.coalesce("user_raw", F.substring_index("email", "@", 1)).alias("user"),
        "created", groups.alias("groups"), "path", accepted.alias("accepted"))


def log_events(log: DataFrame, rules: R.Rules) -> DataFrame:
    p = parse_lines(log, rules)
    return p.select("pod", "line_no", "kind", "ip", "ts", "email", "tenant", "user", "created",
                    F.array_join("groups", " ").alias("groups"), "accepted")


# B22 --------------------------------------------------------------------------
def email_partner(email: Column, domain_map=None) -> Column | None:
    """Partner of an e-mail domain: mapped name, else the first label of the domain."""
    dom = R.email_domain(email)
    fallback = F.substring_index(dom, ".", 1)
    if isinstance(domain_map, dict) and domain_map:
        m = F.create_map(*[F.lit(x) for kv in sorted(domain_map.items()) for x in kv])
        return F.coalesce(F.element_at(m, dom), fallback)
    return fallback


def with_email_partner(df: DataFrame, email_col: str, domain_map=None, out: str = "partner") -> DataFrame:
    """B22 with the map as a DataFrame (domain, partner): a left join (AQE broadcasts a small map)."""
    if domain_map is None or isinstance(domain_map, dict):
        return df.withColumn(out, email_partner(F.col(email_col), domain_map))
    m = domain_map.select(F.col("domain").alias("_dom"), F.col("partner").alias("_mapped")).dropDuplicates(["_dom"])
    j = df.withColumn("_d", R.email_domain(F.col(email_col))).join(m, F.col("_d") == F.col("_dom"), "left")
    return j.withColumn(out, F.coalesce("_mapped", F.substring_index("_d", ".", 1))).drop("_d", "_dom", "_mapped")


class Sessionizer:
    def __init__(self, log: DataFrame, rules: R.Rules, domain_map=None, block_lines: int = DEFAULT_BLOCK_LINES,
                 pod_order: DataFrame | None = None, materialise: bool = False):
        """``materialise``: parse the log once. The accepted, classified lines
        (narrow rows, no raw text) are checkpointed to the shared checkpoint
        folder, so the four branches of the rebuild (sessions, sign-out
        pointers, activity, dedupe) do not each re-run the regexes over the
        raw log."""
        self.rules = rules
        self.domain_map = domain_map
        self.block = int(block_lines)
        self.lines = parse_lines(log, rules).where(F.col("accepted"))
        if materialise:
            from cohortlens.session import checkpoint_dir
            checkpoint_dir(log.sparkSession)
            self.lines = self.lines.checkpoint(eager=True)
        self.pod_order = pod_order  # (pod, pod_rank); default: pod name order

    # sessions per pod: last login line of each key --------------------------
    def pod_sessions(self) -> DataFrame:
        lg = self.lines.where(F.col("kind") == "login")
        last = F.max_by(F.struct("line_no", "ip", "user", "tenant", "groups", "path"), F.col("line_no"))
        s = lg.groupBy("pod", "email", "created").agg(last.alias("l"))
        return s.select("pod", "email", "created", F.col("l.line_no").alias("login_line"),
                        F.col("l.ip").alias("src_ip"), F.col("l.user").alias("user"), F.col("l.tenant").alias("tenant"),
                        F.col("l.groups").alias("groups"), F.col("l.path").alias("path"))

    # Pointer of each sign-out (segmented forward fill) --------------------
    def signout_pointers(self) -> DataFrame:
        return signout_pointers(self.lines, self.block)

    def signouts(self) -> DataFrame:
        """Per session key: the last sign-out that points to it (any IP), pre-aggregated."""
        return aggregate_signouts(self.signout_pointers())

    # J22 -----------------------------------------------------------------------
    def ip_last_seen(self) -> DataFrame:
        return activity_max(self.lines)

    # per-pod documents ---------------------------------------------------------
    def pod_documents(self) -> DataFrame:
        s = self.pod_sessions().join(self.signouts(), ["pod", "email", "created"], "left")
        return pod_documents(s, self.ip_last_seen(), self.rules)

    # W3 ------------------------------------------------------------------------
    def documents(self) -> DataFrame:
        """Deduplicated documents with text dates (first pod in pod order wins)."""
        return dedupe_documents(self.pod_documents(), self.domain_map, self.pod_order)

    def sessions(self) -> DataFrame:
        """K6 document: dates as timestamps (unparsable text -> null)."""
        return as_timestamps(self.documents())


def signout_pointers(lines: DataFrame, block: int) -> DataFrame:
    """Key of the latest accepted login on the same (pod, ip) before each sign-out line."""
    ev = lines.where(((F.col("kind") == "login") & F.col("ip").isNotNull()) | (F.col("kind") == "logout"))
    is_login = F.col("kind") == "login"
    key = F.when(is_login, F.struct("email", "created"))
    ev = ev.select("pod", "ip", "line_no", "kind", "ts", key.alias("key"),
                   F.floor(F.col("line_no") / F.lit(block)).alias("blk"))
    # per-block summary: the last login key of the block (null if none)
    summ = ev.groupBy("pod", "ip", "blk").agg(
        F.max_by(F.col("key"), F.when(F.col("key").isNotNull(), F.col("line_no"))).alias("blk_last"))
    wb = Window.partitionBy("pod", "ip").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    carry = summ.select("pod", "ip", "blk", F.last("blk_last", ignorenulls=True).over(wb).alias("carry"))
    wl = Window.partitionBy("pod", "ip", "blk").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    filled = ev.select("pod", "ip", "blk", "line_no", "kind", "ts",
                       F.last("key", ignorenulls=True).over(wl).alias("in_blk"))
    outs = filled.where(F.col("kind") == "logout").join(carry, ["pod", "ip", "blk"], "left")
    ptr = F.coalesce("in_blk", "carry")
    return outs.select("pod", "ip", "line_no", "ts", ptr.getField("email").alias("email"),
                       ptr.getField("created").alias("created")).where(F.col("email").isNotNull())


# Log times are text: 'YYYY-MM-DD HH:MM:SS', or the raw 'YYYY/MM/DD HH:MM:SS'
# when unparsable (B27). A max over text runs as a sort-based aggregate; the
# key below orders exactly as the text does (year, then the separator, '-'
# before '/', then the remaining digits), so max/max_by run on a long buffer
# (hash aggregate, no sort of the lines) and the text is rebuilt afterwards.
_TEN10 = 10 ** 10


def time_key(text) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    digits = F.concat(*[F.substring(t, p, 2) for p in (6, 9, 12, 15, 18)])
    slash = F.when(F.substring(t, 5, 1) == "/", 1).otherwise(0)
    return (F.substring(t, 1, 4).cast("long") * 2 + slash) * F.lit(_TEN10) + digits.cast("long")


def key_time(key) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    head = F.floor(k / F.lit(_TEN10))
    sep = F.when(head % 2 == 1, F.lit("/")).otherwise(F.lit("-"))
    rest = F.lpad((k % F.lit(_TEN10)).cast("string"), 10, "0")
    part = lambda i: F.substring(rest, i, 2)
    return F.when(k.isNotNull(), F.concat(
        F.lpad(F.floor(head / 2).cast("string"), 4, "0"), sep, part(1), sep, part(3), F.lit(" "),
        part(5), F.lit(":"), part(7), F.lit(":"), part(9)))


def aggregate_signouts(pointers: DataFrame) -> DataFrame:
    g = pointers.groupBy("pod", "email", "created").agg(F.max("line_no").alias("out_line"),
                                                        F.max_by(time_key("ts"), "line_no").alias("_k"))
    return g.select("pod", "email", "created", "out_line", key_time("_k").alias("out_ts"))


def activity_max(lines: DataFrame) -> DataFrame:
    a = lines.where(F.col("kind") == "activity")
    g = a.groupBy("pod", "ip").agg(F.max(time_key("ts")).alias("_k"))
    return g.select("pod", "ip", key_time("_k").alias("last_activity"))


def pod_documents(sessions: DataFrame, activity: DataFrame, rules: R.Rules) -> DataFrame:
    """Sessions (with their last sign-out) -> per-pod documents."""
    act = activity.withColumnRenamed("ip", "src_ip")
    j = sessions.join(act, ["pod", "src_ip"], "left")
    closed = F.col("out_line") > F.col("login_line")
    end = F.when(closed, F.col("out_ts")).otherwise(R.default_end("created", rules.session_minutes))
    last_seen = F.when(F.col("last_activity").isNotNull(), F.greatest("created", "last_activity")).otherwise(
        F.col("created"))
    return j.select("pod", "email", "user", "tenant", F.col("created").alias("fecha_inicio"),
                    end.alias("fecha_fin"), last_seen.alias("last_seen"),
                    R.path_certification("path", rules.path_cert_map).alias("certificacion"), "groups",
                    "login_line")


def dedupe_documents(docs: DataFrame, domain_map=None, pod_order: DataFrame | None = None) -> DataFrame:
    d = docs
    if pod_order is not None:
        d = d.join(pod_order, "pod", "left")
        rank = F.struct(F.col("pod_rank"), F.col("pod"))
    else:
        rank = F.col("pod")
    cols = ["pod", "user", "tenant", "fecha_fin", "last_seen", "certificacion", "groups"]
    w = d.groupBy("email", "fecha_inicio").agg(
        F.min_by(F.struct(*cols), rank).alias("d"), F.count("*").alias("n_pods"))
    out = w.select("email", "fecha_inicio", *[F.col(f"d.{c}").alias(c) for c in cols], "n_pods")
    return with_email_partner(out, "email", domain_map)


def as_timestamps(docs: DataFrame) -> DataFrame:
    ts = lambda c: F.try_to_timestamp(F.col(c), F.lit(TS_FMT)).alias(c)
    return docs.select("email", "user", "partner", "tenant", ts("fecha_inicio"), ts("fecha_fin"), ts("last_seen"),
                       "certificacion", "groups")


# L4, B26 ------------------------------------------------------------------------
def detail(docs: DataFrame) -> DataFrame:
    """Session table rows (text dates as stored) with hours, ordered by (partner, start)."""
    out = docs.select("partner", "email", "user", "tenant", "fecha_inicio", "fecha_fin", "last_seen",
                      R.session_hours("fecha_inicio", "last_seen").alias("duracion_h"))
    return out.orderBy("partner", "fecha_inicio", "email")


# A17 ------------------------------------------------------------------------------
def practice_summary(det: DataFrame) -> DataFrame:
    """Sessions, distinct students, hours (1 decimal; bad values ignored), latest start."""
    c = R.centi(F.col("duracion_h"))
    return det.groupBy("partner").agg(
        F.count("*").alias("sesiones"), F.count_distinct("email").alias("alumnos"),
        (F.round(F.coalesce(F.sum(c), F.lit(0)).cast("double") / F.lit(10.0), 0) / F.lit(10.0)).alias("horas_totales"),
        F.coalesce(F.max("fecha_inicio"), F.lit("")).alias("ultima_sesion"))


# A29-A33 ----------------------------------------------------------------------------
def histogram(sessions: DataFrame, unit: str = "day") -> DataFrame:
    return sessions.groupBy(F.date_trunc(unit, "fecha_inicio").alias("bucket")).agg(F.count("*").alias("sesiones"))


# Bucket widths of the automatic interval, in seconds: a minute to 30 days.
WIDTHS = (60, 300, 600, 1800, 3600, 10_800, 43_200, 86_400, 604_800, 2_592_000)


def histogram_auto(sessions: DataFrame, buckets: int = 50) -> DataFrame:
    """A29 with an automatic interval: the narrowest width that needs at most ``buckets`` buckets (the widest if none does).

    The width follows from the range inside the plan (scalar subqueries over
    partial aggregates); empty buckets are omitted. Buckets start at multiples
    of the width since the epoch.
    """
    at = sessions.select(F.unix_seconds("fecha_inicio").alias("t")).where("t is not null")
    low, high = at.agg(F.min("t")).scalar(), at.agg(F.max("t")).scalar()
    width = F.lit(WIDTHS[-1])
    for w in reversed(WIDTHS[:-1]):
        width = F.when(F.floor(high / w) - F.floor(low / w) < buckets, w).otherwise(width)
    sized = at.withColumn("width_s", width.cast("long"))
    return (sized.groupBy("width_s", (F.floor(F.col("t") / F.col("width_s")) * F.col("width_s")).alias("start")).agg(F.count("*").alias("sesiones"))
            .select(F.timestamp_seconds("start").alias("bucket"), "width_s", "sesiones"))


def top_terms(sessions: DataFrame, col: str, n: int, missing_label: str | None = None) -> DataFrame:
    term = F.col(col) if missing_label is None else F.coalesce(F.col(col), F.lit(missing_label))
    agg = sessions.where(term.isNotNull()).groupBy(term.alias(col)).agg(F.count("*").alias("sesiones"))
    return agg.orderBy(F.col("sesiones").desc(), F.col(col).asc()).limit(n)


def partner_cardinality(sessions: DataFrame, n: int = 20, approx: bool = False) -> DataFrame:
    distinct = (F.approx_count_distinct("email") if approx else F.count_distinct("email")).alias("alumnos")
    agg = sessions.where(F.col("partner").isNotNull()).groupBy("partner").agg(F.count("*").alias("sesiones"), distinct)
    return agg.orderBy(F.col("sesiones").desc(), F.col("partner").asc()).limit(n)


SKETCH_K = 14  # 2^14 registers: a standard error of 0.65 to 0.8 %, so 3 % holds beyond three of them


def student_sketches(sessions: DataFrame) -> DataFrame:
    """A32 as mergeable state: per day and partner the sessions and a HyperLogLog sketch of the e-mails.

    A day's rows are written once; any range of days is answered by merging
    sketches, without reading sessions again.
    """
    return (sessions.where("partner is not null and email is not null").groupBy(F.to_date("fecha_inicio").alias("dia"), "partner")
            .agg(F.count("*").alias("sesiones"), F.hll_sketch_agg("email", SKETCH_K).alias("alumnos")))


def cardinality_of(sketches: DataFrame) -> DataFrame:
    """Sessions and estimated distinct students per partner over the days of ``sketches``."""
    return sketches.groupBy("partner").agg(F.sum("sesiones").alias("sesiones"), F.hll_sketch_estimate(F.hll_union_agg("alumnos")).alias("alumnos"))


def last_days(sessions: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    start = F.lit(as_of).cast("timestamp") - F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(days))
    return sessions.where(F.col("fecha_inicio") >= start)


# B23 ----------------------------------------------------------------------------------
def path_certifications(log: DataFrame, rules: R.Rules) -> DataFrame:
    p = log.select("pod", "line_no", _x(RE_PATH).alias("path")).where(F.col("path").isNotNull())
    return p.select("pod", "line_no", "path", R.path_certification("path", rules.path_cert_map).alias("certificacion"))

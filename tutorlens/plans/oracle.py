"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each string starts from the fixture definitions (``FIXTURE_CTES``) and the
shared cleaning / feature CTEs below, written independently of the Spark code
as plain SQL.  Literals that must be doubles are cast explicitly (DuckDB
reads ``0.15`` as a DECIMAL), sums of BIGINT are cast back from HUGEINT, and
float aggregates whose summation order differs are rounded to 6 places.
"""

from __future__ import annotations

from tutorlens.sources.fixtures import CUTOFF_DAY, FIXTURE_CTES, LEVELS

C = CUTOFF_DAY
K3_ON = lambda a, b: " AND ".join(f"{a}.{k} = {b}.{k}" for k in ("code_module", "code_presentation", "id_student"))
K2_ON = lambda a, b: " AND ".join(f"{a}.{k} = {b}.{k}" for k in ("code_module", "code_presentation"))

TARGET_CASE = (
    "CASE {c} WHEN 'Pass' THEN 0 WHEN 'Distinction' THEN 1 WHEN 'Fail' THEN 2 WHEN 'Withdrawn' THEN 3 END"
)
CLASS_NAME_CASE = (
    "CASE {c} WHEN 0 THEN 'Pass (0)' WHEN 1 THEN 'Distinction (1)' WHEN 2 THEN 'Fail (2)' "
    "WHEN 3 THEN 'Withdrawn (3)' END"
)
CLASS_LABEL_CASE = (
    "CASE {c} WHEN 0 THEN 'Pass' WHEN 1 THEN 'Distinction' WHEN 2 THEN 'Fail' WHEN 3 THEN 'Withdrawn' END"
)

INFO_COLS = [
    "code_module", "code_presentation", "id_student", "gender", "region", "highest_education",
    "imd_band", "age_band", "num_of_prev_attempts", "studied_credits", "disability", "final_result",
]
CATEGORIES = [
    "code_module", "code_presentation", "gender", "region", "highest_education", "imd_band", "age_band", "disability",
]
MASTER_WHOLE_COLS = INFO_COLS + ["total_clicks", "mean_score", "num_submissions", "date_registration", "unregistered", "target"]
MASTER_EARLY_COLS = INFO_COLS + [
    "total_clicks", "active_days", "unique_resources", "clicks_per_day", "days_since_last_click",
    "mean_score", "num_submissions", "submission_rate", "date_registration", "date_unregistration",
]
ACTIVE_COLS = MASTER_EARLY_COLS + ["target"]
WHOLE_FEATURES = [c for c in MASTER_WHOLE_COLS if c not in ("id_student", "final_result")]
EARLY_FEATURES = [c for c in ACTIVE_COLS if c not in ("id_student", "final_result", "date_unregistration")]

SHARED_CTES = f"""
assess_clean AS (
  SELECT a.code_module, a.code_presentation, a.id_assessment, a.assessment_type,
         COALESCE(a.date, CAST(c.module_presentation_length AS DOUBLE)) AS date
  FROM assessments a LEFT JOIN courses c ON {K2_ON('a', 'c')}
),
info_clean AS (
  SELECT code_module, code_presentation, id_student, gender, region, highest_education,
         COALESCE(imd_band, 'Unknown') AS imd_band, age_band, num_of_prev_attempts, studied_credits,
         disability, final_result
  FROM student_info
),
sub_clean AS (SELECT * FROM student_assessment WHERE is_banked = 0),
reg_clean AS (
  SELECT code_module, code_presentation, id_student,
         COALESCE(date_registration,
                  (SELECT quantile_cont(date_registration, 0.5) FROM student_registration)) AS date_registration,
         date_unregistration,
         CAST(date_unregistration IS NOT NULL AS INTEGER) AS unregistered
  FROM student_registration
),
clicks AS (
  SELECT id_student, CAST(SUM(sum_click) AS BIGINT) AS sum_click
  FROM student_vle WHERE id_student IS NOT NULL GROUP BY id_student
),
vle_whole AS (
  SELECT code_module, code_presentation, id_student, CAST(SUM(sum_click) AS BIGINT) AS total_clicks
  FROM student_vle
  WHERE code_module IS NOT NULL AND code_presentation IS NOT NULL AND id_student IS NOT NULL
  GROUP BY code_module, code_presentation, id_student
),
assess_whole AS (
  SELECT a.code_module, a.code_presentation, s.id_student,
         AVG(s.score) AS mean_score, COUNT(s.score) AS num_submissions
  FROM sub_clean s JOIN assess_clean a ON s.id_assessment = a.id_assessment
  WHERE a.code_module IS NOT NULL AND a.code_presentation IS NOT NULL AND s.id_student IS NOT NULL
  GROUP BY a.code_module, a.code_presentation, s.id_student
),
master_whole AS (
  SELECT i.*,
         COALESCE(v.total_clicks, 0) AS total_clicks,
         COALESCE(s.mean_score, CAST(0 AS DOUBLE)) AS mean_score,
         COALESCE(s.num_submissions, 0) AS num_submissions,
         r.date_registration, CAST(r.unregistered AS DOUBLE) AS unregistered,
         {TARGET_CASE.format(c='i.final_result')} AS target
  FROM info_clean i
  LEFT JOIN vle_whole v ON {K3_ON('i', 'v')}
  LEFT JOIN assess_whole s ON {K3_ON('i', 's')}
  LEFT JOIN reg_clean r ON {K3_ON('i', 'r')}
),
vle_early AS (
  SELECT code_module, code_presentation, id_student,
         CAST(SUM(sum_click) AS BIGINT) AS total_clicks,
         COUNT(DISTINCT date) AS active_days,
         COUNT(DISTINCT id_site) AS unique_resources,
         CAST(SUM(sum_click) AS DOUBLE) / CAST({C} AS DOUBLE) AS clicks_per_day,
         CAST({C} - MAX(date) AS INTEGER) AS days_since_last_click
  FROM student_vle
  WHERE date <= {C} AND code_module IS NOT NULL AND code_presentation IS NOT NULL AND id_student IS NOT NULL
  GROUP BY code_module, code_presentation, id_student
),
due AS (
  SELECT code_module, code_presentation, COUNT(id_assessment) AS total_assessments_due
  FROM assess_clean
  WHERE date <= {C} AND code_module IS NOT NULL AND code_presentation IS NOT NULL
  GROUP BY code_module, code_presentation
),
assess_early_base AS (
  SELECT a.code_module, a.code_presentation, s.id_student,
         AVG(s.score) AS mean_score, COUNT(s.score) AS num_submissions
  FROM sub_clean s JOIN assess_clean a ON s.id_assessment = a.id_assessment
  WHERE s.date_submitted <= {C}
    AND a.code_module IS NOT NULL AND a.code_presentation IS NOT NULL AND s.id_student IS NOT NULL
  GROUP BY a.code_module, a.code_presentation, s.id_student
),
assess_early AS (
  SELECT b.code_module, b.code_presentation, b.id_student, b.mean_score, b.num_submissions,
         COALESCE(CAST(b.num_submissions AS DOUBLE) / CAST(d.total_assessments_due AS DOUBLE),
                  CAST(0 AS DOUBLE)) AS submission_rate
  FROM assess_early_base b LEFT JOIN due d ON {K2_ON('b', 'd')}
),
master_early AS (
  SELECT i.*,
         COALESCE(v.total_clicks, 0) AS total_clicks,
         COALESCE(v.active_days, 0) AS active_days,
         COALESCE(v.unique_resources, 0) AS unique_resources,
         COALESCE(v.clicks_per_day, CAST(0 AS DOUBLE)) AS clicks_per_day,
         COALESCE(v.days_since_last_click, CAST({C} AS INTEGER)) AS days_since_last_click,
         COALESCE(s.mean_score, CAST(0 AS DOUBLE)) AS mean_score,
         COALESCE(s.num_submissions, 0) AS num_submissions,
         COALESCE(s.submission_rate, CAST(0 AS DOUBLE)) AS submission_rate,
         r.date_registration, r.date_unregistration
  FROM info_clean i
  LEFT JOIN vle_early v ON {K3_ON('i', 'v')}
  LEFT JOIN assess_early s ON {K3_ON('i', 's')}
  LEFT JOIN reg_clean r ON {K3_ON('i', 'r')}
),
active AS (
  SELECT *, {TARGET_CASE.format(c='final_result')} AS target
  FROM master_early
  WHERE date_unregistration IS NULL OR date_unregistration > {C}
),
engaged AS (
  SELECT i.*, COALESCE(c.sum_click, 0) AS sum_click
  FROM student_info i LEFT JOIN clicks c ON i.id_student = c.id_student
),
fanout AS (
  SELECT s.*, i.final_result
  FROM student_assessment s JOIN student_info i ON s.id_student = i.id_student
)"""


def _with(*extra: str) -> str:
    more = "".join(f",\n{e}" for e in extra)
    return f"WITH {FIXTURE_CTES},{SHARED_CTES}{more}\n"


def _q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _stack_union(selects: list[str]) -> str:
    return "\nUNION ALL\n".join(selects)


# --- exploration registry -------------------------------------------------------

REGISTRY = [
    ("studentInfo", "student_info", INFO_COLS),
    ("studentAssessment", "student_assessment", ["id_assessment", "id_student", "date_submitted", "is_banked", "score"]),
    ("assessments", "assessments", ["code_module", "code_presentation", "id_assessment", "assessment_type", "date"]),
    ("studentVle_small", "clicks", ["id_student", "sum_click"]),
    ("courses", "courses", ["code_module", "code_presentation", "module_presentation_length"]),
    (
        "studentRegistration",
        "student_registration",
        ["code_module", "code_presentation", "id_student", "date_registration", "date_unregistration"],
    ),
    ("vle", "vle", ["id_site", "code_module", "code_presentation", "activity_type", "week_from", "week_to"]),
]
NUMERIC = {
    "studentInfo": ["id_student", "num_of_prev_attempts", "studied_credits"],
    "studentAssessment": ["id_assessment", "id_student", "date_submitted", "is_banked", "score"],
    "studentVle_small": ["id_student", "sum_click"],
}


def _null_counts_sql() -> str:
    parts = []
    for tname, view, cols in REGISTRY:
        for i, c in enumerate(cols):
            parts.append(
                f"SELECT {_lit(tname)} AS table_name, CAST({i} AS INTEGER) AS position, {_lit(c)} AS column_name, "
                f"COUNT(*) - COUNT({_q(c)}) AS null_count FROM {view}"
            )
    return _with() + _stack_union(parts)


def _master_null_columns_sql() -> str:
    parts = [
        f"SELECT CAST({i} AS INTEGER) AS position, {_lit(c)} AS column_name, COUNT(*) - COUNT({_q(c)}) AS null_count FROM master_whole"
        for i, c in enumerate(MASTER_WHOLE_COLS)
    ]
    return _with() + "SELECT * FROM (" + _stack_union(parts) + ") t WHERE null_count > 0"


def _table_profile_sql() -> str:
    parts = [
        f"SELECT {_lit(tname)} AS table_name, COUNT(*) AS n_rows, CAST({len(cols)} AS INTEGER) AS n_cols, "
        f"{_lit(', '.join(cols))} AS columns FROM {view}"
        for tname, view, cols in REGISTRY
    ]
    return _with() + _stack_union(parts)


def _describe_sql(numeric: dict[str, list[str]] = NUMERIC) -> str:
    views = {t: v for t, v, _ in REGISTRY}
    parts = []
    for tname, cols in numeric.items():
        for c in cols:
            parts.append(
                f"SELECT {_lit(tname)} AS table_name, {_lit(c)} AS column_name, COUNT(x) AS count, "
                "round(AVG(x), 6) AS mean, round(stddev_samp(x), 6) AS std, round(MIN(x), 6) AS min, "
                "round(quantile_cont(x, 0.25), 6) AS p25, round(quantile_cont(x, 0.5), 6) AS p50, "
                "round(quantile_cont(x, 0.75), 6) AS p75, round(MAX(x), 6) AS max "
                f"FROM (SELECT CAST({_q(c)} AS DOUBLE) AS x FROM {views[tname]}) d"
            )
    return _with() + _stack_union(parts)


# --- distributions ----------------------------------------------------------------

def _histogram_sql(source: str, column: str, bins: int = 30) -> str:
    edge = lambda i: f"(CASE WHEN {i} = {bins} THEN hi ELSE CAST({i} AS DOUBLE) * step + lo END)"
    return _with(
        f"x AS (SELECT CAST({column} AS DOUBLE) AS v FROM {source} WHERE {column} IS NOT NULL)",
        "st AS (SELECT CASE WHEN MIN(v) = MAX(v) THEN MIN(v) - 0.5 ELSE MIN(v) END AS lo, "
        "CASE WHEN MIN(v) = MAX(v) THEN MAX(v) + 0.5 ELSE MAX(v) END AS hi FROM x)",
        f"p AS (SELECT lo, hi, (hi - lo) / CAST({bins} AS DOUBLE) AS step FROM st)",
        f"b0 AS (SELECT v, lo, hi, step, LEAST(CAST(FLOOR((v - lo) / (hi - lo) * CAST({bins} AS DOUBLE)) AS INTEGER), {bins - 1}) AS i0 FROM x, p)",
        f"b1 AS (SELECT CASE WHEN v < {edge('i0')} THEN i0 - 1 "
        f"WHEN i0 < {bins - 1} AND v >= {edge('i0 + 1')} THEN i0 + 1 ELSE i0 END AS bin FROM b0)",
        "cnt AS (SELECT bin, COUNT(*) AS n FROM b1 GROUP BY bin)",
        f"allb AS (SELECT CAST(range AS INTEGER) AS bin FROM range({bins}))",
    ) + (
        f"SELECT allb.bin, {edge('allb.bin')} AS bin_start, {edge('(allb.bin + 1)')} AS bin_end, "
        "COALESCE(cnt.n, 0) AS count FROM allb LEFT JOIN cnt ON allb.bin = cnt.bin, p"
    )


def _density_sql(source: str, column: str, grid: int = 200, bins: int = 30) -> str:
    return _with(
        f"x AS (SELECT CAST({column} AS DOUBLE) AS v FROM {source} WHERE {column} IS NOT NULL)",
        "vc AS (SELECT v, COUNT(*) AS c FROM x GROUP BY v)",
        "st AS (SELECT COUNT(*) AS n, stddev_samp(v) AS sd, MIN(v) AS lo, MAX(v) AS hi FROM x)",
        f"p AS (SELECT n, sd * pow(CAST(n AS DOUBLE), CAST(-0.2 AS DOUBLE)) AS bw, lo, hi, "
        f"(hi - lo) / CAST({grid - 1} AS DOUBLE) AS step FROM st)",
        f"g AS (SELECT CAST(range AS INTEGER) AS point FROM range({grid}))",
        f"gx AS (SELECT point, CASE WHEN point = {grid - 1} THEN hi ELSE CAST(point AS DOUBLE) * step + lo END AS x, "
        "n, bw, lo, hi FROM g, p)",
        "s AS (SELECT point, x, n, bw, lo, hi, "
        "SUM(c * exp(CAST(-0.5 AS DOUBLE) * ((x - v) / bw) * ((x - v) / bw))) AS s FROM gx, vc "
        "GROUP BY point, x, n, bw, lo, hi)",
    ) + (
        "SELECT point, round(x, 6) AS x, round(s / (n * bw * sqrt(2 * pi())), 6) AS density, "
        f"round(s / (n * bw * sqrt(2 * pi())) * n * ((hi - lo) / CAST({bins} AS DOUBLE)), 6) AS scaled "
        "FROM s WHERE n >= 2 AND bw > 0"
    )


def _box_sql(rows_sql: str, group: str) -> str:
    """Box statistics of (g, v) rows; ``rows_sql`` selects g and v."""
    return _with(
        f"d AS ({rows_sql})",
        "q AS (SELECT g, COUNT(*) AS n, AVG(v) AS mean, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, "
        "quantile_cont(v, 0.75) AS q3, MIN(v) AS min, MAX(v) AS max FROM d GROUP BY g)",
        "f AS (SELECT q.*, q3 - q1 AS iqr, q1 - CAST(1.5 AS DOUBLE) * (q3 - q1) AS lo_f, "
        "q3 + CAST(1.5 AS DOUBLE) * (q3 - q1) AS hi_f FROM q)",
        "w AS (SELECT f.g, MIN(CASE WHEN d.v >= f.lo_f THEN d.v END) AS wlo, "
        "MAX(CASE WHEN d.v <= f.hi_f THEN d.v END) AS whi FROM d JOIN f ON d.g = f.g GROUP BY f.g)",
        "w2 AS (SELECT f.*, CASE WHEN w.wlo IS NULL OR w.wlo > f.q1 THEN f.q1 ELSE w.wlo END AS whisker_low, "
        "CASE WHEN w.whi IS NULL OR w.whi < f.q3 THEN f.q3 ELSE w.whi END AS whisker_high FROM f JOIN w ON f.g = w.g)",
        "o AS (SELECT w2.g, COUNT(*) FILTER (WHERE d.v < w2.whisker_low OR d.v > w2.whisker_high) AS n_outliers "
        "FROM d JOIN w2 ON d.g = w2.g GROUP BY w2.g)",
    ) + (
        f"SELECT w2.g AS {group}, n, round(mean, 6) AS mean, round(q1, 6) AS q1, round(median, 6) AS median, "
        "round(q3, 6) AS q3, round(iqr, 6) AS iqr, round(whisker_low, 6) AS whisker_low, "
        "round(whisker_high, 6) AS whisker_high, o.n_outliers, round(min, 6) AS min, round(max, 6) AS max "
        "FROM w2 JOIN o ON w2.g = o.g"
    )


# --- encoding, split, reports -----------------------------------------------------------

def _one_hot_select(source: str, feature_cols: list[str], drop_first: bool) -> str:
    kept = [_q(c) for c in feature_cols if c not in CATEGORIES]
    dummies = []
    for c in CATEGORIES:
        levels = sorted(LEVELS[c])
        if drop_first:
            levels = levels[1:]
        for v in levels:
            dummies.append(f"COALESCE({_q(c)} = {_lit(v)}, FALSE) AS {_q(f'{c}_{v}')}")
    return f"SELECT {', '.join(kept + dummies)} FROM {source}"


def _one_hot_positions_sql() -> str:
    """Positions over the levels that the table holds, ranked in text order."""
    pairs = _stack_union([f"SELECT {i} AS i, CAST({_q(c)} AS VARCHAR) AS v FROM master_whole WHERE {_q(c)} IS NOT NULL" for i, c in enumerate(CATEGORIES)])
    joins = " ".join(f"LEFT JOIN idx p{i} ON p{i}.i = {i} AND p{i}.v = m.{_q(c)}" for i, c in enumerate(CATEGORIES))
    found = ", ".join(f"p{i}.position" for i in range(len(CATEGORIES)))
    return _with(f"idx AS (SELECT i, v, CAST(ROW_NUMBER() OVER (ORDER BY i, v) - 1 AS INTEGER) AS position FROM (SELECT DISTINCT i, v FROM ({pairs}) u) d)") + (
        "SELECT concat_ws('|', m.code_module, m.code_presentation) AS run, m.id_student, m.target, "
        f"array_to_string(list_filter([{found}], lambda x: x IS NOT NULL), ',') AS positions FROM master_whole m {joins}"
    )


def _encoded_null_columns_sql() -> str:
    """The dummies are never missing; the other columns keep their gaps."""
    kept = [c for c in WHOLE_FEATURES if c not in CATEGORIES]
    parts = [
        f"SELECT CAST({i} AS INTEGER) AS position, {_lit(c)} AS column_name, COUNT(*) - COUNT({_q(c)}) AS null_count FROM master_whole"
        for i, c in enumerate(kept)
    ]
    return _with() + "SELECT * FROM (" + _stack_union(parts) + ") t WHERE null_count > 0"


def _previews_sql(n: int = 5) -> str:
    parts = []
    for tname, view, cols in REGISTRY:
        order = ", ".join(f"{_q(c)} NULLS FIRST" for c in cols)
        content = ", ".join(f"{_lit(c)}, {_q(c)}" for c in cols)
        parts.append(
            f"SELECT {_lit(tname)} AS table_name, CAST(row AS INTEGER) AS row, CAST(json_object({content}) AS VARCHAR) AS content "
            f"FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY {order}) AS row FROM {view}) t WHERE row <= {n}"
        )
    return _with() + _stack_union(parts)


def _n_cols(feature_cols: list[str], drop_first: bool) -> int:
    kept = [c for c in feature_cols if c not in CATEGORIES]
    n = sum(len(LEVELS[c]) - (1 if drop_first else 0) for c in CATEGORIES)
    return len(kept) + n


def _split_ctes(source: str) -> list[str]:
    return [
        f"sb AS (SELECT *, "
        f"md5(concat_ws('|', '42', code_module, code_presentation, CAST(id_student AS VARCHAR))) AS h FROM {source})",
        "cls AS (SELECT target, COUNT(*) AS n_class FROM sb GROUP BY target)",
        "t1 AS (SELECT target, n_class, SUM(n_class) OVER () AS n, "
        "CAST(CEIL(CAST(0.15 AS DOUBLE) * CAST(SUM(n_class) OVER () AS DOUBLE)) AS BIGINT) AS n_test FROM cls)",
        "t2 AS (SELECT *, CAST(n_class AS DOUBLE) / CAST(n AS DOUBLE) * CAST(n - n_test AS DOUBLE) AS cont FROM t1)",
        "t3 AS (SELECT *, (n - n_test) - SUM(FLOOR(cont)) OVER () AS need, "
        "ROW_NUMBER() OVER (ORDER BY cont - FLOOR(cont) DESC, target) AS ord FROM t2)",
        "t4 AS (SELECT target, n_class, CAST(FLOOR(cont) + CASE WHEN ord <= need THEN 1 ELSE 0 END AS BIGINT) AS n_rest FROM t3)",
        "t5 AS (SELECT *, SUM(n_rest) OVER () AS m, "
        f"CAST(CEIL(CAST({0.15 / (1 - 0.15)!r} AS DOUBLE) * CAST(SUM(n_rest) OVER () AS DOUBLE)) AS BIGINT) AS n_val FROM t4)",
        "t6 AS (SELECT *, CAST(n_rest AS DOUBLE) / CAST(m AS DOUBLE) * CAST(m - n_val AS DOUBLE) AS cont2 FROM t5)",
        "t7 AS (SELECT *, (m - n_val) - SUM(FLOOR(cont2)) OVER () AS need2, "
        "ROW_NUMBER() OVER (ORDER BY cont2 - FLOOR(cont2) DESC, target) AS ord2 FROM t6)",
        "quota AS (SELECT target, n_class, n_rest, "
        "CAST(FLOOR(cont2) + CASE WHEN ord2 <= need2 THEN 1 ELSE 0 END AS BIGINT) AS n_train FROM t7)",
        "ranked AS (SELECT sb.*, ROW_NUMBER() OVER (PARTITION BY sb.target ORDER BY h, code_module, code_presentation, id_student) - 1 AS rnk FROM sb)",
        "sp AS (SELECT r.* EXCLUDE (h, rnk), "
        "CASE WHEN rnk < q.n_train THEN 'train' WHEN rnk < q.n_rest THEN 'validation' ELSE 'test' END AS split "
        "FROM ranked r JOIN quota q ON r.target = q.target)",
    ]


def _report_sql(master: str, master_cols: list[str], feature_cols: list[str], extra: list[str] = ()) -> str:
    kept = [c for c in feature_cols if c not in CATEGORIES]
    nulls = " + ".join(f"(COUNT(*) - COUNT({_q(c)}))" for c in kept)
    agg = (
        f"agg AS (SELECT COUNT(*) AS n_rows, {nulls} AS nulls, COUNT(target) AS labelled, "
        + ", ".join(f"COUNT(*) FILTER (WHERE target = {k}) AS c{k}" for k in range(4))
        + f" FROM {master})"
    )
    items = [
        ("master_rows", "n_rows"),
        ("master_cols", str(len(master_cols))),
        ("feature_rows", "n_rows"),
        ("feature_cols", str(len(feature_cols))),
        ("linear_rows", "n_rows"),
        ("linear_cols", str(_n_cols(feature_cols, True))),
        ("tree_rows", "n_rows"),
        ("tree_cols", str(_n_cols(feature_cols, False))),
        ("nulls_linear", "nulls"),
        ("nulls_tree", "nulls"),
        ("all_clear", "CASE WHEN nulls = 0 THEN 1 ELSE 0 END"),
    ]
    names = ["Pass (0)", "Distinction (1)", "Fail (2)", "Withdrawn (3)"]
    for k, name in enumerate(names):
        items.append((f"share {name}", f"round_even(CAST(c{k} AS DOUBLE) / CAST(labelled AS DOUBLE), 3)"))
    items += [(f"feature {c}", str(i)) for i, c in enumerate(feature_cols)]
    parts = [f"SELECT {_lit(n)} AS item, CAST({e} AS DOUBLE) AS value FROM agg" for n, e in items]
    return _with(agg) + _stack_union(parts + list(extra))


def _next_term_sql() -> str:
    """The last presentation with the median and the levels of the ones before; the levels are those of the fixture."""
    before, known, unseen = sorted(LEVELS["code_presentation"])[:-1], {}, []
    dummies = []
    for c in CATEGORIES:
        known[c] = before if c == "code_presentation" else sorted(LEVELS[c])
        dummies += [f"COALESCE({_q(c)} = {_lit(v)}, FALSE) AS {_q(f'{c}_{v}')}" for v in known[c]]
        unseen.append(f"CASE WHEN {_q(c)} NOT IN (SELECT DISTINCT {_q(c)} FROM earlier WHERE {_q(c)} IS NOT NULL) THEN 1 ELSE 0 END")
    kept = [c for c in MASTER_WHOLE_COLS if c not in CATEGORIES and c not in ("final_result", "target", "date_registration")]
    return _with(
        "m AS (SELECT w.* EXCLUDE (date_registration), r.date_registration FROM master_whole w "
        f"LEFT JOIN student_registration r ON {K3_ON('w', 'r')})",
        "earlier AS (SELECT * FROM m WHERE code_presentation < (SELECT MAX(code_presentation) FROM m))",
        "later AS (SELECT * FROM m WHERE code_presentation = (SELECT MAX(code_presentation) FROM m))",
    ) + (
        f"SELECT {', '.join(_q(c) for c in kept)}, "
        "COALESCE(date_registration, (SELECT quantile_cont(date_registration, 0.5) FROM earlier)) AS date_registration, "
        f"{', '.join(dummies)}, CAST({' + '.join(unseen)} AS INTEGER) AS n_unseen, target FROM later"
    )


def oracle_sql() -> dict[str, str]:
    k3 = "code_module, code_presentation, id_student"
    target_info = f"{TARGET_CASE.format(c='final_result')} AS target"
    qs: dict[str, str] = {
        "clicks_per_student": _with() + "SELECT * FROM clicks",
        "clicks_by_enrolment": _with() + "SELECT * FROM vle_whole",
        "assessment_dates_filled": _with() + "SELECT * FROM assess_clean",
        "info_imd_filled": _with() + "SELECT * FROM info_clean",
        "submissions_not_banked": _with() + "SELECT * FROM sub_clean",
        "registration_median_filled": _with() + "SELECT * FROM reg_clean",
        "cleaning_report": _with()
        + _stack_union(
            [
                "SELECT 'assessments' AS table_name, 'dates_filled_from_course_length' AS metric, "
                "COUNT(*) FILTER (WHERE date IS NULL) AS value FROM assessments",
                "SELECT 'student_info', 'imd_band_filled_unknown', COUNT(*) FILTER (WHERE imd_band IS NULL) FROM student_info",
                "SELECT 'student_assessment', 'banked_rows_removed', CAST(COALESCE(SUM(is_banked), 0) AS BIGINT) FROM student_assessment",
                "SELECT 'student_assessment', 'missing_scores_kept', "
                "COUNT(*) FILTER (WHERE is_banked = 0 AND score IS NULL) FROM student_assessment",
                "SELECT 'student_registration', 'date_registration_filled_median', "
                "COUNT(*) FILTER (WHERE date_registration IS NULL) FROM student_registration",
                "SELECT 'student_registration', 'students_unregistered', "
                "COUNT(*) FILTER (WHERE date_unregistration IS NOT NULL) FROM student_registration",
            ]
        ),
        "early_engagement": _with() + "SELECT * FROM vle_early",
        "scores_by_enrolment": _with() + "SELECT * FROM assess_whole",
        "assessments_due": _with() + "SELECT * FROM due",
        "early_assessment": _with() + "SELECT * FROM assess_early",
        "master_whole_course": _with() + "SELECT * FROM master_whole",
        "master_early": _with() + "SELECT * FROM master_early",
        "active_students": _with() + "SELECT * FROM active",
        "active_filter_effect": _with()
        + f"SELECT COUNT(*) AS rows_before, "
        f"COUNT(*) FILTER (WHERE NOT (date_unregistration IS NULL OR date_unregistration > {C})) AS rows_removed, "
        f"COUNT(*) FILTER (WHERE date_unregistration IS NULL OR date_unregistration > {C}) AS rows_after FROM master_early",
        "target_encoded": _with() + f"SELECT {k3}, final_result, {target_info} FROM student_info",
        "class_balance": _with("vc AS (SELECT target, COUNT(*) AS count FROM master_whole WHERE target IS NOT NULL GROUP BY target)")
        + f"SELECT target, {CLASS_NAME_CASE.format(c='target')} AS class_name, count, "
        "round_even(CAST(count AS DOUBLE) / CAST(SUM(count) OVER () AS DOUBLE), 3) AS share FROM vc",
        "value_counts_percent": _with(
            "st AS ("
            + _stack_union(
                [
                    f"SELECT {_lit(c)} AS variable, CAST({c} AS VARCHAR) AS value FROM student_info"
                    for c in ["final_result", "age_band", "gender", "highest_education", "num_of_prev_attempts"]
                ]
            )
            + ")",
            "c AS (SELECT variable, value, COUNT(*) AS count FROM st WHERE value IS NOT NULL GROUP BY variable, value)",
        )
        + "SELECT variable, value, count, "
        "CAST(count AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(SUM(count) OVER (PARTITION BY variable) AS DOUBLE) AS percent FROM c",
        "null_counts": _null_counts_sql(),
        "master_null_columns": _master_null_columns_sql(),
        "duplicate_keys": "SELECT CAST(SUM(n) AS BIGINT) AS n_rows, COUNT(*) AS n_keys, CAST(SUM(n - 1) AS BIGINT) AS n_duplicates "
        "FROM (SELECT user_id, event_type, COUNT(*) AS n FROM events GROUP BY user_id, event_type) g",
        "duplicate_key_groups": "SELECT user_id, event_type, COUNT(*) AS n_rows FROM events "
        "GROUP BY user_id, event_type HAVING COUNT(*) > 1",
        "enrolment_duplicates": _with()
        + "SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS n_rows, COUNT(*) AS n_keys, "
        "CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS n_duplicates "
        f"FROM (SELECT {k3}, COUNT(*) AS n FROM master_early GROUP BY {k3}) g",
        "table_profile": _table_profile_sql(),
        "preview": _with() + f"SELECT * FROM student_info ORDER BY {k3} LIMIT 5",
        "describe_numeric": _describe_sql(),
        "engagement_by_result": _with()
        + "SELECT final_result, round(AVG(sum_click), 6) AS mean_value, "
        "round(quantile_cont(CAST(sum_click AS DOUBLE), 0.5), 6) AS median_value "
        "FROM engaged WHERE final_result IS NOT NULL GROUP BY final_result",
        "score_by_result": _with()
        + "SELECT final_result, round(AVG(score), 6) AS mean_score FROM fanout "
        "WHERE final_result IS NOT NULL GROUP BY final_result",
        "category_by_result": _with(
            "st AS (SELECT 'highest_education' AS variable, highest_education AS level, final_result FROM student_info "
            "UNION ALL SELECT 'age_band', age_band, final_result FROM student_info)"
        )
        + "SELECT variable, level, final_result, COUNT(*) AS n_rows FROM st "
        "WHERE level IS NOT NULL AND final_result IS NOT NULL GROUP BY variable, level, final_result",
        "histogram_score": _histogram_sql("student_assessment", "score"),
        "histogram_clicks": _histogram_sql("clicks", "sum_click"),
        "histogram_credits": _histogram_sql("student_info", "studied_credits"),
        "density_score": _density_sql("student_assessment", "score"),
        "density_clicks": _density_sql("clicks", "sum_click"),
        "box_clicks_by_result": _box_sql(
            "SELECT final_result AS g, CAST(sum_click AS DOUBLE) AS v FROM engaged WHERE final_result IS NOT NULL",
            "final_result",
        ),
        "box_score_by_result": _box_sql(
            "SELECT final_result AS g, score AS v FROM fanout WHERE final_result IS NOT NULL AND score IS NOT NULL",
            "final_result",
        ),
        "one_hot_tree": _with() + _one_hot_select("master_whole", WHOLE_FEATURES, drop_first=False),
        "one_hot_linear": _with() + _one_hot_select("master_whole", WHOLE_FEATURES, drop_first=True),
        "one_hot_tree_early": _with() + _one_hot_select("active", EARLY_FEATURES, drop_first=False),
        "one_hot_linear_early": _with() + _one_hot_select("active", EARLY_FEATURES, drop_first=True),
        "one_hot_vector": _one_hot_positions_sql(),
        "training_frame_whole": _with(*_split_ctes("master_whole")) + _one_hot_select("sp", [*WHOLE_FEATURES, "split"], drop_first=False),
        "training_frame_early": _with(*_split_ctes("active")) + _one_hot_select("sp", [*EARLY_FEATURES, "split"], drop_first=False),
        "training_part_early": _with(*_split_ctes("active")) + _one_hot_select("sp", EARLY_FEATURES, drop_first=False) + " WHERE split = 'train'",
        "encoded_null_columns": _encoded_null_columns_sql(),
        "previews": _previews_sql(),
        "describe_clicks": "SELECT * EXCLUDE (table_name) FROM (" + _describe_sql({"studentVle_small": ["sum_click"]}) + ") t",
        "education_by_result": _with()
        + "SELECT highest_education, "
        + ", ".join(f"COUNT(*) FILTER (WHERE final_result = {_lit(v)}) AS {_q(v)}" for v in ("Pass", "Distinction", "Fail", "Withdrawn"))
        + " FROM student_info WHERE highest_education IS NOT NULL AND final_result IS NOT NULL GROUP BY highest_education",
        "stratified_split": _with(*_split_ctes("master_whole")) + f"SELECT {k3}, target, split FROM sp",
        "split_sizes": _with(*_split_ctes("master_whole"))
        + "SELECT split, COUNT(*) AS n_rows, "
        "round_even(CAST(COUNT(*) AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(SUM(COUNT(*)) OVER () AS DOUBLE), 1) AS percent "
        "FROM sp GROUP BY split",
        "split_class_shares": _with(*_split_ctes("master_whole"))
        + f"SELECT split, {CLASS_LABEL_CASE.format(c='target')} AS class_name, COUNT(*) AS n_rows, "
        "round_even(CAST(COUNT(*) AS DOUBLE) / CAST(SUM(COUNT(*)) OVER (PARTITION BY split) AS DOUBLE), 3) AS share "
        "FROM sp GROUP BY split, target",
        "report_whole_course": _report_sql("master_whole", MASTER_WHOLE_COLS, WHOLE_FEATURES),
        "report_early": _report_sql(
            "active",
            ACTIVE_COLS,
            EARLY_FEATURES,
            extra=[
                "SELECT 'rows_before_filter' AS item, CAST(COUNT(*) AS DOUBLE) AS value FROM master_early",
                f"SELECT 'rows_removed', CAST(COUNT(*) FILTER (WHERE NOT (date_unregistration IS NULL OR date_unregistration > {C})) AS DOUBLE) FROM master_early",
                f"SELECT 'duplicate_keys', CAST(COALESCE(SUM(n - 1), 0) AS DOUBLE) FROM (SELECT {k3}, COUNT(*) AS n FROM master_early GROUP BY {k3}) g",
            ],
        ),
    }
    from tutorlens.plans.queries import EXPLORED

    qs |= {f"explored_{report}": qs[name] for report, name in EXPLORED.items()}
    qs["explore_clicks"] = qs["engagement_by_result"]
    qs["clicks_written"] = qs["clicks_per_student"]
    qs["master_of_buckets"] = qs["master_whole_course"]
    qs["clicks_incremental"] = qs["clicks_by_enrolment"]
    qs["next_term_prepared"] = _next_term_sql()
    qs["registrations_good"] = _with() + "SELECT * FROM student_registration"
    fields = "code_module, code_presentation, CAST(id_student AS VARCHAR)"
    qs["registrations_bad"] = _with() + (
        f"SELECT CASE id_student % 3 WHEN 0 THEN concat_ws(',', {fields}) WHEN 1 THEN concat_ws(',', {fields}, '1', '2', '3') "
        f"ELSE concat_ws(',', {fields}, 'soon', '') END AS line, "
        "CASE WHEN id_student % 3 = 2 THEN 'date_registration: soon' ELSE 'number of fields' END AS reason "
        "FROM student_registration WHERE id_student % 5 = 0"
    )
    qs["registrations_through_csv"] = _with() + "SELECT * FROM student_registration"
    return qs

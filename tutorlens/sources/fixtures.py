"""Learning-shaped tables derived from the generated star-schema test data.

The seven course tables (enrolments, courses, assessments, submissions,
registrations, click log) are defined by fixed rules over ``customer``,
``nation``, ``region``, ``part``, ``lineitem``, ``orders`` and ``events``, so
their size grows with the scale factor.  :func:`fixture_tables` builds them as
lazy Spark plans; :data:`FIXTURE_CTES` holds the same definitions as SQL for
the DuckDB oracle.

Scale notes: ``customer`` is read once (the second enrolment is an
``explode``, not a second scan); ``nation`` and ``region`` are fixed-size
dimension tables (25 and 5 rows at every scale factor), so they are broadcast;
the two large joins (``lineitem``-``orders`` and ``events``-enrolments) are
left to the planner, with AQE splitting a hot ``user_id``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_TABLES = ("customer", "nation", "region", "part", "lineitem", "orders", "events")

# Fixed values of the fixture rules.
CUTOFF_DAY = 14
VLE_START = "2024-01-01"
VLE_DAY_SHIFT = 5
MODULE_BY_PART = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PRESENTATION_BY_SIZE = ["2013J", "2014B", "2014J", "2012X"]
COURSE_LENGTH = {"2013J": 28, "2014B": 24, "2014J": 30}
EDUCATION = ["A Level", "HE", "Lower", "None", "PG"]
AGE_BAND = ["0-35", "35-55", "55<="]


# The layout of the generated test tables (as stored in Parquet).
# Declaring them skips a schema-inference job per read.
RAW_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def read_raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in RAW_SCHEMAS:
        reader = reader.schema(RAW_SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def _case_mod(expr: str, mod: int, values: list[str]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expr} % {mod} {arms} END"


def _case_by(expr: str, mapping: dict) -> str:
    arms = " ".join(f"WHEN '{k}' THEN {v}" for k, v in mapping.items())
    return f"CASE {expr} {arms} END"


# The projections are Spark SQL expressions: one call per view instead of one
# per expression node.

# Levels of the category columns in the fixture tables (after the imd fill),
# fixed by the fixture rules and the generated dimension tables.
LEVELS = {
    "code_module": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "code_presentation": ["2013J", "2014B", "2014J"],
    "gender": ["F", "M"],
    "region": ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"],
    "highest_education": ["A Level", "HE", "Lower", "None", "PG"],
    "imd_band": ["0-20%", "20-40%", "40-60%", "Unknown"],
    "age_band": ["0-35", "35-55", "55<="],
    "disability": ["N", "Y"],
}


def enrolments(customer: DataFrame) -> DataFrame:
    """Every customer once (``again`` = 0), every fourth once more (``again`` = 1)."""
    base = customer.selectExpr(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment",
        "explode(IF(c_custkey % 4 = 0, array(0, 1), array(0))) AS again",
    )
    return base.selectExpr(
        "c_mktsegment AS code_module",
        "CASE WHEN again = 1 THEN '2014J' WHEN c_custkey % 2 = 0 THEN '2013J' ELSE '2014B' END AS code_presentation",
        "c_custkey AS id_student",
        "again",
        "c_custkey",
        "c_nationkey",
        "c_acctbal",
    )


def student_info(enrol: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    n = nation.selectExpr("n_nationkey AS c_nationkey", "n_regionkey")
    r = region.selectExpr("r_regionkey AS n_regionkey", "r_name")
    x = enrol.join(F.broadcast(n), "c_nationkey").join(F.broadcast(r), "n_regionkey")
    result_code = "(c_custkey + 3 * again) % 10"
    return x.selectExpr(
        "code_module",
        "code_presentation",
        "id_student",
        "CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender",
        "r_name AS region",
        f"{_case_mod('c_custkey', 5, EDUCATION)} AS highest_education",
        "CASE WHEN c_custkey % 11 = 0 THEN CAST(NULL AS STRING) WHEN c_acctbal < 2000 THEN '0-20%' "
        "WHEN c_acctbal < 5000 THEN '20-40%' ELSE '40-60%' END AS imd_band",
        f"{_case_mod('c_custkey', 3, AGE_BAND)} AS age_band",
        "CAST(c_custkey % 4 + again AS INT) AS num_of_prev_attempts",
        "CAST(30 * (c_custkey % 6 + 1) AS INT) AS studied_credits",
        "CASE WHEN c_custkey % 9 = 0 THEN 'Y' ELSE 'N' END AS disability",
        f"CASE WHEN {result_code} < 4 THEN 'Pass' WHEN {result_code} < 5 THEN 'Distinction' "
        f"WHEN {result_code} < 7 THEN 'Fail' ELSE 'Withdrawn' END AS final_result",
    )


def courses(enrol: DataFrame) -> DataFrame:
    return (
        enrol.select("code_module", "code_presentation")
        .distinct()
        .selectExpr(
            "code_module",
            "code_presentation",
            f"CAST({_case_by('code_presentation', COURSE_LENGTH)} AS INT) AS module_presentation_length",
        )
    )


def assessments(part: DataFrame) -> DataFrame:
    return part.selectExpr(
        f"{_case_mod('p_partkey', 5, MODULE_BY_PART)} AS code_module",
        f"{_case_mod('p_size', 4, PRESENTATION_BY_SIZE)} AS code_presentation",
        "p_partkey AS id_assessment",
        "p_type AS assessment_type",
        "CASE WHEN p_partkey % 7 = 0 THEN CAST(NULL AS DOUBLE) "
        "WHEN p_partkey % 5 = 4 AND p_size % 4 = 2 THEN CAST(p_size + 20 AS DOUBLE) "
        "ELSE CAST(p_size AS DOUBLE) END AS date",
    )


def student_assessment(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    li = lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_tax", "l_returnflag", "l_shipdate")
    od = orders.selectExpr("o_orderkey AS l_orderkey", "o_custkey", "o_orderdate")
    return li.join(od, "l_orderkey").selectExpr(
        "CASE WHEN l_linenumber = 7 AND l_partkey % 10 = 0 THEN l_partkey + 1000000 ELSE l_partkey END AS id_assessment",
        "o_custkey AS id_student",
        "CAST(abs(datediff(to_date(l_shipdate), to_date(o_orderdate))) % 40 AS INT) AS date_submitted",
        "CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS INT) AS is_banked",
        "CASE WHEN l_tax = 0.0 OR o_custkey % 19 = 0 THEN CAST(NULL AS DOUBLE) "
        "ELSE CAST(l_quantity * 2 AS DOUBLE) END AS score",
    )


def student_vle(events: DataFrame, enrol: DataFrame) -> DataFrame:
    """One row for each event of a known student; the two enrolments of a student take turns."""
    ev = events.selectExpr(
        "ts", "user_id AS id_student", "value", "props", "CAST(IF(user_id % 4 = 0, event_id % 2, 0) AS INT) AS again"
    )
    en = enrol.select("code_module", "code_presentation", "id_student", "again")
    return (
        ev.join(en, ["id_student", "again"])
        .selectExpr(
            "code_module",
            "code_presentation",
            "id_student",
            "CAST(get_json_object(props, '$.k') AS BIGINT) AS id_site",
            f"CAST(datediff(to_date(ts), DATE'{VLE_START}') - {VLE_DAY_SHIFT} AS INT) AS date",
            "CAST(floor(value) AS BIGINT) AS sum_click",
        )
    )


def vle(clicks: DataFrame) -> DataFrame:
    """The sites of each course run, with the weeks of their first and last click (weeks before the start: missing)."""
    return clicks.groupBy("id_site", "code_module", "code_presentation").agg(
        F.lit("resource").alias("activity_type"),
        F.expr("CAST(nullif(floor(min(date) / 7D), -1) AS INT)").alias("week_from"),
        F.expr("CAST(floor(max(date) / 7D) AS INT)").alias("week_to"),
    )


def student_registration(enrol: DataFrame) -> DataFrame:
    return enrol.where("c_custkey % 17 <> 0").selectExpr(
        "code_module",
        "code_presentation",
        "id_student",
        "CASE WHEN c_custkey % 13 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(-(c_custkey % 200) AS DOUBLE) END "
        "AS date_registration",
        "CASE WHEN (c_custkey + 3 * again) % 10 >= 7 THEN CAST(c_custkey % 60 AS DOUBLE) END AS date_unregistration",
    )


class FixtureTables(Mapping):
    """The course tables over one scale-factor folder, each built on first use.

    Only the views a query touches are defined (and analysed), and each raw
    table is read once per registry.
    """

    NAMES = ("student_info", "courses", "assessments", "student_assessment", "student_registration", "student_vle", "vle")

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir
        self._raw: dict[str, DataFrame] = {}
        self._views: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = read_raw(self._spark, self._dir, name)
        return self._raw[name]

    def _enrol(self) -> DataFrame:
        if "_enrol" not in self._views:
            self._views["_enrol"] = enrolments(self.raw("customer"))
        return self._views["_enrol"]

    def _build(self, name: str) -> DataFrame:
        if name == "student_info":
            return student_info(self._enrol(), self.raw("nation"), self.raw("region"))
        if name == "courses":
            return courses(self._enrol())
        if name == "assessments":
            return assessments(self.raw("part"))
        if name == "student_assessment":
            return student_assessment(self.raw("lineitem"), self.raw("orders"))
        if name == "student_registration":
            return student_registration(self._enrol())
        if name == "student_vle":
            return student_vle(self.raw("events"), self._enrol())
        if name == "vle":
            return vle(self["student_vle"])
        raise KeyError(name)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            raise KeyError(name)
        if name not in self._views:
            self._views[name] = self._build(name)
        return self._views[name]

    def __iter__(self):
        return iter(self.NAMES)

    def __len__(self) -> int:
        return len(self.NAMES)


def fixture_tables(spark: SparkSession, sf_dir: str) -> FixtureTables:
    """The course tables over one scale-factor folder (lazy plans, built on use)."""
    return FixtureTables(spark, sf_dir)


# The same seven definitions for DuckDB (the oracle engine).  Unreferenced
# CTEs are never evaluated.
FIXTURE_CTES = """
enrol AS (
  SELECT c_mktsegment AS code_module,
         CASE WHEN c_custkey % 2 = 0 THEN '2013J' ELSE '2014B' END AS code_presentation,
         c_custkey AS id_student, 0 AS again, c_custkey, c_nationkey, c_acctbal
  FROM customer
  UNION ALL
  SELECT c_mktsegment, '2014J', c_custkey, 1, c_custkey, c_nationkey, c_acctbal
  FROM customer WHERE c_custkey % 4 = 0
),
student_info AS (
  SELECT code_module, code_presentation, id_student,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         r_name AS region,
         CASE c_custkey % 5 WHEN 0 THEN 'A Level' WHEN 1 THEN 'HE' WHEN 2 THEN 'Lower'
              WHEN 3 THEN 'None' ELSE 'PG' END AS highest_education,
         CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_acctbal < 2000 THEN '0-20%'
              WHEN c_acctbal < 5000 THEN '20-40%' ELSE '40-60%' END AS imd_band,
         CASE c_custkey % 3 WHEN 0 THEN '0-35' WHEN 1 THEN '35-55' ELSE '55<=' END AS age_band,
         CAST(c_custkey % 4 + again AS INTEGER) AS num_of_prev_attempts,
         CAST(30 * (1 + c_custkey % 6) AS INTEGER) AS studied_credits,
         CASE WHEN c_custkey % 9 = 0 THEN 'Y' ELSE 'N' END AS disability,
         CASE WHEN (c_custkey + 3 * again) % 10 < 4 THEN 'Pass'
              WHEN (c_custkey + 3 * again) % 10 < 5 THEN 'Distinction'
              WHEN (c_custkey + 3 * again) % 10 < 7 THEN 'Fail'
              ELSE 'Withdrawn' END AS final_result
  FROM enrol JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
courses AS (
  SELECT code_module, code_presentation,
         CAST(CASE code_presentation WHEN '2013J' THEN 28 WHEN '2014B' THEN 24 WHEN '2014J' THEN 30 END AS INTEGER)
           AS module_presentation_length
  FROM (SELECT DISTINCT code_module, code_presentation FROM enrol) d
),
assessments AS (
  SELECT CASE p_partkey % 5 WHEN 0 THEN 'AUTOMOBILE' WHEN 1 THEN 'BUILDING' WHEN 2 THEN 'FURNITURE'
              WHEN 3 THEN 'HOUSEHOLD' ELSE 'MACHINERY' END AS code_module,
         CASE p_size % 4 WHEN 0 THEN '2013J' WHEN 1 THEN '2014B' WHEN 2 THEN '2014J' ELSE '2012X' END
           AS code_presentation,
         p_partkey AS id_assessment, p_type AS assessment_type,
         CASE WHEN p_partkey % 7 = 0 THEN NULL
              WHEN p_partkey % 5 = 4 AND p_size % 4 = 2 THEN CAST(p_size + 20 AS DOUBLE)
              ELSE CAST(p_size AS DOUBLE) END AS date
  FROM part
),
student_assessment AS (
  SELECT CASE WHEN l_linenumber = 7 AND l_partkey % 10 = 0 THEN l_partkey + 1000000 ELSE l_partkey END
           AS id_assessment,
         o_custkey AS id_student,
         CAST(abs(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) % 40 AS INTEGER)
           AS date_submitted,
         CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS INTEGER) AS is_banked,
         CASE WHEN l_tax = 0.0 OR o_custkey % 19 = 0 THEN NULL ELSE CAST(2 * l_quantity AS DOUBLE) END AS score
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
student_vle AS (
  SELECT e.code_module, e.code_presentation, e.id_student,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS id_site,
         CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) - 5 AS INTEGER) AS date,
         CAST(floor(value) AS BIGINT) AS sum_click
  FROM events JOIN enrol e ON user_id = e.id_student AND again = CASE WHEN user_id % 4 = 0 THEN event_id % 2 ELSE 0 END
),
vle AS (
  SELECT id_site, code_module, code_presentation, 'resource' AS activity_type,
         CAST(NULLIF(floor(MIN(date) / 7.0), -1) AS INTEGER) AS week_from, CAST(floor(MAX(date) / 7.0) AS INTEGER) AS week_to
  FROM student_vle GROUP BY id_site, code_module, code_presentation
),
student_registration AS (
  SELECT code_module, code_presentation, id_student,
         CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(-(c_custkey % 200) AS DOUBLE) END AS date_registration,
         CASE WHEN (c_custkey + 3 * again) % 10 >= 7 THEN CAST(c_custkey % 60 AS DOUBLE) END AS date_unregistration
  FROM enrol WHERE c_custkey % 17 <> 0
)"""

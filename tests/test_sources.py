"""CSV / Parquet loading with pandas-style missing values, and sinks."""

import os
import tempfile

import pandas as pd

from tutorlens.sources import PANDAS_NA_TOKENS, read_table, write_table
from tutorlens.sources import schemas
from tutorlens.sources.readers import load_tables

CSV = """code_module,code_presentation,id_student,date_registration,date_unregistration
AAA,2013J,11391,-159,
AAA,2013J,28400,NA,
AAA,2013J,30268,NaN,12
"AA,A",2013J,31604,?,
AAA,2013J,32885,-176,NULL
"""


def _write(text):
    d = tempfile.mkdtemp(prefix="tutorlens-csv-")
    p = os.path.join(d, "studentRegistration.csv")
    with open(p, "w") as f:
        f.write(text)
    return d, p


def test_csv_na_tokens_like_pandas(spark):
    d, p = _write(CSV)
    df = read_table(spark, p, schemas.STUDENT_REGISTRATION, extra_na_tokens=("?",))
    got = df.orderBy("id_student").toPandas()
    want = pd.read_csv(p, na_values=["?"])
    assert list(got["code_module"]) == list(want["code_module"])
    assert got["date_registration"].isna().tolist() == want["date_registration"].isna().tolist()
    assert got["date_unregistration"].isna().tolist() == want["date_unregistration"].isna().tolist()
    assert got["date_registration"].dropna().tolist() == want["date_registration"].dropna().tolist()


def test_question_mark_is_not_missing_by_default(spark):
    d, p = _write("id_student,sum_click\n1,5\n2,?\n")
    df = read_table(spark, p, schemas.STUDENT_VLE_SMALL)
    raised = False
    try:
        df.collect()
    except Exception:  # noqa: BLE001 - ANSI cast of '?' to bigint fails, as pandas would keep text
        raised = True
    assert raised


def test_parquet_roundtrip_and_registry(spark):
    d, p = _write(CSV)
    reg = read_table(spark, p, schemas.STUDENT_REGISTRATION, extra_na_tokens=("?",))
    out = tempfile.mkdtemp(prefix="tutorlens-out-")
    write_table(reg, os.path.join(out, "studentRegistration.parquet"))
    back = load_tables(spark, out, fmt="parquet", names=["student_registration"])["student_registration"]
    assert back.schema == reg.schema
    assert back.count() == 5
    write_table(reg.select("id_student"), os.path.join(out, "csv_out"), fmt="csv")
    files = [f for f in os.listdir(os.path.join(out, "csv_out")) if f.endswith(".csv")]
    assert files
    assert open(os.path.join(out, "csv_out", files[0])).readline().strip() == "id_student"


def test_csv_files_give_the_same_master_as_parquet_views(spark, sf001):
    """The published file layout, read through the CSV loader, end to end."""
    from tutorlens.plans import flows
    from tutorlens.sources.fixtures import fixture_tables

    t = fixture_tables(spark, sf001)
    folder = tempfile.mkdtemp(prefix="tutorlens-oulad-")
    for name, df in t.items():
        stem, _ = schemas.TABLES[name]
        write_table(df.coalesce(1), os.path.join(folder, f"{stem}.csv"), fmt="csv")
    # The fixture has an education level literally called 'None', which pandas'
    # read_csv (and so this loader, by default) reads as missing.
    default = load_tables(spark, folder, fmt="csv", names=["student_info"])["student_info"]
    assert default.where("highest_education IS NULL").count() == t["student_info"].where(
        "highest_education = 'None'"
    ).count() > 0
    tokens = [x for x in PANDAS_NA_TOKENS if x != "None"]
    loaded = load_tables(spark, folder, fmt="csv", names=list(t), na_tokens=tokens)
    a = flows.early_master(loaded, 14)
    b = flows.early_master(t, 14)
    # Same names and types (the loader marks every column nullable).
    assert [(f.name, f.dataType) for f in a.schema] == [(f.name, f.dataType) for f in b.schema]
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_job_entry_point(spark, sf001):
    from tutorlens.__main__ import main
    from tutorlens.sources.fixtures import fixture_tables

    t = fixture_tables(spark, sf001)
    folder = tempfile.mkdtemp(prefix="tutorlens-job-in-")
    for name, df in t.items():
        stem, _ = schemas.TABLES[name]
        write_table(df, os.path.join(folder, f"{stem}.parquet"))
    out = tempfile.mkdtemp(prefix="tutorlens-job-out-")
    main(["early", "--input", folder, "--format", "parquet", "--output", out, "--cutoff", "14"])
    frame = spark.read.parquet(os.path.join(out, "training_frame"))
    assert set(frame.select("split").distinct().toPandas()["split"]) == {"train", "validation", "test"}
    report = {r.item: r.value for r in spark.read.parquet(os.path.join(out, "report")).collect()}
    assert report["tree_rows"] == frame.count()


def test_parquet_keeps_the_text_none_and_pushes_filters(spark):
    import contextlib
    import io

    import pytest

    out = os.path.join(tempfile.mkdtemp(prefix="tutorlens-typed-"), "studentVle.parquet")
    rows = [("None", "2013J", 1, 2, 3, 4), (None, "2014B", 1, 2, 3, 4)]
    spark.createDataFrame(rows, schemas.STUDENT_VLE).write.parquet(out)
    df = read_table(spark, out, schemas.STUDENT_VLE, fmt="parquet")
    assert sorted(r.code_module or "" for r in df.collect()) == ["", "None"]
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.where("code_module = 'None'").explain()
    assert "EqualTo(code_module,None)" in text.getvalue()
    spark.createDataFrame(rows, schemas.STUDENT_VLE).drop("code_presentation").write.parquet(out + "2")
    with pytest.raises(ValueError, match="code_presentation"):
        read_table(spark, out + "2", schemas.STUDENT_VLE, fmt="parquet")


def test_explore_reads_the_click_log_once(spark, sf001):
    from tutorlens.plans import flows
    from tutorlens.sources.fixtures import fixture_tables

    folder = tempfile.mkdtemp(prefix="tutorlens-small-")
    reports = flows.explore(fixture_tables(spark, sf001), folder)
    raw = [n for n, df in reports.items() if any(f.endswith("events.parquet") for f in df.inputFiles())]
    # the site table comes from the log too; no other report reads it
    assert raw and set(raw) <= {"profile", "previews", "null_counts"}
    assert any(folder in f for f in reports["histogram_clicks"].inputFiles())
    # (the summaries are small local tables by now)
    assert {r["table_name"] for r in reports["describe"].collect()} == {"studentInfo", "studentAssessment", "studentVle_small"}


def test_explore_builds_only_the_reports_asked_for(spark, sf001, tmp_path):
    import pytest

    from tutorlens.plans import flows, queries
    from tutorlens.sources.fixtures import fixture_tables

    tables, folder = fixture_tables(spark, sf001), str(tmp_path / "small")
    assert list(flows.REPORTS) == list(queries.EXPLORED)
    got = flows.explore(tables, folder, ["value_counts", "category_by_result"])
    # neither reads clicks: no totals are written
    assert list(got) == ["value_counts", "category_by_result"] and not os.path.exists(folder)
    got = flows.explore(tables, folder, ["engagement_by_result"])
    assert list(got) == ["engagement_by_result"] and os.path.exists(folder)
    assert flows.explore(tables, folder, []) == {}
    with pytest.raises(ValueError, match="no such report: scores"):
        flows.explore(tables, folder, ["scores"])

"""Spark query vs DuckDB oracle comparison (what the correctness gate checks).

Usable from pytest and as a script:
    python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duckdb_conn(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    import pandas as pd

    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def spark_pandas(df):
    """``toPandas``, with whole numbers kept whole where some are missing."""
    pdf = df.toPandas()
    for field in df.schema:
        if field.dataType.typeName() in ("integer", "long") and pdf[field.name].dtype == float:
            pdf[field.name] = pdf[field.name].astype("Int64")
    return pdf


def rows_of(pdf):
    cols = sorted(pdf.columns)
    pdf = pdf[cols]
    out = []
    for rec in pdf.itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return cols, out


def _key(row):
    return tuple((0, "") if v is None else (1, str(v)) for v in row)


def compare(spark_pdf, duck_pdf, rel_tol=0.0):
    """Return (ok, message). Exact match unless rel_tol > 0."""
    sc, sr = rows_of(spark_pdf)
    dc, dr = rows_of(duck_pdf)
    if sc != dc:
        return False, f"columns differ: spark={sc} duck={dc}"
    if len(sr) != len(dr):
        return False, f"row count spark={len(sr)} duck={len(dr)}"
    sr.sort(key=_key)
    dr.sort(key=_key)
    bad = 0
    first = None
    for a, b in zip(sr, dr):
        for x, y in zip(a, b):
            if x == y:
                continue
            if isinstance(x, float) and isinstance(y, float) and rel_tol > 0:
                if math.isclose(x, y, rel_tol=rel_tol, abs_tol=rel_tol):
                    continue
            bad += 1
            if first is None:
                first = (a, b)
            break
    if bad:
        return False, f"{bad} rows differ; first spark={first[0]} duck={first[1]}"
    return True, f"{len(sr)} rows match"


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as entry

    from tutorlens.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = local_session()
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duckdb_conn(sf_dir)
    failures = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            spdf = spark_pandas(qs[name](spark, sf_dir))
        except Exception as exc:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(exc).__name__}: {str(exc)[:400]}")
            failures += 1
            continue
        t1 = time.time()
        if name not in sqls:
            print(f"ROWS {name}: {len(spdf)} rows (no oracle) spark={t1 - t0:.1f}s")
            continue
        try:
            dpdf = con.execute(sqls[name]).df()
        except Exception as exc:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(exc)[:400]}")
            failures += 1
            continue
        ok, msg = compare(spdf, dpdf)
        if not ok:
            ok2, msg2 = compare(spdf, dpdf, rel_tol=1e-9)
            msg += f" | within 1e-9: {ok2}"
            failures += 1
        print(f"{'OK  ' if ok else 'FAIL'} {name}: {msg} spark={t1 - t0:.1f}s")
    print(f"failures: {failures}")
    spark.stop()
    return failures


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)

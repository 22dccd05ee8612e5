"""Rows of a Spark frame and of a DuckDB query, with their own types."""

from oracle_compare import duckdb_conn


def rows(df):
    """Rows with columns by name, in an order that does not depend on the engine."""
    names = sorted(df.columns)
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def oracle_rows(sql, sf_dir):
    got = duckdb_conn(sf_dir).execute(sql)
    names = [d[0] for d in got.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(r[k] for k in order) for r in got.fetchall()), key=repr)

from tutorlens.sources.fixtures import fixture_tables
from tutorlens.sources.readers import PANDAS_NA_TOKENS, bad_row_report, load_tables, read_parted, read_table, write_table

__all__ = ["PANDAS_NA_TOKENS", "bad_row_report", "fixture_tables", "load_tables", "read_parted", "read_table", "write_table"]

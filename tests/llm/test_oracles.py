"""Registered corpus queries against their SQL, and their shared edge cases."""

import pytest
from exact_rows import oracle_rows, rows
from pyspark.sql import functions as F

from tutorlens.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, sf001, name):
    assert rows(queries.QUERIES[name](spark, sf001)) == oracle_rows(queries.ORACLE_SQL[name], sf001)


CONVERSATIONS = [
    (1, 0, "user", "Hello there.\nHow are   you?\n\nSecond paragraph"),
    (1, 1, "assistant", "> Hello there.\n> how are you?\n\nFine."),
    (1, 2, "user", "Another"),
    (1, 3, "user", ">> Hello there.\n>> How are you?\n> Fine.\nGood"),
    (1, 4, "u", "> second paragraph\nyes"),
    (1, 4, "u", "same turn"),
    (1, 4, "u", "same turn"),
    (1, 9000, "u", " > yes\r\n> Another\nfar"),
    (1, 9001, "u", "> nobody said\nno"),
    (2, 0, None, None),
    (2, 5, "a", ""),
    (None, 3, "a", "> x"),
    (3, None, "a", "> x\ny"),
    (4, 0, "a", "one\ntwo\nthree\nfour\n\nfive"),
    (4, 1, "b", "two\nthree\nfour"),
    (4, 2, "a", "nothing"),
    (4, 3, "b", "> two\n> three\nsome lines"),
    (4, 4, "b", "> three\n> Five\n> one\nof several paragraphs\n>> two\n>> nothing"),
    (4, 5, "b", ">\n> \t\n>\t>x\n>>\n> two\n"),
    (4, 5, "b", "> two\n> three\nanother of the same turn"),
    (4, 6, "c", "> > two\n> > two\n>>three\r\n \n\nend"),
    (5, 1, "c", "> > two\n> > three\r\n \n\nend"),
] + [(7, t, "u", "again" if t % 2 else "> again\nsure") for t in range(300)]


def test_quotation_linking_matches_sql(spark, sf001, tmp_path):
    df = spark.createDataFrame(CONVERSATIONS, "conv_id long, turn long, role string, text string")
    df.withColumns({"row_id": F.lit("x"), "level": F.lit(1)}).coalesce(1).write.parquet(str(tmp_path / "c"))
    (part,) = (tmp_path / "c").glob("part-*")
    part.rename(tmp_path / "conversations.parquet")
    from oracle_compare import TABLES

    for t in TABLES:
        if t != "conversations":
            (tmp_path / f"{t}.parquet").symlink_to(f"{sf001}/{t}.parquet")
    name = "op8_quotation_linking"
    got = rows(queries.QUERIES[name](spark, str(tmp_path)))
    assert got == oracle_rows(queries.ORACLE_SQL[name], str(tmp_path))
    assert sum(1 for r in got if r[2]) >= 150  # linked


def test_quotation_linking_takes_any_number_of_marks(spark):
    from tutorlens.llm.quotation_linking import link

    n = 1_000_000
    rows = [(1, 0, "u", "x"), (1, 1, "u", ">" * n + " x"), (1, 2, "u", "> " * n), (1, 3, "u", " " * n + "> x"), (1, 4, "u", "\n" * n + ">x\n" * 3)]
    rows += [(1, 5, "u", "\n".join(["a", "> b"] * 20_000)), (1, 6, "u", " " * n), (1, 7, "u", ">\t" * n + "\nx")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["turn"]: r for r in link(df).collect()}
    assert [got[t]["quote_depth"] for t in range(8)] == [0, n, 0, 1, 1, 1, 0, 0]
    assert [got[t]["n_quotes"] for t in range(8)] == [0, 1, 0, 1, 1, 20_000, 0, 0]
    assert [got[t]["reply_to"] for t in range(8)] == [None, 0, 1, 0, 0, 4, 5, 6]
    assert got[7]["clean_text"] == "x" and got[5]["clean_text"].count("a") == 20_000


def test_formatted_conversations(spark):
    from tutorlens.llm.quotation_linking import formatted

    df = spark.createDataFrame(CONVERSATIONS, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r["messages"] for r in formatted(df).collect()}
    assert [m["position"] for m in got[7]] == list(range(1, 301))
    assert not any(m["text"].lstrip().startswith(">") for c in got.values() for m in c)


def test_quotation_linking_of_nothing(spark):
    from tutorlens.llm.quotation_linking import link

    assert link(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []

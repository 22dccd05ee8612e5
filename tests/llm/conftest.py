import pytest


@pytest.fixture(scope="session")
def table_of(spark):
    """A documents table with odd rows and clashing extra columns."""

    def build(pairs):
        names = "doc_id long, text string, lang string, fp long, sha string, row string, fingerprint string, label int, rank long, cell long"
        return spark.createDataFrame([(i, t, "en", 1, "x", "y", "z", 1, 2, 3) for i, t in pairs], names)

    return build

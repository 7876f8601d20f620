import pytest

from vitals.llm.tables import ship

ROOT = "/root/testdata"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def documents(spark):
    """Rows of (doc_id, text) with an extra column."""

    def build(rows):
        return spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, extra string")

    return build

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (id, text) pairs, over several partitions."""
    def build(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(rows, schema).repartition(3)
    return build


@pytest.fixture(scope="session")
def small(spark):
    from lodestar.llm.common import read_table
    from tests.conftest import SF_SMALL
    return lambda name: read_table(spark, SF_SMALL, name)

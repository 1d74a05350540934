import pytest

from tests.oracle_run import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session()
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("staging")))
    yield spark
    spark.stop()


@pytest.fixture
def table(spark):
    def make(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make


def plain(df, *columns):
    """Sorted tuples of a DataFrame's rows."""
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)

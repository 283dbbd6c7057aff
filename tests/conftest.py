from datetime import datetime

import pytest

from cartwheel.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores="4", shuffle_partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Build a table from a schema string and rows."""
    def build(schema, *rows):
        return spark.createDataFrame(list(rows), schema)
    return build


def ts(text):
    return datetime.fromisoformat(text)


def rows_of(df, *order):
    """Rows as dicts in a fixed order."""
    rows = [r.asDict() for r in df.collect()]
    return sorted(rows, key=lambda r: tuple(str(r[c]) for c in (order or r)))


def by_key(df, key):
    return {r[key]: r.asDict() for r in df.collect()}

import os
import sys

import pytest

_HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(_HERE), _HERE]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from halfhourly.session import get_spark
    session = get_spark("tests", "local[8]", **{"spark.sql.shuffle.partitions": "4",
                                                "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
                                                "spark.log.level": "ERROR"})
    yield session
    session.stop()


@pytest.fixture
def rows():
    """A DataFrame's rows as a sorted list of tuples."""
    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)
    return collect

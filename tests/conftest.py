import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oppflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return local_session(4, **{
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.driver.memory": "4g",
        "spark.sql.shuffle.partitions": "4",
    })


@pytest.fixture
def evaluate(spark):
    """Evaluate a column expression over one row of named texts."""
    def run(column_of, **values):
        names = list(values)
        df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} string" for n in names))
        return df.select(column_of.alias("x")).first().x
    return run

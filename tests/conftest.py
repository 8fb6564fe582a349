import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from floortally import session  # noqa: E402


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    settings = {"spark.ui.enabled": "false", "spark.driver.memory": "6g", "spark.sql.execution.arrow.pyspark.enabled": "true"}
    built = session.build("tests", "local[8]", 4, **settings)
    built.sparkContext.setLogLevel("OFF")
    yield built
    built.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Values of expressions over rows of (typed) inputs."""

    def run(rows, schema, *columns):
        found = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"_i int, {schema}")
        return [tuple(r)[1:] for r in found.select("_i", *columns).orderBy("_i").collect()]

    return run

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakemart.session import build_session  # noqa: E402

# Figures of sample exports, tested where there are some; tests/test_golden.py has a small shop of its own.
collect_ignore = [] if os.environ.get("LAKEMART_SAMPLES") else ["test_samples.py"]

TESTDATA = os.environ.get("LAKEMART_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="lakemart-tests-")
    session = build_session(
        "lakemart-tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": f"{folder}/checkpoints",
            "spark.sql.warehouse.dir": f"{folder}/catalog",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def testdata():
    if not os.path.isdir(TESTDATA):
        pytest.skip("no test tables here")
    return TESTDATA


@pytest.fixture(scope="session")
def warehouse(spark, testdata):
    from lakemart.plans.warehouse import Warehouse

    return Warehouse(spark, testdata)


@pytest.fixture
def values(spark):
    """Rows of an expression over hand-written rows, in input order."""

    def run(rows, schema, *columns):
        df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"_i int, {schema}")
        result = df.select("_i", *columns).orderBy("_i").collect()
        return [tuple(r)[1] if len(columns) == 1 else tuple(r)[1:] for r in result]

    return run

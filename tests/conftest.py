import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from daybook.session import build_session  # noqa: E402


# Started on import: test modules hold column expressions, which need a session.
FOLDER = tempfile.mkdtemp(prefix="daybook-tests-")
SESSION = build_session(
    "tests",
    "local[8]",
    **{
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "6g",
        "spark.sql.maxMetadataStringLength": "1000",
        "spark.sql.warehouse.dir": f"{FOLDER}/warehouse",
        "spark.checkpoint.dir": f"{FOLDER}/checkpoints",
    },
)
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture
def values(spark):
    """Evaluate one expression over a column ``v`` and return the results in order."""

    def run(items, ddl, expression):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {ddl}")
        return [r[0] for r in rows.orderBy("i").select(expression).collect()]

    return run

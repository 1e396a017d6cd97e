import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tuneweave.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of a column expression over one row."""

    def run(expression, **columns):
        schema = ", ".join(f"{k} {'long' if isinstance(v, int) else 'string'}" for k, v in columns.items())
        df = spark.createDataFrame([tuple(columns.values())], schema)
        return df.select(expression.alias("v")).first()["v"]

    return run

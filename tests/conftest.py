import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from grantlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "grantlens-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": 4,
            "spark.sql.warehouse.dir": f"file://{tmp_path_factory.mktemp('warehouse')}",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate one column over one row of named values."""

    def run(column, schema, *values):
        return spark.createDataFrame([values], schema).select(column.alias("out")).first()["out"]

    return run

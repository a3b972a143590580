import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pricehouse.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "pricehouse-tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def stage_rows(spark):
    """Staged rows from short tuples; file and row number are added."""

    def build(rows, file="/in/A.csv"):
        columns = ["symbol", "date_str", "open_str", "high_str", "low_str", "close_str", "volume_str"]
        full = [(*r, None, file, i) for i, r in enumerate(rows, 1)]
        schema = ", ".join(f"{c} STRING" for c in [*columns, "adj_close_str", "source_file"])
        return spark.createDataFrame(full, schema + ", row_number BIGINT")

    return build

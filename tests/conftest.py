import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lakeops.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.sql.warehouse.dir": str(root / "wh"),
           "spark.checkpoint.dir": str(root / "cp"), "spark.driver.memory": "4g",
           "spark.log.level": "OFF"})
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""
    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)
    return collect

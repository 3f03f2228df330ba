import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickloom.session import build_session  # noqa: E402
from clickloom.streaming.stateful import use_rocksdb  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "clickloom-tests",
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.checkpoint.dir": str(folder / "checkpoints"),
            "spark.driver.extraJavaOptions": f"-Dderby.system.home={folder}",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    use_rocksdb(session)
    yield session
    session.stop()


@pytest.fixture()
def sf():
    return SF


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted(tuple(r) for r in picked.collect())

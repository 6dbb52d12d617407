import os
import sys
import uuid
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from coldshelf.session import build_session

    home = tmp_path_factory.mktemp("spark")
    os.chdir(home)
    session = build_session(
        "tests",
        {
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": str(home / "warehouse"),
            "spark.checkpoint.dir": str(home / "shared"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def name():
    """A catalog name no other test uses."""
    return f"t_{uuid.uuid4().hex[:10]}"


@pytest.fixture
def source(spark, name):
    """An embedded database of this process, empty at first."""
    from workload.data import embedded

    return embedded(spark, name)

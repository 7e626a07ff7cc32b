import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from chainmart import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "6g",
        "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}",
    }
    session = get_spark("tests", "local[8]", **conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def write_lines(tmp_path):
    """Write a text file below a fresh folder and return its path."""

    def write(name, *lines):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join(lines) + "\n")
        return str(path)

    return write

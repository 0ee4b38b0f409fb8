import os

import pytest

from voxloom.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "voxloom-tests",
        **{
            "spark.master": f"local[{os.environ.get('TEST_CPUS', '8')}]",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

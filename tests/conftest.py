from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from shaftline.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = build_session(
        "tests",
        {
            "spark.master": "local[8]",
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as plain tuples, in no particular order."""

    def collect(df) -> list[tuple]:
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect

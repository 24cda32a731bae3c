import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tidemark-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def split_everything(spark):
    """Every repeated key counts as heavy."""
    spark.conf.set("tidemark.heavy.minRows", "1")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    yield
    spark.conf.unset("tidemark.heavy.minRows")
    spark.conf.set("spark.sql.shuffle.partitions", "8")

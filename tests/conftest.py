from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rillstone import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests",
        master="local[8]",
        shuffle_partitions=4,
        rocksdb=False,
        extra={
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(shared),
            "spark.driver.memory": "4g",
            # Local files without checksum files: half the time per file.
            "spark.hadoop.fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
        },
        log_level="ERROR",
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return SF_DIR

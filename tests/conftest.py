from __future__ import annotations

import io
import os
import sys
from contextlib import redirect_stdout

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def plan_of():
    def text(df: DataFrame, mode: str = "simple") -> str:
        out = io.StringIO()
        with redirect_stdout(out):
            df.explain(mode=mode)
        return out.getvalue()

    return text


@pytest.fixture
def csv_file(tmp_path):
    def write(*lines: str, name: str = "in.csv") -> str:
        path = tmp_path / name
        path.write_text("\n".join(lines) + "\n")
        return str(path)

    return write

from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("eocube-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def cells(spark):
    """Build a cell table from a list of rows of values; None is missing, ... is absent."""

    def build(rows, name="v", y0=0, x0=0):
        flat = [
            (y + y0, x + x0, None if v is None else float(v))
            for y, row in enumerate(rows)
            for x, v in enumerate(row)
            if v is not ...
        ]
        return spark.createDataFrame(flat, f"y_idx bigint, x_idx bigint, {name} double")

    return build


def grid(df, name="v"):
    """A cell table as {(y, x): value}."""
    return {(r["y_idx"], r["x_idx"]): r[name] for r in df.collect()}

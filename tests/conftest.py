from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import SparkSession

from candlelake.session import build_session


def new_session() -> SparkSession:
    spark = build_session(
        "candlelake-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="candlelake-warehouse-"),
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = new_session()
    yield session
    session.stop()

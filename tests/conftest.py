from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.ui.showConsoleProgress": "false", "spark.log.level": "ERROR", "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """The value of a Column expression over one row of named literals."""
    from pyspark.sql import functions as F

    def value(expression, **columns):
        frame = spark.range(1).select(*[(F.lit(v) if v is not None else F.lit(None).cast("string")).alias(k) for k, v in columns.items()])
        return frame.select(expression.alias("x")).first()[0]

    return value

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"  # for Python workers


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from emberlog.config import Settings

    session = (
        SparkSession.builder.master("local[4]")
        .config(map=Settings().spark_conf() | {
            "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "3g",
            "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        })
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark():
    from citeloom.session import SETTINGS
    from pyspark.sql import SparkSession

    settings = SETTINGS | {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g", "spark.default.parallelism": "4"}
    s = SparkSession.builder.master("local[4]").config(map=settings).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()

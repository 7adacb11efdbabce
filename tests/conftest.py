import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(__file__)), os.path.dirname(__file__)]


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    conf = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "4", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "6g"}
    session = SparkSession.builder.master("local[8]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session

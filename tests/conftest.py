import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from sentispark.session import DEFAULT_CONF
    b = (SparkSession.builder.master("local[4]").appName("sentispark-tests")
         .config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "8g"))
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sentispark-test-ckpt-"))
    yield s
    s.stop()

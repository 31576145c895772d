import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import configure

    session = (
        SparkSession.builder.master("local[4]").appName("tidemark-tests")
        .config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return configure(session)

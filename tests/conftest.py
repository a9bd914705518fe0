import os
import tempfile

import pytest
from pyspark.sql import SparkSession

from tillstream.session import tune


def build_session() -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="tillstream-tests-")
    spark = (SparkSession.builder.master("local[8]").appName("tillstream-tests")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "4g")
             .config("spark.checkpoint.dir", f"{scratch}/shared")
             .config("spark.local.dir", f"{scratch}/local")
             .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


@pytest.fixture(scope="session")
def spark():
    session = build_session()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

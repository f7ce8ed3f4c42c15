import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from panelspark.session import BASE_CONF

    builder = SparkSession.builder.master("local[*]").appName("panelspark-tests")
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    session = builder.config("spark.sql.shuffle.partitions", "8").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    # tests run locally: the checkpoint folder is unset, so pick our own
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="panelspark-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck_small():
    from panelspark.oracle.compare import duckdb_connection

    return duckdb_connection(SF_SMALL)


@pytest.fixture(scope="session")
def duck_oracle():
    from panelspark.oracle.compare import duckdb_connection

    return duckdb_connection(SF_ORACLE)

import os
import sys

import duckdb
import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tallyframe.plans.session import tune  # noqa: E402
from tallyframe.sources.catalog import GIVEN  # noqa: E402
from tallyframe.sources.stored import clear_scratch  # noqa: E402

DATA = os.environ.get("TALLYFRAME_DATA", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse"))).config("spark.driver.memory", "8g").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    clear_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def oracle():
    connection = duckdb.connect()
    for name in GIVEN:
        connection.execute(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return connection


@pytest.fixture(scope="session")
def data():
    return DATA

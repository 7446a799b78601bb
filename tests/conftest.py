import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
               .config("spark.driver.memory", "6g").config("spark.ui.enabled", "false")
               .config("spark.sql.maxMetadataStringLength", "10000").config("spark.log.level", "ERROR").getOrCreate())
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


def values(df, *columns):
    """Rows of ``df`` as sorted tuples."""
    rows = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))

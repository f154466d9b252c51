import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[4]").appName("rankloom-tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="rankloom-"))
               .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="rankloom-"))
               .config("spark.driver.memory", "4g")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def micro(spark):
    """Five-line collection whose expected values are worked out by hand."""
    from rankloom import build_index

    docs = spark.createDataFrame(
        [(1, "alpha beta beta"), (2, "beta gamma"), (3, "alpha alpha gamma delta"),
         (4, "delta epsilon zeta eta theta")], "doc_id bigint, contents string")
    queries = spark.createDataFrame(
        [(1, "Alpha beta"), (2, "delta"), (3, "omega")], "query_id int, text string")
    qrels = spark.createDataFrame([(1, 1), (1, 3), (2, 4)], "query_id int, doc_id bigint")
    return build_index(docs), queries, qrels

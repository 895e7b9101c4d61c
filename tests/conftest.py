import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from signalbase.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("signalbase-tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Apply a column function to a list of texts: values(fn, [..]) -> [..]."""
    from pyspark.sql import functions as F

    def apply(fn, texts, type_="string"):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, s {type_}")
        return [r[0] for r in df.orderBy("i").select(fn(F.col("s"))).collect()]
    return apply

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cardlens.session import build_session
    s = build_session("local[4]", shuffle_partitions=8, extra_conf={"spark.driver.memory": "6g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


CARD_COLS = ["S1", "C1", "S2", "C2", "S3", "C3", "S4", "C4", "S5", "C5"]


def with_id(spark, rows, cols):
    """A DataFrame of fixture rows with an explicit row id, so tests join on it instead of order."""
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], ["row_id", *cols])


def by_id(df, col):
    return {r["row_id"]: r[col] for r in df.select("row_id", col).collect()}

import datetime
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskweave import session  # noqa: E402

AS_OF = "2024-02-01 00:00:00"
NOW = datetime.datetime(2024, 2, 1)


def ago(days):
    return None if days is None else NOW - datetime.timedelta(days=days)


@pytest.fixture(scope="session")
def spark():
    s = session.build("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, *cols):
    return [tuple(r) for r in (df.select(*cols) if cols else df).collect()]

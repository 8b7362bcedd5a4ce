import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tramline.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """``frame("a STRING, b INT", (1, 2), …)``: a small DataFrame."""

    def build(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return build


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)

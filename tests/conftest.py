import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from inkwell.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def many_partitions(spark):
    """Keep small shuffles in several partitions, as large ones are."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield spark
    spark.conf.unset(name)


@pytest.fixture(scope="session")
def toy_reviews(spark):
    from inkwell.schema import REVIEW

    rows = [
        ("u1", "2017-08-30", [["0", "Hello  there."], ["1", "He's dead, Jim!"], ["0", "Bye."]], 5, True, "b1", "r1"),
        ("u2", "2017-08-31", [["0", "..."]], 3, False, "b2", "r2"),
        ("u2", "2017-08-31", [], 3, False, "b2", "r3"),
        ("u3", None, [["0", None], ["0", "Fine"], [None, "No class"], ["1"]], 1, None, None, "r4"),
    ]
    return spark.createDataFrame(rows, REVIEW)

import os
import sys
import time
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]

os.environ["TZ"] = "UTC"  # collected timestamps are local ones
time.tzset()

from dewpoint import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session.build(
        "tests",
        master="local[8]",
        conf={
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    yield spark
    spark.stop()


@pytest.fixture
def rule_file(tmp_path):
    """The shipped rules as a CSV file."""
    path = tmp_path / "rules.csv"
    path.write_text(
        "id,humidity_min,humidity_max,temperature_min,temperature_max,code,message\n"
        "1,0,40,-999,-999,101,It's too dry\n"
        "2,60,100,-999,-999,102,It's too wet\n"
        "3,-999,-999,-300,30,103,It's too cold\n"
        "4,-999,-999,40,300,104,It's too hot\n"
    )
    return str(path)

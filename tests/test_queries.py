import pytest

import __spark_entry__ as driver
from oracle import differences

SF_DIR = "/root/testdata/sf0.001"
# Queries for training data have tests of their own.
MORE = set(driver.llm.queries()) | {"pipeline"} if driver.llm else set()
NAMES = [name for name in driver.queries() if name not in MORE]


def test_every_query_has_sql():
    assert set(driver.oracle_sql()) - MORE == set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, name):
    query, sql = driver.queries()[name], driver.oracle_sql()[name]
    assert differences(spark, SF_DIR, query, sql) == []


def test_entry(spark):
    assert driver.entry(spark).count() == 1243 + 1180 + 1337 + 1367


def test_tables_may_be_folders_of_files(spark, tmp_path):
    """As they are at any size worth a cluster; the stream reads them too."""
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    events.repartition(5).write.parquet(str(tmp_path / "events.parquet"))
    for name in ("sliding_averages", "sliding_averages_stream"):
        found = driver.queries()[name](spark, str(tmp_path)).collect()
        assert sorted(found) == sorted(driver.queries()[name](spark, SF_DIR).collect())

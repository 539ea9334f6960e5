import compare
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


def test_every_oracle_has_its_query():
    assert set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare.differences(entry.queries()[name](spark, FOLDER), ORACLES[name], FOLDER) == []


@pytest.mark.parametrize("name", ["segment_clusters", "user_segments"])
def test_one_row_per_user(spark, name):
    found = entry.queries()[name](spark, FOLDER)
    assert found.count() == found.select("user_id").distinct().count() == 150


def test_entry(spark):
    assert entry.entry(spark).count() > 0

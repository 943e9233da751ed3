import os

import pytest

import __spark_entry__ as entry_point

SF = "/root/testdata/sf0.001"


def test_names_agree():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    assert len(entry_point.queries()) >= 70


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["journal", "type", "n"] and df.count() > 0

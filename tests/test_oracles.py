import pytest

from tests.check_oracles import compare, connect, entry_points

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(entry_points.queries()))
def test_query(spark, con, name):
    if name in entry_points.oracle_sql():
        assert compare(spark, con, SF, name) is None
    else:
        assert entry_points.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["resume_id", "position", "skill", "demand"] and df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())

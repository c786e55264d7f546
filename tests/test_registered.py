import pytest

import __spark_entry__ as E
from check_sql import connect, differences, type_differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(E.queries()))
def test_query_agrees_with_its_sql(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    assert rows
    if name in E.oracle_sql():
        res = con.execute(E.oracle_sql()[name])
        assert type_differences(df, res.description) == []
        assert differences(rows, df.columns, res.fetchall(), [d[0] for d in res.description]) is None


def test_entry(spark):
    assert E.entry(spark).count() > 0

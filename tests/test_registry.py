"""Every registered query against its SQL, on the smallest tables."""

import pytest

from compare import connect, normalized
from tidemill.registry import all_oracles, all_queries

SF = "/root/testdata/sf0.001"
# Python in the row path, and joins that pair every row with every row.
OUT_OF_PLACE = ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoopJoin")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(all_queries()) == set(all_oracles())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_its_sql(spark, duck, name):
    df = all_queries()[name](spark, SF)
    result = duck.execute(all_oracles()[name])
    names = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(names)
    want = normalized(names, result.fetchall())
    assert want, "an empty result would prove nothing"
    assert normalized(df.columns, [tuple(r) for r in df.collect()]) == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in OUT_OF_PLACE:
        assert operator not in plan

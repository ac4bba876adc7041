"""Every named query against its SQL, or for rows where there is none."""

import pytest
from conftest import SF
from oracle import compare, connect

from touchline.plans import QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    q = QUERIES[name]
    if q.sql is None:
        assert q(spark, SF).count() > 0
    else:
        assert compare(q, spark, SF, duck) is None


@pytest.mark.parametrize("name", ["rf_importance", "feature_scores"])
def test_importance_uses_all_rows(inputs, monkeypatch, name):
    """Whatever a classifier's bound on its rows is, the score tables are fitted on every row."""
    from touchline.operators import forest
    from touchline.plans import statistics

    seen, grow = [], forest.binned
    monkeypatch.setattr(forest, "binned", lambda df, *a: seen.append(df.count()) or grow(df, *a))
    monkeypatch.setattr(statistics, "fitted", lambda t, key, fit: fit())
    rows = QUERIES[name].build(inputs).collect()
    assert seen == [inputs.stored.count()]
    assert abs(sum(r.importance for r in rows) - 1) < 1e-9 and min(r.importance for r in rows) > 0

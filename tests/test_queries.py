import compare
import pytest

from strandloom.plans import catalog


@pytest.fixture(scope="module")
def duck(sf):
    return compare.views(sf)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_matches_sql(spark, sf, duck, name):
    compare.same(catalog.queries()[name](spark, sf), catalog.oracle_sql()[name], duck)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_runs(spark, sf, name):
    assert catalog.queries()[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

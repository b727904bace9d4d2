"""Every registered library query against its SQL twin, and that the others give rows."""

import pytest
from oracle import compare

from tillweave.plans import catalogue


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_twin(spark, sf_dir, name):
    compare(spark, sf_dir, catalogue.QUERIES[name], catalogue.SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_rows(spark, sf_dir, name):
    assert catalogue.QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

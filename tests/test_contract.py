"""The driver contract: keys, column names, schema stability."""
import pytest

import __spark_entry__ as entry
from fundscope.plans import catalog

SLOW = set(catalog.SEARCHES) | {"lr_plain", "model_matrix", "dt_search", "rf_search",
                                "svc_searched_predict"}


def test_oracle_keys_are_registered():
    assert set(catalog.ORACLE) <= set(catalog.QUERIES)


def test_query_names_avoid_reserved_words():
    for name in catalog.QUERIES:
        assert "pipeline" not in name and not name.startswith("op")


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - SLOW))
def test_columns_unique_and_named(spark, sf, name):
    cols = catalog.QUERIES[name](spark, sf).columns
    assert len(cols) == len(set(cols))
    assert all(c and "(" not in c for c in cols)


def test_entry_schema_is_stable(spark):
    a = entry.entry(spark).schema
    b = entry.entry(spark).schema
    assert a == b

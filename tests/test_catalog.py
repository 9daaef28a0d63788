"""Every registered query against its SQL."""

import pytest

from tests.conftest import rows_of
from tracewell import catalog


@pytest.mark.parametrize("name", list(catalog.oracle_sql()))
def test_query_equals_sql(spark, sf, duck, name):
    got = catalog.queries()[name](spark, sf).toPandas()
    want = duck.execute(catalog.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


def test_entry_registers_everything(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


def test_queries_without_sql(spark, sf):
    drawn = catalog.s8_synthetic_source(spark, sf).collect()
    assert len(drawn) == 32 and all(r["last_channel"] == 8 and 19 < r["last_time"] < 20 and 300 < r["n_spikes"] < 2_000 for r in drawn)
    assert sorted(drawn) == sorted(catalog.s8_synthetic_source(spark, sf).collect())
    assert set(catalog.queries()) - set(catalog.oracle_sql()) == {"s8_synthetic_source"}

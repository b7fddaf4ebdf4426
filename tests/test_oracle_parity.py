"""Every query with an oracle matches DuckDB at sf0.01 (row count, columns, values)."""

import pytest

from tarmac.plans.registry import ORACLE

from tables import SF01


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, duck, name):
    from compare import compare
    r = compare(spark, name, SF01, duck)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r

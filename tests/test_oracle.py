"""Every registered query against its oracle SQL on DuckDB (the driver's check, at sf0.001)."""

import os

import pytest
from conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test data missing")


def test_all_queries_match_oracle(spark):
    import __spark_entry__ as E
    from oracle_harness import compare, duck
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(SF_SMALL)
    bad = {}
    for k, fn in qs.items():
        sdf = fn(spark, SF_SMALL).toPandas()
        if k in sqls:
            ok, msg = compare(sdf, con.execute(sqls[k]).fetchdf())
            if not ok:
                bad[k] = msg
    assert not bad, bad
    assert set(sqls) <= set(qs)


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["order_date", "order_count", "total_amount", "avg_discount_per_order", "net_revenue"]

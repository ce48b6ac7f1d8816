"""Every registered query against its SQL statement on the smallest sample."""

import pytest
from compare import connect, differences

from __spark_entry__ import entry, oracle_sql, queries
from catalog import CLOCK
from millrace.plans.warehouse import TABLES, WAVES, Clock, Warehouse

FOLDER = "/root/testdata/sf0.001"
STATEMENTS = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", [n for n in queries() if n in STATEMENTS])
def test_query_equals_statement(spark, con, name):
    assert differences(queries()[name](spark, FOLDER), con, STATEMENTS[name]) == ""


@pytest.mark.parametrize("name", [n for n in queries() if n not in STATEMENTS])
def test_query_without_statement_returns_rows(spark, name):
    assert queries()[name](spark, FOLDER).count() > 0


def test_statements_belong_to_queries():
    assert set(STATEMENTS) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def test_waves_write_every_table(spark, con):
    wh = Warehouse(spark, FOLDER, Clock(now=CLOCK.now, pit_days=3))
    wh.build()
    assert {n for wave in WAVES for n in wave} == set(TABLES) == set(wh._written)
    for name in ("mart_unit_economics", "mv_customer_360", "agg_daily_sales"):
        assert differences(wh.table(name), con, STATEMENTS[name]) == ""

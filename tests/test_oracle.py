"""Every registered query equals its DuckDB twin (rows, columns, values)."""

import pytest

import __spark_entry__ as entry_mod
from compare import compare, duck
from conftest import SF_ORACLE

from tidemark.plans.catalog import QUERIES
from tidemark.plans.oracle import SQL as ORACLE

# Options next to the default they must differ from on these tables.
DIFFER = [("q02_gaps_adjacent", "q02_gaps"), ("q10_gaps_adjacent", "q10_gaps"),
          ("q05_compound_total_loss", "q05_compound"), ("bar_dedupe_unknown_exchange", "bar_dedupe"),
          ("dirty_bar_quality_filter", "bars"), ("dirty_quotes", "daily_quotes"), ("sq1_dirty_trades", "sq1_price_volatility"),
          ("sq2_dirty_snapshot", "sq2_market_sentiment"), ("sq5_dirty_snapshot", "sq5_vs_prev_close")]


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLE) <= set(entry_mod.oracle_sql())


@pytest.mark.parametrize("option, default", DIFFER)
def test_options_show_on_these_tables(con, option, default):
    def rows(name):
        found = con.sql(f"SELECT * FROM ({ORACLE[name]})")
        return sorted(map(repr, found.fetchall()))
    assert rows(option) != rows(default)


def test_every_quality_rule_fails_somewhere(con):
    found = con.sql(ORACLE["dirty_bar_quality_report"])
    assert all(v > 0 for v in found.fetchall()[0])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(QUERIES[name](spark, SF_ORACLE), con, ORACLE[name])
    assert res["ok"], res


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns == ["exchange_id", "exchange_name", "year", "ticker",
                          "yearly_return_pct", "return_rank"]

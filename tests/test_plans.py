"""Physical plans: pruned scans, pushed filters, no cross joins, pruning before shuffles."""

import re

import pytest

from commerce_lens.catalog.queries import named_queries
from tests.conftest import SMALL, plan

NO_ACTION = (
    "agg_sales_daily",
    "agg_sales_by_city",
    "agg_count_distinct",
    "agg_aspect_score_by_product",
    "review_aspect_geo",
    "left_join_chain",
    "row_number_rank",
    "update_from_join",
    "kde_2d",
    "pair_grid",
    "profile_columns",
    "histogram_20",
    "pivot_top_both",
)


@pytest.fixture(scope="module")
def plans(spark):
    """Plans with automatic broadcasts off, as they are for tables beyond the threshold."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield {name: plan(named_queries()[name](spark, SMALL)) for name in NO_ACTION}
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", NO_ACTION)
def test_no_cross_joins(plans, name):
    assert "CartesianProduct" not in plans[name]
    assert "BroadcastNestedLoopJoin" not in plans[name]


@pytest.mark.parametrize("name", ["agg_sales_daily", "agg_sales_by_city", "agg_aspect_score_by_product", "left_join_chain"])
def test_source_tables_are_not_broadcast(plans, name):
    assert "BroadcastExchange" not in plans[name]


def scans(text, table):
    return re.findall(rf"FileScan parquet \[([^\]]*)\][^\n]*{table}\.parquet", text)


def test_scans_read_only_needed_columns(plans):
    wide = scans(plans["agg_sales_daily"], "lineitem")
    assert wide and {re.sub(r"#\d+L?", "", c) for c in wide[0].split(",")} == {
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
    }
    assert not scans(plans["agg_sales_daily"], "documents")


def test_items_are_summed_before_the_join(plans):
    lines = plans["agg_sales_daily"].splitlines()
    scan = next(i for i, line in enumerate(lines) if "lineitem.parquet" in line)
    above = [line for line in lines[:scan] if line.index(line.strip(" :+-")) < lines[scan].index("FileScan")]
    first_exchange = max(i for i, line in enumerate(above) if "Exchange" in line)
    assert any("partial_sum" in line for line in above[first_exchange:])


def test_first_per_key_is_pruned_before_its_shuffle(plans):
    assert plans["agg_sales_daily"].count("row_number(), 1, Partial") == 2


def test_filters_reach_the_scan(plans):
    assert "PushedFilters: [IsNotNull(l_orderkey)" in plans["agg_aspect_score_by_product"]


def test_left_joins_read_each_table_once(plans):
    for name in ("lineitem", "orders", "events"):
        assert len(scans(plans["left_join_chain"], name)) == (2 if name == "events" else 1)


def test_distinct_counts_copy_no_rows(plans):
    assert "Expand" not in plans["agg_sales_by_city"] and "Expand" not in plans["agg_count_distinct"]
    # A row is merged into its word before the first shuffle.
    assert plans["agg_count_distinct"].count("partial_bit_or") == 2


def test_the_city_mart_reads_what_it_wrote_and_no_table_again(plans):
    assert not scans(plans["agg_sales_by_city"], "orders") and plans["agg_sales_by_city"].count("FileScan") == 2
    assert plans["agg_sales_by_city"].count("order_customers_") == 2

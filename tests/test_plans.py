"""Plan inspection: pruning and pushdown reach the scans, no cartesian
products, the fact table is never broadcast, skew-safe aggregation shapes."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def plan_of(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["a10_customer_features", "e3_describe", "w9_ecdf", "f1_trend_predictions",
                                  "a9_hour_day_pivot", "h3_box_stats", "g7_calinski_harabasz"])
def test_no_cartesian_product(spark, name):
    assert "CartesianProduct" not in plan_of(spark, name)


def test_line_view_prunes_and_never_broadcasts_lineitem(spark):
    p = plan_of(spark, "a10_customer_features")
    scan = [l for l in p.splitlines() if "lineitem.parquet" in l][0]
    assert "l_shipdate" not in scan and "l_tax" not in scan and "l_discount" not in scan
    assert "PushedFilters: [IsNotNull(l_orderkey), IsNotNull(l_partkey)]" in scan
    # the lineitem scan never sits under a BroadcastExchange
    lines = p.splitlines()
    idx = [i for i, l in enumerate(lines) if "lineitem.parquet" in l][0]
    depth = len(lines[idx]) - len(lines[idx].lstrip(" :+-"))
    for l in reversed(lines[:idx]):
        d = len(l) - len(l.lstrip(" :+-"))
        if d < depth:
            assert "BroadcastExchange" not in l
            depth = d


def test_country_filter_reaches_nation_scan(spark):
    p = plan_of(spark, "c16_filter_country")
    scan = [l for l in p.splitlines() if "nation.parquet" in l][0]
    assert "EqualTo(n_name,NATION_7)" in scan


def test_customer_features_aggregates_on_customer_and_product_first(spark):
    p = plan_of(spark, "a10_customer_features")
    assert "hashpartitioning(customer_id" in p and "stock_code" in p
    # partial aggregation before every shuffle of the lines
    assert "partial_count" in p or "partial_sum" in p


def test_stage_table_partition_pruning(spark):
    df = E.queries()["s3_clean_stage_roundtrip"](spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in p and "(year" in p

"""Shapes of the heavy plans: scans, windows, exchanges, Python nodes."""

import re
from collections import Counter

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def nodes(df):
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return plan, Counter(re.findall(r"(?:^|[-+| :])((?:Scan|FileScan) \w+|Window(?= \[)|MapInPandas|ArrowEvalPython|BatchScan \w+)", plan, re.M))


def scans(plan, table="lineitem"):
    return len(re.findall(rf"FileScan parquet [^\n]*{table}\.parquet", plan))


@pytest.mark.parametrize("name,most_scans,most_windows", [("r5_recommend", 2, 8), ("r7_reprice_many", 4, 10),
                                                          ("fp1_train_features", 2, 5)])
def test_scans_and_windows(spark, name, most_scans, most_windows):
    plan, n = nodes(E.queries()[name](spark, SF))
    assert scans(plan) <= most_scans
    assert n["Window"] <= most_windows
    assert "Python" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("name", ["fp1_train_features", "w2_competes_with_platform", "w3_diff_to_platform", "f9_known_markets"])
def test_offers_are_not_shuffled_on_the_market(spark, name):
    df = E.queries()[name](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(MarketplaceId", plan)


def test_distinct_counts_scan_once(spark):
    plan, _ = nodes(E.queries()["a4_distinct_count"](spark, SF))
    assert scans(plan) == 1


def test_offers_go_narrow_to_the_parts_and_not_to_the_suppliers(spark):
    """a supplier table above the session's threshold does not cost an exchange of all offers; flags stand for texts."""
    from bidscope.plans.auction_view import auction_offers
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = auction_offers(spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, old)
    assert "hashpartitioning(l_suppkey" not in plan and "hashpartitioning(l_partkey" in plan
    to_parts = plan[plan.index("hashpartitioning(l_partkey"):]
    assert re.search(r"l_returnflag#\d+ = R", to_parts[:to_parts.index("Scan parquet")])


def test_a_large_dimension_is_not_sent_to_all_tasks(spark, monkeypatch):
    from bidscope.plans import auction_view
    rows = spark.range(10)
    assert "ResolvedHint" in auction_view.small(rows)._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(auction_view, "SMALL", 8)
    assert auction_view.small(rows) is rows

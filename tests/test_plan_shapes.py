"""The physical plans keep the shapes the scale design relies on."""
import re

import __spark_entry__ as entry
from ubeat.plans import scan

SF = "/root/testdata/sf0.001"


def _plan(spark, name):
    return entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_top_n_and_fraud_limit_before_the_shuffle(spark):
    for name in ("hot_items", "hot_pages", "click_fraud_filter"):
        p = _plan(spark, name)
        assert re.search(r"WindowGroupLimit .*Partial", p), name


def test_large_ratio_windows_do_not_expand_rows(spark):
    for name in ("item_view_counts", "hot_items", "page_counts", "ad_clicks_by_province", "market_counts"):
        assert "Expand" not in _plan(spark, name), name


def test_per_key_scans_of_small_keys_share_one_exchange(spark):
    for name, most in (("login_fail_pair", 1), ("login_fail_timer", 1), ("order_timeout", 1), ("login_fail_sequence", 1),
                       ("order_pay_pattern", 1)):
        p = _plan(spark, name)
        assert len(re.findall(r"\bExchange \w+partitioning", p)) <= most and "Scan ExistingRDD" not in p, name


def test_per_key_scans_of_hot_keys_are_blocked(spark, monkeypatch):
    # Every window over a key is cut by a block (or, for P3, by the sub-island).
    monkeypatch.setattr(scan, "ROWS_PER_BLOCK", 5)
    for name, cuts in (("login_fail_pair", ("__blk",)), ("login_fail_timer", ("__blk", "__sub")),
                       ("login_fail_sequence", ("__b",)), ("order_pay_pattern", ("__b",))):
        p = _plan(spark, name)
        specs = re.findall(r"windowspecdefinition\(([^)]*)\)", p)
        keyed = [s for s in specs if "user_id" in s or "order_id" in s or "__key" in s]
        assert keyed and all(any(c in s for c in cuts) for s in keyed), name


def test_view_filters_reach_the_scan(spark):
    for name in ("hot_items", "page_counts", "unique_visitors", "market_counts"):
        assert re.search(r"PushedFilters: \[[^\]]*(EqualTo|In)\(event_type", _plan(spark, name)), name

import datetime as dt

import pytest

from adlake.plans.divisors import sales_divisors
from adlake.plans.operations import (AlertParams, alert_campaigns, alert_messages, estimate_mean, inventory_change, require_campaigns,
                                     spend_alert, trends_long, unique_requests)

D = dt.date(2024, 1, 10)


def _divisor_inputs(spark, slots, sales):
    """slots: {campaign: [asin, ...]} via the API source; sales: {asin: value}."""
    api_rows = []
    for cid, asins in slots.items():
        api_rows.append(({"report_date": str(D)}, [{"campaigns": [{"campaignid": cid, "creative": {"asins": asins}}]}]))
    api = spark.createDataFrame(api_rows, "params struct<report_date:string>, payload array<struct<campaigns:"
                                          "array<struct<campaignid:bigint,creative:struct<asins:array<string>>>>>>")
    ad = spark.createDataFrame([(cid, "no ids here", D) for cid in slots], "campaign_id bigint, campaign_name string, report_date date")
    pm = spark.createDataFrame([("ZZZ", "b", D)], "child_asin string, brand string, last_updated_date date")
    pnl = spark.createDataFrame([(D, a, v) for a, v in sales.items()], "purchased_date_utc date, asin string, item_price_usd double")
    bulk = spark.createDataFrame([], "campaign_id bigint, creative_asins1 string, creative_asins2 string, creative_asins3 string")
    return api, [ad], pm, pnl, bulk


def test_divisor_golden_cases(spark):
    slots = {1: ["A", "B", "C"], 2: ["A", "B"], 3: ["A"], 4: ["D", "E", "F"]}
    sales = {"D": 30.0, "E": 10.0}
    api, ad, pm, pnl, bulk = _divisor_inputs(spark, slots, sales)
    out = {r.campaign_id: (r.divisor_1, r.divisor_2, r.divisor_3)
           for r in sales_divisors(api, ad, pm, pnl, bulk).collect()}
    assert out[1] == (1 / 3, 1 / 3, 1 / 3)
    assert out[2] == (0.5, 0.5, 0.0)
    assert out[3] == (1.0, 0.0, 0.0)
    assert out[4] == (0.75, 0.25, 0.0)


def test_drop_flag_golden(spark):
    snap = spark.createDataFrame([(*r, i) for i, r in enumerate([
        ("r1", 1, "17"), ("r2", 1, "10"),       # 10, change -7 -> Yes
        ("r1", 2, "16"), ("r2", 2, "10"),       # change -6 -> No
        ("r1", 3, "1042"), ("r2", 3, "1001"),   # change -41 -> Yes
        ("r1", 4, "returned_error"), ("r2", 4, "5"),
        ("r2", 5, "3")])], "run_id string, tour_id long, slots string, row_no int")
    out = {r.tour_id: (r.change, r.drop_flag) for r in inventory_change(snap, "r2").collect()}
    assert out[1] == (-7, "Yes") and out[2] == (-6, "No") and out[3] == (-41, "Yes")
    assert out[4] == (None, "No") and out[5] == (None, "No")


def _spend(spark, rows):
    return spark.createDataFrame([("acc", c, f"c{c}", status, ts, cost, 7.25) for c, status, ts, cost in rows],
                                 "account string, campaign_id long, name string, status string, ts timestamp, cost double, amount double")


def _config(spark, rows):
    return spark.createDataFrame([(a, p, m, "who", i) for i, (a, p, m) in enumerate(rows)], "account string, pct string, abs string, contact string, pos int")


ASOF = dt.datetime(2024, 1, 29, 13, 5)
HISTORY = [dt.timedelta(days=7 * k) for k in range(1, 5)]


def test_spend_alert_golden(spark):
    rows = [(c, "ENABLED", ASOF - d, 10.0) for c in (1, 2, 4) for d in HISTORY] + [(1, "ENABLED", ASOF, 25.0), (2, "ENABLED", ASOF, 19.0)]
    rows += [(3, "ENABLED", ASOF, 8.0), (3, "ENABLED", ASOF - dt.timedelta(days=2), 1.0)]       # no history on that weekday
    rows += [(4, "ENABLED", ASOF - dt.timedelta(hours=1), 500.0)]                              # another hour
    rows += [(5, "PAUSED", ASOF, 90.0), (5, "PAUSED", ASOF - HISTORY[0], 1.0)]
    rows += [(6, "ENABLED", ASOF - dt.timedelta(days=35), 1.0), (6, "ENABLED", ASOF, 50.0)]      # not active in the last 30 days
    cost = _spend(spark, rows)
    run = lambda config, **kw: {r.campaign_id: r for r in spend_alert(cost, _config(spark, config), AlertParams("2024-01-29", 13, **kw)).collect()}
    out = run([("acc", "1", "1"), ("acc", "50", "10"), ("other", "1", "1")])                   # the last row of an account counts
    assert set(out) == {1} and out[1].pct_change == 150.0 and out[1].budget == 7.25 and out[1].contact == "who"
    out = run([("acc", "50", "5")])
    assert set(out) == {1, 2, 3} and out[3].pct_change == float("inf")
    assert run([("acc", "fifty", "5")]) == {} == run([("acc", "50", "-1")]) == run([("acc", "50", "5")], earliest_hour=14)
    assert set(run([("acc", "50", "5")], not_contains=("C1",), contains=("c1", "c2"))) == {2}
    assert set(run([("acc", "50", "5")], mode="cumulative")) == {1, 2, 3, 4}
    assert set(run([("acc", "50", "5")], direction="both")) == {1, 2, 3, 4}
    with pytest.raises(ValueError, match="No campaigns"):
        require_campaigns(alert_campaigns(cost, AlertParams("2024-01-29", 13, contains=("nothing",))))
    body = alert_messages(spend_alert(cost, _config(spark, [("acc", "50", "5")]), AlertParams("2024-01-29", 13))).collect()
    assert len(body) == 1 and body[0].subject == "acc Campaigns exceeded threshold."
    assert body[0].body.startswith("@who\nThe following campaigns have exceeded the 50.00% spend threshold:\n\n1. \nName: c1\nChange(%): 150.00\n"
                                   "Change(abs): 15.00\nHour: 13\nDaily Budget ($): 7.25\nSpend ($): 25.00\n\n2. \nName: c2\n")
    assert "Change(%): Infinity" in body[0].body


def test_estimates(spark):
    req = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, "b", True), (4, "c", False)], "request_id long, text string, is_negative boolean")
    resp = spark.createDataFrame([(1, 0.016, 0.006, 0.0, 0.0), (2, 9.0, 9.0, 9.0, 9.0), (3, 1.0, 1.0, 1.0, 1.0), (4, 1.0, None, 0.0, 3.0)],
                                 "request_id long, clicks_min double, clicks_max double, impr_min double, impr_max double")
    out = {r.text: (r.clicks_mean, r.impressions_mean) for r in estimate_mean(unique_requests(req), resp).collect()}
    assert out == {"a": (0.01, 0.0), "c": (None, 1.5)}


def test_previous_snapshot_takes_the_first_row(spark):
    snap = spark.createDataFrame([("r1", 1, "9", 5), ("r1", 1, "4", 2), ("r2", 1, "6", 1), ("r0", 1, "1", 0)], "run_id string, tour_id long, slots string, row_no int")
    assert [(r.current, r.previous) for r in inventory_change(snap, "r2").collect()] == [(6, 4)]


def test_trends_batches(spark):
    counts = spark.createDataFrame([("g1", "a", 4), ("g2", "b", 8), ("g1", "d", 5), ("g1", "é", 1)], "geo string, keyword string, n long")
    out = {(r.batch_id, r.geo, r.keyword): (r.raw, r.score) for r in trends_long(counts, "geo", "keyword", "n").collect()}
    assert len(out) == 8 and out[0, "g1", "a"] == (4, 50) and out[0, "g2", "b"] == (8, 100) and out[0, "g1", "b"] == (None, None)
    assert out[1, "g1", "é"] == (1, 100) and out[1, "g2", "é"] == (None, None)


def test_ppc_ad_rows_are_not_shuffled_by_phrase(spark):
    from adlake.plans.keys_ppc import build_ppc
    from tests.conftest import SMOKE
    plan = build_ppc(spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(keyword_or_target" not in plan

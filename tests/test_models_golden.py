"""Golden rows of the hand-made product (see FIXTURES.md section 2)."""

import datetime as dt
from decimal import Decimal

import pytest

from fixture_feed import A1, write_feed
from histmart.plans.models import build_models
from histmart.sources import read_ndjson


def T(s):
    return dt.datetime.fromisoformat(s)


@pytest.fixture(scope="module")
def models(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("feed"))
    write_feed(root, {"2024/03/01": [A1]})
    raw, bad = read_ndjson(spark, root, load_date="2024-03-01")
    return build_models(raw)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_price(models):
    got = rows(models["stg_price"], "price_channel", "snapshot_ts", "price", "was_sentinel")
    assert got == [("AMAZON", T("2011-01-01 00:00"), Decimal("10.00"), 0),
                   ("AMAZON", T("2011-01-02 00:00"), None, 1),
                   ("LISTPRICE", T("2011-01-01 00:00"), Decimal("0.01"), 0)]
    pk = [r.pk for r in models["stg_price"].collect()
          if r.price_channel == "AMAZON" and r.snapshot_ts == T("2011-01-01")]
    assert pk == ["e8b3f2c1b48456324be649d6182bc014"]


def test_rank_keeps_odd_tail(models):
    got = rows(models["stg_rank"], "snapshot_ts", "rank")
    assert got == [(T("2011-01-01 00:00"), 50), (T("2011-01-01 01:00"), None),
                   (T("2011-01-01 02:00"), None)]


def test_reviews_full_outer(models):
    got = sorted(((r.snapshot_ts, r.rating, r.review_count) for r in models["stg_reviews"].collect()),
                 key=lambda t: t[0])
    assert got == [(T("2011-01-01 00:00"), Decimal("4.5"), 10), (T("2011-01-01 00:30"), None, 11)]


def test_offer_price_band(models):
    got = rows(models["stg_offer_price"], "snapshot_ts", "price", "was_sentinel")
    assert got == [(T("2011-01-01"), Decimal("19.99"), 0), (T("2011-01-02"), None, 1)]


def test_buybox(models):
    got = rows(models["stg_buybox_history"], "snapshot_ts", "seller_id")
    assert got == [(T("2011-01-01 00:00"), "S1"), (T("2011-01-01 00:10"), None)]


def test_sales_monthly(models):
    stage = sorted(((r.sales_month, r.est_units_sold) for r in models["stg_sales_monthly_stats"].collect()),
                   key=lambda t: t[0])
    assert stage == [(dt.date(2011, 1, 1), 7), (dt.date(2011, 2, 1), 9), (dt.date(2011, 3, 1), None)]
    fact = rows(models["fct_sales_estimate_monthly"], "sales_month", "est_units_sold")
    assert fact == [(dt.date(2011, 1, 1), 7), (dt.date(2011, 2, 1), 9)]


def test_category_lag(models):
    got = sorted(((r.category_id, r.category_name, r.parent_category_id)
                  for r in models["core_product_categories"].collect()), key=lambda t: t[0])
    assert got == [(10, "Root", None), (20, "Leaf", 10)]
    edges = rows(models["stg_category_tree"], "category_id", "parent_category_id")
    assert edges == [(10, None), (20, 10)] or edges == sorted([(10, None), (20, 10)], key=str)


def test_daily_key(models):
    pk = [r.pk for r in models["fct_price_history_daily"].collect()
          if r.price_channel == "AMAZON" and r.date == dt.date(2011, 1, 1)]
    assert pk == ["00c2b5ee121bc149555be79a4ea3e287"]


def test_daily_last_of_day(models):
    got = rows(models["core_price_daily"], "price_channel", "date", "price")
    assert got == [("AMAZON", dt.date(2011, 1, 1), Decimal("10.00")),
                   ("AMAZON", dt.date(2011, 1, 2), None),
                   ("LISTPRICE", dt.date(2011, 1, 1), Decimal("0.01"))]


def test_aplus_assets_and_empty_module(models):
    a = models["stg_aplus_module"]
    got = rows(a.filter("module_idx = 0"), "asset_type", "asset_idx", "url", "alt_text", "text")
    assert ("image", 0, "i0", None, None) in got and ("image", 1, "i1", None, None) in got
    assert ("image_alt", 0, None, "alt0", None) in got and ("text", 0, None, None, "hello") in got
    assert ("video", None, None, None, None) in got
    bad = rows(models["stg_aplus_module__bad"], "module_idx", "reason_code")
    assert bad == [(1, "MODULE_EMPTY")]


def test_videos(models):
    got = rows(models["stg_videos"], "url", "name", "duration_sec")
    assert got == [("u1", "v1", 30)]


def test_checks_pass(models, spark):
    from histmart.operators.quality import check_summary
    from histmart.plans.models import model_checks
    checks = model_checks(models)
    assert len(checks) == 35
    s = {r.check_name: r.failures for r in check_summary(spark, checks).collect()}
    assert all(v == 0 for v in s.values()), {k: v for k, v in s.items() if v}

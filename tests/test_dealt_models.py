"""Models whose rows are dealt by product before they are exploded."""

import datetime as dt

import pytest

from histmart.plans import stg
from histmart.plans.core import core_price_daily

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


@pytest.fixture(scope="module")
def base(spark):
    rows = [("A", D1, [[0, 100, 1500, 200], [10, 300], None, None, [0, 7]]), ("A", D2, [[0, 110], None, [], None, None]),
            (None, D1, [[0, 1, 1441, 2]]), (None, D2, [[0, 3, -1, 4]]), (None, D2, None), ("B", D2, [None]), ("B", None, [[5, -1]]),
            ("B", D2, [[5, 9]])]
    return spark.createDataFrame(rows, "asin string, ingest_ts date, csv_v array<array<bigint>>")


def _shuffled(df):
    """The plan below its first shuffle."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan[plan.index("RepartitionByExpression"):]


def test_price_points_take_the_newest_load_also_without_a_product(base):
    got = {(r.asin, r.price_channel, r.snapshot_ts): (float(r.price) if r.price is not None else None, r.ingest_ts)
           for r in stg.stg_price(base).collect()}
    at = lambda m: dt.datetime(2011, 1, 1) + dt.timedelta(minutes=m)
    assert got == {
        ("A", "AMAZON", at(0)): (1.1, D2), ("A", "AMAZON", at(1500)): (2.0, D1), ("A", "NEW", at(10)): (3.0, D1),
        ("A", "LISTPRICE", at(0)): (0.07, D1), (None, "AMAZON", at(0)): (0.03, D2), (None, "AMAZON", at(1441)): (0.02, D1),
        (None, "AMAZON", at(-1)): (0.04, D2), ("B", "AMAZON", at(5)): (None, None)}
    days = sorted((r.asin or "", r.price_channel, str(r.date), float(r.price or 0)) for r in core_price_daily(stg.price_points(base)).collect())
    assert days == [("", "AMAZON", "2010-12-31", 0.04), ("", "AMAZON", "2011-01-01", 0.03), ("", "AMAZON", "2011-01-02", 0.02),
                    ("A", "AMAZON", "2011-01-01", 1.1), ("A", "AMAZON", "2011-01-02", 2.0), ("A", "LISTPRICE", "2011-01-01", 0.07),
                    ("A", "NEW", "2011-01-01", 3.0), ("B", "AMAZON", "2011-01-01", 0.0)]


def test_price_points_are_exploded_after_the_shuffle(base):
    for df in (stg.stg_price(base), core_price_daily(stg.price_points(base))):
        physical = df._jdf.queryExecution().executedPlan().toString()
        assert physical.count("Exchange") == 1 and "Window" not in _shuffled(df)


def test_assets_take_the_newest_load_of_each_place(spark):
    module = lambda *images: [(images and list(images) or None, ["alt"], None, None)]
    rows = [("A", D1, [(module("x", "y"),)]), ("A", D2, [(module("z"),)]), ("A", D1, [(module("z"),)]), ("B", D2, [(module("p"),)]),
            ("B", None, [(module("p"),)]), (None, D1, [(module("q"),)]), ("C", D1, None)]
    b = spark.createDataFrame(rows, "asin string, ingest_ts date, aplus_v array<struct<module:array<struct<image:array<string>,"
                                    "imageAltText:array<string>,text:array<string>,video:array<string>>>>>")
    model = stg.stg_aplus_module(b)
    got = {(r.asin, r.asset_idx): (r.url, r.ingest_ts) for r in model.filter("asset_type = 'image'").collect()}
    assert got == {("A", 0): ("z", D2), ("A", 1): ("y", D1), ("B", 0): ("p", None), (None, 0): ("q", D1), ("C", None): (None, D1)}
    assert "Aggregate" in model._jdf.queryExecution().optimizedPlan().toString() and "tagged" not in _shuffled(model)


def test_the_rollup_shuffles_suspects_alone(spark):
    """The same rows as from the whole models; only points whose key has a broken one are shuffled."""
    from histmart.plans.models import build_models, quarantine_models
    offer = "offers_v array<struct<offerId:string,sellerId:string,isPrime:boolean,isFBA:boolean,condition:string,isShippable:boolean,isMAP:boolean,offerCSV:string>>"
    aplus = "aplus_v array<struct<module:array<struct<image:array<string>,imageAltText:array<string>,text:array<string>,video:array<string>>>>>"

    def csv(price, rank, rating, count):
        return [price, None, None, rank, None, *[None] * 11, rating, count]

    def offers(*texts):
        return [(f"O{i}" if t != "none" else None, "S", True, True, "New", True, False, t) for i, t in enumerate(texts)]

    rows = [("A", D1, "r1", csv([0, 5], [0, 0, 9, 3], [0, 45], [0, 5]), 0, offers("1,2", ""), None),
            ("A", D2, "r2", csv([0, 6], [0, 4, 9, 0], [0, 60], [0, 7]), 1, offers("", "3,4"), [([(None, None, None, None)],)]),
            ("B", D1, "r3", csv([0, 5], [7], [3, 99], [0, 5]), 0, offers("none"), None), ("B", D2, "r4", csv(None, [7, 1], [3, 20], [3, 5]), 0, None, None),
            (None, D1, "r5", csv([0, 5, 9, 1], [0, 1], [0, 45, 8, 45], [0, 5]), 0, offers("1,2"), None),
            (None, D2, "r6", csv([0, 4], [0, 2], [0, 44], [8, 5]), 0, offers("1,1"), None)]
    b = spark.createDataFrame(rows, "asin string, ingest_ts date, _airbyte_raw_id string, csv_v array<array<bigint>>, csv_text_values int, "
                              f"{offer}, {aplus}")
    found = quarantine_models(b)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(found) == key(build_models(None, b)["quarantine_union"].select(*found.columns))
    assert {r.reason_code for r in found.collect()} >= {"ASIN_NULL", "RANK_NONPOSITIVE", "RATING_OOB", "OFFER_CSV_EMPTY", "OFFER_ID_NULL", "MODULE_EMPTY"}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("bitmap_construct_agg") == 5


def test_ndjson_reviews_parse_the_lines_once(spark):
    from conftest import SF_SMALL
    from histmart.plans.registry import ndjson_query
    plan = ndjson_query("fct_review_history_daily")(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "variant" not in plan.lower() and "parsejson" not in plan.lower()


def test_the_ndjson_feed_is_written_and_read_by_many_tasks(spark, monkeypatch):
    """A stored line item becomes a long line, and a gzip file is one task."""
    from conftest import SF_SMALL
    from histmart.plans import feed
    monkeypatch.setattr(feed, "FILE_LINES", 700)
    raw = feed.ndjson_feed(spark, SF_SMALL)
    lines = raw.groupBy("file_name").count().collect()
    n = feed.table(spark, SF_SMALL, "lineitem").count()
    assert sum(r["count"] for r in lines) == n and len(lines) >= n // 700 and max(r["count"] for r in lines) <= 1400

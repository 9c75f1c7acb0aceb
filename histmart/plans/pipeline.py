"""The daily run: publish every model layer by layer.

Tables live under ``root/<LAYER>/<model>`` (Parquet). A run takes raw rows (a
day folder, or one micro-batch of the raw stream) of any load dates, and:

1. parses them once into the typed base increment and writes it to a staging
   table in the shared checkpoint folder - this cuts the lineage, so a lost
   executor re-reads a written table instead of re-parsing JSON;
2. computes every per-product model from that increment and merges it by its
   natural key (NULL is a value) under the model's own total order. The first
   row under a total order of all loads is the first among the increments'
   first rows, so late, same-day and repeated loads give the table of one
   full run; order columns that a model does not show are kept as ``_o_*``;
3. re-aggregates what depends on several loads from the published tables, only
   where the increment touched them: review points per (asin, minute), day
   rows per (keys, date), the enriched points of touched offers, quarantines
   per month or bucket;
4. rebuilds the dimension tables and the table-materialised core models from
   the published tables (their size is bounded by products, sellers and
   categories, or they are full-rebuild tables in the warehouse);
5. runs the declared checks on the published tables, one scan a table, stores
   the run's failing rows under MONITORING (a check that passes is emptied),
   and keeps one run-monitoring row per run id.

``full_refresh=True`` replaces every table by the given raw rows. Staged
tables are deleted when the run ends.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from histmart.functions import minutes_to_ts
from histmart.operators.quality import Check, store_failures, summarise
from histmart.plans import bad, core, marts, stg
from histmart.plans.models import TESTS
from histmart.session import shared_path
from histmart.sources.files import Folder
from histmart.sources.sink import (
    BUCKET, bucket_column, create_view, high_water, increment_filter, key_bucket, layer_path, overwrite, replace_partitions,
    replace_table, same, table_exists, upsert,
)

PART = "_month"
BUCKETS = 16
MERGE_KEY = "_merge_key"


@dataclass(frozen=True)
class Merged:
    """A table merged by ``key``; ``order`` () means the increment is recomputed truth for its keys.

    ``month_of`` names the key column whose month partitions the table; a table
    without a time in its key has ``bucket_of``, the key columns whose hash
    bucket does. So a key never changes partition and a merge rewrites only the
    months or buckets touched.
    """
    layer: str
    key: tuple[str, ...]
    order: tuple = ()
    month_of: str | None = None
    bucket_of: tuple[str, ...] = ()


def _staged(name: str, *key: str, month_of: str | None = None) -> Merged:
    return Merged("stg", key, tuple(stg.desc(stg.ORDERS[name])), month_of, () if month_of else ("asin",))


MERGED: dict[str, Merged] = {
    "stg_base": Merged("stg", ("stg_row_id",), (("_airbyte_extracted_at", "desc"), ("filename", "desc"), ("_content", "desc")),
                       "ingest_ts"),
    "stg_price": _staged("stg_price", "asin", "price_channel", "snapshot_ts", month_of="snapshot_ts"),
    "stg_rank": _staged("stg_rank", "asin", "snapshot_ts", month_of="snapshot_ts"),
    "stg_reviews_rating_pts": _staged("stg_reviews_rating_pts", "asin", "series_min", month_of="series_min"),
    "stg_reviews_count_pts": _staged("stg_reviews_count_pts", "asin", "series_min", month_of="series_min"),
    "stg_reviews": Merged("stg", ("asin", "snapshot_ts"), (), "snapshot_ts"),
    "stg_offers": _staged("stg_offers", "asin", "offer_id"),
    "stg_offer_metadata": _staged("stg_offer_metadata", "asin", "offer_id", "ingest_ts", month_of="ingest_ts"),
    "stg_offer_price": _staged("stg_offer_price", "asin", "offer_id", "snapshot_ts", month_of="snapshot_ts"),
    "stg_buybox_history": _staged("stg_buybox_history", "asin", "snapshot_ts", month_of="snapshot_ts"),
    "stg_category_tree": _staged("stg_category_tree", "asin", "category_id", "parent_category_id"),
    "stg_product_metadata": _staged("stg_product_metadata", "asin", "ingest_ts", month_of="ingest_ts"),
    "stg_sales_monthly_stats": _staged("stg_sales_monthly_stats", "asin", "sales_month", month_of="sales_month"),
    # the video id contains the snapshot, so it would keep every superseded row: merged on what identifies a video
    "stg_videos": _staged("stg_videos", "asin", MERGE_KEY),
    "stg_aplus_module": _staged("stg_aplus_module", "asin", "aplus_idx", "module_idx", "asset_type", "asset_idx"),
    "core_price_daily": Merged("core", ("asin", "price_channel", "date"), (), "date"),
    "core_rank_daily": Merged("core", ("asin", "date"), (), "date"),
    "core_reviews_daily": Merged("core", ("asin", "date"), (), "date"),
    "core_offer_price_daily": Merged("core", ("asin", "offer_id", "date"), (), "date"),
    "core_product_latest": Merged("core", ("asin",), tuple(stg.desc(core.PRODUCT_ORDER)), None, ("asin",)),
    "core_offer_meta_latest": Merged("core", ("asin", "offer_id"), tuple(stg.desc(core.META_ORDER)), None, ("asin",)),
    # a key for merges: the table shows a point's date alone
    "core_offer_enriched": Merged("core", ("asin", "offer_id", "_o_snapshot_ts"), (), None, ("asin",)),
    "fct_price_history_daily": Merged("mart", ("asin", "price_channel", "date"), (), "date"),
    "fct_rank_history_daily": Merged("mart", ("asin", "date"), (), "date"),
    "fct_review_history_daily": Merged("mart", ("asin", "date"), (), "date"),
    "fct_offer_price_daily": Merged("mart", ("asin", "offer_id", "date"), (), "date"),
}

# Quarantines: (source table, rule function), partitioned as their source.
QUARANTINES = {
    "stg_base__bad": ("stg_base", bad.base_bad),
    "stg_price__bad": ("stg_price", bad.price_bad),
    "stg_rank__bad": ("stg_rank", bad.rank_bad),
    "stg_reviews__bad": ("stg_reviews", bad.reviews_bad),
    "stg_offers__bad": ("stg_offers", bad.offers_bad),
    "stg_aplus_module__bad": ("stg_aplus_module", bad.aplus_bad),
}

# Day tables: (core table, staged source, fact).
DAILY = {
    "core_price_daily": ("stg_price", "fct_price_history_daily"),
    "core_rank_daily": ("stg_rank", "fct_rank_history_daily"),
    "core_reviews_daily": ("stg_reviews", "fct_review_history_daily"),
    "core_offer_price_daily": ("stg_offer_price", "fct_offer_price_daily"),
}

# Tables rebuilt from published tables each run.
REBUILT = {
    "core_buybox_daily": "core", "core_category_hierarchy": "core",
    "core_product_categories": "core", "core_product_enriched": "core",
    "core_sales_estimate_monthly": "core", "dim_product": "mart", "dim_product_enriched": "mart",
    "dim_category": "mart", "dim_product_category": "mart", "dim_seller": "mart",
    "fct_buybox_history_daily": "mart", "fct_sales_estimate_monthly": "mart",
}

MONITORING_TABLE = "pipeline_run_monitoring"


def _month_of(column: str):
    """Partition month of a key column (series minutes are converted first)."""
    c = minutes_to_ts(column) if column == "series_min" else F.col(column)
    return F.date_trunc("MONTH", c).cast("date")


def _path(root: str, name: str) -> str:
    layer = (MERGED[name].layer if name in MERGED else "stg_bad" if name in QUARANTINES
             else REBUILT.get(name, "monitoring"))
    return layer_path(root, layer, name)


def shown(df: DataFrame) -> DataFrame:
    """A published table without its partition and order columns."""
    return df.drop(*[c for c in df.columns if c in (PART, MERGE_KEY, "_content") or c.startswith(("_o_", BUCKET))])


def _parallel(jobs: dict, workers: int) -> dict:
    """Run independent publish steps as concurrent Spark jobs from driver threads."""
    if workers <= 1:
        return {name: fn() for name, fn in jobs.items()}
    with ThreadPoolExecutor(max_workers=workers) as pool:
        futures = {name: pool.submit(fn) for name, fn in jobs.items()}
        return {name: f.result() for name, f in futures.items()}


def run_pipeline(spark: SparkSession, raw: DataFrame, root: str, full_refresh: bool = False,
                 strict_watermark: bool = False, strict_event_date: bool = False, run_id: str | None = None,
                 workers: int = 4, buckets: int = BUCKETS) -> dict:
    """Publish all models from the ``raw`` rows. Returns run metrics.

    ``strict_watermark`` skips rows whose load date is not past the published
    base's; ``strict_event_date`` lets the day tables take only dates past
    their own last one (both are the warehouse's marks, which drop late rows;
    default: off). Models of one layer that do not read each other are
    published concurrently (``workers`` driver threads, one session).
    ``buckets``: of new tables that are partitioned by a hash of the product
    (an increment rewrites the buckets of its products, so many buckets suit
    tables of many products); existing tables keep theirs.
    """
    t0 = time.time()
    run_id = run_id or uuid.uuid4().hex
    rows: dict[str, int] = {}
    steps: dict[str, float] = {}
    schemas: dict = {}  # published schemas: an empty table has no file to infer one from
    scratch: list[str] = []

    def published(name: str) -> DataFrame:
        return spark.read.schema(schemas[name]).parquet(_path(root, name))

    def read(name: str) -> DataFrame:
        return shown(published(name))

    def write_stage(name: str, df: DataFrame) -> DataFrame:
        path = shared_path(spark, f"inc-{name}")
        scratch.append(path)
        o = Observation(name)
        df.observe(o, F.count(F.lit(1)).alias("rows")).write.parquet(path)
        rows[name] = o.get["rows"]
        return spark.read.schema(df.schema).parquet(path)

    # 1. typed base increment, written once (lineage cut)
    base = stg.product_base(raw)
    if strict_watermark and not full_refresh:
        mark = high_water(spark, _path(root, "stg_base"), "ingest_ts")
        base = base.filter(increment_filter("ingest_ts", mark, "strict", as_date=True))
    b = write_stage("stg_base", base)

    def dealt(name: str) -> tuple[str, Column]:
        """Partition column of a merged table and its value for a row."""
        spec = MERGED[name]
        if spec.month_of:
            return PART, _month_of(spec.month_of)
        part, n = bucket_column(spark, _path(root, name), buckets) if not full_refresh else (f"{BUCKET}{buckets}", buckets)
        return part, key_bucket(spec.bucket_of, n)

    def folders(part: str, rows: DataFrame) -> list[str]:
        """The partitions of ``rows`` (collected: one short value each)."""
        return [f"{part}={r[0]}" for r in rows.select(part).filter(F.col(part).isNotNull()).distinct().collect()]

    def merge(name: str, df: DataFrame, staged: bool = False) -> DataFrame:
        """Merge the increment by key; returns its staged rows (on a full refresh the published ones)."""
        t = time.time()
        spec = MERGED[name]
        part, place = dealt(name)
        out = df.withColumn(part, place)
        schemas[name] = out.schema
        if not full_refresh and not staged:
            out = write_stage(name, out)
        upsert(spark, out, _path(root, name), spec.key, partition_by=[part],
               order=list(spec.order) if name == "stg_base" or not full_refresh else None, full_refresh=full_refresh,
               unique_source=True, null_keys="match", fixed_partition=True)
        if full_refresh:
            rows[name] = published(name).count()  # from the files' footers
        steps[name] = time.time() - t
        return published(name) if full_refresh else out

    merge("stg_base", b.withColumn("_content", F.md5(F.to_json(F.struct(*b.columns)))))

    # 2. per-product models from the increment (each is one row per key)
    r_inc, c_inc = stg.review_sides(b)
    first = {
        "stg_price": lambda: stg.stg_price(b), "stg_rank": lambda: stg.stg_rank(b), "stg_offers": lambda: stg.stg_offers(b),
        "stg_offer_metadata": lambda: stg.stg_offer_metadata(b),
        "stg_offer_price": lambda: stg.stg_offer_price(stg.offer_snapshots(b)),
        "stg_buybox_history": lambda: stg.stg_buybox_history(b), "stg_category_tree": lambda: stg.stg_category_tree(b),
        "stg_product_metadata": lambda: stg.stg_product_metadata(b, hidden=True),
        "stg_sales_monthly_stats": lambda: stg.stg_sales_monthly_stats(b, hidden=True),
        "stg_videos": lambda: stg.stg_videos(b).withColumn(MERGE_KEY, F.coalesce("url", "name")),
        "stg_aplus_module": lambda: stg.stg_aplus_module(b),
        "core_product_latest": lambda: core.core_product_latest(b, hidden=True),
        "stg_reviews_rating_pts": lambda: r_inc, "stg_reviews_count_pts": lambda: c_inc,
    }
    inc = _parallel({n: (lambda n=n, f=f: merge(n, f())) for n, f in first.items()}, workers)
    merge("core_offer_meta_latest", core.core_offer_meta_latest(inc["stg_offer_metadata"]))

    # price points of the offers that the increment holds, with their newest metadata: the points that the table
    # has already, but for those merged now, which come as they are published
    def enrich() -> None:
        name, group = "core_offer_enriched", ["asin", "offer_id"]
        t, path = time.time(), _path(root, name)
        (part, place), meta = dealt(name), published("core_offer_meta_latest")
        if full_refresh or not table_exists(spark, path, meta.schema):
            out = core.core_offer_enriched(published("stg_offer_price"), meta, hidden=True).withColumn(part, place)
            schemas[name] = out.schema
            replace_table(out, path, [part])
        else:
            offers = inc["stg_offer_price"].select(*group).union(inc["stg_offer_metadata"].select(*group)).distinct().withColumn(part, place)
            offers = write_stage("offers", offers)
            changed = inc["stg_offer_price"].select(*group, "snapshot_ts", PART).distinct()
            new = published("stg_offer_price").alias("t").join(changed.alias("k"), same("t", "k", [*group, "snapshot_ts", PART]), "left_semi")
            schemas[name] = core.core_offer_enriched(new, meta, hidden=True).withColumn(part, place).schema
            old = published(name).alias("t").join(offers.select(part).distinct().alias("k"), same("t", "k", [part]), "left_semi")
            ours = lambda how: old.alias("t").join(offers.alias("k"), same("t", "k", [*group, part]), how)
            points = ours("left_semi").select(*group, F.col("_o_snapshot_ts").alias("snapshot_ts"), "price")
            points = points.alias("t").join(changed.alias("k"), same("t", "k", [*group, "snapshot_ts"]), "left_anti").unionByName(
                new.select(*points.columns))
            at = dealt("core_offer_meta_latest")
            mine = meta.alias("t").join(offers.select(*group, at[1].alias(at[0])).alias("k"), same("t", "k", [*group, at[0]]), "left_semi")
            out = core.core_offer_enriched(points, mine, hidden=True).withColumn(part, place)
            replace_partitions(ours("left_anti").unionByName(out), path, [part], folders(part, offers))
            rows.pop("offers")
        rows[name] = published(name).count()
        steps[name] = time.time() - t

    # 3. review points of the touched (asin, minute), joined again from both published series
    keys = ["asin", "series_min", PART]
    touched = inc["stg_reviews_rating_pts"].select(*keys).union(inc["stg_reviews_count_pts"].select(*keys)).distinct()

    def side(name):
        if full_refresh:
            return published(name).drop(PART)
        return published(name).alias("t").join(touched.alias("k"), same("t", "k", keys), "left_semi").drop(PART)
    inc["stg_reviews"] = merge("stg_reviews", stg.reviews_from_sides(side("stg_reviews_rating_pts"), side("stg_reviews_count_pts")))

    # day rows of the touched (keys, date), aggregated again from the published points
    def daily(name: str) -> None:
        source, fact = DAILY[name]
        points, group = published(source), list(MERGED[name].key[:-1])
        days = inc[source].select(*group, F.col("snapshot_ts").cast("date").alias("date"), PART).distinct()
        if strict_event_date and not full_refresh:
            days = days.filter(F.col("date") > F.lit(str(high_water(spark, _path(root, name), "date"))).cast("date"))
        if not full_refresh or strict_event_date:
            points = points.withColumn("date", F.col("snapshot_ts").cast("date"))
            points = points.alias("t").join(days.alias("k"), same("t", "k", [*group, "date", PART]), "left_semi").drop("date")
        rows_ = merge(name, getattr(core, name)(points.drop(PART)))
        merge(fact, getattr(marts, fact)(rows_))

    # quarantines of the touched months and buckets (a row repaired by a newer load leaves its quarantine)
    def set_aside(name: str) -> None:
        t = time.time()
        source, rules = QUARANTINES[name]
        points, path = published(source), _path(root, name)
        part, place = dealt(source)
        out = rules(points).withColumn(part, place)
        schemas[name] = out.schema
        if not full_refresh and table_exists(spark, path, schemas[name]):
            touched = inc[source].select(part).distinct()
            points = points.alias("t").join(touched.alias("k"), same("t", "k", [part]), "left_semi")
            replace_partitions(rules(points).withColumn(part, place), path, [part], folders(part, touched))
        else:
            overwrite(out, path, [part])
        rows[name] = published(name).count()
        steps[name] = time.time() - t

    inc["stg_base"] = b.withColumn(PART, _month_of("ingest_ts"))
    _parallel({"core_offer_enriched": enrich, **{n: (lambda n=n: daily(n)) for n in DAILY}, **{n: (lambda n=n: set_aside(n)) for n in QUARANTINES}}, workers)

    # 4. rebuilt tables, from published tables
    def rebuild(name: str, df: DataFrame) -> None:
        t = time.time()
        o = Observation(name)
        overwrite(df.observe(o, F.count(F.lit(1)).alias("rows")), _path(root, name))
        rows[name] = o.get["rows"]
        schemas[name] = df.schema
        steps[name] = time.time() - t

    _parallel({
        "core_buybox_daily": lambda: rebuild("core_buybox_daily", core.core_buybox_daily(read("stg_buybox_history"))),
        "core_category_hierarchy": lambda: rebuild("core_category_hierarchy",
                                                   core.core_category_hierarchy(read("stg_category_tree"))),
        "core_product_categories": lambda: rebuild("core_product_categories",
                                                   core.core_product_categories(read("core_product_latest"))),
        "core_product_enriched": lambda: rebuild("core_product_enriched",
                                                 core.core_product_enriched(read("stg_product_metadata"))),
        "core_sales_estimate_monthly": lambda: rebuild("core_sales_estimate_monthly", core.core_sales_estimate_monthly(
            read("stg_sales_monthly_stats"))),
        "dim_product": lambda: rebuild("dim_product", marts.dim_product(read("core_product_latest"))),
        "dim_seller": lambda: rebuild("dim_seller", marts.dim_seller(read("stg_offers"))),
    }, workers)
    _parallel({
        "dim_product_enriched": lambda: rebuild("dim_product_enriched",
                                                marts.dim_product_enriched(read("core_product_enriched"))),
        "dim_category": lambda: rebuild("dim_category", marts.dim_category(read("core_product_categories"))),
        "dim_product_category": lambda: rebuild("dim_product_category",
                                                marts.dim_product_category(read("core_product_categories"))),
        "fct_buybox_history_daily": lambda: rebuild("fct_buybox_history_daily",
                                                    marts.fct_buybox_history_daily(read("core_buybox_daily"))),
        "fct_sales_estimate_monthly": lambda: rebuild("fct_sales_estimate_monthly", marts.fct_sales_estimate_monthly(
            read("core_sales_estimate_monthly"))),
    }, workers)

    # quarantine roll-up: a view over the published quarantine tables
    create_view(bad.quarantine_rollup(*[read(f"stg_{n}__bad") for n in ("price", "rank", "reviews", "offers", "aplus_module")],
                                      base=read("stg_base__bad")), "quarantine_union")

    # 5. checks on the published tables, failures stored, one monitoring row
    t = time.time()
    tables = {name: read(name) for name in [*MERGED, *QUARANTINES, *REBUILT]}
    summary = summarise(spark, tables, TESTS).collect()  # one small row per test
    failing = {r["check_name"] for r in summary if r["failures"] > 0}
    store_failures([Check(x.name, x.failures(tables)) for x in TESTS if x.name in failing], layer_path(root, "monitoring", "test_failures"),
                   run_id, [x.name for x in TESTS if x.name not in failing])
    steps["checks"] = time.time() - t
    failed = sum(1 for r in summary if r["failures"] > 0)
    status = "success" if failed == 0 else "success_with_warnings"
    metrics = {
        "run_id": run_id, "status": status, "models_run": len(rows) - 1,
        "tests_passed": len(summary) - failed, "tests_failed": failed,
        "rows_loaded": rows["stg_base"], "rows": rows, "steps": steps, "seconds": time.time() - t0,
    }
    log_run(spark, root, metrics)
    for path in scratch:
        Folder(spark, path).delete()
    return metrics


def log_run(spark: SparkSession, root: str, metrics: dict, dag_id: str = "histmart_daily") -> None:
    """Keep one monitoring row per run id (created on the first run; a replay replaces its row)."""
    row = [(dag_id, metrics["run_id"], _dt.datetime.now(_dt.timezone.utc).isoformat(), metrics["status"],
            None, int(metrics["models_run"]), int(metrics["tests_passed"]), int(metrics["tests_failed"]),
            int(metrics["rows_loaded"]))]
    schema = ("dag_id string, run_id string, execution_date string, status string, extract_job_id string, "
              "models_run int, tests_passed int, tests_failed int, rows_loaded_raw bigint")
    df = spark.createDataFrame(row, schema).withColumn("logged_at", F.current_timestamp())
    upsert(spark, df, layer_path(root, "monitoring", MONITORING_TABLE), ["dag_id", "run_id"], unique_source=True)


def bench_pipeline(spark: SparkSession, sf_dir: str) -> dict:
    """Full refresh on all but the last ship day of the derived feed, then that day incrementally."""
    from histmart.plans.feed import product_feed
    feed = product_feed(spark, sf_dir)
    last = feed.select(F.max("ingest_dt")).scalar()
    root = shared_path(spark, "warehouse")
    t0 = time.perf_counter()
    run_pipeline(spark, feed.filter(F.col("ingest_dt") < last), root, full_refresh=True)
    t1 = time.perf_counter()
    run_pipeline(spark, feed.filter(F.col("ingest_dt") == last), root)
    t2 = time.perf_counter()
    return {"full_sec": t1 - t0, "incremental_sec": t2 - t1, "root": root}

"""Batch jobs: ingest, models, tests, training and refresh, in that order.

Each stage reads what the stage before it wrote. A later stage thus starts
from files, whose size Spark knows when it plans joins, and a lost executor
costs the tasks it ran rather than the whole lineage.

A run writes a version of its own, which tables and views show only once all tests have passed and the model is
trained (see ``sinks.versions``).
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from shopmart.operators.quality import Check, row_metrics, run_checks, unique
from shopmart.plans import delivery_model, gold, marts, views
from shopmart.plans.checks import declared_checks, key_checks
from shopmart.plans.silver import silver_geolocation
from shopmart.schemas import FACT_COLUMNS, GOLD_TABLES, RAW_TABLES
from shopmart.sinks import catalog, versions
from shopmart.sinks.parquet_tables import ROWS, write_bucketed, write_measured, write_table
from shopmart.sources.csv_files import list_csv, read_csv
from shopmart.sources.parquet_tables import read_tables

SILVER = "silver_geolocation"
MEASURES = "order_measures"
TRANSLATION = "product_category_name_translation"
PREDICTIONS = "gold_delivery_predictions"
SUMMARY = "sales_summary"
# Tables that may be written in buckets, with the key of their join in the wide view.
BUCKETED = {"fact_order_items": "order_id", "dim_orders": "order_id"}
# Columns that joins are planned by.
JOIN_KEYS = {
    "fact_order_items": ("order_id", "product_id", "seller_id"),
    "dim_orders": ("order_id", "customer_id"),
    "dim_customers": ("customer_id",),
    "dim_products": ("product_id",),
    "dim_sellers": ("seller_id",),
    "dim_payments": ("order_id",),
}


class QualityError(RuntimeError):
    """A declared test found failures."""


@dataclass(frozen=True)
class RunSummary:
    rows: dict[str, int]
    auc: float
    version: str


@dataclass(frozen=True)
class Failure:
    """A test and how many failures it found."""

    check: Check
    failures: int


def ingest(
    spark: SparkSession,
    src: str,
    dst: str,
    prefix: str | None = None,
    coalesce: int | None = None,
    rebalance: bool = False,
    multi_line: bool | Collection[str] = ("order_reviews",),
    infer: bool = False,
) -> dict[str, int]:
    """Every CSV table under ``src`` as a Parquet dataset under ``dst``; rows per table.

    ``multi_line`` names the tables with line breaks in their fields, by default the reviews with
    their free text; they are scanned twice more. A line break in one of the others raises.
    """
    rows = {}
    for table, source in list_csv(spark, src, prefix).items():
        breaks = multi_line if isinstance(multi_line, bool) else table in multi_line
        frame = read_csv(spark, table, source, multi_line=breaks, infer=infer)
        path = f"{dst.rstrip('/')}/{table}"
        rows[table] = write_table(frame, path, coalesce=coalesce, rebalance=rebalance)
    return rows


def build_models(spark: SparkSession, raw_base: str, dst: str) -> dict[str, int]:
    """Silver and gold datasets under ``dst`` from raw Parquet; rows per table."""
    return build_checked(spark, raw_base, dst, [])[0]


def build_checked(
    spark: SparkSession,
    raw_base: str,
    dst: str,
    checks: Sequence[Check],
    buckets: int | None = None,
    scratch: str = "scratch_bucketed",
) -> tuple[dict[str, int], list[Failure]]:
    """``build_models``, with the row-level ones of ``checks`` counted in the passes that write.

    With ``buckets`` the tables in ``BUCKETED`` are written in so many, by way of the table ``scratch``.

    Silver and the measures per order are written first and read back: silver is then computed
    once for customers and sellers, and items meet a written table, so that
    Spark can split an order with very many items.
    """
    dst = dst.rstrip("/")
    rows: dict[str, int] = {}
    tested: list[Failure] = []

    def write(name: str, frame: DataFrame) -> DataFrame:
        own = [c for c in checks if c.model == name and c.test != "unique"]
        path, metrics = f"{dst}/{name}", row_metrics(own)
        if buckets and name in BUCKETED:
            found = write_bucketed(frame, path, metrics, BUCKETED[name], buckets, scratch)
        else:
            found = write_measured(frame, path, metrics)
        rows[name] = found.pop(ROWS)
        tested.extend(Failure(own[int(k.rpartition("_")[2])], n) for k, n in found.items())
        return spark.read.parquet(f"{dst}/{name}")

    raw = read_tables(spark, raw_base, RAW_TABLES)
    geo = write(SILVER, silver_geolocation(raw["geolocation"]))
    staged = write(MEASURES, gold.order_measures(raw["orders"], raw["order_reviews"]))
    models = {
        "dim_customers": gold.dim_customers(raw["customers"], geo),
        "dim_products": gold.dim_products(
            raw["products"], raw["product_category_name_translation"]
        ),
        "dim_sellers": gold.dim_sellers(raw["sellers"], geo),
        "dim_orders": gold.dim_orders(raw["orders"]),
        "dim_payments": gold.dim_payments(raw["order_payments"]),
        "fact_order_items": gold.sales_lines(raw["order_items"], staged).select(*FACT_COLUMNS),
    }
    done = {name: write(name, models[name]) for name in GOLD_TABLES}
    summary = marts.sales_summary(
        *(
            done[name]
            for name in ("fact_order_items", "dim_orders", "dim_customers", "dim_products", "dim_sellers")
        )
    )
    write(SUMMARY, summary)
    return rows, tested


def model_checks() -> list[Check]:
    """The declared tests, and those of the keys that the questions rely on."""
    return [*declared_checks(), *key_checks(), unique(TRANSLATION, "product_category_name")]


def check_models(tables: Mapping[str, DataFrame], tested: Sequence[Failure] = ()) -> None:
    """Raise if a test of the given tables fails; tests in ``tested`` have been counted before."""
    done = {t.check for t in tested}
    checks = [c for c in model_checks() if c.model in tables and c not in done]
    report = run_checks(tables, checks).collect() if checks else []
    failed = [(r.model, r.column_name, r.test, r.failures) for r in report]
    failed += [(t.check.model, t.check.column, t.check.test, t.failures) for t in tested]
    found = ", ".join(f"{m}.{column} {test}: {n}" for m, column, test, n in failed if n)
    if found:
        raise QualityError(f"failed tests: {found}")


def write_predictions(orders: DataFrame, path: str, delivered_only: bool = False) -> float:
    """Train on ``orders`` and write the predictions of the test orders; area under their ROC."""
    train, test = delivery_model.split(delivery_model.delay_features(orders, delivered_only))
    model = delivery_model.train(train)
    write_table(delivery_model.predict(model, test), path)
    return delivery_model.area_under_roc(model, test)


def train_model(
    spark: SparkSession, database: str, dst: str, delivered_only: bool = False
) -> float:
    """Train on the registered orders; area under ROC of the test orders.

    Their predictions are written beside the other datasets under ``dst`` and registered.
    """
    orders = catalog.read_table(spark, database, "dim_orders")
    path = f"{dst.rstrip('/')}/{PREDICTIONS}"
    auc = write_predictions(orders, path, delivered_only)
    catalog.register_parquet(spark, database, PREDICTIONS, path)
    return auc


def create_views(spark: SparkSession, database: str) -> None:
    """The two wide views that the questions are asked on: in the catalog, and by their bare names in this session."""
    for name, sql in views.VIEWS.items():
        catalog.create_sql_view(spark, database, name, sql(database))
        catalog.create_view(spark.table(catalog.qualified(database, name)), name)


def run_all(
    spark: SparkSession,
    src: str,
    dst: str,
    raw_database: str = "shop_raw",
    gold_database: str = "shop_dw",
    keep_versions: int = 2,
    buckets: int | None = None,
    statistics: bool = False,
    **ingest_options,
) -> RunSummary:
    """All stages in order. A failing stage raises, the later ones do not run, and tables and views stay as they were.

    Only when everything is written, tested and trained, the tables are switched to the new version.
    Of older versions the last ``keep_versions`` stay, for readers that still use them, and any that a
    table points to. ``ingest_options`` are those of ``ingest``.

    ``buckets`` writes items and orders in so many files sorted by order, so that the wide view joins them without
    a shuffle. An order's items are then in one file: leave it out where one order has a large share of all items.
    ``statistics`` counts rows and keys of the new tables for the planner, at one read of their keys.
    """
    version = versions.new_version()
    raw_root, gold_root = f"{dst.rstrip('/')}/raw", f"{dst.rstrip('/')}/warehouse"
    raw_base, gold_base = f"{raw_root}/{version}", f"{gold_root}/{version}"
    models = (SILVER, *GOLD_TABLES, SUMMARY)

    rows = ingest(spark, src, raw_base, **ingest_options)
    catalog.create_database(spark, gold_database)
    scratch = catalog.qualified(gold_database, f"scratch_{version.replace('-', '_')}")
    built, tested = build_checked(spark, raw_base, gold_base, model_checks(), buckets, scratch)
    tables = read_tables(spark, gold_base, models)
    translation = read_tables(spark, raw_base, [TRANSLATION])
    check_models(tables | translation, tested)
    auc = write_predictions(tables["dim_orders"], f"{gold_base}/{PREDICTIONS}")

    versions.publish(spark, raw_database, raw_base, RAW_TABLES)
    versions.publish(spark, gold_database, gold_base, (*models, PREDICTIONS), buckets, BUCKETED)
    if statistics:
        for name, keys in JOIN_KEYS.items():
            catalog.analyze(spark, gold_database, name, keys)
    create_views(spark, gold_database)
    for root, database, names in (
        (raw_root, raw_database, RAW_TABLES),
        (gold_root, gold_database, (*models, PREDICTIONS)),
    ):
        in_use = [catalog.location(spark, database, name) for name in names]
        versions.expire(spark, root, keep_versions, in_use)
    return RunSummary(rows=rows | built, auc=auc, version=version)

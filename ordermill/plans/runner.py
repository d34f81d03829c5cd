"""Runs the layers as a graph of steps and reports one status row per step."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ordermill.operators import audit, backtest, checks, churn, customers, demand, marts, orders, periods, revenue, rfm, sellers
from ordermill.plans.graph import Step, run_graph
from ordermill.sources import publish
from ordermill.sources.contract import RAW_TABLES
from ordermill.sources.ingest import ingest_source, ledger
from ordermill.sources.readers import read_table, without_metadata
from ordermill.sources.scratch import scratch_run
from ordermill.sources.writers import counted, rows_seen, write_csv_report, write_json_report, write_table

STATUS = "layer string, table_name string, status string, row_count bigint, duration_s double, error string"
LAYERS = ("bronze", "silver", "gold", "forecast", "export")
VARIANTS = ("standard", "study")
PARTITIONS = {
    "silver/orders": ["order_year_month"],
    "silver/master_orders": ["order_year_month"],
    "silver/product_demand": ["order_year_month"],
    "silver/seller_performance": ["seller_state"],
    "gold/churn_features": ["snapshot_date"],
    "gold/bi_revenue": ["order_year"],
}
GATES = {"silver/master_orders": "order_id"}  # tables that must hold one row per key


class Store:
    """Tables of a run, addressed by layer and name below one root folder."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet") -> None:
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str) -> DataFrame:
        return without_metadata(read_table(self.spark, self.path(table), fmt=self.fmt))

    def write(self, table: str, df: DataFrame) -> int:
        """Replace a table; returns its rows, counted while they were written."""
        layer, name = table.split("/")
        keys = PARTITIONS.get(table)
        if layer == "bronze" and RAW_TABLES[name].partition_by:
            keys = [RAW_TABLES[name].partition_by]
        seen_rows, seen = counted(df)
        write_table(seen_rows, self.path(table), keys, self.fmt, gather=layer != "bronze")
        return rows_seen(seen)


def bronze_steps(store: Store, sources: Mapping[str, str]) -> dict[str, Callable[[], DataFrame]]:
    """Raw tables are stored by a few values each, so every input split makes a few files: no shuffle gathers their rows."""
    return {
        name: (lambda name=name: ingest_source(store.spark, dict(sources), name, gather=False))
        for name in RAW_TABLES
    }


def silver_steps(store: Store, variant: str = "standard") -> dict[str, Callable[[], DataFrame]]:
    raw = lambda name: store.read(f"bronze/{name}")
    done = lambda name: store.read(f"silver/{name}")
    study = variant == "study"
    facts = orders.master_orders_by_row if study else orders.master_orders
    profile = customers.customer_profile_first_order if study else customers.customer_profile
    two_level = sellers.seller_performance_two_level if study else sellers.seller_performance
    return {
        "orders": lambda: orders.clean_orders(
            orders.require_unique(raw("orders"), "order_id", "orders"), delivered_only=study
        ),
        "order_items": lambda: orders.clean_order_items(raw("order_items")),
        "master_orders": lambda: facts(
            done("orders"), done("order_items"), raw("payments"), raw("reviews"), raw("customers")
        ),
        "customer_profile": lambda: profile(done("master_orders")),
        "product_demand": lambda: demand.product_demand(
            done("order_items"), done("orders"), raw("products"), raw("category_translation")
        ),
        "seller_performance": lambda: two_level(
            done("order_items"), done("master_orders"), raw("sellers")
        ),
    }


def _churn(store: Store) -> DataFrame:
    master = store.read("silver/master_orders")
    bounds = churn.require_snapshots(churn.snapshot_bounds(churn.eligible_orders(master)))
    return churn.churn_features(master, store.read("bronze/reviews"), bounds)


def _study_churn(store: Store) -> DataFrame:
    return churn.churn_features_first_known(store.read("silver/master_orders"))


def gold_steps(store: Store, variant: str = "standard") -> dict[str, Callable[[], DataFrame]]:
    done = lambda name: store.read(f"silver/{name}")
    if variant == "study":
        return {
            "demand_history": lambda: demand.demand_history(done("product_demand")),
            "demand_features": lambda: demand.demand_features_calendar(done("product_demand"), done("orders")),
            "churn_features": lambda: _study_churn(store),
            "rfm_segments": lambda: rfm.rfm_segments_by_rank(done("customer_profile")),
            "bi_revenue": lambda: revenue.bi_revenue_delivered(done("master_orders")),
        }
    return {
        "demand_features": lambda: demand.demand_features(done("product_demand")),
        "churn_features": lambda: _churn(store),
        "rfm_segments": lambda: rfm.rfm_segments(done("customer_profile")),
        "bi_revenue": lambda: revenue.bi_revenue(done("master_orders")),
    }


def forecast_steps(store: Store) -> dict[str, Callable[[], DataFrame]]:
    """The backtest's input and its out-of-fold predictions; no predictions where there are too few months."""

    def inputs() -> DataFrame:
        return backtest.prepare_backtest_input(backtest.backtest_input(store.read("gold/demand_features"), _coverage(store)))

    def predictions() -> DataFrame:
        rows = store.read("forecast/backtest_input")
        compared = backtest.boosted_backtest(rows, model_path=store.path("forecast/models")) if backtest.can_be_tested(rows) else backtest.no_predictions(rows)
        return backtest.with_champion(compared)

    return {"backtest_input": inputs, "predictions": predictions}


def _coverage(store: Store) -> DataFrame:
    return periods.flag_period_quality(periods.period_coverage(store.read("silver/orders")))


def _summary(store: Store) -> DataFrame:
    """Audit of the raw tables, row counts of the stored layers and excluded months."""
    raw = {name: store.read(f"bronze/{name}") for name in RAW_TABLES}
    plain = {name: df.drop(*RAW_TABLES[name].derived) for name, df in raw.items()}
    in_order = {name: df.select(*RAW_TABLES[name].columns) for name, df in plain.items()}
    layers = {layer: {name: store.read(f"{layer}/{name}") for name in names} for layer, names in SUMMARY_TABLES.items()}
    return checks.data_quality_summary(
        audit.audit_verdict(audit.audit_findings(in_order)), marts.layer_row_counts(layers), _coverage(store),
        gap=audit.lookup_gap(raw["products"], raw["category_translation"]),
    )


SUMMARY_TABLES = {
    "bronze": tuple(RAW_TABLES),
    "silver": ("orders", "order_items", "master_orders", "customer_profile", "product_demand", "seller_performance"),
    "gold": ("demand_features", "churn_features", "rfm_segments", "bi_revenue"),
}


def export_reports(store: Store) -> dict[str, tuple[Callable[[], DataFrame], list[str]]]:
    """The report tables by file name, each with the stored tables it is built from."""
    read = store.read
    predictions = "forecast/predictions"

    def delivery() -> DataFrame:
        return marts.delivery_performance(read("silver/orders"), _coverage(store))

    return {
        "overview_kpis.json": (lambda: marts.overview_kpis(read("silver/master_orders")), ["silver/master_orders"]),
        "period_quality.csv": (lambda: _coverage(store), ["silver/orders"]),
        "monthly_revenue.csv": (
            lambda: marts.monthly_revenue(read("gold/bi_revenue"), _coverage(store)), ["gold/bi_revenue", "silver/orders"],
        ),
        "state_revenue.csv": (lambda: marts.state_revenue(read("gold/bi_revenue")), ["gold/bi_revenue"]),
        "payment_mix.csv": (lambda: marts.payment_mix(read("gold/bi_revenue")), ["gold/bi_revenue"]),
        "delivery_performance.csv": (delivery, ["silver/orders"]),
        "delivery_trend.csv": (lambda: marts.delivery_trend(delivery()), ["silver/orders"]),
        "rfm_segment_distribution.csv": (lambda: rfm.rfm_distribution(read("gold/rfm_segments")), ["gold/rfm_segments"]),
        "rfm_segment_profiles.csv": (lambda: rfm.rfm_profiles(read("gold/rfm_segments")), ["gold/rfm_segments"]),
        "seller_performance.csv": (
            lambda: sellers.seller_ranking(read("silver/seller_performance")), ["silver/seller_performance"],
        ),
        "churn_summary.json": (lambda: churn.churn_summary(read("gold/churn_features")), ["gold/churn_features"]),
        "demand_history.csv": (lambda: demand.demand_history(read("silver/product_demand")), ["silver/product_demand"]),
        "demand_backtest_input.csv": (lambda: read("forecast/backtest_input"), ["forecast/backtest_input"]),
        "demand_backtest_predictions.csv": (lambda: read(predictions), [predictions]),
        "demand_backtest_monthly_aggregate.csv": (lambda: backtest.backtest_monthly(read(predictions)), [predictions]),
        "demand_backtest_category_errors.csv": (lambda: backtest.backtest_category_errors(read(predictions)), [predictions]),
        "demand_backtest_fold_metrics.csv": (lambda: backtest.fold_metrics(read(predictions)), [predictions]),
        "demand_model_metrics.json": (lambda: backtest.model_metrics(read(predictions)), [predictions]),
        "data_quality_summary.json": (
            lambda: _summary(store), [f"{layer}/{name}" for layer, names in SUMMARY_TABLES.items() for name in names],
        ),
    }


def export_graph(store: Store) -> list[Step]:
    """Write every report into a folder of this run; the last step publishes them all by one manifest."""
    folder, run = store.path("export"), publish.new_folder()
    entries: dict[str, publish.Entry] = {}

    def write(name: str, build: Callable[[], DataFrame]) -> int:
        rows, seen = counted(build())
        (write_json_report if name.endswith(".json") else write_csv_report)(rows, f"{folder}/{run}/{name}")
        entries[name] = publish.Entry(name, f"{run}/{name}", rows_seen(seen))
        return entries[name].row_count

    def announce() -> int:
        publish.publish(store.spark, folder, list(entries.values()))
        publish.drop_unpublished(store.spark, folder)
        return len(entries)

    reports = export_reports(store)
    steps = [Step("export", name, partial(write, name, build), tuple(needs)) for name, (build, needs) in reports.items()]
    return [*steps, Step("export", publish.MANIFEST, announce, tuple(step.key for step in steps))]


# What each table is built from.
NEEDS = {
    "silver/orders": ["bronze/orders"],
    "silver/order_items": ["bronze/order_items"],
    "silver/master_orders": ["silver/orders", "silver/order_items", "bronze/payments", "bronze/reviews", "bronze/customers"],
    "silver/customer_profile": ["silver/master_orders"],
    "silver/product_demand": ["silver/order_items", "silver/orders", "bronze/products", "bronze/category_translation"],
    "silver/seller_performance": ["silver/order_items", "silver/master_orders", "bronze/sellers"],
    "gold/demand_history": ["silver/product_demand"],
    "gold/demand_features": ["silver/product_demand", "silver/orders"],
    "gold/churn_features": ["silver/master_orders", "bronze/reviews"],
    "gold/rfm_segments": ["silver/customer_profile"],
    "gold/bi_revenue": ["silver/master_orders"],
    "forecast/backtest_input": ["gold/demand_features", "silver/orders"],
    "forecast/predictions": ["forecast/backtest_input"],
}


def table_steps(
    store: Store, layer: str, builders: Mapping[str, Callable[[], DataFrame]], gates: Mapping[str, str] = GATES
) -> list[Step]:
    """One step per table: build it, write it, and check its gate on what was written."""

    def run(key: str, build: Callable[[], DataFrame]) -> int:
        rows = store.write(key, build())
        if layer == "bronze":  # cells that did not parse lie beside the table
            write_table(ledger(read_table(store.spark, store.path(key), fmt=store.fmt), key.split("/")[1]), store.path(f"rejected/{key.split('/')[1]}"))
        if key in gates:
            orders.require_unique(store.read(key), gates[key], key.split("/")[1])
        return rows

    keys = {name: f"{layer}/{name}" for name in builders}
    return [Step(layer, name, partial(run, keys[name], build), tuple(NEEDS.get(keys[name], ()))) for name, build in builders.items()]


def run_steps(store: Store, layer: str, steps: Mapping[str, Callable[[], DataFrame]]) -> list[tuple]:
    """Build and write every table; a failing step is reported and the rest goes on."""
    return [outcome.row for outcome in run_graph(store.spark, table_steps(store, layer, steps))]


def run_layers(
    spark: SparkSession,
    root: str,
    sources: Mapping[str, str] | None = None,
    layers: tuple[str, ...] = LAYERS,
    fmt: str = "parquet",
    variant: str = "standard",
    gates: Mapping[str, str] | None = None,
) -> DataFrame:
    """Run the chosen layers as one graph; one status row per table.

    Independent tables are built at the same time; tables below a failed one
    are SKIPPED, with its name as the error. ``gates`` names further tables
    that must hold one row per key. Reports are published only if none of
    them failed; else the former set stays.
    ``variant`` "study": single-row payments, calendar lags, percent-rank
    segments, delivered revenue and the panel of the fixed study window.
    Intermediate tables of the run are deleted at its end, no others.
    """
    if variant not in VARIANTS:
        raise ValueError(f"unknown variant: {variant}")
    store = Store(spark, root, fmt)
    builders = {
        "bronze": lambda: bronze_steps(store, sources or {}),
        "silver": lambda: silver_steps(store, variant),
        "gold": lambda: gold_steps(store, variant),
        "forecast": lambda: forecast_steps(store),
    }
    checked = GATES | dict(gates or {})
    steps: list[Step] = []
    for layer in layers:
        steps += export_graph(store) if layer == "export" else table_steps(store, layer, builders[layer](), checked)
    with scratch_run(spark):
        outcomes = run_graph(spark, steps)
    return spark.createDataFrame([outcome.row for outcome in outcomes], STATUS)


def exit_code(status: DataFrame) -> int:
    return 0 if status.where("status = 'FAILED'").isEmpty() else 1


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Build the analytics tables layer by layer.")
    parser.add_argument("--layer", choices=[*LAYERS, "all"], default="all")
    parser.add_argument("--root", required=True, help="folder of the tables")
    parser.add_argument("--raw", help="folder with one <table>.csv per raw table")
    parser.add_argument("--format", default="parquet")
    parser.add_argument("--variant", choices=VARIANTS, default="standard")
    options = parser.parse_args(argv)
    spark = SparkSession.builder.appName("ordermill").getOrCreate()
    raw = (options.raw or "").rstrip("/")
    sources = {name: f"{raw}/{name}.csv" for name in RAW_TABLES} if raw else {}
    layers = LAYERS if options.layer == "all" else (options.layer,)
    status = run_layers(spark, options.root, sources, layers, options.format, options.variant)
    status.drop("error").show(100, truncate=False)
    return exit_code(status)


if __name__ == "__main__":
    sys.exit(main())

"""Registered queries of readers, typing and writers.

Each writes given tables to scratch storage and reads them back.
"""

from __future__ import annotations

import uuid
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ordermill.operators import audit, orders
from ordermill.operators.marts import row_counts
from ordermill.plans import runner
from ordermill.plans.graph import Step, run_graph
from ordermill.plans.presentation import show, times
from ordermill.plans.report_queries import EXPORT_SQL, LAYER_SQL, RAW_SQL
from ordermill.plans.shop import Shop, sql
from ordermill.sources import publish, readers, writers
from ordermill.sources.contract import RAW_TABLES
from ordermill.sources.ingest import ingest, ledger, row_hash, value_reconciliation, with_metadata, with_rejections
from ordermill.sources.scratch import materialize, scratch_path


def as_text(df: DataFrame) -> DataFrame:
    """All columns as a text file would hold them."""

    def written(name: str) -> Column:
        if df.schema[name].dataType.typeName().startswith("timestamp"):
            return F.date_format(name, "yyyy-MM-dd HH:mm:ss")
        return F.col(name).cast(StringType())

    return df.select(*[written(name).alias(name) for name in df.columns])


def _ingested(name: str):
    def build(shop: Shop):
        raw = as_text(shop.raw_tables[name])
        if name == "payments":
            spoiled = F.when(F.col("payment_installments") != "1", F.col("payment_installments"))
            raw = raw.withColumn("payment_installments", F.coalesce(spoiled, F.lit("n/a")))
        return show(ingest(raw, name))

    return build


def _ingested_sql(name: str) -> str:
    columns = []
    for column, kind in RAW_TABLES[name].columns.items():
        if name == "payments" and column == "payment_installments":
            columns.append("CASE WHEN payment_installments <> 1 THEN payment_installments END AS payment_installments")
        elif kind == "timestamp":
            columns.append(times(column))
        elif kind == "string":
            columns.append(f"CAST({column} AS VARCHAR) AS {column}")
        else:
            columns.append(f"CAST({column} AS {kind.upper()}) AS {column}")
    if name == "order_items":
        columns.append("CAST(year(shipping_limit_date) AS INTEGER) AS shipping_year")
    view = RAW_SQL[name]
    return sql(f"SELECT {', '.join(columns)} FROM {view}", view)


def _csv(shop: Shop):
    path = scratch_path(shop.spark, "csv")
    writers.write_csv(shop.items, path)
    back = readers.read_csv(shop.spark, path, shop.items.schema)
    return show(back)


def _csv_multiline(shop: Shop):
    path = scratch_path(shop.spark, "csv")
    writers.write_csv(shop.reviews, path)
    back = readers.read_csv(shop.spark, path, shop.reviews.schema, multiline=True)
    return show(back)


def _reconciled(shop: Shop):
    path = scratch_path(shop.spark, "csv")
    writers.write_csv(shop.reviews, path)
    return readers.reader_reconciliation(shop.spark, path, shop.reviews)


def _parquet(shop: Shop):
    return show(writers.write_table(shop.orders, scratch_path(shop.spark, "orders")))


def _partitioned(shop: Shop):
    path = scratch_path(shop.spark, "payments")
    return writers.write_table(shop.payments, path, ["payment_type"])


def _managed(shop: Shop):
    schema = f"shop_{uuid.uuid4().hex}"
    writers.ensure_schema(
        shop.spark, schema, comment="round trip", location=scratch_path(shop.spark, "schema")
    )
    table = writers.write_catalog_table(shop.sellers, f"{schema}.sellers")
    found = materialize(table, "sellers")
    shop.spark.sql(f"DROP SCHEMA {schema} CASCADE")
    return found


def _without_metadata(shop: Shop):
    path = scratch_path(shop.spark, "customers")
    stored = writers.write_table(with_metadata(shop.customers, "customers"), path)
    return readers.without_metadata(stored)


def _hashed(shop: Shop):
    hashed = ["order_id", "payment_sequential", "payment_type", "installments", "payment_value"]
    rows = shop.payments.withColumn(
        "installments", F.when(F.col("payment_installments") > 10, F.col("payment_installments"))
    )
    return rows.select("order_id", "payment_sequential", row_hash(hashed).alias("row_hash"))


# Rows that each raw table must have, counted on the given tables alone.
_BASES = {
    "orders": "SELECT count(*) FROM {orders}",
    "customers": "SELECT count(*) FROM {customer}",
    "order_items": "SELECT count(*) FROM {lineitem}",
    "payments": "SELECT count(*) FROM {lineitem}",
    "reviews": "SELECT count_if(o_orderpriority <> '5-LOW') + count_if(o_orderpriority = '1-URGENT') FROM {orders}",
    "products": "SELECT count(*) FROM {part}",
    "sellers": "SELECT count(*) FROM {supplier}",
    "geolocation": "SELECT count(*) FROM {customer}",
    "category_translation": "SELECT count(DISTINCT concat(p_brand, '/', p_type)) FROM {part} WHERE p_type <> 'PROMO' AND p_size <> 50",
}
_GIVEN = ("orders", "customer", "lineitem", "part", "supplier")


def _source_counts(shop: Shop):
    tables = {name: shop.table(name) for name in _GIVEN}
    expected = reduce(
        DataFrame.unionAll,
        [
            shop.spark.sql(query, **tables).toDF("expected_rows").selectExpr(f"'{name}' AS table_name", "expected_rows")
            for name, query in _BASES.items()
        ],
    )
    return audit.source_row_counts(shop.raw_tables, expected)


def _ingest_counts(shop: Shop):
    written = {
        name: writers.write_table(with_metadata(df, name), scratch_path(shop.spark, name))
        for name, df in shop.raw_tables.items()
    }
    expected = row_counts(shop.raw_tables)
    return audit.source_row_counts(written, expected.withColumnRenamed("row_count", "expected_rows"))


def _compared_sql(pairs: dict[str, tuple[str, str]]) -> str:
    """Counts of two queries per table and whether they agree."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, expected_rows, actual_rows,"
        f" CASE WHEN expected_rows = actual_rows THEN 'PASS' ELSE 'FAIL' END AS status"
        f" FROM (SELECT CAST(({expected}) AS BIGINT) AS expected_rows, ({actual}) AS actual_rows)"
        for name, (expected, actual) in pairs.items()
    )


def _step_status(shop: Shop):
    store = runner.Store(shop.spark, scratch_path(shop.spark, "store"))
    steps = {
        "orders": lambda: shop.clean_orders,
        "order_items": lambda: shop.clean_items,
        "broken": lambda: orders.require_unique(shop.items, "order_id", "broken"),
        "customers": lambda: shop.customers,
    }
    rows = runner.run_steps(store, "silver", steps)
    status = shop.spark.createDataFrame(rows, runner.STATUS)
    return status.select("layer", "table_name", "status", "row_count")


def _raw_files(shop: Shop) -> dict[str, str]:
    """The raw tables as compressed CSV files, as a delivery brings them: many files, each read by one task."""
    sources = {name: scratch_path(shop.spark, f"raw-{name}") for name in shop.raw_tables}
    for name, path in sources.items():
        writers.write_csv(as_text(shop.raw_tables[name]), path, "gzip")
    return sources


# Cells of the raw tables that are replaced by unreadable text: (table, column, SQL condition, text).
_SPOILED = [
    ("orders", "order_purchase_timestamp", "order_id % 31 = 0", "2018-13-45 00:00:00"),
    ("orders", "order_approved_at", "order_id % 29 = 0", "soon"),
    ("customers", "customer_zip_code_prefix", "customer_id % 11 = 0", "04 711"),
    ("order_items", "order_item_id", "order_id % 37 = 0", "one"),
    ("order_items", "price", "order_id % 41 = 0", "12,50"),
    ("order_items", "shipping_limit_date", "order_id % 43 = 0", "31/12/2017"),
    ("payments", "payment_installments", "payment_installments = 1", "n/a"),
    ("payments", "payment_value", "order_id % 47 = 0", "R$ 10"),
    ("reviews", "review_score", "review_id % 13 = 0", "five"),
    ("products", "product_weight_g", "product_id % 17 = 0", "--"),
    ("geolocation", "geolocation_lat", "geolocation_zip_code_prefix = 3", "23S"),
]


def _spoiled(shop: Shop, name: str) -> DataFrame:
    typed = shop.raw_tables[name]
    text = {
        column: F.when(F.expr(condition) & F.col(column).isNotNull(), F.lit(value))
        for table, column, condition, value in _SPOILED
        if table == name
    }
    marked = typed.withColumns({f"bad_{column}": bad for column, bad in text.items()}) if text else typed
    plain = as_text(marked)
    return plain.withColumns({column: F.coalesce(f"bad_{column}", column) for column in text}).drop(*[f"bad_{c}" for c in text])


def _stored_with_ledger(shop: Shop) -> dict[str, tuple[DataFrame, DataFrame, DataFrame]]:
    """By table: the raw text, the stored table and its ledger, both read back; some tables at the same time."""
    raw = {name: _spoiled(shop, name) for name in RAW_TABLES}
    result = {}

    def store(name: str) -> int:
        stored = writers.write_table(with_metadata(with_rejections(raw[name], name), name), scratch_path(shop.spark, name))
        result[name] = (raw[name], stored, materialize(ledger(stored, name), f"rejected-{name}"))
        return 0

    for outcome in run_graph(shop.spark, [Step("raw", name, partial(store, name)) for name in RAW_TABLES]):
        if outcome.error:
            raise RuntimeError(f"{outcome.step.key}: {outcome.error}")
    return {name: result[name] for name in RAW_TABLES}


def _rejected(shop: Shop) -> DataFrame:
    """Rejected cells of all raw tables; each must name a stored row."""
    parts = [
        rejected.join(stored.select(F.col("_row_hash").alias("row_hash")), "row_hash", "left_semi")
        for _, stored, rejected in _stored_with_ledger(shop).values()
    ]
    return reduce(DataFrame.unionAll, parts).groupBy("table_name", "column_name", "text", "reason").agg(F.count(F.lit(1)).alias("cells"))


def _rejected_sql() -> str:
    parts = [
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{text}' AS text, 'no {RAW_TABLES[table].columns[column]}' AS reason,"
        f" count(*) AS cells FROM {RAW_SQL[table]} WHERE {condition} AND {column} IS NOT NULL HAVING count(*) > 0"
        for table, column, condition, text in _SPOILED
    ]
    return sql(" UNION ALL ".join(parts), *dict.fromkeys(RAW_SQL[table] for table, *_ in _SPOILED))


def _values(shop: Shop) -> DataFrame:
    parts = [value_reconciliation(*tables, name) for name, tables in _stored_with_ledger(shop).items()]
    return reduce(DataFrame.unionAll, parts)


def _values_sql() -> str:
    bad = {(table, column): condition for table, column, condition, _ in _SPOILED}
    parts = []
    for table, raw in RAW_TABLES.items():
        for column, kind in raw.columns.items():
            if kind != "string":
                lost = f"count(*) FILTER (WHERE {bad.get((table, column), 'false')} AND {column} IS NOT NULL)"
                parts.append(
                    f"SELECT '{table}' AS table_name, '{column}' AS column_name, count({column}) AS raw_values,"
                    f" count({column}) - {lost} AS typed_values, {lost} AS rejected_values, 'PASS' AS status FROM {RAW_SQL[table]}"
                )
    return sql(" UNION ALL ".join(parts), *RAW_SQL.values())


# A gate that the data cannot pass: categories occur in many months.
_SEEDED = {"silver/product_demand": "category_name_english"}
_BELOW = [
    "gold/demand_features", "forecast/backtest_input", "forecast/predictions", "export/data_quality_summary.json",
    "export/demand_history.csv", "export/demand_backtest_input.csv", "export/demand_backtest_predictions.csv",
    "export/demand_backtest_monthly_aggregate.csv", "export/demand_backtest_category_errors.csv",
    "export/demand_backtest_fold_metrics.csv", "export/demand_model_metrics.json", "export/export_manifest.json",
]


def _pipeline_status(shop: Shop):
    """All layers from raw files, with one table in the middle that fails its gate."""
    status = runner.run_layers(shop.spark, scratch_path(shop.spark, "store"), _raw_files(shop), gates=_SEEDED)
    reason = F.when(F.col("status") == "SKIPPED", F.col("error")).when(F.col("status") == "FAILED", "gate")
    return status.select("layer", "table_name", "status", "row_count", reason.alias("reason"))


def _pipeline_sql() -> str:
    tables = {f"{layer}/{name}": source for layer, names in LAYER_SQL.items() for name, source in names.items()}
    tables |= {f"export/{name}": source for name, (source, _) in EXPORT_SQL.items()}
    tables |= {"forecast/backtest_input": "", "forecast/predictions": "", "export/export_manifest.json": ""}
    uses = [source for names in LAYER_SQL.values() for source in names.values()]
    uses += [use for _, use in EXPORT_SQL.values() if use]

    def row(key: str) -> str:
        layer, name = key.split("/")
        state, rows, reason = "SUCCESS", f"(SELECT count(*) FROM {tables[key]})", "NULL"
        if key in _SEEDED:
            state, rows, reason = "FAILED", "NULL", "'gate'"
        elif key in _BELOW:
            state, rows, reason = "SKIPPED", "NULL", "'below silver/product_demand'"
        return (
            f"SELECT '{layer}' AS layer, '{name}' AS table_name, '{state}' AS status, CAST({rows} AS BIGINT) AS row_count,"
            f" CAST({reason} AS VARCHAR) AS reason"
        )

    return sql(" UNION ALL ".join(row(key) for key in tables), *dict.fromkeys(uses))


def _export_manifest(shop: Shop):
    """All layers from raw files; the published manifest next to what lies on disk."""
    store = runner.Store(shop.spark, scratch_path(shop.spark, "store"))
    status = runner.run_layers(shop.spark, store.root, _raw_files(shop))
    if runner.exit_code(status):
        raise RuntimeError(f"the run failed: {[tuple(r) for r in status.where('error is not null').collect()]}")
    folder = store.path("export")
    listed = publish.read_manifest(shop.spark, folder)
    found = {name: publish.read_published(shop.spark, folder, name) for name in runner.export_reports(store)}
    on_disk = row_counts(found, name="filename").withColumnRenamed("row_count", "rows_on_disk")
    return listed.join(on_disk, "filename", "full").select("filename", "row_count", "rows_on_disk")


def _export_sql() -> str:
    rows = [
        f"SELECT '{name}' AS filename, CAST(n AS BIGINT) AS row_count, CAST(n AS BIGINT) AS rows_on_disk FROM (SELECT count(*) AS n FROM {source})"
        for name, (source, _) in EXPORT_SQL.items()
    ]
    return sql(" UNION ALL ".join(rows), *dict.fromkeys(use for _, use in EXPORT_SQL.values() if use))


QUERIES = {
    "pipeline_status": (_pipeline_status, _pipeline_sql()),
    "export_manifest": (_export_manifest, _export_sql()),
    "rejected_values": (_rejected, _rejected_sql()),
    "value_reconciliation": (_values, _values_sql()),
    "csv_roundtrip": (
        _csv,
        sql(f"SELECT * EXCLUDE (shipping_limit_date), {times('shipping_limit_date')} FROM v_items", "v_items"),
    ),
    "csv_multiline_roundtrip": (
        _csv_multiline,
        sql(
            "SELECT * EXCLUDE (review_creation_date, review_answer_timestamp),"
            f" {times('review_creation_date', 'review_answer_timestamp')} FROM v_reviews",
            "v_reviews",
        ),
    ),
    "reader_reconciliation": (
        _reconciled,
        sql(
            "SELECT expected_rows, naive_rows, multiline_rows, naive_rows <> expected_rows AND multiline_rows = expected_rows"
            " AS multiline_explains_difference FROM (SELECT count(*) AS expected_rows, count(*) AS multiline_rows,"
            " CAST(sum(1 + length(review_comment_message) - length(replace(review_comment_message, chr(10), ''))) AS BIGINT)"
            " AS naive_rows FROM v_reviews)",
            "v_reviews",
        ),
    ),
    "source_manifest": (
        lambda shop: readers.source_manifest(shop.spark, shop.folder, "*.parquet"),
        None,
    ),
    "parquet_roundtrip": (
        _parquet,
        sql(
            "SELECT order_id, customer_id, order_status, "
            + times(*[n for n, kind in RAW_TABLES["orders"].columns.items() if kind == "timestamp"])
            + " FROM v_orders",
            "v_orders",
        ),
    ),
    "partitioned_roundtrip": (_partitioned, sql("SELECT * FROM v_payments", "v_payments")),
    "managed_table_roundtrip": (_managed, sql("SELECT * FROM v_sellers", "v_sellers")),
    "scan_drop_metadata": (_without_metadata, sql("SELECT * FROM v_customers", "v_customers")),
    "row_hash": (
        _hashed,
        sql(
            """SELECT order_id, payment_sequential, md5(concat_ws('||', CAST(order_id AS VARCHAR), CAST(payment_sequential AS VARCHAR),
            payment_type, CASE WHEN payment_installments > 10 THEN CAST(payment_installments AS VARCHAR) ELSE '<NULL>' END,
            CAST(payment_value AS VARCHAR))) AS row_hash
            FROM v_payments""",
            "v_payments",
        ),
    ),
    "source_row_count_check": (
        _source_counts,
        sql(
            _compared_sql(
                {
                    name: (query.format(**{given: given for given in _GIVEN}), f"SELECT count(*) FROM {RAW_SQL[name]}")
                    for name, query in _BASES.items()
                }
            ),
            *RAW_SQL.values(),
        ),
    ),
    "ingest_reconciliation": (
        _ingest_counts,
        sql(
            _compared_sql({name: (f"SELECT count(*) FROM {view}",) * 2 for name, view in RAW_SQL.items()}),
            *RAW_SQL.values(),
        ),
    ),
    "step_status": (
        _step_status,
        sql(
            "SELECT 'silver' AS layer, 'orders' AS table_name, 'SUCCESS' AS status, count(*) AS row_count FROM c_orders"
            " UNION ALL SELECT 'silver', 'order_items', 'SUCCESS', count(*) FROM c_items"
            " UNION ALL SELECT 'silver', 'broken', 'FAILED', NULL"
            " UNION ALL SELECT 'silver', 'customers', 'SUCCESS', count(*) FROM v_customers",
            "c_orders", "c_items", "v_customers",
        ),
    ),
    **{f"ingest_{name}": (_ingested(name), _ingested_sql(name)) for name in RAW_TABLES},
}

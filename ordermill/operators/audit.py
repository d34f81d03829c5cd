"""Audit of raw tables: schema, keys, references, ranges and a verdict.

Every check is an aggregate over whole tables; findings are rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.operators.marts import row_counts
from ordermill.sources.contract import RAW_TABLES, TIMESTAMP_FORMAT

# Which column must be found in which other table.
REFERENCES = [
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("order_items", "seller_id", "sellers", "seller_id"),
    ("payments", "order_id", "orders", "order_id"),
    ("reviews", "order_id", "orders", "order_id"),
]
PRIMARY_KEYS = {
    "orders": "order_id",
    "customers": "customer_id",
    "products": "product_id",
    "sellers": "seller_id",
}
NEVER_NEGATIVE = [
    ("order_items", "price"),
    ("order_items", "freight_value"),
    ("payments", "payment_value"),
]
ORDER_TIMES = [
    name for name, kind in RAW_TABLES["orders"].columns.items() if kind == "timestamp"
]
ABSENT = -1


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, frames)


def _as_rows(totals: DataFrame, name: str, value: str) -> DataFrame:
    """Turn the one row of ``totals`` into (name, value) rows."""
    pairs = [
        F.struct(F.lit(column).alias(name), F.col(f"`{column}`").cast("bigint").alias(value))
        for column in totals.columns
    ]
    return totals.select(F.inline(F.array(*pairs)))


def expected_vs_actual(expected: DataFrame, actual: DataFrame, name: str = "name") -> DataFrame:
    """Names on one side only, as ``missing`` or ``unexpected``."""
    missing = expected.select(name).join(actual.select(name), name, "left_anti")
    unexpected = actual.select(name).join(expected.select(name), name, "left_anti")
    return missing.withColumn("status", F.lit("missing")).unionAll(
        unexpected.withColumn("status", F.lit("unexpected"))
    )


def schema_results(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    expected: Mapping[str, list[str]] | None = None,
) -> DataFrame:
    """Whether each expected table is there with exactly the expected column order."""
    wanted = expected or {name: list(table.columns) for name, table in RAW_TABLES.items()}
    rows = []
    for name, columns in wanted.items():
        if name not in tables:
            rows.append((name, False, "missing file"))
        else:
            same = tables[name].columns == list(columns)
            rows.append((name, same, None if same else "schema mismatch"))
    return spark.createDataFrame(rows, "table_name string, valid boolean, error string")


def column_profile(df: DataFrame, table: str) -> DataFrame:
    """NULLs per column and the row count, from one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_count"))
        for i, c in enumerate(df.columns)
    ]
    return counted.select(F.lit(table).alias("table_name"), "row_count", F.inline(F.array(*pairs)))


def exact_duplicates(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in every column.

    A first pass counts 64-bit hashes of the rows, 8 bytes a row in the
    shuffle. Whole rows are shuffled and compared only where a hash occurs more
    than once, so rows that merely share a hash are told apart.
    """
    cells = [F.col(f"`{name}`") for name in df.columns]
    cells += [cell.isNull() for cell in cells]  # hashing skips missing values
    hashed = df.withColumn("_hash", F.xxhash64(*cells))
    often = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select("_hash")
    suspects = hashed.join(often, "_hash", "left_semi")
    copies = suspects.groupBy("_hash", *[F.col(f"`{name}`") for name in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))
    surplus = F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0))
    return copies.agg(surplus.alias("exact_duplicate_rows"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows with a key that occurred before; rows without a key do not count."""
    copies = (
        df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_copies"))
    )
    surplus = F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0))
    return copies.agg(surplus.alias("duplicate_rows"))


def _repeated_values(df: DataFrame, key: str) -> DataFrame:
    """As ``duplicate_keys``, with missing values counting as one value."""
    copies = df.groupBy(key).agg(F.count(F.lit(1)).alias("_copies"))
    surplus = F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0))
    return copies.agg(surplus.alias("duplicate_rows"))


def missing_references(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Child rows whose non-NULL key has no parent.

    Child rows are counted per key first, so a key held by very many rows is
    one row in the join.
    """
    used = (
        child.where(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("_key"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    known = parent.select(F.col(parent_key).alias("_key"))
    orphans = used.join(known, "_key", "left_anti")
    return orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("missing_rows"))


def reference_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All cross-table references; -1 where a table is absent."""
    results = []
    for child, child_key, parent, parent_key in REFERENCES:
        label = F.lit(f"{child}.{child_key} not found in {parent}.{parent_key}").alias("check_name")
        if child in tables and parent in tables:
            found = missing_references(tables[child], child_key, tables[parent], parent_key)
            results.append(found.select(label, F.col("missing_rows").cast("bigint")))
        else:
            spark = next(iter(tables.values())).sparkSession
            results.append(
                spark.range(1).select(label, F.lit(ABSENT).cast("bigint").alias("missing_rows"))
            )
    return _stack(results)


def untranslated_categories(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Product categories without a translation, one row each with its products."""
    used = (
        products.where(F.col("product_category_name").isNotNull())
        .groupBy("product_category_name")
        .agg(F.count(F.lit(1)).alias("product_rows"))
    )
    known = translation.select("product_category_name")
    return used.join(known, "product_category_name", "left_anti").orderBy("product_category_name")


def lookup_gap(products: DataFrame, translation: DataFrame) -> DataFrame:
    """How many products and categories lack a translation."""
    return untranslated_categories(products, translation).agg(
        F.coalesce(F.sum("product_rows"), F.lit(0)).alias("unmatched_product_row_count"),
        F.count(F.lit(1)).alias("unmatched_distinct_category_count"),
    )


def _as_time(name: str, df: DataFrame) -> Column:
    if df.schema[name].dataType.typeName() != "string":
        return F.col(name)
    return F.try_to_timestamp(F.col(name), F.lit(TIMESTAMP_FORMAT))


def sanity_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Offending rows per sanity check; one pass per table plus one per key."""
    by_table: dict[str, list[Column]] = {}

    def count(table: str, label: str, offending: Column) -> None:
        by_table.setdefault(table, []).append(F.count_if(offending).alias(label))

    for table, column in NEVER_NEGATIVE:
        count(table, f"negative {table}.{column}", F.col(column).try_cast("double") < 0)
    score = F.col("review_score").try_cast("double")
    off_scale = score.isNull() | ~score.between(1, 5)
    count("reviews", "review score outside 1-5", F.col("review_score").isNotNull() & off_scale)
    orders = tables["orders"]
    for name in ORDER_TIMES:
        if name in orders.columns:
            unreadable = F.col(name).isNotNull() & _as_time(name, orders).isNull()
            count("orders", f"invalid orders.{name}", unreadable)
    early = _as_time("order_delivered_customer_date", orders) < _as_time(
        "order_purchase_timestamp", orders
    )
    count("orders", "delivered before purchase", early)

    results = [
        _as_rows(tables[table].agg(*columns), "check_name", "offending_rows")
        for table, columns in by_table.items()
    ]
    for table, key in PRIMARY_KEYS.items():
        results.append(
            duplicate_keys(tables[table], key).select(
                F.lit(f"duplicate {table}.{key}").alias("check_name"),
                F.col("duplicate_rows").cast("bigint").alias("offending_rows"),
            )
        )
    return _stack(results)


def _sanity_category() -> Column:
    """Failure named in the verdict for each kind of sanity check."""
    check = F.col("check_name")
    return (
        F.when(check.startswith("negative"), "negative monetary values")
        .when(check.startswith("review score"), "review scores outside 1-5")
        .when(check.startswith("invalid"), "invalid order timestamps")
        .when(check.startswith("delivered"), "delivered date before purchase date")
        .otherwise("duplicate primary IDs")
    )


def purchase_range(orders: DataFrame) -> DataFrame:
    """Earliest and latest readable purchase time."""
    bought = _as_time("order_purchase_timestamp", orders)
    return orders.agg(
        F.min(bought).alias("earliest_purchase"), F.max(bought).alias("latest_purchase")
    )


def audit_findings(
    tables: Mapping[str, DataFrame],
    unexpected_files: list[str] | None = None,
    expected: Mapping[str, list[str]] | None = None,
) -> DataFrame:
    """Every fatal and warning check with its count; a count other than 0 is a finding."""
    spark = next(iter(tables.values())).sparkSession
    wanted = expected or {name: list(table.columns) for name, table in RAW_TABLES.items()}
    absent = [name for name in wanted if name not in tables]
    findings = []

    def add(severity: str, category: str | None, counts: DataFrame) -> None:
        name, value = counts.columns
        findings.append(
            counts.select(
                F.lit(severity).alias("severity"),
                (F.lit(category) if category else _sanity_category()).alias("category"),
                F.col(name).alias("check_name"),
                F.col(value).cast("bigint").alias("finding_count"),
            )
        )

    def fixed(name: str, value: int) -> DataFrame:
        return spark.range(1).select(F.lit(name).alias("n"), F.lit(value).alias("v"))

    add("fatal", "missing expected files", fixed("missing files", len(absent)))
    mismatches = schema_results(spark, tables, expected).where("not valid").count()
    add("fatal", "schema mismatch", fixed("tables with another schema", mismatches))
    add("fatal", "relationship mismatch", reference_checks(tables))
    # The translation is only a lookup: the sanity checks do without it.
    if not set(absent) - {"category_translation"}:
        add("fatal", None, sanity_counts(tables))
        if "geolocation" in tables:
            repeated = _repeated_values(tables["geolocation"], "geolocation_zip_code_prefix")
            add(
                "warning",
                "repeated zip codes",
                repeated.select(F.lit("geolocation zip codes").alias("n"), "duplicate_rows"),
            )

    add("warning", "unexpected files", fixed("unexpected files", len(unexpected_files or [])))
    for name, df in tables.items():
        copies = exact_duplicates(df)
        add(
            "warning",
            "exact duplicate rows",
            copies.select(F.lit(name).alias("n"), "exact_duplicate_rows"),
        )
    if "products" in tables and "category_translation" in tables:
        gap = lookup_gap(tables["products"], tables["category_translation"])
        add(
            "warning",
            "untranslated categories",
            gap.select(F.lit("products").alias("n"), "unmatched_product_row_count"),
        )
    return _stack(findings)


def audit_verdict(findings: DataFrame) -> DataFrame:
    """READY, READY WITH WARNINGS or NOT READY, with the number of findings behind it."""
    found = F.col("finding_count") != 0
    counted = findings.agg(
        F.count_if(found & (F.col("severity") == "fatal")).alias("fatal_checks"),
        F.count_if(found & (F.col("severity") == "warning")).alias("warning_checks"),
    )
    fatal, warned = F.col("fatal_checks") > 0, F.col("warning_checks") > 0
    return counted.withColumns(
        {
            "executive_verdict": F.when(fatal, "NOT READY")
            .when(warned, "READY WITH WARNINGS")
            .otherwise("READY"),
            "safe_to_run": F.when(fatal, "NO").otherwise("YES"),
        }
    )


def source_row_counts(
    tables: Mapping[str, DataFrame], expected: dict[str, int] | DataFrame
) -> DataFrame:
    """Actual against expected rows per source, as PASS or FAIL."""
    actual = row_counts(tables).withColumnRenamed("row_count", "actual_rows")
    if isinstance(expected, dict):
        spark = actual.sparkSession
        expected = spark.createDataFrame(list(expected.items()), "table_name string, expected_rows bigint")
    matches = F.col("actual_rows") == F.col("expected_rows")
    return (
        expected.join(actual, "table_name", "full")
        .withColumn("status", F.when(matches, "PASS").otherwise("FAIL"))
        .select("table_name", "expected_rows", "actual_rows", "status")
    )


def require_all_pass(report: DataFrame) -> DataFrame:
    """``report`` itself, after checking that no row says FAIL."""
    failed = report.where(F.col("status") != "PASS").count()
    if failed:
        raise ValueError(f"{failed} checks failed")
    return report

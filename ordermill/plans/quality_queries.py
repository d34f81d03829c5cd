"""Registered queries of audits and validation checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.labels import UNTRANSLATED_PREFIX
from ordermill.operators import audit, checks, demand, orders, revenue
from ordermill.operators.marts import layer_row_counts
from ordermill.operators.revenue import GRAIN
from ordermill.plans.report_queries import LAYER_SQL, RAW_SQL, all_layers
from ordermill.plans.shop import Shop, sql
from ordermill.sources.contract import RAW_TABLES
from ordermill.sources.scratch import materialize


# The key of each raw table: what a row stands for, or what it repeats on purpose.
_KEYS = {
    "orders": "order_id",
    "customers": "customer_id",
    "order_items": "order_id",
    "payments": "order_id",
    "reviews": "order_id",
    "products": "product_id",
    "sellers": "seller_id",
    "geolocation": "geolocation_zip_code_prefix",
    "category_translation": "product_category_name",
}


def _per_table(shop: Shop, build) -> DataFrame:
    """``build(table, name)`` of all raw tables, stacked."""
    return reduce(DataFrame.unionAll, [build(df, name) for name, df in shop.raw_tables.items()])


def _per_table_sql(select: str) -> str:
    """``select`` over all raw tables, with {name}, {view} and {key}."""
    parts = [select.format(name=name, view=view, key=_KEYS[name]) for name, view in RAW_SQL.items()]
    return sql(" UNION ALL ".join(parts), *RAW_SQL.values())


def _uniqueness(shop: Shop):
    return _per_table(
        shop,
        lambda df, name: orders.key_uniqueness(df, _KEYS[name]).withColumn("table_name", F.lit(name)),
    )


def _profile_sql() -> str:
    parts = [
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, count(*) AS row_count,"
        f" count(*) - count({column}) AS null_count FROM {view}"
        for table, view in RAW_SQL.items()
        for column in RAW_TABLES[table].columns
    ]
    return sql(" UNION ALL ".join(parts), *RAW_SQL.values())


def _named_duplicates(shop: Shop):
    return _per_table(
        shop, lambda df, name: audit.duplicate_keys(df, _KEYS[name]).withColumn("table_name", F.lit(name))
    )


def _exact_duplicates(shop: Shop):
    return _per_table(shop, lambda df, name: audit.exact_duplicates(df).withColumn("table_name", F.lit(name)))


# Every order is kept; every 13th key is altered, so that some references have no parent.
_ALTERED = "CASE WHEN order_id % 13 = 0 THEN -order_id ELSE order_id END AS order_id"


def _altered_orders(shop: Shop) -> DataFrame:
    order = F.col("order_id")
    return shop.orders.withColumn("order_id", F.when(order % 13 == 0, -order).otherwise(order))


def _references(shop: Shop):
    return audit.reference_checks({**shop.raw_tables, "orders": _altered_orders(shop)})


def _reference_sql() -> str:
    view = dict(RAW_SQL, orders=f"(SELECT * REPLACE ({_ALTERED}) FROM v_orders)")
    return sql(
        " UNION ALL ".join(
            f"SELECT '{child}.{ck} not found in {parent}.{pk}' AS check_name, count(*) AS missing_rows"
            f" FROM {view[child]} WHERE {ck} IS NOT NULL AND {ck} NOT IN (SELECT {pk} FROM {view[parent]} WHERE {pk} IS NOT NULL)"
            for child, ck, parent, pk in audit.REFERENCES
        ),
        *RAW_SQL.values(),
    )


# Order times that are replaced by unreadable text: by column, the divisor of the order ids concerned.
_UNREADABLE = {"order_approved_at": 23, "order_delivered_carrier_date": 29, "order_estimated_delivery_date": 31}


def _with_unreadable_times(shop: Shop) -> dict[str, DataFrame]:
    times = [name for name, kind in RAW_TABLES["orders"].columns.items() if kind == "timestamp"]
    text = {name: F.date_format(name, "yyyy-MM-dd HH:mm:ss") for name in times}
    for name, divisor in _UNREADABLE.items():
        bad = F.col(name).isNotNull() & (F.col("order_id") % divisor == 0)
        text[name] = F.when(bad, "2018-02-30 25:00:00").otherwise(text[name])
    return {**shop.raw_tables, "orders": shop.orders.withColumns(text)}


def _sanity_sql() -> str:
    times = [n for n, kind in RAW_TABLES["orders"].columns.items() if kind == "timestamp"]
    unreadable = {name: f"{name} IS NOT NULL AND order_id % {divisor} = 0" for name, divisor in _UNREADABLE.items()}
    rows = [
        ("negative order_items.price", "v_items WHERE price < 0"),
        ("negative order_items.freight_value", "v_items WHERE freight_value < 0"),
        ("negative payments.payment_value", "v_payments WHERE payment_value < 0"),
        ("review score outside 1-5", "v_reviews WHERE review_score NOT BETWEEN 1 AND 5"),
        *[(f"invalid orders.{name}", f"v_orders WHERE {unreadable.get(name, 'false')}") for name in times],
        ("delivered before purchase", "v_orders WHERE order_delivered_customer_date < order_purchase_timestamp"),
    ]
    parts = [f"SELECT '{name}' AS check_name, count(*) AS offending_rows FROM {source}" for name, source in rows]
    for table, key in audit.PRIMARY_KEYS.items():
        parts.append(
            f"SELECT 'duplicate {table}.{key}', count({key}) - count(DISTINCT {key}) FROM {RAW_SQL[table]}"
        )
    return sql(" UNION ALL ".join(parts), *RAW_SQL.values())


def _names(shop: Shop):
    """Categories on the product side against those on the translation side."""
    used = shop.products.selectExpr("product_category_name AS name").where("name IS NOT NULL").distinct()
    translated = shop.translation.selectExpr("product_category_name AS name")
    plain = shop.table("part").selectExpr("p_type AS name").distinct()
    return audit.expected_vs_actual(used, translated.unionAll(plain))


def _findings(shop: Shop) -> DataFrame:
    return audit.audit_findings(shop.raw_tables)


def _defective(shop: Shop) -> dict[str, DataFrame]:
    """The raw tables with altered order keys, negative prices and scores of 6."""
    price = F.when(F.col("order_id") % 17 == 0, -F.col("price")).otherwise(F.col("price"))
    score = F.when(F.col("order_id") % 19 == 0, 6).otherwise(F.col("review_score"))
    return {
        **shop.raw_tables,
        "orders": _altered_orders(shop),
        "order_items": shop.items.withColumn("price", price),
        "reviews": shop.reviews.withColumn("review_score", score.cast("int")),
    }


def _verdicts(shop: Shop) -> DataFrame:
    """The verdict on the tables as they are, and with defects put in."""
    found = audit.audit_verdict(_findings(shop)).withColumn("input", F.lit("raw"))
    seeded = audit.audit_verdict(audit.audit_findings(_defective(shop))).withColumn("input", F.lit("defective"))
    return found.unionAll(seeded)


_DEFECTIVE_SQL = dict(
    RAW_SQL,
    orders=f"(SELECT * REPLACE ({_ALTERED}) FROM v_orders)",
    order_items="(SELECT * REPLACE (CASE WHEN order_id % 17 = 0 THEN -price ELSE price END AS price) FROM v_items)",
    reviews="(SELECT * REPLACE (CASE WHEN order_id % 19 = 0 THEN 6 ELSE review_score END AS review_score) FROM v_reviews)",
)


def _verdict_sql(view: dict[str, str]) -> str:
    """Counts of findings other than 0, from the tables; readable times are a matter of their type."""

    def some(rows: str) -> str:
        return f"(SELECT CAST(count(*) > 0 AS INTEGER) FROM {rows})"

    def repeated(table: str, key: str) -> str:
        return f"(SELECT CAST(count({key}) > count(DISTINCT {key}) AS INTEGER) FROM {view[table]})"

    fatal = [
        some(f"{view[c]} WHERE {ck} IS NOT NULL AND {ck} NOT IN (SELECT {pk} FROM {view[p]} WHERE {pk} IS NOT NULL)")
        for c, ck, p, pk in audit.REFERENCES
    ] + [
        some(f"{view['order_items']} WHERE price < 0"),
        some(f"{view['order_items']} WHERE freight_value < 0"),
        some(f"{view['payments']} WHERE payment_value < 0"),
        some(f"{view['reviews']} WHERE review_score NOT BETWEEN 1 AND 5"),
        some(f"{view['orders']} WHERE order_delivered_customer_date < order_purchase_timestamp"),
        *[repeated(table, key) for table, key in audit.PRIMARY_KEYS.items()],
    ]
    warning = [
        f"(SELECT CAST((SELECT count(*) FROM {v}) > (SELECT count(*) FROM (SELECT DISTINCT * FROM {v})) AS INTEGER))"
        for v in view.values()
    ] + [
        repeated("geolocation", "geolocation_zip_code_prefix"),
        some(
            f"{view['products']} WHERE product_category_name IS NOT NULL"
            f" AND product_category_name NOT IN (SELECT product_category_name FROM {view['category_translation']})"
        ),
    ]
    return f"SELECT CAST({' + '.join(fatal)} AS BIGINT) AS fatal_checks, CAST({' + '.join(warning)} AS BIGINT) AS warning_checks"


_VERDICT_RULE = """CASE WHEN fatal_checks > 0 THEN 'NOT READY' WHEN warning_checks > 0 THEN 'READY WITH WARNINGS' ELSE 'READY' END
    AS executive_verdict, CASE WHEN fatal_checks > 0 THEN 'NO' ELSE 'YES' END AS safe_to_run"""


def _silver_tables(shop: Shop) -> dict[str, DataFrame]:
    return {
        "orders": shop.clean_orders,
        "order_items": shop.clean_items,
        "master_orders": shop.stored_master,
        "customer_profile": shop.stored_profile,
        "product_demand": shop.stored_demand,
        "seller_performance": shop.stored_seller_performance,
    }


def _on(inputs: dict[str, DataFrame]) -> DataFrame:
    """Checks of several inputs, each named in the column ``input``."""
    named = [found.select(F.lit(name).alias("input"), "check_name", "passed") for name, found in inputs.items()]
    return reduce(DataFrame.unionAll, named)


def _silver(shop: Shop):
    """The tables as built, and altered so that rules must fail."""
    built = _silver_tables(shop)
    total, category = F.col("total_revenue"), F.col("category_name_english")
    altered = {
        **built,
        "master_orders": shop.stored_master.where("order_id % 13 <> 0"),
        "customer_profile": shop.stored_profile.withColumn(
            "customer_unique_id", F.col("customer_unique_id") - F.col("customer_unique_id") % 8
        ),
        "product_demand": shop.stored_demand.withColumn(
            "category_name_english", F.when(category.startswith(UNTRANSLATED_PREFIX), None).otherwise(category)
        ),
        "seller_performance": shop.stored_seller_performance.withColumn("total_revenue", -total),
    }
    return _on(
        {name: checks.silver_checks(tables, shop.products, shop.translation)
         for name, tables in (("built", built), ("altered", altered))}
    )


_SILVER_VIEWS = {
    "built": {"master": "master", "profile": "profile", "demand": "demand", "sellers": "seller_perf"},
    "altered": {
        "master": "(SELECT * FROM master WHERE order_id % 13 <> 0)",
        "profile": "(SELECT * REPLACE (customer_unique_id - customer_unique_id % 8 AS customer_unique_id) FROM profile)",
        "demand": "(SELECT * REPLACE (CASE WHEN starts_with(category_name_english, 'untranslated__') THEN NULL"
        " ELSE category_name_english END AS category_name_english) FROM demand)",
        "sellers": "(SELECT * REPLACE (-total_revenue AS total_revenue) FROM seller_perf)",
    },
}
_SILVER_RULES = {
    "orders_unique_order_id": "SELECT count(*) = count(DISTINCT order_id) FROM c_orders",
    "master_orders_unique_order_id": "SELECT count(*) = count(DISTINCT order_id) FROM {master}",
    "master_orders_keeps_all_orders": "SELECT count(*) = (SELECT count(*) FROM c_orders) FROM {master}",
    "customer_profile_unique_customer": "SELECT count(*) = count(DISTINCT customer_unique_id) FROM {profile}",
    "product_demand_category_not_null": "SELECT count(*) = count(category_name_english) FROM {demand}",
    "unmatched_categories_preserved": """SELECT count(*) = 0 FROM c_items JOIN c_orders USING (order_id)
        JOIN v_products p USING (product_id) JOIN labelled l ON l.product_id = p.product_id
        WHERE order_status = 'delivered' AND order_purchase_timestamp IS NOT NULL AND p.product_category_name IS NOT NULL
        AND p.product_category_name NOT IN (SELECT product_category_name FROM v_translation)
        AND category_name_english NOT IN (SELECT category_name_english FROM {demand} WHERE category_name_english IS NOT NULL)""",
    "seller_revenue_non_negative": "SELECT count(*) = count(*) FILTER (WHERE total_revenue >= 0) FROM {sellers}",
}


def _gold(shop: Shop):
    """The tables as built, and altered so that rules must fail."""
    master = shop.stored_master
    built = {
        "demand_features": demand.demand_features(shop.stored_demand),
        "churn_features": materialize(shop.churn, "churn"),
        "rfm_segments": shop.rfm,
        "bi_revenue": materialize(revenue.bi_revenue(master), "bi"),
    }
    altered = {
        "demand_features": built["demand_features"].withColumn("lag_1", F.col("lag_1") + 1),
        "churn_features": built["churn_features"].where("is_churned = 1").withColumn(
            "snapshot_date", F.date_sub("snapshot_date", 400)
        ),
        "rfm_segments": built["rfm_segments"].withColumns(
            {"recency_score": F.col("recency_score") + 5, "segment_label": F.lit(None).cast("string")}
        ),
        "bi_revenue": built["bi_revenue"].withColumns(
            {"total_revenue": -F.col("total_revenue") - 1, "late_delivery_rate": F.col("late_delivery_rate") + 2}
        ),
    }
    calendar = demand.demand_features_calendar(shop.stored_demand, shop.clean_orders)
    late = calendar.withColumn("lag_2_source_month", F.add_months("lag_2_source_month", -1))
    return _on(
        {
            name: checks.gold_checks(tables, shop.stored_demand, shop.stored_profile, master).unionAll(
                checks.calendar_checks(features)
            )
            for name, tables, features in (("built", built, calendar), ("altered", altered, late))
        }
    )


_GOLD_VIEWS = {
    "built": {"features": "features", "churn": "churn", "rfm": "rfm", "bi": "bi", "calendar": "calendar_features"},
    "altered": {
        "features": "(SELECT * REPLACE (lag_1 + 1 AS lag_1) FROM features)",
        "churn": "(SELECT * REPLACE (snapshot_date - INTERVAL 400 DAY AS snapshot_date) FROM churn WHERE is_churned = 1)",
        "rfm": "(SELECT * REPLACE (recency_score + 5 AS recency_score, NULL AS segment_label) FROM rfm)",
        "bi": "(SELECT * REPLACE (-total_revenue - 1 AS total_revenue, late_delivery_rate + 2 AS late_delivery_rate) FROM bi)",
        "calendar": "(SELECT * REPLACE (lag_2_source_month - INTERVAL 1 MONTH AS lag_2_source_month) FROM calendar_features)",
    },
}
_RECOMPUTED = """(SELECT category_name_english,
    strftime(CAST(concat(n.order_year_month, '-01') AS DATE) + INTERVAL 1 MONTH, '%Y-%m') AS forecast_month,
    t.monthly_units AS target, n.monthly_units AS u0, a.monthly_units AS u1, b.monthly_units AS u2, c.monthly_units AS u3
    FROM numbered n JOIN (SELECT category_name_english, place - 1 AS place, monthly_units FROM numbered) t USING (category_name_english, place)
    JOIN (SELECT category_name_english, place + 1 AS place, monthly_units FROM numbered) a USING (category_name_english, place)
    JOIN (SELECT category_name_english, place + 2 AS place, monthly_units FROM numbered) b USING (category_name_english, place)
    JOIN (SELECT category_name_english, place + 3 AS place, monthly_units FROM numbered) c USING (category_name_english, place))"""
_RECOMPUTE_WRONG = """f.lag_1 IS NULL OR r.u0 IS NULL OR f.target_units <> r.target OR f.lag_1 <> u0 OR f.lag_2 <> u1 OR f.lag_4 <> u3
    OR abs(f.rolling_mean_3 - (u0 + u1 + u2) / 3.0) > 1e-9"""
_NO_NULL = "count(*) = count(*) FILTER (WHERE target_units IS NOT NULL AND lag_1 IS NOT NULL AND lag_2 IS NOT NULL AND lag_4 IS NOT NULL AND rolling_mean_3 IS NOT NULL)"
_GOLD_RULES = {
    "demand_required_fields_not_null": f"SELECT {_NO_NULL} FROM {{features}}",
    "demand_features_match_recompute": f"""SELECT count(*) = 0 FROM {{features}} f FULL JOIN {_RECOMPUTED} r
        USING (category_name_english, forecast_month) WHERE {_RECOMPUTE_WRONG}""",
    "demand_row_count_matches_recompute": f"SELECT count(*) = (SELECT count(*) FROM {_RECOMPUTED}) FROM {{features}}",
    "churn_has_snapshot_date": "SELECT count(*) = count(snapshot_date) FROM {churn}",
    "churn_has_both_target_classes": "SELECT min(is_churned) <> max(is_churned) FROM {churn}",
    "churn_feature_dates_not_after_snapshot": """SELECT count(*) = 0 FROM {churn} WHERE greatest(CAST(last_purchase_timestamp AS DATE),
        CAST(last_review_creation_date AS DATE), CAST(last_delivery_date AS DATE)) > snapshot_date""",
    "rfm_scores_between_1_and_5": """SELECT count(*) = count(*) FILTER (WHERE recency_score BETWEEN 1 AND 5
        AND frequency_score BETWEEN 1 AND 5 AND monetary_score BETWEEN 1 AND 5) FROM {rfm}""",
    "rfm_total_between_3_and_15": "SELECT count(*) = count(*) FILTER (WHERE rfm_total BETWEEN 3 AND 15) FROM {rfm}",
    "rfm_segment_label_not_null": "SELECT count(*) = count(segment_label) FROM {rfm}",
    "rfm_keeps_all_customers": "SELECT count(*) = (SELECT count(*) FROM profile) FROM {rfm}",
    "bi_revenue_non_negative": "SELECT count(*) FILTER (WHERE total_revenue IS NULL OR total_revenue < 0 OR avg_order_value < 0) = 0 FROM {bi}",
    "bi_late_rate_between_0_and_1": "SELECT count(*) FILTER (WHERE late_delivery_rate NOT BETWEEN 0 AND 1) = 0 FROM {bi}",
    "bi_orders_non_negative": "SELECT count(*) FILTER (WHERE total_orders < 0) = 0 FROM {bi}",
    "bi_has_late_delivery_rate": "SELECT count(*) > 0 FROM {bi}",
    "bi_one_row_per_group": f"SELECT count(*) = (SELECT count(*) FROM (SELECT DISTINCT {', '.join(GRAIN)} FROM master)) FROM {{bi}}",
    "calendar_features_not_null": f"SELECT {_NO_NULL} FROM {{calendar}}",
    **{
        f"lag_{n}_is_{n}_months_back": f"SELECT count(*) FILTER (WHERE lag_{n}_source_month + INTERVAL {n} MONTH <> forecast_month) = 0 FROM {{calendar}}"
        for n in (1, 2, 4)
    },
    "comparability_known": "SELECT count(*) = count(target_period_comparable) FROM {calendar}",
    "calendar_features_not_empty": "SELECT count(*) > 0 FROM {calendar}",
}


def _rules_sql(views: dict[str, dict[str, str]], rules: dict[str, str], *names: str) -> str:
    """Every rule over every input."""
    parts = [
        f"SELECT '{name}' AS input, '{check}' AS check_name, ({rule.format(**view)}) AS passed"
        for name, view in views.items()
        for check, rule in rules.items()
    ]
    return sql(" UNION ALL ".join(parts), *names)


def _calendar_against_rows(shop: Shop):
    """Where row lags and calendar lags disagree."""
    calendar = demand.demand_features_calendar(shop.stored_demand, shop.clean_orders).select(
        "category_name_english",
        F.col("order_year_month").alias("forecast_month"),
        F.col("target_units"),
        "lag_1", "lag_2", "lag_4",
    )
    rows = demand.demand_features(shop.stored_demand)
    keys = ["category_name_english", "forecast_month"]
    return checks.differences(rows, calendar, keys, ["target_units", "lag_1", "lag_2", "lag_4"]).select(
        *keys,
        F.col("lag_1").cast("double").alias("row_lag_1"),
        F.col("expected_lag_1").alias("calendar_lag_1"),
    )


def _quality_summary(shop: Shop):
    return checks.data_quality_summary(
        audit.audit_verdict(_findings(shop)),
        layer_row_counts(all_layers(shop)),
        shop.coverage,
        gap=audit.lookup_gap(shop.products, shop.translation),
    )


QUERIES = {
    "uniqueness_gate": (
        _uniqueness,
        _per_table_sql(
            "SELECT '{name}' AS table_name, row_count, distinct_keys, row_count = distinct_keys AS is_unique FROM (SELECT"
            " count(*) AS row_count, count(DISTINCT {key}) + CASE WHEN count(*) > count({key}) THEN 1 ELSE 0 END AS distinct_keys FROM {view})"
        ),
    ),
    "column_profile": (lambda shop: _per_table(shop, audit.column_profile), _profile_sql()),
    "exact_duplicates": (
        _exact_duplicates,
        _per_table_sql(
            "SELECT '{name}' AS table_name, (SELECT count(*) FROM {view})"
            " - (SELECT count(*) FROM (SELECT DISTINCT * FROM {view})) AS exact_duplicate_rows"
        ),
    ),
    "duplicate_keys": (
        _named_duplicates,
        _per_table_sql("SELECT '{name}' AS table_name, count({key}) - count(DISTINCT {key}) AS duplicate_rows FROM {view}"),
    ),
    "fk_checks": (_references, _reference_sql()),
    "lookup_gap": (
        lambda shop: audit.lookup_gap(shop.products, shop.translation),
        sql(
            "SELECT count(*) AS unmatched_product_row_count, count(DISTINCT product_category_name) AS unmatched_distinct_category_count"
            " FROM v_products WHERE product_category_name NOT IN (SELECT product_category_name FROM v_translation)",
            "v_products", "v_translation",
        ),
    ),
    "lookup_gap_categories": (
        lambda shop: audit.untranslated_categories(shop.products, shop.translation),
        sql(
            "SELECT product_category_name, count(*) AS product_rows FROM v_products"
            " WHERE product_category_name NOT IN (SELECT product_category_name FROM v_translation) GROUP BY 1",
            "v_products", "v_translation",
        ),
    ),
    "sanity_counts": (lambda shop: audit.sanity_counts(_with_unreadable_times(shop)), _sanity_sql()),
    "purchase_range": (
        lambda shop: audit.purchase_range(shop.orders).select(
            F.to_date("earliest_purchase").alias("earliest_purchase"),
            F.to_date("latest_purchase").alias("latest_purchase"),
        ),
        sql(
            "SELECT CAST(min(order_purchase_timestamp) AS DATE) AS earliest_purchase,"
            " CAST(max(order_purchase_timestamp) AS DATE) AS latest_purchase FROM v_orders",
            "v_orders",
        ),
    ),
    "expected_vs_actual": (
        _names,
        sql(
            """SELECT name, 'missing' AS status FROM (SELECT DISTINCT product_category_name AS name FROM v_products
              WHERE product_category_name NOT IN (SELECT product_category_name FROM v_translation))
            UNION ALL SELECT DISTINCT p_type, 'unexpected' FROM part""",
            "v_products", "v_translation",
        ),
    ),
    "audit_verdict": (
        _verdicts,
        sql(
            f"SELECT *, {_VERDICT_RULE}, 'raw' AS input FROM ({_verdict_sql(RAW_SQL)})"
            f" UNION ALL SELECT *, {_VERDICT_RULE}, 'defective' AS input FROM ({_verdict_sql(_DEFECTIVE_SQL)})",
            *RAW_SQL.values(),
        ),
    ),
    "untranslated_preserved": (
        lambda shop: checks.untranslated_shown(
            shop.clean_items, shop.clean_orders, shop.products, shop.translation, shop.demand
        ),
        sql(
            """SELECT DISTINCT category_name_english, true AS is_shown FROM c_items JOIN c_orders USING (order_id)
            JOIN v_products p USING (product_id) JOIN labelled l ON l.product_id = p.product_id
            WHERE order_status = 'delivered' AND order_purchase_timestamp IS NOT NULL AND p.product_category_name IS NOT NULL
            AND p.product_category_name NOT IN (SELECT product_category_name FROM v_translation)""",
            "c_items", "c_orders", "labelled", "v_products", "v_translation",
        ),
    ),
    "recompute_diff": (
        lambda shop: checks.differences(
            demand.demand_features(shop.stored_demand),
            checks.recomputed_demand_features(shop.stored_demand),
            ["category_name_english", "forecast_month"],
            checks.DEMAND_VALUES,
        ).select("category_name_english", "forecast_month"),
        sql(
            f"SELECT category_name_english, forecast_month FROM features f FULL JOIN {_RECOMPUTED} r"
            f" USING (category_name_english, forecast_month) WHERE {_RECOMPUTE_WRONG}",
            "features", "numbered",
        ),
    ),
    "lag_divergence": (
        _calendar_against_rows,
        sql(
            """SELECT coalesce(f.category_name_english, c.category_name_english) AS category_name_english,
            coalesce(f.forecast_month, c.order_year_month) AS forecast_month,
            CAST(f.lag_1 AS DOUBLE) AS row_lag_1, c.lag_1 AS calendar_lag_1
            FROM features f FULL JOIN calendar_features c
              ON f.category_name_english = c.category_name_english AND f.forecast_month = c.order_year_month
            WHERE f.lag_1 IS NULL OR c.lag_1 IS NULL OR f.target_units <> c.target_units OR f.lag_1 <> c.lag_1
              OR f.lag_2 <> c.lag_2 OR f.lag_4 <> c.lag_4""",
            "features", "calendar_features",
        ),
    ),
    "bi_grain_check": (
        lambda shop: checks.bi_grain(shop.bi, shop.master),
        sql(
            f"""SELECT (SELECT count(*) FROM bi) AS bi_rows, g AS expected_groups, (SELECT count(*) FROM bi) = g AS matches
            FROM (SELECT count(*) AS g FROM (SELECT DISTINCT {', '.join(GRAIN)} FROM master))""",
            "bi", "master",
        ),
    ),
    "silver_checks": (
        _silver,
        _rules_sql(
            _SILVER_VIEWS, _SILVER_RULES,
            "c_orders", "c_items", "master", "profile", "demand", "seller_perf", "labelled", "v_products", "v_translation",
        ),
    ),
    "gold_checks": (
        _gold,
        _rules_sql(
            _GOLD_VIEWS, _GOLD_RULES,
            "features", "numbered", "churn", "rfm", "bi", "calendar_features", "profile", "master",
        ),
    ),
    "data_quality_summary": (
        _quality_summary,
        sql(
            f"""SELECT 'source_audit' AS topic, 'executive_verdict' AS item, executive_verdict AS value
              FROM (SELECT *, {_VERDICT_RULE} FROM ({_verdict_sql(RAW_SQL)}))
            UNION ALL SELECT 'source_audit', 'safe_to_run', safe_to_run FROM (SELECT *, {_VERDICT_RULE} FROM ({_verdict_sql(RAW_SQL)}))
            UNION ALL SELECT 'source_audit', 'fatal_checks', CAST(fatal_checks AS VARCHAR) FROM ({_verdict_sql(RAW_SQL)})
            UNION ALL SELECT 'source_audit', 'warning_checks', CAST(warning_checks AS VARCHAR) FROM ({_verdict_sql(RAW_SQL)})
            UNION ALL SELECT 'translation_gap', 'product_rows', CAST(count(*) AS VARCHAR) FROM v_products
              WHERE product_category_name NOT IN (SELECT product_category_name FROM v_translation)
            UNION ALL SELECT 'translation_gap', 'categories', CAST(count(DISTINCT product_category_name) AS VARCHAR) FROM v_products
              WHERE product_category_name NOT IN (SELECT product_category_name FROM v_translation)
            """
            + " ".join(
                f"UNION ALL SELECT 'row_count', '{layer}/{name}', CAST(count(*) AS VARCHAR) FROM {source}"
                for layer, tables in LAYER_SQL.items()
                for name, source in tables.items()
            )
            + """ UNION ALL SELECT 'excluded_period', order_year_month,
                concat('orders=', order_count, ' partial=', is_partial_period, ' low_volume=', is_low_volume_period)
              FROM coverage WHERE NOT is_comparable_period""",
            *[source for tables in LAYER_SQL.values() for source in tables.values()], "coverage",
        ),
    ),
}

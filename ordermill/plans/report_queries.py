"""Registered queries of the report tables."""

from __future__ import annotations

from ordermill.operators import demand, marts, orders, periods, revenue, rfm, sellers
from ordermill.plans.presentation import means, show, times
from ordermill.plans.shop import MIN_ORDERS, Shop, sql

_MONTHLY = (
    "order_year_month, order_count, item_merchandise_value_ex_freight, item_revenue_ex_freight,"
    " avg_item_merchandise_value_per_order, avg_item_revenue_per_order,"
    " is_partial_period, is_low_volume_period, is_comparable_period"
)
_RANKED = (
    "seller_rank, seller_id_short, seller_state, total_orders, seller_attributed_order_value,"
    f" {means('avg_review', 'late_rate')}, performance_tier"
)
_SELLER_MEANS = "avg_review late_rate"
_DELIVERY_MEANS = "avg_delivery_days avg_delivery_delay_days late_delivery_rate late_delivery_rate_display"
_DELIVERY = (
    "order_year_month, order_count, delivered_order_count, late_delivered_order_count,"
    f" {means(*_DELIVERY_MEANS.split())}, is_partial_period, is_low_volume_period,"
    " is_comparable_period, is_low_delivered_volume_period"
)
_SEGMENT_MEANS = (
    "avg_recency_days avg_total_orders avg_total_revenue avg_order_value avg_review_score"
    " late_delivery_rate avg_rfm_total repeat_customer_rate"
)
MIN_DELIVERED = 50
_SELLER_STATE, _SELLER_TIER = "NATION_3", "medium"


def _overview(shop: Shop):
    return show(
        marts.overview_kpis(orders.with_item_totals(shop.clean_orders, shop.clean_items)),
        rounded="late_delivery_rate",
    )


def _late_rate(shop: Shop):
    rate = shop.clean_orders.agg(marts.late_delivery_rate().alias("late_delivery_rate"))
    return show(rate, rounded="late_delivery_rate")


def _delivery(shop: Shop):
    return marts.delivery_performance(shop.clean_orders, shop.coverage, MIN_DELIVERED)


def all_layers(shop: Shop) -> dict:
    """Every table of every layer; the facts are written once and read by what is built on them."""
    return {
        "bronze": shop.raw_tables,
        "silver": {
            "orders": shop.clean_orders,
            "order_items": shop.clean_items,
            "master_orders": shop.stored_master,
            "customer_profile": shop.stored_profile,
            "product_demand": shop.stored_demand,
            "seller_performance": shop.seller_performance,
        },
        "gold": {
            "demand_features": demand.demand_features(shop.stored_demand),
            "churn_features": shop.churn,
            "rfm_segments": shop.rfm,
            "bi_revenue": revenue.bi_revenue(shop.stored_master),
        },
    }


def _layer_counts(shop: Shop):
    return marts.layer_row_counts(all_layers(shop))


def _count_sql(pairs: dict[str, str], first: str = "") -> str:
    lead = f"'{first}' AS layer, " if first else ""
    return " UNION ALL ".join(
        f"SELECT {lead}'{name}' AS table_name, count(*) AS row_count FROM {source}"
        for name, source in pairs.items()
    )


RAW_SQL = {
    "orders": "v_orders",
    "customers": "v_customers",
    "order_items": "v_items",
    "payments": "v_payments",
    "reviews": "v_reviews",
    "products": "v_products",
    "sellers": "v_sellers",
    "geolocation": "v_geolocation",
    "category_translation": "v_translation",
}
LAYER_SQL = {
    "bronze": RAW_SQL,
    "silver": {
        "orders": "c_orders",
        "order_items": "c_items",
        "master_orders": "master",
        "customer_profile": "profile",
        "product_demand": "demand",
        "seller_performance": "seller_perf",
    },
    "gold": {
        "demand_features": "features",
        "churn_features": "churn",
        "rfm_segments": "rfm",
        "bi_revenue": "bi",
    },
}


_PREDICTED = "(SELECT DISTINCT forecast_month FROM bt_naive)"
# The rows of every exported file: (source, names of the definitions it needs).
EXPORT_SQL = {
    "overview_kpis.json": ("(SELECT 1)", ""),
    "period_quality.csv": ("coverage", "coverage"),
    "monthly_revenue.csv": ("monthly", "monthly"),
    "state_revenue.csv": ("states", "states"),
    "payment_mix.csv": ("(SELECT DISTINCT primary_payment_type FROM bi WHERE primary_payment_type IS NOT NULL)", "bi"),
    "delivery_performance.csv": ("(SELECT DISTINCT order_year_month FROM c_orders WHERE order_year_month IS NOT NULL)", "c_orders"),
    "delivery_trend.csv": (
        "(SELECT order_year_month FROM c_orders WHERE order_status = 'delivered' AND is_late IS NOT NULL"
        f" AND order_year_month IS NOT NULL GROUP BY 1 HAVING count(*) >= {marts.MIN_DELIVERED_ORDERS})", "c_orders",
    ),
    "rfm_segment_distribution.csv": ("(SELECT DISTINCT segment_label FROM rfm)", "rfm"),
    "rfm_segment_profiles.csv": ("(SELECT DISTINCT segment_label FROM rfm)", "rfm"),
    "seller_performance.csv": ("ranked_sellers", "ranked_sellers"),
    "churn_summary.json": ("(SELECT 1)", ""),
    "demand_history.csv": ("demand", "demand"),
    "demand_backtest_input.csv": ("bt_input", "bt_input"),
    "demand_backtest_predictions.csv": ("bt_naive", "bt_naive"),
    "demand_backtest_monthly_aggregate.csv": (_PREDICTED, "bt_naive"),
    "demand_backtest_category_errors.csv": ("(SELECT DISTINCT category_name_english FROM bt_naive)", "bt_naive"),
    "demand_backtest_fold_metrics.csv": (f"(SELECT * FROM {_PREDICTED}, range(2))", "bt_naive"),  # two models
    "demand_model_metrics.json": ("range(2)", ""),
    "data_quality_summary.json": (
        # verdict, safety and two counts; two gap figures; 19 tables; excluded months
        "(SELECT 1 FROM range(4 + 2 + 19) UNION ALL SELECT 1 FROM coverage WHERE NOT is_comparable_period)", "coverage",
    ),
}


QUERIES = {
    "overview_kpis": (
        _overview,
        sql(
            """SELECT total_orders, value AS item_merchandise_value_ex_freight, value AS item_revenue_ex_freight, freight_value,
            value / total_orders AS avg_item_merchandise_value_per_order, value / total_orders AS avg_item_revenue_per_order,
            round(late_delivery_rate, 6) AS late_delivery_rate, first_order_month, last_order_month FROM (
            SELECT count(DISTINCT order_id) AS total_orders, CAST(sum(CAST(coalesce(order_revenue, 0.0) AS DECIMAL(18, 4))) AS DOUBLE) AS value,
            CAST(sum(CAST(coalesce(freight_total, 0.0) AS DECIMAL(18, 4))) AS DOUBLE) AS freight_value,
            count(*) FILTER (WHERE order_status = 'delivered' AND is_late = 1) * 1.0
              / count(*) FILTER (WHERE order_status = 'delivered' AND is_late IS NOT NULL) AS late_delivery_rate,
            min(order_year_month) AS first_order_month, max(order_year_month) AS last_order_month
            FROM c_orders LEFT JOIN item_agg USING (order_id))""",
            "c_orders", "item_agg",
        ),
    ),
    "late_rate": (
        _late_rate,
        sql(
            "SELECT round(avg(is_late), 6) AS late_delivery_rate FROM c_orders WHERE order_status = 'delivered'",
            "c_orders",
        ),
    ),
    "period_coverage": (
        lambda shop: show(periods.period_coverage(shop.clean_orders)),
        sql(
            f"SELECT order_year_month, order_count, {times('first_purchase', 'last_purchase')} FROM coverage",
            "coverage",
        ),
    ),
    "period_quality": (
        lambda shop: show(shop.coverage),
        sql(
            f"SELECT * EXCLUDE (first_purchase, last_purchase), {times('first_purchase', 'last_purchase')} FROM coverage",
            "coverage",
        ),
    ),
    "period_quality_nb": (
        lambda shop: periods.edge_period_flags(shop.clean_orders, MIN_ORDERS),
        sql("SELECT * FROM edge_flags", "edge_flags"),
    ),
    "monthly_revenue": (
        lambda shop: shop.monthly_revenue,
        sql(f"SELECT {_MONTHLY} FROM monthly", "monthly"),
    ),
    "monthly_revenue_comparable": (
        lambda shop: marts.comparable_months(shop.monthly_revenue),
        sql(f"SELECT {_MONTHLY} FROM monthly WHERE is_comparable_period", "monthly"),
    ),
    "state_revenue": (
        lambda shop: marts.state_revenue(shop.bi),
        sql("SELECT * FROM states", "states"),
    ),
    "top_states": (
        lambda shop: marts.top_states(marts.state_revenue(shop.bi)),
        sql(
            "SELECT * FROM states ORDER BY item_merchandise_value_ex_freight DESC, customer_state LIMIT 15",
            "states",
        ),
    ),
    "payment_mix": (
        lambda shop: show(marts.payment_mix(shop.bi), rounded="order_share"),
        sql(
            """SELECT *, v AS item_revenue_ex_freight, round(CAST(order_count AS DOUBLE) / sum(order_count) OVER (), 6) AS order_share
            FROM (SELECT primary_payment_type, CAST(sum(total_orders) AS BIGINT) AS order_count,
            CAST(sum(CAST(total_revenue AS DECIMAL(18, 4))) AS DOUBLE) AS v FROM bi GROUP BY 1)""",
            "bi",
        ).replace("SELECT *, v AS", "SELECT * EXCLUDE (v), v AS item_merchandise_value_ex_freight, v AS"),
    ),
    "delivery_performance": (
        lambda shop: show(_delivery(shop), rounded=_DELIVERY_MEANS),
        sql(f"SELECT {_DELIVERY} FROM delivery", "delivery"),
    ),
    "delivery_trend": (
        lambda shop: show(marts.delivery_trend(_delivery(shop)), rounded=_DELIVERY_MEANS),
        sql(
            f"SELECT {_DELIVERY} FROM delivery WHERE NOT is_low_delivered_volume_period"
            " AND late_delivery_rate_display IS NOT NULL",
            "delivery",
        ),
    ),
    "rfm_distribution": (
        lambda shop: rfm.rfm_distribution(shop.rfm),
        sql("SELECT segment_label, count(*) AS customers FROM rfm GROUP BY 1", "rfm"),
    ),
    "rfm_profiles": (
        lambda shop: show(rfm.rfm_profiles(shop.rfm), rounded=_SEGMENT_MEANS),
        sql(
            """SELECT segment_label, count(customer_unique_id) AS customers, count(*) FILTER (WHERE total_orders > 1) AS repeat_customers,
            round(avg(recency_days), 6) AS avg_recency_days, round(avg(total_orders), 6) AS avg_total_orders,
            round(avg(total_revenue), 6) AS avg_total_revenue, round(avg(avg_order_value), 6) AS avg_order_value,
            round(avg(avg_review_score), 6) AS avg_review_score, round(avg(late_delivery_rate), 6) AS late_delivery_rate,
            round(avg(rfm_total), 6) AS avg_rfm_total,
            round(count(*) FILTER (WHERE total_orders > 1) * 1.0 / count(customer_unique_id), 6) AS repeat_customer_rate
            FROM rfm GROUP BY 1""",
            "rfm",
        ),
    ),
    "rfm_overview": (
        lambda shop: rfm.rfm_overview(rfm.rfm_segments_by_rank(shop.stored_profile)),
        sql(
            """SELECT segment_label, count(*) AS customers, CAST(sum(repeat_customer_flag) AS BIGINT) AS repeat_customers,
            round(avg(total_orders), 4) AS avg_total_orders, round(avg(total_revenue), 2) AS avg_total_revenue,
            round(avg(recency_days), 2) AS avg_recency_days FROM rfm_rank GROUP BY 1""",
            "rfm_rank",
        ),
    ),
    "seller_ranking": (
        lambda shop: show(shop.ranking, rounded=_SELLER_MEANS),
        sql(f"SELECT {_RANKED} FROM ranked_sellers", "ranked_sellers"),
    ),
    "top_sellers": (
        lambda shop: show(
            shop.ranking.orderBy("seller_rank").limit(250), rounded=_SELLER_MEANS
        ),
        sql(f"SELECT {_RANKED} FROM ranked_sellers ORDER BY seller_rank LIMIT 250", "ranked_sellers"),
    ),
    "seller_filtered": (
        lambda shop: show(
            sellers.sellers_where(shop.ranking, _SELLER_STATE, _SELLER_TIER), rounded=_SELLER_MEANS
        ),
        sql(
            f"SELECT {_RANKED} FROM ranked_sellers WHERE seller_state = '{_SELLER_STATE}'"
            f" AND performance_tier = '{_SELLER_TIER}'",
            "ranked_sellers",
        ),
    ),
    "seller_top_state": (
        lambda shop: sellers.top_seller_state(shop.ranking),
        sql(
            """SELECT seller_state, CAST(sum(CAST(seller_attributed_order_value AS DECIMAL(18, 4))) AS DOUBLE) AS seller_attributed_order_value
            FROM ranked_sellers GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
            "ranked_sellers",
        ),
    ),
    "mode_tier": (
        lambda shop: sellers.most_common_tier(shop.ranking),
        sql(
            "SELECT performance_tier, count(*) AS sellers FROM ranked_sellers GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1",
            "ranked_sellers",
        ),
    ),
    "distinct_values": (
        lambda shop: marts.distinct_values(shop.orders, "order_status"),
        sql("SELECT DISTINCT order_status FROM v_orders WHERE order_status IS NOT NULL", "v_orders"),
    ),
    "layer_row_counts": (
        _layer_counts,
        sql(
            " UNION ALL ".join(_count_sql(tables, layer) for layer, tables in LAYER_SQL.items()),
            *[source for tables in LAYER_SQL.values() for source in tables.values()],
        ),
    ),
}

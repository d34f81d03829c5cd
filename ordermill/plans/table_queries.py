"""Registered queries of the cleaned, joined and feature tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ordermill.functions.labels import mask_identifier
from ordermill.functions.numeric import ratio
from ordermill.operators import churn, customers, demand, orders, revenue, rfm, sellers
from ordermill.plans.presentation import means, show, times
from ordermill.plans.shop import (
    REFERENCE_DATE,
    STUDY_FIRST,
    STUDY_LAST,
    TIER_HIGH_ABOVE,
    TIER_MEDIUM_FROM,
    Shop,
    sql,
)

_ORDER = (
    "order_id order_status order_purchase_timestamp order_approved_at is_canceled order_year"
    " order_month order_year_month delivery_days is_late delivery_delay_days"
)
_ORDER_SQL = (
    f"order_id, order_status, {times('order_purchase_timestamp', 'order_approved_at')}, is_canceled,"
    " order_year, order_month, order_year_month, delivery_days, is_late, delivery_delay_days"
)
_MASTER = (
    "order_id customer_unique_id customer_city customer_state order_year_month is_late order_revenue"
    " freight_total item_count payment_total primary_payment_type avg_review_score revenue_per_item"
)
_MASTER_SQL = (
    "order_id, customer_unique_id, customer_city, customer_state, order_year_month, is_late, order_revenue,"
    " freight_total, item_count, payment_total, primary_payment_type,"
    f" {means('avg_review_score')}, revenue_per_item"
)
_PROFILE_MEANS = "avg_review_score late_delivery_rate"
_FEATURES = (
    "category_name_english feature_cutoff_month forecast_month monthly_units monthly_revenue avg_price"
    " target_units lag_1 lag_2 lag_4 rolling_mean_3 month_num is_q4"
)
_CHURN_LOGS = "avg_review_score late_delivery_rate log_recency log_total_revenue purchase_frequency_30d"


def _clean_orders(shop: Shop):
    return show(shop.clean_orders, _ORDER)


def _delivered_only(shop: Shop):
    return show(orders.clean_orders(shop.orders, delivered_only=True), _ORDER)


def _safe_divide(shop: Shop):
    totals = orders.item_totals(shop.items)
    return totals.select(
        "order_id",
        ratio("freight_total", "order_revenue").alias("freight_per_value"),
        ratio("order_revenue", "item_count").alias("value_per_item"),
    )


def _fill_defaults(shop: Shop):
    filled = orders.with_payments(
        orders.with_item_totals(shop.clean_orders, shop.clean_items),
        orders.payments_by_type(shop.payments),
    )
    return show(
        filled, "order_id order_revenue freight_total item_count payment_total primary_payment_type"
    )


def _category_fallback(shop: Shop):
    return demand.labelled_products(shop.products, shop.translation)


def _two_level(shop: Shop):
    master = orders.with_reviews(
        orders.clean_orders(shop.orders, delivered_only=True), shop.reviews, missing_score=0.0
    )
    table = sellers.seller_performance_two_level(
        shop.clean_items, master, shop.sellers, TIER_HIGH_ABOVE, TIER_MEDIUM_FROM
    )
    return show(table, rounded="avg_review late_rate")


def _profile_first_order(shop: Shop):
    facts = orders.with_reviews(
        orders.with_payments(shop.valued_orders, orders.payments_by_type(shop.payments)),
        shop.reviews,
    )
    table = customers.customer_profile_first_order(facts, REFERENCE_DATE)
    return show(table, rounded=f"{_PROFILE_MEANS} purchase_frequency_score")


def _mask(shop: Shop):
    return shop.sellers.select("seller_id", mask_identifier("seller_id").alias("seller_id_short"))


def _snapshot_dates(shop: Shop):
    known = orders.with_customers(shop.clean_orders, shop.customers)
    return churn.month_calendar(churn.snapshot_bounds(churn.eligible_orders(known)))


def _month_calendar(shop: Shop):
    bought = F.to_date("order_purchase_timestamp")
    span = orders.fulfilled(shop.clean_orders).agg(
        F.trunc(F.min(bought), "MM").alias("first_snapshot"),
        F.trunc(F.max(bought), "MM").alias("last_snapshot"),
    )
    return churn.month_calendar(span).withColumnRenamed("snapshot_date", "month_start")


def _churn_nb(shop: Shop):
    owned = orders.with_customers(
        orders.clean_orders(shop.orders, delivered_only=True), shop.customers
    )
    facts = orders.with_reviews(
        orders.with_item_totals(owned, shop.clean_items, count_lines=True),
        shop.reviews,
        missing_score=0.0,
    )
    table = churn.churn_features_first_known(facts, STUDY_FIRST, STUDY_LAST)
    noisy = "avg_review_score late_delivery_rate purchase_frequency_score log_total_revenue log_recency"
    return show(table, rounded=noisy)


_CHURN_NB_SQL = f"""SELECT f.*, round(total_orders * 1.0 / (customer_age_days + 1) * 30, 6) AS purchase_frequency_score,
    total_revenue / (total_orders + 1) AS revenue_per_order_norm,
    CASE WHEN rate > 0.3 THEN 1 ELSE 0 END AS high_late_delivery_flag,
    round(ln(total_revenue + 1), 6) AS log_total_revenue, round(ln(recency_days + 1), 6) AS log_recency,
    CASE WHEN u.customer_unique_id IS NULL THEN 1 ELSE 0 END AS is_churned,
    round(coalesce(rate, 0.0), 6) AS late_delivery_rate FROM (
    SELECT customer_unique_id, snapshot_date, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_purchase,
        strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_purchase, count(DISTINCT order_id) AS total_orders,
        CAST(sum(CAST(order_revenue AS DECIMAL(18, 4))) AS DOUBLE) AS total_revenue,
        CAST(sum(CAST(order_revenue AS DECIMAL(18, 4))) AS DOUBLE) / count(*) AS avg_order_value,
        round(avg(avg_review_score), 6) AS avg_review_score, avg(is_late) AS rate,
        CAST(date_diff('day', max(bought_on), snapshot_date) AS INTEGER) AS recency_days,
        CAST(date_diff('day', min(bought_on), max(bought_on)) AS INTEGER) AS customer_age_days
        FROM months JOIN bought ON bought_on <= snapshot_date GROUP BY customer_unique_id, snapshot_date) f
    LEFT JOIN (SELECT DISTINCT customer_unique_id, snapshot_date FROM months JOIN bought
        ON bought_on > snapshot_date AND bought_on <= snapshot_date + 90) u USING (customer_unique_id, snapshot_date)"""


def _churn_nb_sql() -> str:
    months = (
        "months AS (SELECT CAST(unnest(generate_series(DATE '"
        + STUDY_FIRST
        + "', DATE '"
        + STUDY_LAST
        + "', INTERVAL 1 MONTH)) AS DATE) AS snapshot_date)"
    )
    bought = (
        "bought AS (SELECT *, order_purchase_timestamp AS ts, CAST(order_purchase_timestamp AS DATE) AS bought_on"
        " FROM master_row WHERE order_status = 'delivered' AND order_purchase_timestamp IS NOT NULL"
        " AND customer_unique_id IS NOT NULL)"
    )
    columns = (
        "customer_unique_id, snapshot_date, first_purchase, last_purchase, total_orders, total_revenue,"
        " avg_order_value, avg_review_score, late_delivery_rate, is_churned, recency_days, customer_age_days,"
        " purchase_frequency_score, revenue_per_order_norm, high_late_delivery_flag, log_total_revenue, log_recency"
    )
    base = sql("", "master_row").rstrip()
    return f"{base},\n{months},\n{bought}\nSELECT {columns} FROM ({_CHURN_NB_SQL.replace('f.*', 'f.* EXCLUDE (rate)')})"


def _churn_label(shop: Shop):
    return shop.churn.where("is_churned = 0").select("snapshot_date", "customer_unique_id")


def _rfm_rank(shop: Shop):
    return show(rfm.rfm_segments_by_rank(shop.stored_profile), _RFM_RANK)


_RFM = (
    "customer_unique_id recency_days total_orders total_revenue recency_score frequency_score"
    " monetary_score rfm_total segment_label"
)
_RFM_RANK = f"{_RFM} repeat_customer_flag"

QUERIES = {
    "clean_orders": (_clean_orders, sql(f"SELECT {_ORDER_SQL} FROM c_orders", "c_orders")),
    "clean_orders_delivered_only": (
        _delivered_only,
        sql(f"SELECT {_ORDER_SQL} FROM d_orders", "d_orders"),
    ),
    "clean_order_items": (
        lambda shop: show(
            shop.clean_items,
            "order_id order_item_id product_id seller_id price freight_value total_item_value freight_ratio",
        ),
        sql(
            "SELECT order_id, order_item_id, product_id, seller_id, price, freight_value, total_item_value,"
            " freight_ratio FROM c_items",
            "c_items",
        ),
    ),
    "filter_drop_count": (
        lambda shop: orders.dropped_item_count(shop.items),
        sql(
            "SELECT count(*) AS input_rows, count(*) FILTER (WHERE price > 0) AS output_rows,"
            " count(*) FILTER (WHERE price IS NULL OR price <= 0) AS filtered_rows FROM v_items",
            "v_items",
        ),
    ),
    "safe_divide": (
        _safe_divide,
        sql(
            "SELECT order_id, CASE WHEN v <> 0 THEN coalesce(f / v, 0.0) ELSE 0.0 END AS freight_per_value,"
            " coalesce(v / n, 0.0) AS value_per_item FROM (SELECT order_id,"
            " CAST(sum(CAST(price AS DECIMAL(18, 4))) AS DOUBLE) AS v,"
            " CAST(sum(CAST(freight_value AS DECIMAL(18, 4))) AS DOUBLE) AS f, count(*) AS n FROM v_items GROUP BY 1)",
            "v_items",
        ),
    ),
    "fill_defaults": (
        _fill_defaults,
        sql(
            "SELECT order_id, coalesce(order_revenue, 0.0) AS order_revenue, coalesce(freight_total, 0.0) AS freight_total,"
            " coalesce(item_count, 0) AS item_count, coalesce(payment_total, 0.0) AS payment_total,"
            " coalesce(primary_payment_type, 'unknown') AS primary_payment_type FROM c_orders"
            " LEFT JOIN item_agg USING (order_id) LEFT JOIN pay_total USING (order_id) LEFT JOIN pay_primary USING (order_id)",
            "c_orders", "item_agg", "pay_total", "pay_primary",
        ),
    ),
    "category_fallback": (
        _category_fallback,
        sql("SELECT product_id, category_name_english FROM labelled", "labelled"),
    ),
    "order_item_agg": (
        lambda shop: orders.item_totals(shop.clean_items),
        sql("SELECT * FROM item_agg", "item_agg"),
    ),
    "payment_total": (
        lambda shop: orders.payment_totals(shop.payments),
        sql("SELECT * FROM pay_total", "pay_total"),
    ),
    "primary_payment": (
        lambda shop: orders.payments_by_type(shop.payments),
        sql(
            "SELECT order_id, payment_total, primary_payment_type FROM pay_total JOIN pay_primary USING (order_id)",
            "pay_total", "pay_primary",
        ),
    ),
    "primary_payment_by_row": (
        lambda shop: orders.primary_payment_by_row(shop.payments),
        sql("SELECT * FROM pay_primary_row", "pay_primary_row"),
    ),
    "review_agg": (
        lambda shop: show(orders.review_means(shop.reviews), rounded="avg_review_score"),
        sql(f"SELECT order_id, {means('avg_review_score')} FROM rev_agg", "rev_agg"),
    ),
    "master_orders": (
        lambda shop: show(shop.master, _MASTER, "avg_review_score"),
        sql(f"SELECT {_MASTER_SQL} FROM master", "master"),
    ),
    "master_orders_nb": (
        lambda shop: show(shop.master_by_row, _MASTER, "avg_review_score"),
        sql(f"SELECT {_MASTER_SQL} FROM master_row", "master_row"),
    ),
    "preferred_payment": (
        lambda shop: customers.preferred_payment(
            orders.with_payments(
                orders.with_customers(shop.clean_orders, shop.customers),
                orders.payments_by_type(shop.payments),
            )
        ),
        sql("SELECT * FROM preferred", "preferred"),
    ),
    "customer_profile": (
        lambda shop: show(shop.profile, rounded=_PROFILE_MEANS),
        sql(
            f"SELECT * EXCLUDE (first_purchase, last_purchase, avg_review_score, late_delivery_rate),"
            f" {times('first_purchase', 'last_purchase')}, {means('avg_review_score', 'late_delivery_rate')} FROM profile",
            "profile",
        ),
    ),
    "customer_profile_min_by": (
        _profile_first_order,
        sql(
            f"""SELECT customer_unique_id, {times('first_purchase', 'last_purchase')}, total_orders, total_revenue,
            avg_order_value, {means('avg_review_score', 'late_delivery_rate')}, f.preferred_payment, f.customer_state,
            recency_days, customer_age_days,
            round(total_orders * 1.0 / (customer_age_days + 1) * 30, 6) AS purchase_frequency_score
            FROM profile p LEFT JOIN (SELECT customer_unique_id, primary_payment_type AS preferred_payment, customer_state FROM (
                SELECT *, row_number() OVER (PARTITION BY customer_unique_id ORDER BY order_purchase_timestamp, order_id) AS rn
                FROM master WHERE order_purchase_timestamp IS NOT NULL) WHERE rn = 1) f USING (customer_unique_id)""",
            "profile",
        ),
    ),
    "product_demand": (
        lambda shop: show(shop.demand, rounded="mom_growth"),
        sql(f"SELECT * EXCLUDE (mom_growth), {means('mom_growth')} FROM demand", "demand"),
    ),
    "mom_growth": (
        lambda shop: show(
            shop.demand,
            "category_name_english order_year_month monthly_units prev_month mom_growth",
            "mom_growth",
        ),
        sql(
            "SELECT category_name_english, order_year_month, monthly_units, prev_month,"
            f" {means('mom_growth')} FROM demand",
            "demand",
        ),
    ),
    "demand_history": (
        lambda shop: demand.demand_history(shop.demand),
        sql(
            "SELECT category_name_english, order_year_month, monthly_units, monthly_revenue, avg_price FROM demand",
            "demand",
        ),
    ),
    "demand_features": (
        lambda shop: show(demand.demand_features(shop.demand), _FEATURES, "rolling_mean_3"),
        sql(
            f"SELECT * EXCLUDE (rolling_mean_3), {means('rolling_mean_3')} FROM features", "features"
        ),
    ),
    "demand_spine": (
        lambda shop: show(
            demand.monthly_demand(shop.stored_demand),
            "category_name_english order_year_month target_units monthly_revenue avg_price",
        ),
        sql(
            """SELECT s.category_name_english, strftime(s.forecast_month, '%Y-%m') AS order_year_month,
            coalesce(CAST(monthly_units AS DOUBLE), 0.0) AS target_units, coalesce(monthly_revenue, 0.0) AS monthly_revenue,
            coalesce(avg_price, 0.0) AS avg_price FROM spine s LEFT JOIN demand d
            ON s.category_name_english = d.category_name_english AND strftime(s.forecast_month, '%Y-%m') = d.order_year_month""",
            "spine", "demand",
        ),
    ),
    "demand_features_calendar": (
        lambda shop: show(
            demand.demand_features_calendar(shop.stored_demand, shop.clean_orders),
            rounded="rolling_mean_3",
        ),
        sql(
            f"SELECT * EXCLUDE (rolling_mean_3), {means('rolling_mean_3')} FROM calendar_features",
            "calendar_features",
        ),
    ),
    "comparable_summary": (
        lambda shop: demand.comparable_summary(
            demand.demand_features_calendar(shop.stored_demand, shop.clean_orders)
        ),
        sql(
            "SELECT target_period_comparable, count(*) AS feature_rows, count(DISTINCT forecast_month) AS forecast_months,"
            " count(DISTINCT category_name_english) AS categories FROM calendar_features GROUP BY 1",
            "calendar_features",
        ),
    ),
    "demand_cutoff_month": (
        lambda shop: demand.demand_cutoff_month(shop.orders),
        sql(
            "SELECT strftime(max(order_purchase_timestamp) - INTERVAL 1 MONTH, '%Y-%m') AS cutoff_month FROM v_orders",
            "v_orders",
        ),
    ),
    "seller_order_map": (
        lambda shop: sellers.seller_orders(shop.clean_items),
        sql("SELECT * FROM seller_orders", "seller_orders"),
    ),
    "seller_performance": (
        lambda shop: show(shop.seller_performance, rounded="avg_review late_rate"),
        sql(
            f"SELECT * EXCLUDE (avg_review, late_rate), {means('avg_review', 'late_rate')} FROM seller_perf",
            "seller_perf",
        ),
    ),
    "seller_performance_two_level": (
        _two_level,
        sql(
            f"""SELECT *, CASE WHEN total_revenue > {TIER_HIGH_ABOVE} THEN 'high' WHEN total_revenue >= {TIER_MEDIUM_FROM} THEN 'medium' ELSE 'low' END AS performance_tier
            FROM (SELECT seller_id, seller_state, count(DISTINCT order_id) AS total_orders, CAST(sum(v) AS DOUBLE) AS total_revenue,
            round(avg(score), 6) AS avg_review, round(avg(is_late), 6) AS late_rate FROM (
                SELECT seller_id, seller_state, i.order_id, sum(CAST(total_item_value AS DECIMAL(18, 4))) AS v,
                max(coalesce(avg_review_score, 0.0)) AS score, max(is_late) AS is_late
                FROM c_items i LEFT JOIN v_sellers USING (seller_id) LEFT JOIN d_orders o ON i.order_id = o.order_id
                LEFT JOIN rev_agg r ON i.order_id = r.order_id GROUP BY ALL) GROUP BY ALL)""",
            "c_items", "v_sellers", "d_orders", "rev_agg",
        ),
    ),
    "mask_identifier": (
        _mask,
        sql(
            "SELECT seller_id, CASE WHEN length(seller_id) <= 12 THEN seller_id"
            " ELSE concat(substr(seller_id, 1, 8), '...', right(seller_id, 4)) END AS seller_id_short FROM v_sellers",
            "v_sellers",
        ),
    ),
    "month_calendar": (
        _month_calendar,
        sql(
            """SELECT CAST(unnest(generate_series(f, l, INTERVAL 1 MONTH)) AS DATE) AS month_start FROM (
            SELECT date_trunc('month', min(order_purchase_timestamp)) AS f, date_trunc('month', max(order_purchase_timestamp)) AS l
            FROM c_orders WHERE order_status = 'delivered')""",
            "c_orders",
        ),
    ),
    "snapshot_dates": (_snapshot_dates, sql("SELECT * FROM snapshots", "snapshots")),
    "churn_features": (
        lambda shop: show(shop.churn, rounded=_CHURN_LOGS),
        sql(
            f"""SELECT snapshot_date, customer_unique_id, total_orders, total_revenue, total_revenue / total_orders AS avg_order_value,
            {times('first_purchase_timestamp', 'last_purchase_timestamp')}, recency_days, customer_age_days,
            {means('avg_review_score', 'late_delivery_rate')}, {times('last_review_creation_date', 'last_delivery_date')}, is_churned,
            round(total_orders * 1.0 / (customer_age_days + 1) * 30, 6) AS purchase_frequency_30d,
            round(ln(1 + recency_days), 6) AS log_recency, round(ln(1 + total_revenue), 6) AS log_total_revenue,
            total_revenue / total_orders AS revenue_per_order FROM churn""",
            "churn",
        ),
    ),
    "churn_label": (
        _churn_label,
        sql(
            "SELECT snapshot_date, customer_unique_id FROM future SEMI JOIN past USING (snapshot_date, customer_unique_id)",
            "future", "past",
        ),
    ),
    "churn_review_features": (
        lambda shop: show(
            shop.churn,
            "snapshot_date customer_unique_id avg_review_score last_review_creation_date",
            "avg_review_score",
        ),
        sql(
            f"""SELECT snapshot_date, customer_unique_id, round(coalesce(avg_review_score, 0.0), 6) AS avg_review_score,
            {times('last_review_creation_date')} FROM (SELECT DISTINCT snapshot_date, customer_unique_id FROM past)
            LEFT JOIN past_reviews USING (snapshot_date, customer_unique_id)""",
            "past", "past_reviews",
        ),
    ),
    "churn_delivery_features": (
        lambda shop: show(
            shop.churn,
            "snapshot_date customer_unique_id late_delivery_rate last_delivery_date",
            "late_delivery_rate",
        ),
        sql(
            f"""SELECT snapshot_date, customer_unique_id, round(coalesce(late_delivery_rate, 0.0), 6) AS late_delivery_rate,
            {times('last_delivery_date')} FROM (SELECT DISTINCT snapshot_date, customer_unique_id FROM past)
            LEFT JOIN past_deliveries USING (snapshot_date, customer_unique_id)""",
            "past", "past_deliveries",
        ),
    ),
    "churn_summary": (
        lambda shop: show(churn.churn_summary(shop.churn), rounded="churn_rate"),
        sql(
            "SELECT min(snapshot_date) AS min_snapshot, max(snapshot_date) AS max_snapshot,"
            " count(DISTINCT snapshot_date) AS snapshot_count, count(DISTINCT customer_unique_id) AS unique_customers,"
            " round(avg(is_churned), 6) AS churn_rate FROM churn",
            "churn",
        ),
    ),
    "churn_features_nb": (_churn_nb, _churn_nb_sql()),
    "rfm_segments": (
        lambda shop: show(shop.rfm, _RFM),
        sql(f"SELECT {_RFM.replace(' ', ', ')} FROM rfm", "rfm"),
    ),
    "rfm_percent_rank": (
        _rfm_rank,
        sql(f"SELECT {_RFM_RANK.replace(' ', ', ')} FROM rfm_rank", "rfm_rank"),
    ),
    "bi_revenue": (
        lambda shop: show(shop.bi, rounded="late_delivery_rate"),
        sql(f"SELECT * EXCLUDE (late_delivery_rate), {means('late_delivery_rate')} FROM bi", "bi"),
    ),
    "bi_revenue_delivered": (
        lambda shop: show(
            revenue.bi_revenue_delivered(
                orders.with_payments(shop.valued_orders, orders.payments_by_type(shop.payments))
            ),
            rounded="late_delivery_rate",
        ),
        sql(
            """SELECT order_year, order_month, order_year_month, customer_state, primary_payment_type, total_orders,
            item_merchandise_value_ex_freight, delivered_order_count, late_delivery_count,
            item_merchandise_value_ex_freight / total_orders AS avg_item_value_per_order,
            CASE WHEN delivered_order_count > 0 THEN round(late_delivery_count * 1.0 / delivered_order_count, 6) END AS late_delivery_rate
            FROM (SELECT order_year, order_month, order_year_month, customer_state, primary_payment_type,
            count(DISTINCT order_id) AS total_orders,
            CAST(sum(CAST(order_revenue AS DECIMAL(18, 4))) AS DOUBLE) AS item_merchandise_value_ex_freight,
            count(*) FILTER (WHERE order_status = 'delivered' AND is_late IS NOT NULL) AS delivered_order_count,
            count(*) FILTER (WHERE order_status = 'delivered' AND is_late = 1) AS late_delivery_count
            FROM master GROUP BY 1, 2, 3, 4, 5)""",
            "master",
        ),
    ),
}

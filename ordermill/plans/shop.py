"""The order-processing tables as views over the star-schema test tables.

``Shop`` builds them with Spark; ``CTES`` states the same definitions, and
those of the derived tables, in SQL for the side-by-side check.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.operators import (
    backtest,
    churn,
    customers,
    demand,
    marts,
    orders,
    periods,
    revenue,
    rfm,
    sellers,
)
from ordermill.sources.scratch import materialize

REFERENCE_DATE = "2001-10-17"
TIER_HIGH_ABOVE, TIER_MEDIUM_FROM = 33_000_000, 27_000_000
STUDY_FIRST, STUDY_LAST = "1996-01-01", "2001-05-01"
MIN_ORDERS = 100


class Shop:
    """Views and derived tables of one data folder; each is built once per instance."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    # Raw views ---------------------------------------------------------------

    @cached_property
    def orders(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS customer_id",
            "CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'"
            " ELSE 'canceled' END AS order_status",
            "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderdate END"
            " AS order_purchase_timestamp",
            "CASE WHEN o_orderkey % 10 = 0 THEN NULL"
            " ELSE o_orderdate + make_dt_interval(1) END AS order_approved_at",
            "CASE WHEN o_orderstatus = 'F' THEN o_orderdate + make_dt_interval(2) END"
            " AS order_delivered_carrier_date",
            "CASE WHEN (o_orderstatus = 'F' AND NOT"
            " (o_orderpriority = '4-NOT SPECIFIED' AND o_totalprice < 50000))"
            " OR (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')"
            " THEN o_orderdate + make_dt_interval(int(o_orderkey % 45), int(o_orderkey % 2) * 6)"
            " END AS order_delivered_customer_date",
            "CASE WHEN o_orderkey % 89 = 0 THEN NULL"
            " ELSE o_orderdate + make_dt_interval(30) END AS order_estimated_delivery_date",
        )

    @cached_property
    def items(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "l_orderkey AS order_id",
            "l_linenumber AS order_item_id",
            "l_partkey AS product_id",
            "concat('Supplier#', lpad(CAST(l_suppkey AS STRING), 9, '0')) AS seller_id",
            "l_shipdate AS shipping_limit_date",
            "CASE WHEN l_quantity = 1 THEN 0.0D WHEN l_quantity = 2 THEN NULL"
            " ELSE l_extendedprice END AS price",
            "CAST(rint(l_extendedprice * 100) AS BIGINT) * CAST(rint(l_tax * 100) AS BIGINT)"
            " / 10000.0D AS freight_value",
        )

    @cached_property
    def payments(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "l_orderkey AS order_id",
            "l_linenumber AS payment_sequential",
            "concat(l_returnflag, l_linestatus) AS payment_type",
            "CAST(l_quantity AS INT) AS payment_installments",
            "CAST(rint(l_extendedprice * 100) AS BIGINT) * (100 + CAST(rint(l_tax * 100) AS BIGINT))"
            " / 10000.0D AS payment_value",
        )

    @cached_property
    def reviews(self) -> DataFrame:
        """Every order but the low-priority ones is reviewed; urgent ones twice."""
        reviewed = self.table("orders").where("o_orderpriority <> '5-LOW'")
        message = "concat(o_orderpriority, ', \"', o_orderstatus, '\"', chr(10), 'ok')"
        first = reviewed.selectExpr(
            "o_orderkey * 2 AS review_id",
            "o_orderkey AS order_id",
            "CAST(1 + o_orderkey % 5 AS INT) AS review_score",
            "o_orderpriority AS review_comment_title",
            f"{message} AS review_comment_message",
            "CASE WHEN o_orderkey % 101 = 0 THEN NULL"
            " ELSE o_orderdate + make_dt_interval(12) END AS review_creation_date",
            "o_orderdate + make_dt_interval(13) AS review_answer_timestamp",
        )
        second = reviewed.where("o_orderpriority = '1-URGENT'").selectExpr(
            "o_orderkey * 2 + 1 AS review_id",
            "o_orderkey AS order_id",
            "CAST(1 + (o_orderkey % 7) % 5 AS INT) AS review_score",
            "o_orderpriority AS review_comment_title",
            f"{message} AS review_comment_message",
            "o_orderdate + make_dt_interval(40) AS review_creation_date",
            "o_orderdate + make_dt_interval(41) AS review_answer_timestamp",
        )
        return first.unionAll(second)

    def _nations(self) -> DataFrame:
        return self.table("nation").select("n_nationkey", "n_name")

    @cached_property
    def customers(self) -> DataFrame:
        joined = self.table("customer").join(
            self._nations(), F.col("c_nationkey") == F.col("n_nationkey"), "left"
        )
        return joined.selectExpr(
            "c_custkey AS customer_id",
            "c_custkey - c_custkey % 2 AS customer_unique_id",
            "c_nationkey AS customer_zip_code_prefix",
            "c_mktsegment AS customer_city",
            "n_name AS customer_state",
        )

    @cached_property
    def products(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey AS product_id",
            "CASE WHEN p_size = 50 THEN NULL ELSE concat(p_brand, '/', p_type) END"
            " AS product_category_name",
            "CAST(length(p_name) AS DOUBLE) AS product_name_lenght",
            "CAST(length(p_type) AS DOUBLE) AS product_description_lenght",
            "CAST(p_size % 5 AS DOUBLE) AS product_photos_qty",
            "p_retailprice AS product_weight_g",
            "CAST(p_size AS DOUBLE) AS product_length_cm",
            "CAST(p_size AS DOUBLE) AS product_height_cm",
            "CAST(p_size AS DOUBLE) AS product_width_cm",
        )

    @cached_property
    def translation(self) -> DataFrame:
        """All categories but the promotional ones are translated."""
        category = "concat(p_brand, '/', p_type)"
        return (
            self.table("part")
            .where("p_type <> 'PROMO' AND p_size <> 50")
            .selectExpr(
                f"{category} AS product_category_name",
                f"lower({category}) AS product_category_name_english",
            )
            .distinct()
        )

    @cached_property
    def sellers(self) -> DataFrame:
        joined = self.table("supplier").join(
            self._nations(), F.col("s_nationkey") == F.col("n_nationkey"), "left"
        )
        return joined.selectExpr(
            "concat('Supplier#', lpad(CAST(s_suppkey AS STRING), 9, '0')) AS seller_id",
            "s_nationkey AS seller_zip_code_prefix",
            "s_name AS seller_city",
            "n_name AS seller_state",
        )

    @cached_property
    def geolocation(self) -> DataFrame:
        joined = self.table("customer").join(
            self._nations(), F.col("c_nationkey") == F.col("n_nationkey"), "left"
        )
        return joined.selectExpr(
            "c_nationkey AS geolocation_zip_code_prefix",
            "c_acctbal AS geolocation_lat",
            "-c_acctbal AS geolocation_lng",
            "c_mktsegment AS geolocation_city",
            "n_name AS geolocation_state",
        )

    @property
    def raw_tables(self) -> dict[str, DataFrame]:
        return {
            "orders": self.orders,
            "customers": self.customers,
            "order_items": self.items,
            "payments": self.payments,
            "reviews": self.reviews,
            "products": self.products,
            "sellers": self.sellers,
            "geolocation": self.geolocation,
            "category_translation": self.translation,
        }

    # Derived tables ------------------------------------------------------------

    @cached_property
    def clean_orders(self) -> DataFrame:
        return orders.clean_orders(self.orders)

    @cached_property
    def clean_items(self) -> DataFrame:
        return orders.clean_order_items(self.items)

    @cached_property
    def master(self) -> DataFrame:
        return orders.master_orders(
            self.clean_orders, self.clean_items, self.payments, self.reviews, self.customers
        )

    @cached_property
    def stored_master(self) -> DataFrame:
        """The fact table written out, for reports that read it more than once."""
        return materialize(self.master, "master")

    @property
    def facts(self) -> DataFrame:
        """The fact table as stored if a report stored it before, else as computed from the columns in use."""
        return self.__dict__.get("stored_master", self.master)

    @cached_property
    def valued_orders(self) -> DataFrame:
        """Orders with item money and customer only: no payments, no reviews."""
        owned = orders.with_customers(self.clean_orders, self.customers)
        return orders.with_item_totals(owned, self.clean_items)

    @cached_property
    def stored_eligible_orders(self) -> DataFrame:
        """What the churn panel reads: its orders alone, in the columns in use."""
        return materialize(churn.eligible_orders(self.valued_orders).select(*churn.ORDER_COLUMNS), "orders")

    @cached_property
    def reviewed_orders(self) -> DataFrame:
        """Orders with their review score only."""
        return orders.with_reviews(self.clean_orders, self.reviews)

    @cached_property
    def master_by_row(self) -> DataFrame:
        return orders.master_orders_by_row(
            orders.clean_orders(self.orders, delivered_only=True),
            self.clean_items,
            self.payments,
            self.reviews,
            self.customers,
        )

    @cached_property
    def profile(self) -> DataFrame:
        return customers.customer_profile(self.facts, REFERENCE_DATE)

    @cached_property
    def stored_profile(self) -> DataFrame:
        return materialize(self.profile, "profile")

    @cached_property
    def demand(self) -> DataFrame:
        return demand.product_demand(
            self.clean_items, self.clean_orders, self.products, self.translation
        )

    @cached_property
    def stored_demand(self) -> DataFrame:
        return materialize(self.demand, "demand")

    @cached_property
    def seller_performance(self) -> DataFrame:
        return sellers.seller_performance(
            self.clean_items, self.__dict__.get("stored_master", self.reviewed_orders), self.sellers,
            TIER_HIGH_ABOVE, TIER_MEDIUM_FROM,
        )

    @cached_property
    def stored_seller_performance(self) -> DataFrame:
        return materialize(self.seller_performance, "sellers")

    @cached_property
    def ranking(self) -> DataFrame:
        return sellers.seller_ranking(self.seller_performance)

    @cached_property
    def churn(self) -> DataFrame:
        return churn.churn_features(self.stored_eligible_orders, self.reviews)

    @cached_property
    def rfm(self) -> DataFrame:
        return rfm.rfm_segments(self.stored_profile)

    @cached_property
    def bi(self) -> DataFrame:
        return revenue.bi_revenue(self.master)

    @cached_property
    def coverage(self) -> DataFrame:
        """Coverage needs the orders alone, not the joined facts."""
        return periods.flag_period_quality(
            periods.period_coverage(self.clean_orders), min_orders=MIN_ORDERS
        )

    @cached_property
    def backtest_input(self) -> DataFrame:
        features = demand.demand_features(self.demand)
        return backtest.prepare_backtest_input(backtest.backtest_input(features, self.coverage))

    @cached_property
    def stored_backtest_input(self) -> DataFrame:
        return materialize(self.backtest_input, "backtest")

    @cached_property
    def naive_predictions(self) -> DataFrame:
        return backtest.naive_backtest(self.stored_backtest_input)

    @cached_property
    def compared_predictions(self) -> DataFrame:
        """Naive rows next to a moving average, and the better of the two."""
        average = self.naive_predictions.withColumn("moving_average_prediction", F.col("rolling_mean_3"))
        return backtest.with_champion(average, backtest.MOVING)

    @cached_property
    def monthly_revenue(self) -> DataFrame:
        return marts.monthly_revenue(self.bi, self.coverage)


# SQL definitions: name -> (names it uses, body).
CTES: dict[str, tuple[str, str]] = {
    "v_orders": (
        "",
        """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
        CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END AS order_status,
        CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderdate END AS order_purchase_timestamp,
        CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderdate + to_days(1) END AS order_approved_at,
        CASE WHEN o_orderstatus = 'F' THEN o_orderdate + to_days(2) END AS order_delivered_carrier_date,
        CASE WHEN (o_orderstatus = 'F' AND NOT (o_orderpriority = '4-NOT SPECIFIED' AND o_totalprice < 50000))
               OR (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')
             THEN o_orderdate + to_days(CAST(o_orderkey % 45 AS INTEGER)) + to_hours(CAST(o_orderkey % 2 * 6 AS INTEGER))
        END AS order_delivered_customer_date,
        CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE o_orderdate + to_days(30) END AS order_estimated_delivery_date
        FROM orders""",
    ),
    "v_items": (
        "",
        """SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
        concat('Supplier#', lpad(CAST(l_suppkey AS VARCHAR), 9, '0')) AS seller_id,
        l_shipdate AS shipping_limit_date,
        CASE WHEN l_quantity = 1 THEN 0.0 WHEN l_quantity = 2 THEN NULL ELSE l_extendedprice END AS price,
        CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(round(l_tax * 100) AS BIGINT) / CAST(10000 AS DOUBLE) AS freight_value
        FROM lineitem""",
    ),
    "v_payments": (
        "",
        """SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential,
        concat(l_returnflag, l_linestatus) AS payment_type, CAST(l_quantity AS INTEGER) AS payment_installments,
        CAST(round(l_extendedprice * 100) AS BIGINT) * (100 + CAST(round(l_tax * 100) AS BIGINT)) / CAST(10000 AS DOUBLE) AS payment_value
        FROM lineitem""",
    ),
    "v_reviews": (
        "",
        """SELECT o_orderkey * 2 AS review_id, o_orderkey AS order_id, CAST(1 + o_orderkey % 5 AS INTEGER) AS review_score,
        o_orderpriority AS review_comment_title,
        concat(o_orderpriority, ', "', o_orderstatus, '"', chr(10), 'ok') AS review_comment_message,
        CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_orderdate + to_days(12) END AS review_creation_date,
        o_orderdate + to_days(13) AS review_answer_timestamp
        FROM orders WHERE o_orderpriority <> '5-LOW'
        UNION ALL
        SELECT o_orderkey * 2 + 1, o_orderkey, CAST(1 + (o_orderkey % 7) % 5 AS INTEGER), o_orderpriority,
        concat(o_orderpriority, ', "', o_orderstatus, '"', chr(10), 'ok'),
        o_orderdate + to_days(40), o_orderdate + to_days(41)
        FROM orders WHERE o_orderpriority = '1-URGENT'""",
    ),
    "v_customers": (
        "",
        """SELECT c_custkey AS customer_id, c_custkey - c_custkey % 2 AS customer_unique_id,
        c_nationkey AS customer_zip_code_prefix, c_mktsegment AS customer_city, n_name AS customer_state
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "v_products": (
        "",
        """SELECT p_partkey AS product_id,
        CASE WHEN p_size = 50 THEN NULL ELSE concat(p_brand, '/', p_type) END AS product_category_name,
        CAST(length(p_name) AS DOUBLE) AS product_name_lenght,
        CAST(length(p_type) AS DOUBLE) AS product_description_lenght,
        CAST(p_size % 5 AS DOUBLE) AS product_photos_qty, p_retailprice AS product_weight_g,
        CAST(p_size AS DOUBLE) AS product_length_cm, CAST(p_size AS DOUBLE) AS product_height_cm,
        CAST(p_size AS DOUBLE) AS product_width_cm FROM part""",
    ),
    "v_translation": (
        "",
        """SELECT DISTINCT concat(p_brand, '/', p_type) AS product_category_name,
        lower(concat(p_brand, '/', p_type)) AS product_category_name_english
        FROM part WHERE p_type <> 'PROMO' AND p_size <> 50""",
    ),
    "v_sellers": (
        "",
        """SELECT concat('Supplier#', lpad(CAST(s_suppkey AS VARCHAR), 9, '0')) AS seller_id,
        s_nationkey AS seller_zip_code_prefix, s_name AS seller_city, n_name AS seller_state
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    ),
    "v_geolocation": (
        "",
        """SELECT c_nationkey AS geolocation_zip_code_prefix, c_acctbal AS geolocation_lat,
        -c_acctbal AS geolocation_lng, c_mktsegment AS geolocation_city, n_name AS geolocation_state
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "dated_orders": (
        "v_orders",
        """SELECT order_id, customer_id, order_status, order_purchase_timestamp,
        coalesce(order_approved_at, order_purchase_timestamp) AS order_approved_at,
        order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date,
        CASE WHEN order_status = 'canceled' THEN 1 ELSE 0 END AS is_canceled,
        CAST(year(order_purchase_timestamp) AS INTEGER) AS order_year,
        CAST(month(order_purchase_timestamp) AS INTEGER) AS order_month,
        strftime(order_purchase_timestamp, '%Y-%m') AS order_year_month,
        CAST(date_diff('day', CAST(order_purchase_timestamp AS DATE), CAST(order_delivered_customer_date AS DATE)) AS INTEGER) AS delivery_days,
        CASE WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 1
             WHEN order_delivered_customer_date <= order_estimated_delivery_date THEN 0 END AS late_any
        FROM v_orders""",
    ),
    "c_orders": (
        "dated_orders",
        """SELECT * EXCLUDE (late_any), late_any AS is_late,
        CASE late_any WHEN 1 THEN CAST(date_diff('day', CAST(order_estimated_delivery_date AS DATE), CAST(order_delivered_customer_date AS DATE)) AS INTEGER)
             WHEN 0 THEN 0 END AS delivery_delay_days FROM dated_orders""",
    ),
    "d_orders": (
        "c_orders",
        """SELECT * EXCLUDE (is_late, delivery_delay_days),
        CASE WHEN order_status = 'delivered' THEN is_late END AS is_late,
        CASE WHEN order_status = 'delivered' THEN delivery_delay_days END AS delivery_delay_days FROM c_orders""",
    ),
    "c_items": (
        "v_items",
        """SELECT *, price + freight_value AS total_item_value,
        CASE WHEN price + freight_value > 0 THEN freight_value / (price + freight_value) ELSE 0.0 END AS freight_ratio
        FROM v_items WHERE price > 0""",
    ),
    "item_agg": (
        "c_items",
        """SELECT order_id, CAST(sum(CAST(price AS DECIMAL(18, 4))) AS DOUBLE) AS order_revenue,
        CAST(sum(CAST(freight_value AS DECIMAL(18, 4))) AS DOUBLE) AS freight_total, count(*) AS item_count
        FROM c_items GROUP BY order_id""",
    ),
    "pay_total": (
        "v_payments",
        """SELECT order_id, CAST(sum(CAST(payment_value AS DECIMAL(18, 4))) AS DOUBLE) AS payment_total
        FROM v_payments GROUP BY order_id""",
    ),
    "pay_primary": (
        "v_payments",
        """SELECT order_id, payment_type AS primary_payment_type FROM (
        SELECT order_id, payment_type, row_number() OVER (PARTITION BY order_id ORDER BY v DESC, s, payment_type) AS rn FROM (
        SELECT order_id, payment_type, sum(CAST(payment_value AS DECIMAL(18, 4))) AS v, min(payment_sequential) AS s
        FROM v_payments GROUP BY order_id, payment_type)) WHERE rn = 1""",
    ),
    "pay_primary_row": (
        "v_payments",
        """SELECT order_id, payment_type AS primary_payment_type FROM (
        SELECT order_id, payment_type, row_number() OVER (PARTITION BY order_id
            ORDER BY payment_value DESC, payment_sequential, payment_type) AS rn FROM v_payments) WHERE rn = 1""",
    ),
    "rev_agg": (
        "v_reviews",
        "SELECT order_id, avg(CAST(review_score AS DOUBLE)) AS avg_review_score FROM v_reviews GROUP BY order_id",
    ),
    "master": (
        "c_orders item_agg pay_total pay_primary rev_agg v_customers",
        """SELECT o.*, coalesce(order_revenue, 0.0) AS order_revenue, coalesce(freight_total, 0.0) AS freight_total,
        coalesce(item_count, 0) AS item_count, coalesce(payment_total, 0.0) AS payment_total,
        coalesce(primary_payment_type, 'unknown') AS primary_payment_type, avg_review_score, customer_unique_id,
        coalesce(customer_city, 'unknown') AS customer_city, coalesce(customer_state, 'unknown') AS customer_state,
        CASE WHEN item_count > 0 THEN order_revenue / item_count ELSE 0.0 END AS revenue_per_item
        FROM c_orders o LEFT JOIN item_agg USING (order_id) LEFT JOIN pay_total USING (order_id)
        LEFT JOIN pay_primary USING (order_id) LEFT JOIN rev_agg USING (order_id) LEFT JOIN v_customers USING (customer_id)""",
    ),
    "master_row": (
        "d_orders item_agg pay_total pay_primary_row rev_agg v_customers",
        """SELECT o.*, coalesce(order_revenue, 0.0) AS order_revenue, coalesce(freight_total, 0.0) AS freight_total,
        coalesce(item_count, 0) AS item_count, coalesce(payment_total, 0.0) AS payment_total,
        coalesce(primary_payment_type, 'unknown') AS primary_payment_type,
        coalesce(avg_review_score, 0.0) AS avg_review_score, customer_unique_id,
        coalesce(customer_city, 'unknown') AS customer_city, coalesce(customer_state, 'unknown') AS customer_state,
        CASE WHEN item_count > 0 THEN order_revenue / item_count ELSE 0.0 END AS revenue_per_item
        FROM d_orders o LEFT JOIN item_agg USING (order_id) LEFT JOIN pay_total USING (order_id)
        LEFT JOIN pay_primary_row USING (order_id) LEFT JOIN rev_agg USING (order_id) LEFT JOIN v_customers USING (customer_id)""",
    ),
    "preferred": (
        "master",
        """SELECT customer_unique_id, primary_payment_type AS preferred_payment FROM (
        SELECT customer_unique_id, primary_payment_type, row_number() OVER (PARTITION BY customer_unique_id
            ORDER BY n DESC, v DESC, primary_payment_type) AS rn FROM (
        SELECT customer_unique_id, primary_payment_type, count(DISTINCT order_id) AS n,
            sum(CAST(payment_total AS DECIMAL(18, 4))) AS v
        FROM master WHERE customer_unique_id IS NOT NULL AND primary_payment_type IS NOT NULL
        GROUP BY ALL)) WHERE rn = 1""",
    ),
    "profile": (
        "master preferred",
        f"""SELECT m.*, coalesce(preferred_payment, 'unknown') AS preferred_payment FROM (
        SELECT customer_unique_id, min(order_purchase_timestamp) AS first_purchase,
        max(order_purchase_timestamp) AS last_purchase, count(DISTINCT order_id) AS total_orders,
        CAST(sum(CAST(order_revenue AS DECIMAL(18, 4))) AS DOUBLE) AS total_revenue,
        CAST(sum(CAST(order_revenue AS DECIMAL(18, 4))) AS DOUBLE) / count(order_revenue) AS avg_order_value,
        avg(avg_review_score) AS avg_review_score, avg(is_late) AS late_delivery_rate,
        CAST(date_diff('day', CAST(max(order_purchase_timestamp) AS DATE), DATE '{REFERENCE_DATE}') AS INTEGER) AS recency_days,
        CAST(date_diff('day', CAST(min(order_purchase_timestamp) AS DATE), CAST(max(order_purchase_timestamp) AS DATE)) AS INTEGER) AS customer_age_days,
        coalesce(min(customer_state), 'unknown') AS customer_state
        FROM master GROUP BY customer_unique_id) m LEFT JOIN preferred USING (customer_unique_id)""",
    ),
    "labelled": (
        "v_products v_translation",
        """SELECT p.product_id, coalesce(product_category_name_english,
        CASE WHEN p.product_category_name IS NOT NULL THEN concat('untranslated__', p.product_category_name) END,
        'unknown') AS category_name_english
        FROM v_products p LEFT JOIN v_translation t ON p.product_category_name = t.product_category_name""",
    ),
    "demand": (
        "c_items c_orders labelled",
        """SELECT *, CASE WHEN prev_month > 0 THEN CAST(monthly_units - prev_month AS DOUBLE) / prev_month * 100 ELSE 0.0 END AS mom_growth
        FROM (SELECT *, lag(monthly_units) OVER (PARTITION BY category_name_english ORDER BY order_year_month) AS prev_month FROM (
        SELECT coalesce(category_name_english, 'unknown') AS category_name_english, order_year_month,
        count(order_item_id) AS monthly_units,
        CAST(sum(CAST(price AS DECIMAL(18, 4))) AS DOUBLE) AS monthly_revenue,
        CAST(sum(CAST(price AS DECIMAL(18, 4))) AS DOUBLE) / count(price) AS avg_price
        FROM c_items i JOIN (SELECT order_id, order_year_month FROM c_orders
            WHERE order_status = 'delivered' AND order_purchase_timestamp IS NOT NULL) o USING (order_id)
        LEFT JOIN labelled USING (product_id) GROUP BY ALL))""",
    ),
    "features": (
        "demand",
        """SELECT category_name_english, order_year_month AS feature_cutoff_month,
        strftime(CAST(concat(order_year_month, '-01') AS DATE) + INTERVAL 1 MONTH, '%Y-%m') AS forecast_month,
        monthly_units, monthly_revenue, avg_price, target_units, monthly_units AS lag_1, lag_2, lag_4, rolling_mean_3,
        CAST(month(CAST(concat(order_year_month, '-01') AS DATE) + INTERVAL 1 MONTH) AS INTEGER) AS month_num,
        CASE WHEN month(CAST(concat(order_year_month, '-01') AS DATE) + INTERVAL 1 MONTH) >= 10 THEN 1 ELSE 0 END AS is_q4
        FROM (SELECT *, lead(monthly_units) OVER w AS target_units, lag(monthly_units, 1) OVER w AS lag_2,
            lag(monthly_units, 3) OVER w AS lag_4,
            avg(monthly_units) OVER (PARTITION BY category_name_english ORDER BY order_year_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_mean_3
            FROM demand WINDOW w AS (PARTITION BY category_name_english ORDER BY order_year_month))
        WHERE lag_4 IS NOT NULL AND target_units IS NOT NULL""",
    ),
    "spine": (
        "demand",
        """SELECT category_name_english, CAST(unnest(generate_series(f, l, INTERVAL 1 MONTH)) AS DATE) AS forecast_month FROM (
        SELECT category_name_english, min(CAST(concat(order_year_month, '-01') AS DATE)) AS f FROM demand GROUP BY 1),
        (SELECT max(CAST(concat(order_year_month, '-01') AS DATE)) AS l FROM demand)""",
    ),
    "edge_flags": (
        "c_orders",
        f"""SELECT order_year_month, order_count,
        order_year_month = min(order_year_month) OVER () OR order_year_month = max(order_year_month) OVER () AS is_partial_period,
        order_count < {MIN_ORDERS} AS is_low_volume_period FROM (
        SELECT order_year_month, count(DISTINCT order_id) AS order_count FROM c_orders
        WHERE order_status = 'delivered' AND order_purchase_timestamp IS NOT NULL GROUP BY 1)""",
    ),
    "calendar_features": (
        "spine demand edge_flags",
        """SELECT category_name_english, forecast_month, order_year_month, target_units, lag_1, lag_2, lag_4, rolling_mean_3,
        lag_1_source_month, lag_2_source_month, lag_4_source_month,
        CAST(month(forecast_month) AS INTEGER) AS month_num,
        CASE WHEN month(forecast_month) >= 10 THEN 1 ELSE 0 END AS is_q4, coalesce(order_count, 0) AS order_count,
        coalesce(is_partial_period, true) AS is_partial_period, coalesce(is_low_volume_period, true) AS is_low_volume_period,
        NOT (coalesce(is_partial_period, true) OR coalesce(is_low_volume_period, true)) AS target_period_comparable
        FROM (SELECT *, lag(target_units, 1) OVER w AS lag_1, lag(target_units, 2) OVER w AS lag_2, lag(target_units, 4) OVER w AS lag_4,
            lag(forecast_month, 1) OVER w AS lag_1_source_month, lag(forecast_month, 2) OVER w AS lag_2_source_month,
            lag(forecast_month, 4) OVER w AS lag_4_source_month,
            avg(target_units) OVER (PARTITION BY category_name_english ORDER BY forecast_month ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS rolling_mean_3
            FROM (SELECT s.category_name_english, s.forecast_month, strftime(s.forecast_month, '%Y-%m') AS order_year_month,
                  coalesce(CAST(d.monthly_units AS DOUBLE), 0.0) AS target_units
                  FROM spine s LEFT JOIN demand d ON s.category_name_english = d.category_name_english
                  AND strftime(s.forecast_month, '%Y-%m') = d.order_year_month)
            WINDOW w AS (PARTITION BY category_name_english ORDER BY forecast_month))
        LEFT JOIN edge_flags USING (order_year_month)
        WHERE lag_1 IS NOT NULL AND lag_2 IS NOT NULL AND lag_4 IS NOT NULL AND rolling_mean_3 IS NOT NULL""",
    ),
    "seller_orders": (
        "c_items",
        "SELECT DISTINCT seller_id, order_id FROM c_items",
    ),
    "seller_perf": (
        "c_items seller_orders c_orders rev_agg v_sellers",
        f"""SELECT *, CASE WHEN total_revenue > {TIER_HIGH_ABOVE} THEN 'high' WHEN total_revenue >= {TIER_MEDIUM_FROM} THEN 'medium' ELSE 'low' END AS performance_tier
        FROM (SELECT a.*, q.avg_review, q.late_rate, coalesce(s.seller_state, 'unknown') AS seller_state FROM (
            SELECT seller_id, count(DISTINCT order_id) AS total_orders,
            CAST(sum(CAST(price AS DECIMAL(18, 4))) AS DOUBLE) AS total_product_revenue,
            CAST(sum(CAST(freight_value AS DECIMAL(18, 4))) AS DOUBLE) AS total_freight,
            CAST(sum(CAST(price + freight_value AS DECIMAL(18, 4))) AS DOUBLE) AS total_revenue
            FROM c_items GROUP BY seller_id) a
        LEFT JOIN (SELECT seller_id, avg(avg_review_score) AS avg_review, avg(is_late) AS late_rate
            FROM seller_orders LEFT JOIN c_orders USING (order_id) LEFT JOIN rev_agg USING (order_id) GROUP BY seller_id) q USING (seller_id)
        LEFT JOIN v_sellers s USING (seller_id))""",
    ),
    "ranked_sellers": (
        "seller_perf",
        """SELECT row_number() OVER (ORDER BY total_revenue DESC, seller_id) AS seller_rank,
        CASE WHEN length(seller_id) <= 12 THEN seller_id ELSE concat(substr(seller_id, 1, 8), '...', right(seller_id, 4)) END AS seller_id_short,
        seller_state, total_orders, total_revenue AS seller_attributed_order_value, avg_review, late_rate, performance_tier FROM seller_perf""",
    ),
    "eligible": (
        "master",
        """SELECT *, CAST(order_purchase_timestamp AS DATE) AS bought_on FROM master
        WHERE order_status = 'delivered' AND order_purchase_timestamp IS NOT NULL AND customer_unique_id IS NOT NULL""",
    ),
    "snapshots": (
        "eligible",
        """SELECT CAST(d AS DATE) AS snapshot_date FROM (SELECT unnest(generate_series(DATE '1990-01-01', DATE '2010-01-01', INTERVAL 1 MONTH)) AS d)
        WHERE d >= (SELECT min(bought_on) + 90 FROM eligible) AND d <= (SELECT max(bought_on) - 90 FROM eligible)""",
    ),
    "past": ("eligible snapshots", "SELECT * FROM snapshots JOIN eligible ON bought_on <= snapshot_date"),
    "future": (
        "eligible snapshots",
        """SELECT DISTINCT snapshot_date, customer_unique_id FROM snapshots
        JOIN eligible ON bought_on > snapshot_date AND bought_on <= snapshot_date + 90""",
    ),
    "past_reviews": (
        "past v_reviews",
        """SELECT snapshot_date, customer_unique_id, avg(CAST(review_score AS DOUBLE)) AS avg_review_score,
        max(review_creation_date) AS last_review_creation_date
        FROM past LEFT JOIN v_reviews USING (order_id)
        WHERE review_creation_date IS NULL OR CAST(review_creation_date AS DATE) <= snapshot_date GROUP BY ALL""",
    ),
    "past_deliveries": (
        "past",
        """SELECT snapshot_date, customer_unique_id, avg(is_late) AS late_delivery_rate,
        max(order_delivered_customer_date) AS last_delivery_date FROM past
        WHERE CAST(order_delivered_customer_date AS DATE) <= snapshot_date GROUP BY ALL""",
    ),
    "churn": (
        "past past_reviews past_deliveries future",
        """SELECT f.*, coalesce(avg_review_score, 0.0) AS avg_review_score, last_review_creation_date,
        coalesce(late_delivery_rate, 0.0) AS late_delivery_rate, last_delivery_date,
        CASE WHEN u.customer_unique_id IS NULL THEN 1 ELSE 0 END AS is_churned FROM (
            SELECT snapshot_date, customer_unique_id, count(DISTINCT order_id) AS total_orders,
            CAST(sum(CAST(order_revenue AS DECIMAL(18, 4))) AS DOUBLE) AS total_revenue,
            min(order_purchase_timestamp) AS first_purchase_timestamp, max(order_purchase_timestamp) AS last_purchase_timestamp,
            CAST(date_diff('day', max(bought_on), snapshot_date) AS INTEGER) AS recency_days,
            CAST(date_diff('day', min(bought_on), max(bought_on)) AS INTEGER) AS customer_age_days
            FROM past GROUP BY snapshot_date, customer_unique_id) f
        LEFT JOIN past_reviews USING (snapshot_date, customer_unique_id)
        LEFT JOIN past_deliveries USING (snapshot_date, customer_unique_id)
        LEFT JOIN future u USING (snapshot_date, customer_unique_id)""",
    ),
    "rfm": (
        "profile",
        """SELECT *, CASE WHEN rfm_total >= 13 THEN 'Champion' WHEN rfm_total >= 10 THEN 'Loyal' WHEN rfm_total >= 7 THEN 'Potential'
            WHEN rfm_total >= 4 THEN 'At Risk' ELSE 'Lost' END AS segment_label
        FROM (SELECT *, recency_score + frequency_score + monetary_score AS rfm_total FROM (
        SELECT *, CAST(ntile(5) OVER (ORDER BY recency_days DESC NULLS LAST, customer_unique_id) AS INTEGER) AS recency_score,
        CAST(ntile(5) OVER (ORDER BY total_orders NULLS FIRST, customer_unique_id) AS INTEGER) AS frequency_score,
        CAST(ntile(5) OVER (ORDER BY total_revenue NULLS FIRST, customer_unique_id) AS INTEGER) AS monetary_score FROM profile))""",
    ),
    "rfm_rank": (
        "profile",
        """SELECT *, CASE WHEN recency_score >= 4 AND frequency_score >= 4 AND monetary_score >= 4 THEN 'Champion'
            WHEN recency_score >= 3 AND monetary_score >= 3 THEN 'Loyal' WHEN recency_score >= 3 THEN 'Potential'
            WHEN recency_score <= 2 AND monetary_score >= 3 THEN 'At Risk' ELSE 'Lost' END AS segment_label
        FROM (SELECT *, recency_score + frequency_score + monetary_score AS rfm_total FROM (
        SELECT *, CAST(least(5, floor(percent_rank() OVER (ORDER BY recency_days DESC NULLS LAST) * 5) + 1) AS INTEGER) AS recency_score,
        CASE WHEN total_orders >= 3 THEN 5 WHEN total_orders = 2 THEN 4 ELSE 1 END AS frequency_score,
        CAST(least(5, floor(percent_rank() OVER (ORDER BY total_revenue NULLS FIRST) * 5) + 1) AS INTEGER) AS monetary_score,
        CASE WHEN total_orders >= 2 THEN 1 ELSE 0 END AS repeat_customer_flag FROM profile))""",
    ),
    "bi": (
        "master",
        """SELECT order_year, order_month, order_year_month, customer_state, primary_payment_type, count(order_id) AS total_orders,
        CAST(sum(CAST(order_revenue AS DECIMAL(18, 4))) AS DOUBLE) AS total_revenue,
        CAST(sum(CAST(order_revenue AS DECIMAL(18, 4))) AS DOUBLE) / count(order_revenue) AS avg_order_value,
        avg(is_late) AS late_delivery_rate FROM master GROUP BY 1, 2, 3, 4, 5""",
    ),
    "coverage": (
        "c_orders",
        f"""SELECT *, NOT (is_partial_period OR is_low_volume_period) AS is_comparable_period FROM (
        SELECT *, (order_year_month = min(order_year_month) OVER () AND day(first_purchase) > 1)
            OR (order_year_month = max(order_year_month) OVER () AND day(last_purchase) < day(last_day(last_purchase))) AS is_partial_period,
        order_count < {MIN_ORDERS} AS is_low_volume_period FROM (
        SELECT order_year_month, count(DISTINCT order_id) AS order_count, min(order_purchase_timestamp) AS first_purchase,
        max(order_purchase_timestamp) AS last_purchase FROM c_orders WHERE order_year_month IS NOT NULL GROUP BY 1))""",
    ),
    "monthly": (
        "bi coverage",
        """SELECT b.*, order_value AS item_revenue_ex_freight, order_value / order_count AS avg_item_merchandise_value_per_order,
        order_value / order_count AS avg_item_revenue_per_order, order_value AS item_merchandise_value_ex_freight,
        is_partial_period, is_low_volume_period, is_comparable_period FROM (
        SELECT order_year_month, CAST(sum(total_orders) AS BIGINT) AS order_count,
        CAST(sum(CAST(total_revenue AS DECIMAL(18, 4))) AS DOUBLE) AS order_value FROM bi
        WHERE order_year_month IS NOT NULL GROUP BY 1) b
        LEFT JOIN (SELECT order_year_month, is_partial_period, is_low_volume_period, is_comparable_period FROM coverage) USING (order_year_month)""",
    ),
    "states": (
        "bi",
        """SELECT *, item_merchandise_value_ex_freight AS item_revenue_ex_freight,
        item_merchandise_value_ex_freight / order_count AS avg_item_merchandise_value_per_order,
        item_merchandise_value_ex_freight / order_count AS avg_item_revenue_per_order FROM (
        SELECT customer_state, CAST(sum(total_orders) AS BIGINT) AS order_count,
        CAST(sum(CAST(total_revenue AS DECIMAL(18, 4))) AS DOUBLE) AS item_merchandise_value_ex_freight FROM bi
        WHERE customer_state IS NOT NULL GROUP BY 1)""",
    ),
    "delivery": (
        "c_orders coverage",
        """SELECT *, delivered_order_count < 50 AS is_low_delivered_volume_period,
        CASE WHEN delivered_order_count >= 50 THEN late_delivery_rate END AS late_delivery_rate_display FROM (
        SELECT order_year_month, o.order_count, avg_delivery_days, avg_delivery_delay_days, delivered_order_count, late_delivered_order_count,
        CASE WHEN delivered_order_count > 0 THEN CAST(late_delivered_order_count AS DOUBLE) / delivered_order_count ELSE 0.0 END AS late_delivery_rate,
        is_partial_period, is_low_volume_period, is_comparable_period FROM (
            SELECT order_year_month, count(DISTINCT order_id) AS order_count, avg(delivery_days) AS avg_delivery_days,
            avg(delivery_delay_days) AS avg_delivery_delay_days,
            count(*) FILTER (WHERE order_status = 'delivered' AND is_late IS NOT NULL) AS delivered_order_count,
            count(*) FILTER (WHERE order_status = 'delivered' AND is_late = 1) AS late_delivered_order_count
            FROM c_orders WHERE order_year_month IS NOT NULL GROUP BY 1) o LEFT JOIN coverage USING (order_year_month))""",
    ),
    "numbered": (
        "demand",
        """SELECT category_name_english, order_year_month, monthly_units,
        row_number() OVER (PARTITION BY category_name_english ORDER BY order_year_month) AS place FROM demand""",
    ),
    "bt_input": (
        "features coverage",
        """SELECT f.category_name_english, f.forecast_month, f.feature_cutoff_month, CAST(target_units AS DOUBLE) AS target_units,
        CAST(lag_1 AS DOUBLE) AS lag_1, CAST(lag_2 AS DOUBLE) AS lag_2, CAST(lag_4 AS DOUBLE) AS lag_4, rolling_mean_3,
        CAST(month_num AS DOUBLE) AS month_num, CAST(is_q4 AS DOUBLE) AS is_q4,
        coalesce(order_count, 0) AS target_period_order_count,
        coalesce(is_partial_period, false) AS is_partial_period, coalesce(is_low_volume_period, false) AS is_low_volume_period,
        coalesce(is_comparable_period, false) AS is_comparable_period
        FROM features f LEFT JOIN coverage c ON f.forecast_month = c.order_year_month""",
    ),
    "bt_folds": (
        "bt_input",
        """SELECT row_number() OVER (ORDER BY forecast_month) AS fold, forecast_month, train_rows, max_train_forecast_month FROM (
        SELECT m.forecast_month, (SELECT count(*) FROM bt_input t WHERE t.is_comparable_period AND t.forecast_month < m.forecast_month) AS train_rows,
        (SELECT max(forecast_month) FROM bt_input t WHERE t.is_comparable_period AND t.forecast_month < m.forecast_month) AS max_train_forecast_month
        FROM (SELECT DISTINCT forecast_month FROM bt_input WHERE is_comparable_period ORDER BY forecast_month DESC LIMIT 6) m)""",
    ),
    "bt_naive": (
        "bt_input bt_folds",
        """SELECT i.*, CAST(fold AS INTEGER) AS fold, train_rows, max_train_forecast_month, greatest(lag_1, 0.0) AS naive_prediction
        FROM bt_input i JOIN bt_folds USING (forecast_month) WHERE is_comparable_period""",
    ),
    "bt_models": (
        "bt_naive",
        """SELECT *, 'naive_lag_1' AS model, naive_prediction AS prediction FROM bt_naive
        UNION ALL SELECT *, 'moving_average', rolling_mean_3 FROM bt_naive""",
    ),
    "bt_champion": (
        "bt_models",
        """SELECT CASE WHEN c.mae < n.mae AND (c.wape, c.mae, c.rmse) < (n.wape, n.mae, n.rmse)
        THEN 'moving_average' ELSE 'naive_lag_1' END AS model
        FROM (SELECT avg(abs(target_units - prediction)) AS mae, sqrt(avg(pow(target_units - prediction, 2))) AS rmse,
            sum(abs(target_units - prediction)) / greatest(sum(abs(target_units)), 1.0) AS wape FROM bt_models WHERE model = 'naive_lag_1') n,
        (SELECT avg(abs(target_units - prediction)) AS mae, sqrt(avg(pow(target_units - prediction, 2))) AS rmse,
            sum(abs(target_units - prediction)) / greatest(sum(abs(target_units)), 1.0) AS wape FROM bt_models WHERE model = 'moving_average') c""",
    ),
    "bt_pred": (
        "bt_naive bt_champion",
        """SELECT *, rolling_mean_3 AS moving_average_prediction,
        CASE WHEN (SELECT model FROM bt_champion) = 'moving_average' THEN rolling_mean_3 ELSE naive_prediction END AS champion_prediction
        FROM bt_naive""",
    ),
}


def sql(select: str, *names: str, instead: dict[str, tuple[str, str]] | None = None) -> str:
    """``select`` with the definitions it needs, each after those it uses itself.

    ``instead``: definitions that are added or take the place of known ones.
    """
    ordered: list[str] = []
    known = CTES | (instead or {})

    def need(name: str) -> None:
        if name not in ordered:
            for used in known[name][0].split():
                need(used)
            ordered.append(name)

    for name in names:
        need(name)
    definitions = ",\n".join(f"{name} AS MATERIALIZED ({known[name][1]})" for name in ordered)
    return f"WITH {definitions}\n{select}" if ordered else select

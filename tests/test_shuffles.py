"""What queries move: each detail table is shuffled once, and only in the columns in use."""

from __future__ import annotations

import re
import time
from contextlib import contextmanager

from ordermill.operators import audit, churn, demand, orders, sellers
from ordermill.plans import runner, storage_queries
from ordermill.plans.distinct_queries import with_repeats
from ordermill.plans.graph import Step, run_graph
from ordermill.plans.shop import Shop
from ordermill.sources import ingest, writers

SMALL = "/root/testdata/sf0.001"
PAYMENTS = "order_id bigint, payment_sequential int, payment_type string, payment_value double"


@contextmanager
def shuffle_partitions(spark, number):
    """Enough partitions that a key can be a hot one."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, number)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_payments_are_left_out_where_nothing_needs_them(spark):
    shop = Shop(spark, SMALL)
    paid = orders.with_payments(shop.clean_orders, orders.payments_by_type(shop.payments))
    assert "Join" not in plan(paid.select("order_id", "is_late"))
    assert "Join" in plan(paid.select("order_id", "primary_payment_type"))


def test_orders_with_very_many_payments_keep_their_totals(spark):
    many = [(1, n, "card" if n % 3 else "voucher", 0.25) for n in range(3000)]
    rows = [*many, (None, 1, "card", 2.0), (2, 2, "b", 5.0), (2, 1, "c", 5.0), (3, 1, "x", None), (4, 1, "n", float("nan")), (4, 2, "y", 9.0)]
    found = {r[0]: tuple(r)[1:] for r in orders.payments_by_type(spark.createDataFrame(rows, PAYMENTS)).collect()}
    assert found[1] == (750.0, "card") and found[None] == (2.0, "card")
    assert found[2] == (10.0, "c") and found[3] == (None, "x")
    assert found[4][1] == "n"  # not a number sorts above all amounts


def test_repeated_orders_are_computed_once(spark):
    shop = Shop(spark, SMALL)
    rows = with_repeats(shop.orders.selectExpr("*", "'card' AS primary_payment_type"))
    assert plan(rows).count("Relation ") == 1
    once = shop.orders.selectExpr("sum(1 + int(order_id % 10 = 0) + int(order_id % 20 = 0))").first()[0]
    assert rows.count() == once


def test_repeats_need_no_stored_facts(spark):
    shop = Shop(spark, SMALL)
    joins = plan(with_repeats(shop.facts).select("order_id", "order_revenue")).count("Join")
    assert joins == 3 and "stored_master" not in shop.__dict__  # customers, their nations, items


def test_money_of_sellers_is_not_shuffled_by_order(spark):
    shop = Shop(spark, SMALL)
    grouped = re.findall(r"Aggregate \[seller_id#\d+, order_id#\d+L?\], \[(.*)\]", plan(shop.seller_performance))
    assert grouped and not any("sum(" in columns for columns in grouped)


def test_sellers_and_orders_may_be_unknown(spark):
    items = spark.createDataFrame(
        [("o1", "s1", 10.0, 1.0), ("o1", "s1", 5.0, 0.5), (None, "s1", 2.0, 0.0), ("o1", None, 7.0, 0.0)],
        "order_id string, seller_id string, price double, freight_value double",
    )
    facts = spark.createDataFrame([("o1", 4.0, 1)], "order_id string, avg_review_score double, is_late int")
    people = spark.createDataFrame([("s1", "SP")], "seller_id string, seller_state string")
    found = {r["seller_id"]: r for r in sellers.seller_performance(items, facts, people).collect()}
    assert (found["s1"]["total_orders"], found["s1"]["total_revenue"], found["s1"]["avg_review"]) == (1, 18.5, 4.0)
    assert (found[None]["total_orders"], found[None]["total_revenue"]) == (1, 7.0)


def test_profile_reads_the_stored_facts(spark):
    shop = Shop(spark, SMALL)
    stored = set(shop.stored_master.inputFiles())
    assert set(shop.profile.inputFiles()) == stored


def test_duplicates_are_looked_for_by_one_hash(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (2, "")], "a int, b string")
    assert plan(audit.exact_duplicates(rows)).count("xxhash64(") == 2  # counted, then looked up
    assert audit.exact_duplicates(rows).first()[0] == 2


def test_cells_are_parsed_once(spark):
    raw = spark.createDataFrame([("o1", "2018-13-45 00:00:00"), ("o2", "2018-01-02 03:04:05")], "order_id string, order_purchase_timestamp string")
    typed = ingest.with_rejections(raw, "orders")
    assert plan(typed).count("yyyy-MM-dd HH:mm:ss") == 1
    assert [(r[1] is None, len(r["_rejected"])) for r in typed.orderBy("order_id").collect()] == [(True, 1), (False, 0)]


def test_raw_tables_are_stored_at_the_same_time(spark, monkeypatch):
    import threading

    inside, most, lock = [], [], threading.Lock()
    write, meet = storage_queries.writers.write_table, threading.Event()

    def watched(*arguments):
        with lock:
            inside.append(1)
            most.append(len(inside))
            if len(inside) > 1:
                meet.set()
        meet.wait(20)  # until a second table is written
        try:
            return write(*arguments)
        finally:
            inside.pop()

    monkeypatch.setattr(storage_queries.writers, "write_table", watched)
    assert len(storage_queries._stored_with_ledger(Shop(spark, SMALL))) == 9
    assert max(most) > 1


def test_stored_tables_and_raw_files_are_compressed(spark, folder):
    stored = writers.write_table(spark.range(5), f"{folder}/table")
    assert all("zstd" in name for name in stored.inputFiles()) and stored.count() == 5
    writers.write_csv(spark.range(5), f"{folder}/csv", "gzip")
    back = spark.read.option("header", True).csv(f"{folder}/csv")
    assert all(name.endswith(".csv.gz") for name in back.inputFiles()) and back.count() == 5


def test_row_hashes_are_added_behind_the_shuffle(spark, folder):
    with open(f"{folder}/payments.csv", "w") as file:
        file.write("order_id,payment_sequential,payment_type,payment_installments,payment_value\no1,1,card,2,9.5\n")
    read = plan(ingest.ingest_source(spark, {"payments": f"{folder}/payments.csv"}, "payments"))
    assert "md5" in read.split("RebalancePartitions")[0] and "md5" not in read.split("RebalancePartitions")[1]


def test_raw_tables_are_stored_without_a_shuffle(spark, folder):
    with open(f"{folder}/payments.csv", "w") as file:
        file.write("order_id,payment_sequential,payment_type,payment_installments,payment_value\no1,1,card,2,9.5\no2,1,,x,1\n")
    store = runner.Store(spark, f"{folder}/store")
    rows = runner.bronze_steps(store, {"payments": f"{folder}/payments.csv"})["payments"]()
    assert "md5" in plan(rows) and "RebalancePartitions" not in plan(rows)
    assert store.write("bronze/payments", rows) == 2
    back = store.read("bronze/payments").select("order_id", "payment_type", "payment_installments")
    assert {tuple(r) for r in back.collect()} == {("o1", "card", 2), ("o2", None, None)}
    assert back.where("payment_type = 'card'").inputFiles() and "payment_type=card" in " ".join(back.inputFiles())


def test_shuffle_files_go_when_a_step_has_ended(spark, folder):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles() -> set[str]:
        return set(re.findall(r"shuffle_\d+", disk.getAllFiles().mkString(" ")))

    before, made = shuffles(), set()

    def shuffled() -> int:
        spark.range(1000).repartition(4, "id").write.parquet(f"{folder}/table")
        made.update(shuffles() - before)
        return 1000

    def later() -> int:
        until = time.monotonic() + 20  # they are deleted in the background
        while made & shuffles() and time.monotonic() < until:
            time.sleep(0.1)
        return len(made & shuffles())

    first, second = run_graph(spark, [Step("some", "table", shuffled), Step("some", "later", later, ("some/table",))])
    assert first.rows == 1000 and made and second.rows == 0


ITEMS = "order_id bigint, order_item_id int, price double, freight_value double"


def test_items_are_dealt_before_they_are_summed(spark):
    tree = plan(orders.item_totals(Shop(spark, SMALL).clean_items).select("order_id", "order_revenue"))
    above, below = tree.split("RepartitionByExpression")
    assert above.count("Aggregate [order_id") == 1 and below.count("Aggregate [order_id") == 1  # hot orders only
    assert "l_tax" not in below.split("Relation ")[0]  # no freight where nothing needs it


def test_orders_with_very_many_items_keep_their_totals(spark):
    many = [(1, n if n % 2 else None, 0.25 if n % 3 else None, 1e-7 if n == 5 else 0.5) for n in range(3000)]
    rest = [(None, 1, 2.0, 1.0), (None, 2, 3.0, None), (2, 1, float("inf"), 0.1), (2, 2, 1.0, 0.2), (3, 1, None, None)]
    with shuffle_partitions(spark, 64):
        items = spark.createDataFrame(many + rest, ITEMS)
        totals = orders.item_totals(items, count_lines=True)
        assert totals.dtypes == [("order_id", "bigint"), ("order_revenue", "double"), ("freight_total", "double"), ("item_count", "bigint")]
        found = {r[0]: tuple(r)[1:] for r in totals.collect()}
    assert found[1] == (500.0, 1499.5 + 1e-7, 1500)
    assert found[None] == (5.0, 1.0, 2) and found[3] == (None, None, 1)
    assert found[2][0] == float("inf") and found[2][1] == 0.3


def test_churn_stores_only_the_orders_and_columns_it_reads(spark):
    shop = Shop(spark, SMALL)
    stored = shop.stored_eligible_orders
    assert stored.columns == churn.ORDER_COLUMNS
    assert stored.count() == churn.eligible_orders(shop.valued_orders).count() < shop.orders.count()


def test_sold_items_are_neither_sorted_nor_summed_by_product(spark):
    shop = Shop(spark, SMALL)
    sales = demand.category_sales(shop.clean_items, shop.clean_orders, shop.products, shop.translation)
    assert "Aggregate [product_id" not in plan(sales)
    joins = sales._jdf.queryExecution().executedPlan().toString()
    assert joins.count("ShuffledHashJoin") == 2 and "SortMergeJoin [order_id" not in joins


def test_a_best_selling_product_keeps_its_sales(spark):
    with shuffle_partitions(spark, 64):
        items = spark.range(3000).selectExpr(
            "id % 50 AS order_id", "int(id) AS order_item_id", "IF(id % 10 = 0, id, IF(id % 7 = 0, NULL, 1)) AS product_id", "0.25D AS price"
        )
        facts = spark.range(40).selectExpr("id AS order_id", "'delivered' AS order_status", "current_timestamp() AS order_purchase_timestamp", "'2018-01' AS order_year_month")
        products = spark.range(3000).selectExpr("id AS product_id", "IF(id = 1, 'best', 'other') AS product_category_name")
        words = spark.createDataFrame([("best", "best"), ("other", "other")], "product_category_name string, product_category_name_english string")
        found = {r[0]: tuple(r)[1:] for r in demand.category_sales(items, facts, products, words).collect()}
    kinds = ["other" if n % 10 == 0 else "unknown" if n % 7 == 0 else "best" for n in range(3000) if n % 50 < 40]
    assert found == {kind: ("2018-01", kinds.count(kind), kinds.count(kind) / 4, 0.25) for kind in set(kinds)}

from __future__ import annotations

import hashlib
from datetime import datetime as dt
from pathlib import Path

import pytest

from ordermill.operators import audit, orders
from ordermill.plans import graph, runner
from ordermill.sources import publish, ingest, readers, scratch, writers
from ordermill.sources.contract import RAW_TABLES


def write(folder, name, text):
    Path(folder, name).write_text(text)
    return f"{folder}/{name}"


REVIEW_HEADER = ",".join(RAW_TABLES["reviews"].columns) + "\n"
REVIEW = 'r1,o1,5,title,"first line\nsecond ""line""",2018-01-02 00:00:00,2018-01-03 10:11:12\n'


def test_quoted_line_break_stays_in_its_row(spark, folder):
    path = write(folder, "reviews.csv", REVIEW_HEADER + REVIEW)
    table = ingest.ingest_source(spark, {"reviews": path}, "reviews", batch_id="b1")
    row = table.first()
    assert table.count() == 1
    assert row["review_comment_message"] == 'first line\nsecond "line"'
    assert row["review_answer_timestamp"] == dt(2018, 1, 3, 10, 11, 12) and row["review_score"] == 5
    assert (row["_source"], row["_batch_id"]) == ("reviews", "b1")
    assert readers.without_metadata(table).columns == list(RAW_TABLES["reviews"].columns)


def test_reconciliation_blames_the_linewise_reader(spark, folder):
    path = write(folder, "reviews.csv", REVIEW_HEADER + REVIEW)
    row = readers.reader_reconciliation(spark, path, 1).first()
    assert tuple(row) == (1, 2, 1, True)
    plain = write(folder, "plain.csv", "a,b\n1,2\n")
    assert not readers.reader_reconciliation(spark, plain, 1).first()[3]


def test_missing_sources_are_refused(spark, folder):
    with pytest.raises(KeyError):
        readers.source_path(spark, {}, "orders")
    with pytest.raises(FileNotFoundError):
        readers.source_path(spark, {"orders": f"{folder}/none.csv"}, "orders")
    with pytest.raises(FileNotFoundError):
        readers.read_report(spark, f"{folder}/none.csv", "a string")
    with pytest.raises(FileNotFoundError):
        readers.read_report(spark, write(folder, "empty.csv", "a\n"), "a string")
    assert readers.read_json(spark, f"{folder}/none.json").isEmpty()


def test_bad_values_become_null(spark):
    raw = spark.createDataFrame(
        [("o1", "x", "p", "s", "2018-13-45 00:00:00", "12,5", "1.5"), ("o1", "2", "p", "s", "2018-02-03 04:05:06", "7", None)],
        ",".join(f"{c} string" for c in RAW_TABLES["order_items"].columns),
    )
    bad, good = ingest.ingest(raw, "order_items").collect()
    assert (bad["order_item_id"], bad["shipping_limit_date"], bad["price"], bad["shipping_year"]) == (None,) * 4
    assert (good["order_item_id"], good["price"], good["shipping_year"]) == (2, 7.0, 2018)


def test_geolocation_and_absent_columns(spark):
    raw = spark.createDataFrame(
        [("01037", "-23.5", "x")],
        "geolocation_zip_code_prefix string, geolocation_lat string, geolocation_lng string",
    )
    assert tuple(ingest.ingest(raw, "geolocation").first()) == (1037, -23.5, None)
    products = spark.createDataFrame([("p", "3")], "product_id string, product_photos_qty string")
    assert tuple(ingest.ingest(products, "products").first()) == ("p", 3.0)


def test_row_hash_tells_missing_values_apart(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a", None, "b")], "x string, y string, z string")
    first, second, third = [r["_row_hash"] for r in ingest.with_metadata(df, "t").collect()]
    assert first == third != second
    assert first == hashlib.md5(b"a||<NULL>||b").hexdigest()
    assert ingest.with_metadata(df, "t").select("_batch_id").distinct().count() == 1


def test_overwrite_replaces_rows_and_schema(spark, folder):
    path = f"{folder}/t"
    writers.write_table(spark.range(5), path)
    again = writers.write_table(spark.range(2).selectExpr("id", "id % 2 AS part"), path, ["part"])
    assert again.count() == 2 and sorted(again.columns) == ["id", "part"]
    assert sorted(p.name for p in Path(path).iterdir() if p.is_dir()) == ["part=0", "part=1"]
    assert readers.read_table(spark, path, ["id"]).columns == ["id"]


def test_catalog_tables(spark, folder):
    writers.ensure_schema(spark, "shop_test", "for a test", f"{folder}/schema")
    table = writers.write_catalog_table(spark.range(3), "shop_test.numbers")
    assert table.count() == readers.read_catalog_table(spark, "shop_test.numbers").count() == 3
    assert [r["tableName"] for r in writers.list_tables(spark, "shop_test").collect()] == ["numbers"]
    spark.sql("DROP SCHEMA shop_test CASCADE")


def test_report_files(spark, folder):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    writers.write_csv_report(df, f"{folder}/r")
    assert tuple(readers.read_report(spark, f"{folder}/r", "k string, v int").first()) == ("a", 1)
    writers.write_json_report(df, f"{folder}/j")
    assert readers.read_json(spark, f"{folder}/j").first()["v"] == 1


def test_reports_are_read_without_trust(spark, folder):
    path = write(folder, "r.csv", "k,v,extra\na,1,x\nb,two,y\nc,3,z\n")
    found = readers.scan_report(spark, path, "k string, v int, gone double")
    assert found.columns == ["k", "v", "gone", readers.CORRUPT] and readers.report_columns(spark, path) == ["k", "v", "extra"]
    rows = {r["k"]: (r["v"], r[readers.CORRUPT]) for r in found.collect()}
    assert rows["a"] == (1, None) and rows["b"] == (None, "b,two,y")
    assert readers.corrupt_rows(found).first()[0] == 1
    path = write(folder, "r.json", '{"k": "a", "v": 1}\n{"k": "b", "v": \n')
    found = readers.scan_report(spark, path, "k string, v int")
    assert readers.corrupt_rows(found).first()[0] == 1 and found.where("k = 'a'").first()["v"] == 1
    with pytest.raises(FileNotFoundError):
        readers.scan_report(spark, f"{folder}/none.csv", "k string")


def test_manifest(spark, folder):
    write(folder, "a.csv", "x\n1\n")
    write(folder, "b.txt", "ignored")
    row = readers.source_manifest(spark, folder).collect()
    assert [tuple(r) for r in row] == [("a.csv", 4, hashlib.sha256(b"x\n1\n").hexdigest())]


def test_manifest_of_streamed_files(spark, folder):
    data = bytes(range(256)) * 100_000  # several blocks
    Path(folder, "big.csv").write_bytes(data)
    write(folder, "a.csv", "x\n1\n")
    found = {r["filename"]: (r["bytes"], r["sha256"]) for r in readers.source_manifest(spark, folder, whole_bytes=10).collect()}
    assert found == {
        "big.csv": (len(data), hashlib.sha256(data).hexdigest()), "a.csv": (4, hashlib.sha256(b"x\n1\n").hexdigest())
    }


def test_manifest_of_a_file_beyond_two_gigabytes(spark, folder):
    size = (2 << 30) + 5
    with open(f"{folder}/huge.csv", "wb") as file:
        file.truncate(size)  # takes no room on the disk
    digest, block = hashlib.sha256(), bytes(1 << 20)
    for _ in range(2 << 10):
        digest.update(block)
    digest.update(bytes(5))
    assert [tuple(r) for r in readers.source_manifest(spark, folder).collect()] == [("huge.csv", size, digest.hexdigest())]


def test_manifest_without_hash(spark, folder):
    write(folder, "a.csv", "x\n1\n")
    listed = readers.source_manifest(spark, folder, with_hash=False)
    assert [tuple(r) for r in listed.collect()] == [("a.csv", 4)]
    assert "content" not in listed.columns and len(listed.columns) == 2


def test_row_count_report(spark):
    tables = {"a": spark.range(3), "b": spark.range(1)}
    report = audit.source_row_counts(tables, {"a": 3, "b": 2, "c": 1})
    assert {r["table_name"]: r["status"] for r in report.collect()} == {"a": "PASS", "b": "FAIL", "c": "FAIL"}
    with pytest.raises(ValueError):
        audit.require_all_pass(report)
    assert audit.require_all_pass(report.where("table_name = 'a'")).count() == 1


def test_scratch_lies_below_the_checkpoint_folder(spark):
    kept = scratch.materialize(spark.range(4), "numbers")
    root = scratch.scratch_root(spark)
    assert kept.count() == 4 and all(root.removeprefix("file:") in f for f in kept.inputFiles())
    assert spark.conf.get("spark.checkpoint.dir", root) == root
    with scratch.scratch_run(spark):
        own = scratch.materialize(spark.range(2), "numbers")
        files = own.inputFiles()
        assert own.count() == 2
    assert not any(readers.path_exists(spark, f) for f in files)
    assert kept.count() == 4  # a run deletes what it wrote, not what another caller still reads


RAW = {
    "orders": [
        "o1,c1,delivered,2018-01-05 10:00:00,,2018-01-06 00:00:00,2018-01-08 00:00:00,2018-01-09 00:00:00",
        "o2,c2,delivered,2018-12-20 10:00:00,2018-12-20 11:00:00,,2019-01-20 00:00:00,2019-01-09 00:00:00",
        "o3,c2,canceled,,,,,",
    ],
    "customers": ["c1,u1,01000,a,SP", "c2,u2,02000,b,RJ"],
    "order_items": ["o1,1,p1,s1,2018-01-07 00:00:00,10.0,1.0", "o2,1,p2,s1,2018-06-22 00:00:00,20.0,2.0"],
    "payments": ["o1,1,card,1,11.0", "o2,1,boleto,1,22.0"],
    "reviews": ["r1,o1,4,,,2018-01-10 00:00:00,2018-01-11 00:00:00"],
    "products": ["p1,beleza,1,1,1,1,1,1,1", "p2,,1,1,1,1,1,1,1"],
    "sellers": ["s1,01000,a,SP"],
    "geolocation": ["01000,1.0,2.0,a,SP"],
    "category_translation": ["beleza,beauty"],
}


def test_all_layers_from_csv(spark, folder):
    sources = {
        name: write(folder, f"{name}.csv", "\n".join([",".join(RAW_TABLES[name].columns), *rows]) + "\n")
        for name, rows in RAW.items()
    }
    status = runner.run_layers(spark, f"{folder}/store", sources)
    rows = {f"{r['layer']}/{r['table_name']}": r for r in status.collect()}
    failed = {name: r["error"] for name, r in rows.items() if r["status"] != "SUCCESS"}
    assert not failed and len(rows) == 9 + 6 + 4 + 2 + 20
    assert runner.exit_code(status) == 0
    assert rows["silver/master_orders"]["row_count"] == 3
    assert rows["gold/rfm_segments"]["row_count"] == 2
    store = runner.Store(spark, f"{folder}/store")
    master = {r["order_id"]: r for r in store.read("silver/master_orders").collect()}
    assert master["o1"]["order_year_month"] == "2018-01" and master["o3"]["order_year_month"] is None
    assert master["o2"]["is_late"] == 1 and master["o1"]["avg_review_score"] == 4.0
    panel = store.read("gold/churn_features").collect()
    assert sorted(str(r["snapshot_date"]) for r in panel) == [f"2018-0{m}-01" for m in range(5, 10)]
    assert {(r["customer_unique_id"], r["is_churned"], r["avg_review_score"]) for r in panel} == {("u1", 1, 4.0)}
    for key, row in rows.items():
        if not key.startswith("export/"):
            assert store.read(key).count() == row["row_count"], key

    export = f"{folder}/store/export"
    listed = {r["filename"]: r["row_count"] for r in publish.read_manifest(spark, export).collect()}
    assert listed == {n: rows[f"export/{n}"]["row_count"] for n in runner.export_reports(store)}
    on_disk = {name: publish.read_published(spark, export, name).count() for name in listed}
    assert on_disk == listed
    assert listed["demand_backtest_predictions.csv"] == 0  # two orders cannot be tested
    assert "boosted_prediction" in publish.read_published(spark, export, "demand_backtest_predictions.csv").columns
    assert publish.read_published(spark, export, "overview_kpis.json").first()["total_orders"] == 3

    # A later run that fails leaves the published set whole and says what hung on the failure.
    again = runner.run_layers(spark, f"{folder}/store", sources, ("silver", "gold", "export"), gates={"silver/seller_performance": "seller_state", "silver/customer_profile": "customer_unique_id", "silver/orders": "order_status"})
    seen = {f"{r['layer']}/{r['table_name']}": r for r in again.collect()}
    assert seen["silver/orders"]["status"] == "FAILED" and "one row per order_status" in seen["silver/orders"]["error"]
    assert (seen["gold/churn_features"]["status"], seen["gold/churn_features"]["error"]) == ("SKIPPED", "below silver/orders")
    assert seen["silver/order_items"]["status"] == "SUCCESS"
    assert seen[f"export/{publish.MANIFEST}"]["status"] == "SKIPPED" and runner.exit_code(again) == 1
    assert {r["filename"]: r["row_count"] for r in publish.read_manifest(spark, export).collect()} == listed
    assert {name: publish.read_published(spark, export, name).count() for name in listed} == listed
    study = runner.run_layers(spark, f"{folder}/study", sources, ("bronze", "silver", "gold"), variant="study")
    built = {r["table_name"]: r for r in study.where("layer = 'gold'").collect()}
    assert {r["status"] for r in study.collect()} == {"SUCCESS"}, [r["error"] for r in study.collect()]
    assert set(built) == {"demand_history", "demand_features", "churn_features", "rfm_segments", "bi_revenue"}


def test_rejected_cells_are_kept_and_reconciled(spark, folder):
    text = "order_id,payment_sequential,payment_type,payment_installments,payment_value\no1,1,card,two,9.5\no2,x,card,,1e2\no3,2,boleto,3,\no3,2,boleto,3,12.5.1\n"
    sources = {"payments": write(folder, "payments.csv", text)}
    stored = writers.write_table(ingest.ingest_source(spark, sources, "payments"), f"{folder}/payments")
    found = ingest.ledger(stored, "payments")
    cells = {(r["column_name"], r["text"], r["reason"]): r["row_hash"] for r in found.collect()}
    assert set(cells) == {("payment_installments", "two", "no int"), ("payment_sequential", "x", "no int"), ("payment_value", "12.5.1", "no double")}
    hashes = {r["_row_hash"]: r["order_id"] for r in stored.collect()}
    assert hashes[cells["payment_installments", "two", "no int"]] == "o1"
    raw = spark.read.option("header", True).csv(f"{folder}/payments.csv")
    rows = {r["column_name"]: tuple(r)[2:] for r in ingest.value_reconciliation(raw, stored, found, "payments").collect()}
    assert rows == {"payment_sequential": (4, 3, 1, "PASS"), "payment_installments": (3, 2, 1, "PASS"), "payment_value": (3, 2, 1, "PASS")}
    lost = ingest.value_reconciliation(raw, stored.where("order_id <> 'o2'"), found, "payments").collect()
    assert {r["column_name"]: r["status"] for r in lost}["payment_value"] == "FAIL"
    assert readers.without_metadata(stored).columns == list(RAW_TABLES["payments"].columns)


def test_steps_wait_for_what_they_need(spark):
    import threading
    import time

    ended, together = [], []

    def work(name: str, seconds: float = 0.0):
        def run() -> int:
            together.append(threading.active_count())
            time.sleep(seconds)
            ended.append(name)
            return len(ended)

        return run

    def broken() -> int:
        raise ValueError("no such column")

    steps = [
        graph.Step("b", "last", work("last"), ("a/slow", "a/fast")),
        graph.Step("b", "never", work("never"), ("a/broken",)),
        graph.Step("c", "never either", work("never either"), ("b/never", "b/last")),
        graph.Step("a", "slow", work("slow", 0.5)),
        graph.Step("a", "fast", work("fast", 0.1)),
        graph.Step("a", "broken", broken, ("stored/elsewhere",)),
    ]
    found = {o.step.key: o for o in graph.run_graph(spark, steps)}
    assert ended == ["fast", "slow", "last"]
    assert found["a/broken"].status == "FAILED" and found["a/broken"].error == "no such column"
    assert (found["b/never"].status, found["b/never"].error) == ("SKIPPED", "below a/broken")
    assert (found["c/never either"].status, found["c/never either"].error) == ("SKIPPED", "below a/broken")
    assert found["b/last"].rows == 3
    with pytest.raises(ValueError, match="each other"):
        graph.ordered([graph.Step("x", "a", broken, ("x/b",)), graph.Step("x", "b", broken, ("x/a",))])
    with pytest.raises(ValueError, match="two steps"):
        graph.ordered([graph.Step("x", "a", broken), graph.Step("x", "a", broken)])


def test_publishing_replaces_the_set_and_refuses_absent_files(spark, folder):
    def entry(run: str, name: str, rows: int):
        writers.write_csv_report(spark.range(rows), f"{folder}/{run}/{name}")
        return publish.Entry(name, f"{run}/{name}", rows)

    first, second = publish.new_folder(), publish.new_folder()
    assert publish.read_manifest(spark, folder).count() == 0
    publish.publish(spark, folder, [entry(first, "a.csv", 2), entry(first, "b.csv", 1)])
    with pytest.raises(FileNotFoundError):
        publish.publish(spark, folder, [entry(second, "a.csv", 3), publish.Entry("b.csv", f"{second}/b.csv", 1)])
    assert publish.read_published(spark, folder, "a.csv").count() == 2
    publish.publish(spark, folder, [entry(second, "a.csv", 3)])
    assert publish.read_published(spark, folder, "a.csv").count() == 3
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, folder, "b.csv")
    assert publish.drop_unpublished(spark, folder) == [first.split("/")[1]]
    assert publish.drop_unpublished(spark, folder) == []
    with pytest.raises(ValueError):
        publish.publish(spark, folder, [entry(second, "a.csv", 3)] * 2)


def test_a_failing_step_does_not_stop_the_others(spark, folder):
    store = runner.Store(spark, folder)
    twice = spark.createDataFrame([("a",), ("a",)], "order_id string")
    results = runner.run_steps(
        store,
        "silver",
        {
            "broken": lambda: orders.require_unique(twice, "order_id", "broken"),
            "fine": lambda: spark.range(2),
        },
    )
    status = spark.createDataFrame(results, runner.STATUS)
    seen = {r["table_name"]: r for r in status.collect()}
    assert seen["broken"]["status"] == "FAILED" and "one row per order_id" in seen["broken"]["error"]
    assert seen["fine"]["status"] == "SUCCESS" and seen["fine"]["row_count"] == 2
    assert runner.exit_code(status) == 1


def test_command_line_offers_the_layers():
    with pytest.raises(SystemExit):
        runner.main(["--layer", "platinum", "--root", "x"])

from __future__ import annotations

import random

import pytest

from ordermill.operators import distinct


@pytest.fixture(scope="module")
def facts(spark):
    chooser = random.Random(3)
    rows = [(f"o{chooser.randint(0, 300)}", chooser.choice("abc"), chooser.choice(["x", "y", None])) for _ in range(900)]
    rows += [(None, "a", "x")] * 3 + [("o1", "a", "x")] * 50
    return rows, spark.createDataFrame(rows, "order_id string, month string, state string").repartition(5)


@pytest.mark.parametrize("keys", [[], ["month"], ["state"], ["month", "state"]])
def test_counts_of_every_grouping_come_from_the_stored_sets(facts, keys):
    rows, df = facts
    sets = distinct.order_sets(df, ["month", "state"]).persist()
    found = {tuple(r)[:-1]: r["order_count"] for r in distinct.order_counts(sets, keys).collect()}
    wanted: dict = {}
    for order, month, state in rows:
        if order is not None:
            wanted.setdefault(tuple({"month": month, "state": state}[k] for k in keys), set()).add(order)
    assert found == {key: len(orders) for key, orders in wanted.items()}


def test_numbers_are_distinct_and_side_by_side(facts):
    rows, df = facts
    numbers = [r["number"] for r in distinct.numbered_orders(df, ["month"]).collect()]
    assert len(set(numbers)) == len(numbers) == len({r[0] for r in rows} - {None}) and min(numbers) >= 1
    buckets = {(n - 1) // distinct.BUCKET_BITS for n in numbers}
    assert len(buckets) <= 8


def test_no_orders(spark):
    none = spark.createDataFrame([], "order_id string, month string")
    assert distinct.order_counts(distinct.order_sets(none, ["month"]), ["month"]).collect() == []

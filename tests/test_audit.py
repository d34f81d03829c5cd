from __future__ import annotations

import pytest

from ordermill.operators import audit
from ordermill.sources.contract import RAW_TABLES

CLEAN = {
    "orders": [("o1", "c1", "delivered", "2018-01-05 10:00:00", None, None, "2018-01-08 00:00:00", "2018-01-09 00:00:00")],
    "customers": [("c1", "u1", "01000", "a", "SP")],
    "order_items": [("o1", "1", "p1", "s1", "2018-01-07 00:00:00", "10.0", "1.0")],
    "payments": [("o1", "1", "card", "1", "11.0")],
    "reviews": [("r1", "o1", "4", None, None, "2018-01-10 00:00:00", "2018-01-11 00:00:00")],
    "products": [("p1", "beleza", "1", "1", "1", "1", "1", "1", "1")],
    "sellers": [("s1", "01000", "a", "SP")],
    "geolocation": [("01000", "1.0", "2.0", "a", "SP")],
    "category_translation": [("beleza", "beauty")],
}


def tables(spark, **changes):
    rows = {**CLEAN, **changes}
    return {
        name: spark.createDataFrame(rows[name], RAW_TABLES[name].text_schema)
        for name in RAW_TABLES
        if rows[name] is not None
    }


def findings_of(tables, **options):
    """The findings as stored rows: the tests look at them more than once."""
    findings = audit.audit_findings(tables, **options)
    return findings.sparkSession.createDataFrame(findings.collect(), findings.schema).coalesce(1)


def verdict(findings):
    return audit.audit_verdict(findings).first()


def found(findings):
    return {r["category"] for r in findings.where("finding_count <> 0").collect()}


def order(**values):
    names = list(RAW_TABLES["orders"].columns)
    row = dict(zip(names, CLEAN["orders"][0]))
    row.update(values)
    return tuple(row[n] for n in names)


def test_clean_tables_are_ready(spark):
    result = verdict(findings_of(tables(spark)))
    assert (result["executive_verdict"], result["safe_to_run"]) == ("READY", "YES")


def test_warnings_only(spark):
    doubled = tables(spark, payments=CLEAN["payments"] * 2)
    findings = findings_of(doubled, unexpected_files=["more.csv"])
    assert verdict(findings)["executive_verdict"] == "READY WITH WARNINGS"
    assert found(findings) == {"exact duplicate rows", "unexpected files"}
    gap = findings_of(tables(spark, category_translation=[("x", "y")]))
    assert found(gap) == {"untranslated categories"}
    zips = findings_of(tables(spark, geolocation=CLEAN["geolocation"] + [("01000", "3", "4", "b", "SP")]))
    assert found(zips) == {"repeated zip codes"} and verdict(zips)["safe_to_run"] == "YES"


DEFECTS = [
    (dict(order_items=CLEAN["order_items"] + [("o9", "1", "p1", "s1", None, "1", "1")]), "relationship mismatch"),
    (dict(orders=CLEAN["orders"] + [order(order_status="x")]), "duplicate primary IDs"),
    (dict(payments=[("o1", "1", "card", "1", "-0.5")]), "negative monetary values"),
    (dict(reviews=[("r1", "o1", "6", None, None, None, None)]), "review scores outside 1-5"),
    (dict(reviews=[("r1", "o1", "bad", None, None, None, None)]), "review scores outside 1-5"),
    (dict(orders=[order(order_approved_at="yesterday")]), "invalid order timestamps"),
    (dict(orders=[order(order_delivered_customer_date="2018-01-05 09:00:00")]), "delivered date before purchase date"),
]


@pytest.mark.parametrize("changes, category", DEFECTS)
def test_defects_are_fatal(spark, changes, category):
    findings = findings_of(tables(spark, **changes))
    assert found(findings) == {category}
    result = verdict(findings)
    assert (result["executive_verdict"], result["safe_to_run"]) == ("NOT READY", "NO")


def test_missing_table_and_other_schema_are_fatal(spark):
    missing = findings_of(tables(spark, sellers=None))
    assert found(missing) == {"missing expected files", "schema mismatch", "relationship mismatch"}
    extra = tables(spark)
    extra["sellers"] = extra["sellers"].selectExpr("*", "1 AS more")
    assert found(findings_of(extra)) == {"schema mismatch"}
    errors = {r["table_name"]: r["error"] for r in audit.schema_results(spark, extra).collect()}
    assert errors["sellers"] == "schema mismatch" and errors["orders"] is None


def test_duplicates_and_references(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 3), (None, 3)], "k string, v int")
    assert audit.exact_duplicates(df).first()[0] == 2
    assert audit.duplicate_keys(df, "k").first()[0] == 2
    parent = spark.createDataFrame([("b",), (None,)], "k string")
    assert audit.missing_references(df, "k", parent, "k").first()[0] == 3
    profile = {r["column_name"]: (r["row_count"], r["null_count"]) for r in audit.column_profile(df, "t").collect()}
    assert profile == {"k": (5, 2), "v": (5, 0)}
    assert audit.exact_duplicates(df.limit(0)).first()[0] == 0


def test_expected_vs_actual(spark):
    names = lambda *n: spark.createDataFrame([(x,) for x in n], "name string")
    rows = audit.expected_vs_actual(names("a", "b"), names("b", "c")).collect()
    assert sorted(map(tuple, rows)) == [("a", "missing"), ("c", "unexpected")]


def test_lookup_gap(spark):
    t = tables(spark, products=[("p1", "a", *"1111111"), ("p2", "a", *"1111111"), ("p3", None, *"1111111")])
    assert tuple(audit.lookup_gap(t["products"], t["category_translation"]).first()) == (2, 1)


def test_purchase_range(spark):
    t = tables(spark, orders=[order(), order(order_id="o2", order_purchase_timestamp="never")])
    low, high = audit.purchase_range(t["orders"]).first()
    assert low == high and low.year == 2018

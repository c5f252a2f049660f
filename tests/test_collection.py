"""Collection decisions on small fixtures: nulls, repeats, empty inputs."""

import pytest
from pyspark.sql import functions as F

from recordflow.operators import collection
from recordflow.sources import bundles
from recordflow.sources.shared import shared_dir


def test_country(spark):
    rows = [("DE", "DE", False), ("DE", "FR", True), ("DE", None, True), ("DE", None, None), (None, "DE", False), (None, "IT", False), (None, None, False)]
    d = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string, u boolean")
    x = collection.country(F.col("a"), F.col("b"), F.col("u"), F.lit(False), ["DE", "FR"])
    got = [tuple(r[0]) if r[0] else None for r in d.orderBy("i").select(x).collect()]
    assert got == [
        ("DE", "DETAIL_MATCH"), ("FR", "DETAIL_MISMATCH"), (None, "UNTRUSTED_IDENTICAL_RESULT_SET"), ("DE", "FILTER_URL_VALIDATED"),
        ("DE", "DETAIL_MATCH"), None, None,
    ]


def test_pages(spark):
    pages = {1: "ab", 2: "bc", 3: "ab", 4: "c", 5: "a"}
    rows = [("l", p, i) for p, items in pages.items() for i in items] + [("m", 9, None), ("m", 9, None), ("m", 10, None)]
    d = spark.createDataFrame(rows, "listing string, page int, item string")
    got = {(r.listing, r.page): r.kind for r in collection.page_kinds(d, "listing", "page", "item").collect()}
    assert got == {
        ("l", 1): "FIRST", ("l", 2): "NEW", ("l", 3): "RESET", ("l", 4): "REPEATED", ("l", 5): "REPEATED", ("m", 9): "FIRST", ("m", 10): "REPEATED",
    }
    assert collection.page_kinds(d.limit(0), "listing", "page", "item").collect() == []


def test_table_rows(spark):
    page = "<TABLE><tr><th>h</th></tr><tr class=a><td>1</td><td>\n<i>x</i> y</td></tr><tr><td>2</td></tr></TABLE>"
    d = spark.createDataFrame([(1, page), (2, ""), (3, None)], "i int, h string")
    got = [r[0] for r in d.orderBy("i").select(collection.table_rows(F.col("h"), 2)).collect()]
    assert got == [[["1", "x y"]], [], None]


def test_attempts(spark):
    rows = [(1, True, 0, "FULL"), (1, False, 1, "BLOCKED"), (1, False, 2, "PARTIAL"), (2, False, 0, "FETCH_FAILED"), (2, True, 0, "BLOCKED")]
    d = spark.createDataFrame(rows, "i int, away boolean, place int, outcome string")
    got = collection.settled_attempts(d, "i", F.col("away"), "place", F.col("outcome")).orderBy("i").collect()
    assert [tuple(r) for r in got] == [(1, "PARTIAL", 3), (2, "BLOCKED", 2)]


def test_aliases(spark):
    d = spark.createDataFrame([("C1", "s", "9", "u", "R"), (None, "s", "", None, None), (None,) * 5], "c string, s string, i string, u string, r string")
    x = collection.aliases(F.col("c"), F.col("s"), F.col("i"), [F.col("u"), F.col("u")], F.col("r"))
    got = [[tuple(a) for a in r[0]] for r in d.select(x).collect()]
    assert got == [[(0, "canonical:c1"), (1, "source_id:s:9"), (2, "url:u"), (3, "source_record:s:r")], [], []]


def test_counts_changes_metrics(spark):
    d = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (1, 3, None), (2, 1, "b")], "e int, t int, v string")
    top = collection.counts_by(d, ["v", "e"], 1).collect()
    assert {(r.dimension, r.value, r.n) for r in top} == {("v", None, 2), ("e", "1", 3)}
    kinds = [r.change for r in collection.run_changes(d, "e", ["t"], "v").orderBy("e", "t").collect()]
    assert kinds == ["NEW", "CHANGED", "SAME", "NEW"]
    flat = spark.createDataFrame([(1, 2, None)], "k int, a int, b double")
    assert [tuple(r) for r in collection.flattened(flat, ["k"], ["a", "b"]).collect()] == [(1, "a", 2.0)]


def test_report_pointer(spark, monkeypatch):
    root = shared_dir(spark, "test-reports")
    d = spark.range(3).toDF("x")
    assert bundles.publish_report(d, root) == 1
    real = bundles.digest
    calls = iter([(0, "other")])
    monkeypatch.setattr(bundles, "digest", lambda df: next(calls, None) or real(df))
    with pytest.raises(ValueError):
        bundles.publish_report(spark.range(5).toDF("x"), root)
    assert bundles.latest(spark, root) == 1 and bundles.load_state(spark, root).count() == 3

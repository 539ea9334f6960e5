from shoptide.operators.serving import (
    potential_customers,
    product_counts,
    serve_batch_recommendations,
    serve_realtime_recommendations,
    serve_trending,
    trend_history,
)
from shoptide.schemas import REALTIME_VIEW

RECOMMENDED = (
    "user_id string, segment_name string, product_id string, product_name string, category string, "
    "recommendation_score double, recommendation_type string"
)


def realtime(spark, rows):
    full = [(u, p, f"{p}-{u}", "Toys", 1, 2, 3, score, at) for u, p, score, at in rows]
    return spark.createDataFrame(full, REALTIME_VIEW)


def test_trending_sums_over_users(spark):
    row = serve_trending(realtime(spark, [("v", "p", 0.1, 0), ("u", "p", 0.2, 0)])).first()
    assert (row["trend_score"], row["view_count"], row["cart_count"], row["purchase_count"]) == (0.3, 2, 4, 6)
    assert row["product_name"] == "p-u"


def test_fifty_products_with_ties_by_id(spark):
    rows = [("u", f"p{i:02}", 1.0, 0) for i in range(60)]
    assert [r["product_id"] for r in serve_trending(realtime(spark, rows)).collect()] == [f"p{i:02}" for i in range(50)]
    own = serve_realtime_recommendations(realtime(spark, rows + [("v", "p", 1.0, 0)]))
    assert own.count() == 51
    only = serve_realtime_recommendations(realtime(spark, rows + [("v", "p", 1.0, 0)]), user_ids=["v"]).collect()
    assert [(r["user_id"], r["event_type"], r["score"]) for r in only] == [("v", "Aggregated", 1.0)]


def recommended(spark):
    rows = [
        ("u", "Low Frequency", "a", "A", "Toys", 0.5, "similar"),
        ("u", "Low Frequency", "b", "B", "Toys", 0.9, "consumption"),
        ("u", "Low Frequency", "c", "C", "Toys", None, "similar"),
        ("u", "Low Frequency", "d", "D", "Toys", 0.5, "similar"),
        ("v", None, "a", "A", "Toys", 0.7, "consumption"),
    ]
    return spark.createDataFrame(rows, RECOMMENDED)


def test_batch_recommendations(spark):
    found = {r["user_id"]: r for r in serve_batch_recommendations(recommended(spark)).collect()}
    assert [e["product_id"] for e in found["u"]["recommendations"]] == ["b", "a", "d", "c"]
    assert found["u"]["recommendations"][0].asDict() == {
        "product_id": "b",
        "product_name": "B",
        "category": "Toys",
        "score": 0.9,
        "recommendation_type": "consumption",
    }
    assert (found["u"]["segment_name"], found["v"]["segment_name"]) == ("Low Frequency", "Unknown")
    assert [r["user_id"] for r in serve_batch_recommendations(recommended(spark), ["v"]).collect()] == ["v"]


def test_a_long_list_comes_in_pages_of_the_ranking(spark):
    rows = [("u", "s", f"p{i:03}", "n", "c", i / 100, "similar") for i in range(100)]
    parts = serve_batch_recommendations(spark.createDataFrame(rows, RECOMMENDED), max_list_rows=30).collect()
    assert [len(r["recommendations"]) for r in sorted(parts, key=lambda r: r["part"])] == [30, 30, 30, 10]
    in_order = [e["product_id"] for r in sorted(parts, key=lambda r: r["part"]) for e in r["recommendations"]]
    assert in_order == [f"p{i:03}" for i in reversed(range(100))]


def test_potential_customers(spark):
    rows = potential_customers(recommended(spark), ["a"]).collect()
    assert [(r["user_id"], r["interest_score"], r["type"]) for r in rows] == [("v", 0.7, "consumption"), ("u", 0.5, "similar")]
    assert [r["user_id"] for r in potential_customers(recommended(spark), ["a"], n=1).collect()] == ["v"]


def test_trend_history(spark):
    rows = realtime(spark, [("u", "p", 0.1, 60), ("v", "p", 0.2, 60), ("u", "p", 1.0, 120), ("u", "q", 1.0, 720)])
    whole = sorted(trend_history(rows, ["p"], minutes=None).collect())
    assert whole == [("p", 60, 0.3), ("p", 120, 1.0)]
    assert sorted(trend_history(rows, minutes=10).collect()) == [("q", 720, 1.0)]
    assert sorted(trend_history(rows, minutes=10, as_of=660).collect()) == [("p", 120, 1.0)]


def test_product_counts(spark):
    items = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "product_id string")
    assert [tuple(r) for r in product_counts(items).collect()] == [("b", 2), ("a", 1), ("c", 1)]

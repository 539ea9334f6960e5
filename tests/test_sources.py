from datetime import datetime

import pytest
from pyspark.errors import AnalysisException

from shoptide.operators.trending import trending_products
from shoptide.schemas import EVENTS, ORDERS, TABLES
from shoptide.sources.tables import read_csv_table, read_inputs, read_or_none, read_view
from shoptide.sources.views import commit_view, merge_by_key, read_committed, read_snapshot, upsert_snapshot, write_csv, write_view

HEADERS = {
    "users": "user_id,name,email,gender,signup_date\nu1,Ann,a@example.net,Other,2025-03-13\n",
    "orders": "order_id,user_id,order_data,order_status,total_amount,note\n"
    "o1,u1,2025-09-09T14:52:37.292731,completed,12.5,extra\no2,u1,soon,completed,much,extra\n",
    "order_items": "order_item_id,order_id,product_id,user_id,quantity,item_price,item_total\ni1,o1,p1,u1,3,1.0,3.0\n",
    "products": "product_id,product_name,category,brand,price,rating\np1,Thing,Toys,Acme,9.5,4.1\n",
}


@pytest.fixture
def folder(tmp_path):
    for name, text in HEADERS.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return str(tmp_path)


def test_csv_goes_by_name_and_declared_type(spark, folder):
    orders = read_csv_table(spark, f"{folder}/orders.csv", ORDERS)
    assert orders.schema == ORDERS
    first, second = orders.collect()
    assert first["order_date"] == datetime(2025, 9, 9, 14, 52, 37, 292731) and first["total_amount"] == 12.5
    assert second["order_date"] is None and second["total_amount"] is None


def test_only_missing_events_are_forgiven(spark, folder, tmp_path):
    inputs = read_inputs(spark, folder)
    assert inputs["events"].schema == EVENTS and inputs["events"].count() == 0
    assert inputs["users"].schema == TABLES["users"]
    with pytest.raises(AnalysisException):
        read_inputs(spark, str(tmp_path / "nowhere"))
    with pytest.raises(AnalysisException):
        read_or_none(lambda: spark.range(1).select("missing"))


def test_products_may_be_named_optional(spark, tmp_path):
    for name in ("users", "orders", "order_items"):
        (tmp_path / f"{name}.csv").write_text(HEADERS[name])
    with pytest.raises(AnalysisException):
        read_inputs(spark, str(tmp_path))
    inputs = read_inputs(spark, str(tmp_path), optional=("events", "products"))
    assert inputs["products"].schema == TABLES["products"] and inputs["products"].count() == 0
    trends = trending_products(inputs["events"], inputs["orders"], inputs["order_items"], datetime(2025, 9, 10))
    assert [(r.product_id, r.view_growth) for r in trends.collect()] == [("p1", 0.0)]


def test_view_round_trip(spark, tmp_path):
    view = spark.createDataFrame([("a", 1)], "k string, v int")
    write_view(view, str(tmp_path / "v"))
    write_view(view, str(tmp_path / "v"))
    assert read_view(spark, str(tmp_path / "v")).collect() == [("a", 1)]
    write_csv(view, str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), header=True).collect() == [("a", "1")]


def test_sorted_inside_each_file(spark, tmp_path):
    view = spark.range(2_000, numPartitions=2).selectExpr("id * 37 % 100 as user_id", "id as product_id")
    write_view(view, str(tmp_path / "v"), sort_by=["user_id"])
    for file in (tmp_path / "v").glob("part-*.parquet"):
        users = [r["user_id"] for r in spark.read.parquet(str(file)).collect()]
        assert users == sorted(users) and len(users) == 1_000


def test_upsert_keeps_what_is_not_updated(spark, tmp_path):
    at = str(tmp_path / "segments")
    made = lambda *rows: spark.createDataFrame(list(rows), "user_id string, segment string")
    assert read_snapshot(spark, at) is None
    upsert_snapshot(made(("u1", "a"), ("u2", "a")), at, ["user_id"], 1)
    upsert_snapshot(made(("u2", "b"), ("u3", "b")), at, ["user_id"], 2)
    wanted = [("u1", "a"), ("u2", "b"), ("u3", "b")]
    assert sorted(read_snapshot(spark, at).collect()) == wanted
    upsert_snapshot(made(("u2", "b"), ("u3", "b")), at, ["user_id"], 2)
    assert sorted(read_snapshot(spark, at).collect()) == wanted
    merged = merge_by_key(made(("u1", "a")), made(("u1", "z")), ["user_id"])
    assert merged.collect() == [("u1", "z")]


def test_committed_versions(spark, tmp_path):
    at = str(tmp_path / "v")
    assert read_committed(spark, at) is None
    commit_view(spark.range(3), at, 10)
    opened = read_committed(spark, at)
    commit_view(spark.range(5), at, 20)
    # who has opened the older version reads it to the end
    assert opened.count() == 3 and read_committed(spark, at).count() == 5 and read_committed(spark, at, below=20).count() == 3
    with pytest.raises(Exception):
        commit_view(spark.range(4).selectExpr("assert_true(id < 2)"), at, 30)
    assert read_committed(spark, at).count() == 5
    commit_view(spark.range(6), at, 30)
    assert read_committed(spark, at).count() == 6
    assert len([p for p in (tmp_path / "v").iterdir() if not p.name.startswith("_")]) == 2  # older and failed ones are gone


def test_committed_versions_are_sorted_inside_each_file(spark, tmp_path):
    view = spark.range(2_000, numPartitions=2).selectExpr("id * 37 % 100 as user_id", "id as product_id")
    commit_view(view, str(tmp_path / "v"), 1, sort_by=["user_id"])
    files = list((tmp_path / "v").glob("v1-*/part-*.parquet"))
    assert len(files) == 2
    for file in files:
        users = [r["user_id"] for r in spark.read.parquet(str(file)).collect()]
        assert users == sorted(users) and len(users) == 1_000

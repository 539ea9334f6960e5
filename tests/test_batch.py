from datetime import datetime

from pyspark.sql import functions as F

from shoptide.operators.consumption import user_consumption_profile
from shoptide.operators.trending import trending_products
from shoptide.plans.batch import VIEWS, run_batch
from shoptide.plans.daily import update_partials
from shoptide.sources.star import BAD, COMPLETED, EVENTS_TODAY, ORDERS_TODAY, StarTables

FOLDER = "/root/testdata/sf0.001"


def test_chain_writes_all_views(spark, tmp_path):
    t = StarTables(spark, FOLDER)
    inputs = {"users": t.users, "orders": t.orders, "order_items": t.order_items, "products": t.products, "events": t.events}
    options = {
        "user_segments": {"completed": COMPLETED, "bad": BAD, "partitions": 4},
        "user_consumption_profile": {"completed": COMPLETED},
        "trending_products": {"orders_as_of": ORDERS_TODAY},
        "product_complementary": {"min_count": 2},
    }
    as_of = datetime(EVENTS_TODAY.year, EVENTS_TODAY.month, EVENTS_TODAY.day)
    views = run_batch(inputs, str(tmp_path), as_of, options)
    assert tuple(views) == VIEWS
    recommended = views["user_recommendations_batch"]
    users = views["user_segments"].count()
    assert users == 150
    assert recommended.select("user_id").distinct().count() == users
    assert recommended.count() == recommended.select("user_id", "product_id").distinct().count()
    assert recommended.filter(F.col("segment_name").isNull()).count() == 0
    assert views["product_similarity"].filter("product_id_1 = product_id_2").count() == 0
    assert views["product_similarity"].groupBy("product_id_1").count().agg(F.max("count")).first()[0] <= 20
    low, high = views["product_similarity"].agg(F.min("similarity_score"), F.max("similarity_score")).first()
    assert 0.5 <= low <= high <= 1.0

    rows = recommended.count()
    again = run_batch(inputs, str(tmp_path), as_of, options)
    assert again["user_recommendations_batch"].count() == rows
    assert again["user_segments"].count() == users


def test_a_failed_run_is_resumed(spark, tmp_path, monkeypatch):
    import pytest

    from shoptide.plans import batch

    t = StarTables(spark, FOLDER)
    inputs = {"users": t.users, "orders": t.orders, "order_items": t.order_items, "products": t.products, "events": t.events}
    options = {"user_segments": {"completed": COMPLETED, "bad": BAD, "partitions": 4}, "user_consumption_profile": {"completed": COMPLETED}, "trending_products": {"orders_as_of": ORDERS_TODAY}}
    as_of = datetime(EVENTS_TODAY.year, EVENTS_TODAY.month, EVENTS_TODAY.day)

    def broken(*_, **__):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(batch, "user_recommendations", broken)
        with pytest.raises(OSError):
            run_batch(inputs, str(tmp_path), as_of, options)
    written = {p for p in tmp_path.glob("*/v*") if p.is_dir()}
    assert len(written) == 5
    for name in ("user_segments", "user_consumption_profile", "trending_products", "product_similarity", "product_complementary"):
        monkeypatch.setattr(batch, name, broken)
    views = run_batch(inputs, str(tmp_path), as_of, options, resume=True)
    assert views["user_recommendations_batch"].count() > 0
    assert written < {p for p in tmp_path.glob("*/v*") if p.is_dir()}


def test_chain_on_partials_equals_the_chain_on_everything(spark, tmp_path):
    t = StarTables(spark, FOLDER)
    inputs = {"users": t.users, "orders": t.orders, "order_items": t.order_items, "products": t.products, "events": t.events}
    options = {"user_segments": {"completed": COMPLETED, "bad": BAD, "partitions": 4}, "user_consumption_profile": {"completed": COMPLETED}, "trending_products": {"orders_as_of": ORDERS_TODAY}}
    as_of = datetime(EVENTS_TODAY.year, EVENTS_TODAY.month, EVENTS_TODAY.day)
    store = str(tmp_path / "partials")
    late = F.col("order_date") >= F.lit(datetime(1997, 1, 1))
    earlier = {**inputs, "orders": inputs["orders"].filter(~late)}
    update_partials(earlier, store, 1, completed=COMPLETED)
    found = run_batch(inputs, str(tmp_path / "daily"), as_of, options, partials=store, arrivals={"orders": inputs["orders"].filter(late)})
    profile = user_consumption_profile(t.users, t.orders, t.order_items, t.products, COMPLETED)
    trends = trending_products(t.events, t.orders, t.order_items, as_of, orders_as_of=ORDERS_TODAY)
    for got, wanted in ((found["user_consumption_profile"], profile), (found["trending_products"], trends)):
        assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect()))
    assert found["user_recommendations_batch"].count() > 0

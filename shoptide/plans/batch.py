"""The batch chain: five views that do not depend on each other, then the recommendations on top."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, datetime

from pyspark.sql import DataFrame

from shoptide.functions.clock import epoch_ms
from shoptide.operators.baskets import product_complementary
from shoptide.operators.consumption import user_consumption_profile
from shoptide.operators.recommend import user_recommendations
from shoptide.operators.segments import user_segments
from shoptide.operators.similarity import product_similarity
from shoptide.operators.trending import trending_products
from shoptide.plans.daily import daily_profile, daily_trending, update_partials
from shoptide.plans.settle import checkpoint_root, settle, side_by_side
from shoptide.sources.views import commit_view, committed_version, read_committed, read_snapshot, upsert_snapshot

VIEWS = (
    "user_segments",
    "user_consumption_profile",
    "trending_products",
    "product_similarity",
    "product_complementary",
    "user_recommendations_batch",
)


def run_batch(
    inputs: Mapping[str, DataFrame],
    out_dir: str,
    as_of: date | datetime,
    options: Mapping[str, dict] | None = None,
    resume: bool = False,
    partials: str | None = None,
    arrivals: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Compute all six views into ``out_dir`` and return them as read back from there.

    ``inputs`` holds users, orders, order_items, products and events; ``options`` holds keyword
    arguments per view. The first five run side by side; the last reads them as written, so nothing is
    computed twice. Segments are merged into what is there by user, the other views are replaced.

    Each view is a committed version of ``as_of``: readers keep the one they opened, and a view that fails leaves its last
    version current. ``resume`` takes the views that have been committed for ``as_of`` as they are and computes the others.

    ``partials`` names the stores of the daily run (``plans/daily.py``): the profile and the trends then come from them, after the periods of
    the rows in ``arrivals`` have been recomputed. The other views have no partials and are computed from all rows.
    """
    options = options or {}

    def of(view: str) -> dict:
        return dict(options.get(view, {}))

    users, orders, items = inputs["users"], inputs["orders"], inputs["order_items"]
    products, events = inputs["products"], inputs["events"]
    spark, version = orders.sparkSession, epoch_ms(as_of)

    def done(name: str) -> bool:
        return resume and committed_version(spark, f"{out_dir}/{name}") == version

    def segments() -> DataFrame:
        name = "user_segments"
        at = f"{out_dir}/{name}"
        if not done(name):
            upsert_snapshot(user_segments(users, orders, as_of, settle=settle, **of(name)), at, ["user_id"], version)
        return read_snapshot(spark, at)

    def kept(name: str, compute: Callable[[], DataFrame], *sort_by: str) -> DataFrame:
        if not done(name):
            commit_view(compute(), f"{out_dir}/{name}", version, sort_by)
        return read_committed(spark, f"{out_dir}/{name}")

    def profile() -> DataFrame:
        name = "user_consumption_profile"
        if partials:
            return kept(name, lambda: daily_profile(users, products, partials))
        return kept(name, lambda: user_consumption_profile(users, orders, items, products, settle=settle, **of(name)))

    def trending() -> DataFrame:
        name = "trending_products"
        if partials:
            return kept(name, lambda: daily_trending(spark, partials, as_of, **of(name)))
        return kept(name, lambda: trending_products(events, orders, items, as_of, **of(name)))

    def similar() -> DataFrame:
        name = "product_similarity"
        return kept(name, lambda: product_similarity(products, as_of=as_of, **of(name)))

    def together() -> DataFrame:
        name = "product_complementary"
        return kept(name, lambda: product_complementary(items, products, as_of=as_of, settle=settle, **of(name)))

    checkpoint_root(spark)
    if partials:
        update_partials(inputs, partials, version, arrivals, **of("user_consumption_profile"))
    by_user, profiles, trends, alike, pairs = side_by_side(segments, profile, trending, similar, together)
    name = "user_recommendations_batch"
    best = lambda: user_recommendations(profiles, trends, alike, pairs, by_user, products, as_of=as_of, **of(name))
    served = kept(name, best, "user_id")
    return dict(zip(VIEWS, (by_user, profiles, trends, alike, pairs, served), strict=True))

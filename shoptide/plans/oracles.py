"""The registered queries as plain SQL over the test tables, for checking."""

from __future__ import annotations

from shoptide.plans.queries import MIN_COUNT, REALTIME_NOW, SNAPSHOT_DAY

_SPENDING = """
paid as (
  select o_custkey as user_id, o_orderkey as order_id, strftime(o_orderdate, '%Y-%m') as year_month,
         cast(o_totalprice as decimal(18,2)) as amount
  from orders where o_orderstatus = 'F'),
months as (
  select user_id, year_month, sum(amount) as spent, count(amount) as paid, count(*) as n from paid group by all),
latest as (
  select user_id, max(year_month) as year_month from months group by all),
bought as (
  select p.user_id, p.order_id, l_partkey as product_id,
         coalesce(p_name, 'unknown') as product_name, coalesce(p_brand, 'unknown') as category,
         coalesce(p_retailprice, 0.0) as price
  from paid p join latest using (user_id, year_month) join lineitem on l_orderkey = p.order_id
       left join part on p_partkey = l_partkey)"""

_TREND = """
viewed as (
  select cast(props->>'$.k' as bigint) as product_id,
         date_diff('day', cast(ts as date), date '2024-01-30') as age
  from events where event_type = 'view'),
view_stats as (
  select product_id,
         cast(sum(case when age between 0 and 7 then 1 else 0 end) as bigint) as current_views,
         cast(sum(case when age between 8 and 14 then 1 else 0 end) as bigint) as previous_views
  from viewed group by all),
sold as (
  select l_partkey as product_id, l_quantity as quantity,
         date_diff('day', cast(o_orderdate as date), date '2001-08-01') as age
  from orders join lineitem on o_orderkey = l_orderkey),
order_stats as (
  select product_id,
         sum(case when age between 0 and 7 then quantity else 0 end) as current_orders,
         sum(case when age between 8 and 14 then quantity else 0 end) as previous_orders
  from sold group by all),
view_growths as (
  select *, (current_views - previous_views) / cast(previous_views + 1 as double) as view_growth from view_stats),
order_growths as (
  select *, (current_orders - previous_orders) / (previous_orders + 1) as order_growth from order_stats),
filled as (
  select coalesce(v.product_id, o.product_id) as product_id,
         coalesce(current_views, 0) as cv, coalesce(view_growth, 0) as view_growth,
         coalesce(current_orders, 0) as co, coalesce(order_growth, 0) as order_growth
  from view_growths v full join order_growths o on v.product_id = o.product_id),
trending as (
  select product_id,
         (cv * cast(0.2 as double) + co * cast(0.8 as double))
         + (view_growth * cast(5.0 as double) + order_growth * cast(15.0 as double)) as trend_score,
         view_growth, order_growth, '7d' as trend_window, cast(1706572800000 as bigint) as trend_date
  from filled),
hot as (select * from trending where trend_score > 0),
top_ten as (select product_id from hot order by trend_score desc, product_id limit 10)"""

_SIMILAR = """
price_span as (select max(p_retailprice) - min(p_retailprice) as width from part),
alike as (
  select x.p_partkey as product_id_1, y.p_partkey as product_id_2,
         cast(0.5 as double) + cast(0.5 as double)
           * (cast(1.0 as double) - abs(x.p_retailprice - y.p_retailprice) / width) as similarity_score
  from part x join part y on x.p_brand = y.p_brand and x.p_partkey <> y.p_partkey, price_span),
alike_best as (
  select product_id_1, product_id_2, similarity_score, 'content_based' as similarity_type, true as category_match
  from alike
  qualify row_number() over (partition by product_id_1 order by similarity_score desc, product_id_2) <= 20)"""

_BASKETS = """
lines as (select distinct l_orderkey as order_id, l_partkey as product_id from lineitem),
mixed as (select order_id from lines group by all having count(*) > 1),
baskets as (select lines.* from lines join mixed using (order_id))"""

# Rounding goes through the shortest decimal text, half up, as the views do it.
_RULES = f"""
{_BASKETS},
total as (select cast(count(*) as double) as n from mixed),
single as (select product_id, count(*) as n from baskets group by all),
pair as (
  select x.product_id as a, y.product_id as b, count(*) as n
  from baskets x join baskets y on x.order_id = y.order_id and x.product_id <> y.product_id
  group by all having count(*) >= {MIN_COUNT}),
rules as (
  select a as product_id_1, b as product_id_2, cast(pair.n as integer) as co_purchase_count,
         cast(pair.n as double) / total.n as support,
         cast(pair.n as double) / sa.n as confidence,
         (cast(pair.n as double) / sa.n) / (cast(sb.n as double) / total.n) as lift
  from pair join single sa on sa.product_id = a join single sb on sb.product_id = b, total
  where cast(pair.n as double) / sa.n >= 0.005),
scored_rules as (
  select product_id_1, product_id_2, 'co_purchase' as relationship_type, co_purchase_count, confidence,
         p1.p_brand <> p2.p_brand as category_cross_sell,
         confidence * cast(0.7 as double) + (lift / 10) * cast(0.3 as double) as raw_score
  from rules left join part p1 on p1.p_partkey = product_id_1 left join part p2 on p2.p_partkey = product_id_2),
complementary as (
  select * exclude (raw_score),
         cast(round(cast(cast(raw_score as varchar) as decimal(38,20)), 2) as double) as complementary_score
  from scored_rules)"""

_BASE = """
shopping as (select distinct user_id, product_id from bought),
base as (
  select * from shopping
  union all
  select c_custkey, product_id from customer, top_ten where c_custkey not in (select user_id from shopping))"""

_CANDIDATES = """
best_rule as (select max(complementary_score) as top from complementary),
candidates as (
  select user_id, product_id, cast(1.0 as double) as score, 'consumption' as type from base
  union all
  select user_id, product_id_2, similarity_score, 'similar' from base join alike_best on product_id = product_id_1
  union all
  select user_id, product_id_2,
         complementary_score / (case when top is null or top = 0 then 1 else top end), 'complementary'
  from base join complementary on product_id = product_id_1, best_rule)"""

_SCORED = """
weighted as (
  select user_id, product_id, type, priority,
         cast(0.5 as double) * priority * score
           + cast(0.5 as double) * (coalesce(trend_score, 0) / 100) as final_score
  from (select *, cast(case type when 'consumption' then 1.0 when 'similar' then 0.8
                       when 'complementary' then 0.7 else 0.3 end as double) as priority from candidates)
       left join hot using (product_id)),
scored as (
  select user_id, product_id, type, final_score from weighted
  qualify row_number() over (partition by user_id, product_id order by final_score desc, priority desc, type) = 1)"""

_FEATURES = """
order_counts as (
  select o_custkey as user_id, min(cast(o_orderdate as date)) as signup_date, count(o_orderkey) as total_orders,
         cast(sum(case when o_orderstatus = 'F' then 1 else 0 end) as bigint) as total_completed_orders,
         cast(sum(case when o_orderstatus = 'P' then 1 else 0 end) as bigint) as total_bad_orders
  from orders group by all),
features as (
  select c_custkey as user_id,
         cast(coalesce(date_diff('day', signup_date, date '2001-08-01'), 0) as integer) as days_since_signup,
         coalesce(total_orders, 0) as total_orders,
         coalesce(total_completed_orders, 0) as total_completed_orders,
         coalesce(total_bad_orders, 0) as total_bad_orders,
         coalesce(total_completed_orders / cast(total_orders as double), 0) as completion_rate,
         coalesce(total_bad_orders / cast(total_orders as double), 0) as cancellation_rate
  from customer left join order_counts on user_id = c_custkey)"""

_LABELS = f"""
{_FEATURES},
clustered as (select user_id, cast(user_id % 4 as integer) as cluster, * exclude (user_id) from features),
profile as (
  select cluster, avg(total_orders) as avg_orders, avg(completion_rate) - avg(cancellation_rate) as goodness
  from clustered group by all),
halves as (
  select cluster, goodness, row_number() over (order by avg_orders, cluster) * 2 > count(*) over () as high
  from profile),
names as (
  select cluster,
         case when high and place = 1 then 'Frequent Shoppers' when high then 'Risky Frequent Buyers'
              when place = 1 then 'Low Frequency' else 'Bad Customer' end as segment_name
  from (select *, row_number() over (partition by high order by goodness desc, cluster) as place from halves)),
labels as (select user_id, cluster, segment_name from clustered join names using (cluster))"""

_RECOMMENDED = f"""
{_SPENDING}, {_TREND}, {_SIMILAR}, {_RULES}, {_BASE}, {_CANDIDATES}, {_SCORED}, {_LABELS},
recommended as (
  select user_id, segment_name, product_id, p_name as product_name, p_brand as category,
         final_score as recommendation_score, type as recommendation_type
  from scored left join labels using (user_id) left join part on p_partkey = product_id)"""

# An event is in the five windows that end one to five minutes after its own minute.
_ACTIVITY = """
activity as (
  select user_id, cast(props->>'$.k' as bigint) as product_id, p_name as product_name, p_brand as category,
         case when event_type = 'click' then 'cart' else event_type end as event_type,
         epoch_us(ts) // 60000000 * 60 as event_minute, epoch_us(ts) // 1000 as event_millis
  from events left join part on p_partkey = cast(props->>'$.k' as bigint))"""

_INTEREST = f"""
{_ACTIVITY},
interest as (
  select event_minute + 60 * i as window_end, user_id, product_id, product_name, category,
         cast(sum(case when event_type = 'view' then 1 else 0 end) as bigint) as view_count,
         cast(sum(case when event_type = 'cart' then 1 else 0 end) as bigint) as cart_count,
         cast(sum(case when event_type = 'purchase' then 1 else 0 end) as bigint) as purchase_count
  from activity, range(1, 6) t(i) group by all),
trend_rows as (
  select user_id, product_id, product_name, category, view_count, cart_count, purchase_count,
         view_count * cast(0.2 as double) + cart_count * cast(0.5 as double)
           + purchase_count * cast(1.0 as double) as trend_score,
         window_end as computed_time
  from interest)"""

# A key's row is the window that ends right after the minute of its newest event.
_REALTIME = f"""
{_INTEREST},
newest as (
  select user_id, product_id, max(event_minute) + 60 as computed_time from activity group by all),
realtime as (select trend_rows.* from trend_rows join newest using (user_id, product_id, computed_time))"""


def _sql(parts: str, body: str) -> str:
    return f"with {parts.strip()}\n{body.strip()}"


ORACLES = {
    "user_order_features": _sql(_FEATURES, "select * from features"),
    "label_segments": _sql(_LABELS, "select * from labels"),
    "avg_order_value": _sql(
        _SPENDING,
        "select user_id, cast(sum(amount) as double) / count(amount) as avg_order_value from paid group by all",
    ),
    "monthly_spending": _sql(
        _SPENDING, "select user_id, year_month, cast(spent as double) as monthly_spending from months"
    ),
    "latest_month_spending": _sql(
        _SPENDING,
        "select user_id, year_month, cast(spent as double) as monthly_spending "
        "from months join latest using (user_id, year_month)",
    ),
    "latest_month_items": _sql(_SPENDING, "select * from bought"),
    "user_consumption_profile": _sql(
        _SPENDING
        + """,
means as (
  select user_id, cast(sum(amount) as double) / count(amount) as avg_order_value from paid group by all),
last_spent as (
  select user_id, cast(spent as double) as monthly_spending from months join latest using (user_id, year_month)),
lists as (
  select user_id,
         string_agg(cast(product_id as varchar), '|' order by product_id) as product_ids_in_latest_month,
         string_agg(product_name, '|' order by product_id) as products_in_latest_month,
         string_agg(category, '|' order by product_id) as categories_in_latest_month,
         string_agg(cast(price as varchar), '|' order by product_id) as product_prices_in_latest_month
  from bought group by all)""",
        """
select c_custkey as user_id, coalesce(avg_order_value, 0) as avg_order_value,
       coalesce(monthly_spending, 0) as monthly_spending, product_ids_in_latest_month, products_in_latest_month,
       categories_in_latest_month, product_prices_in_latest_month
from customer left join means on means.user_id = c_custkey left join last_spent on last_spent.user_id = c_custkey
     left join lists on lists.user_id = c_custkey""",
    ),
    "view_growth": _sql(_TREND, "select * from view_growths"),
    "order_growth": _sql(_TREND, "select * from order_growths"),
    "trending_products": _sql(_TREND, "select * from hot"),
    "top_trending": _sql(_TREND, "select * from top_ten"),
    "product_similarity": _sql(_SIMILAR, "select * from alike_best"),
    "baskets": _sql(_BASKETS, "select * from baskets"),
    "copurchase_rules": _sql(_RULES, "select * from rules"),
    "product_complementary": _sql(_RULES, "select * from complementary"),
    "consumption_base": _sql(f"{_SPENDING}, {_TREND}, {_BASE}", "select * from base"),
    "rec_candidates": _sql(
        f"{_SPENDING}, {_TREND}, {_SIMILAR}, {_RULES}, {_BASE}, {_CANDIDATES}", "select * from candidates"
    ),
    "score_candidates": _sql(
        f"{_SPENDING}, {_TREND}, {_SIMILAR}, {_RULES}, {_BASE}, {_CANDIDATES}, {_SCORED}", "select * from scored"
    ),
    "user_recommendations": _sql(_RECOMMENDED, "select * from recommended"),
    "run_batch": _sql(_RECOMMENDED, "select * exclude (segment_name) from recommended"),
    "serve_batch_recommendations": _sql(
        _RECOMMENDED,
        """
select user_id, coalesce(any_value(segment_name), 'Unknown') as segment_name, count(*) as n,
       string_agg(concat_ws(':', cast(product_id as varchar), category, recommendation_type), '|'
                  order by recommendation_score desc, product_id) as recommendations,
       cast(0 as integer) as part
from recommended group by user_id""",
    ),
    "potential_customers": _sql(
        _RECOMMENDED,
        "select product_id, user_id, recommendation_score as interest_score, recommendation_type as type "
        "from recommended",
    ),
    "potential_customers_top": _sql(
        _RECOMMENDED,
        "select product_id, user_id, recommendation_score as interest_score, recommendation_type as type "
        "from recommended "
        "qualify row_number() over (partition by product_id order by recommendation_score desc, user_id) <= 10",
    ),
    "parse_activity_events": _sql(
        _ACTIVITY,
        """
select cast(user_id as varchar) as user_id, cast(product_id as varchar) as product_id, product_name, category,
       event_type, cast(trunc((cast(event_millis as double) / 1000) * 1000000) as bigint) as event_micros
from activity""",
    ),
    "sliding_user_interest": _sql(_INTEREST, "select * from interest"),
    "realtime_trend_score": _sql(_INTEREST, "select * from trend_rows"),
    "upsert_realtime_view": _sql(_REALTIME, "select * from realtime"),
    "run_speed_layer": _sql(
        _REALTIME,
        "select * replace (cast(user_id as varchar) as user_id, cast(product_id as varchar) as product_id) "
        "from realtime",
    ),
    "run_speed_layer_batches": _sql(
        _REALTIME,
        "select * replace (cast(user_id as varchar) as user_id, cast(product_id as varchar) as product_id) "
        "from realtime",
    ),
    "live_realtime_view": _sql(
        _REALTIME,
        "select * replace (cast(user_id as varchar) as user_id, cast(product_id as varchar) as product_id) "
        f"from realtime where computed_time > {REALTIME_NOW} - 600",
    ),
    "stored_serve_trending": _sql(
        _REALTIME,
        """
select cast(product_id as varchar) as product_id, min_by(product_name, cast(user_id as varchar)) as product_name,
       min_by(category, cast(user_id as varchar)) as category,
       cast(sum(cast(trend_score as decimal(20,6))) as double) as trend_score,
       cast(sum(view_count) as bigint) as view_count, cast(sum(cart_count) as bigint) as cart_count,
       cast(sum(purchase_count) as bigint) as purchase_count
from realtime group by product_id order by 4 desc, 1 limit 50""",
    ),
    "stored_trend_history": _sql(
        _INTEREST,
        """
select cast(product_id as varchar) as product_id, computed_time as window_end,
       cast(sum(cast(trend_score as decimal(20,6))) as double) as trend_score
from trend_rows group by all""",
    ),
    "upsert_snapshot": f"""
with counted as (
  select o_custkey as user_id, o_orderdate >= date '{SNAPSHOT_DAY}' as late, count(*) as n_orders,
         strftime(max(o_orderdate), '%Y-%m-%d') as newest
  from orders group by all)
select user_id, n_orders, newest from counted
qualify row_number() over (partition by user_id order by late desc) = 1""",
    "expire_realtime_view": _sql(_REALTIME, f"select * from realtime where computed_time > {REALTIME_NOW} - 86400"),
    "raw_event_append": _sql(
        _ACTIVITY,
        """
select cast(user_id as varchar) as user_id, cast(product_id as varchar) as product_id, product_name, category,
       event_type, cast(event_millis as double) as event_timestamp
from activity""",
    ),
    "serve_trending": _sql(
        _REALTIME,
        """
select product_id, min_by(product_name, user_id) as product_name, min_by(category, user_id) as category,
       cast(sum(cast(trend_score as decimal(20,6))) as double) as trend_score,
       cast(sum(view_count) as bigint) as view_count, cast(sum(cart_count) as bigint) as cart_count,
       cast(sum(purchase_count) as bigint) as purchase_count
from realtime group by product_id order by 4 desc, 1 limit 50""",
    ),
    "serve_realtime_recommendations": _sql(
        _REALTIME,
        """
select user_id, product_id, product_name, category, trend_score as score, 'Aggregated' as event_type
from realtime qualify row_number() over (partition by user_id order by trend_score desc, product_id) <= 50""",
    ),
    "trend_history": _sql(
        _INTEREST,
        """
select product_id, computed_time as window_end,
       cast(sum(cast(trend_score as decimal(20,6))) as double) as trend_score
from trend_rows group by all""",
    ),
    "trend_history_recent": _sql(
        _INTEREST,
        """
select product_id, computed_time as window_end,
       cast(sum(cast(trend_score as decimal(20,6))) as double) as trend_score
from trend_rows where computed_time > (select max(computed_time) - 600 from trend_rows) group by all""",
    ),
    "product_counts": "select l_partkey as product_id, count(*) as count from lineitem group by all",
}

# a daily run on partials ends in what a run on everything gives
ORACLES["daily_consumption_profile"] = ORACLES["user_consumption_profile"]
ORACLES["daily_trending_products"] = ORACLES["trending_products"]

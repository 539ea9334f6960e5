"""Declared schemas of the input tables, the messages and the views.

Nothing is inferred from content: inference is another pass over the data and
makes a column's type depend on the rows that happen to be there. The operators
themselves do not care about id types; strings here, longs elsewhere.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_STRING, _DOUBLE, _INT, _LONG = StringType(), DoubleType(), IntegerType(), LongType()
_DATE, _TIME = DateType(), TimestampType()


def _row(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


USERS = _row(user_id=_STRING, name=_STRING, email=_STRING, gender=_STRING, signup_date=_DATE)

ORDERS = _row(order_id=_STRING, user_id=_STRING, order_date=_TIME, order_status=_STRING, total_amount=_DOUBLE)

ORDER_ITEMS = _row(
    order_item_id=_STRING,
    order_id=_STRING,
    product_id=_STRING,
    user_id=_STRING,
    quantity=_INT,
    item_price=_DOUBLE,
    item_total=_DOUBLE,
)

PRODUCTS = _row(
    product_id=_STRING, product_name=_STRING, category=_STRING, brand=_STRING, price=_DOUBLE, rating=_DOUBLE
)

EVENTS = _row(event_id=_STRING, user_id=_STRING, product_id=_STRING, event_type=_STRING, event_timestamp=_TIME)

REVIEWS = _row(
    review_id=_STRING,
    order_id=_STRING,
    product_id=_STRING,
    user_id=_STRING,
    rating=_INT,
    review_text=_STRING,
    review_date=_TIME,
)

SEARCH_LOGS = _row(
    search_id=_STRING,
    user_id=_STRING,
    session_id=_STRING,
    search_keyword=_STRING,
    category_filter=_STRING,
    min_price=_DOUBLE,
    max_price=_DOUBLE,
    sort_by=_STRING,
    search_time=_TIME,
)

TABLES = {
    "users": USERS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "products": PRODUCTS,
    "events": EVENTS,
    "reviews": REVIEWS,
    "search_logs": SEARCH_LOGS,
}

# Header spellings met in the wild -> declared column.
HEADER_ALIASES = {"order_data": "order_date"}

# Messages on the activity topic; event_timestamp is epoch milliseconds.
ACTIVITY_MESSAGE = _row(
    user_id=_STRING,
    product_id=_STRING,
    product_name=_STRING,
    category=_STRING,
    event_type=_STRING,
    event_timestamp=_DOUBLE,
)

# Messages of the plain append feed.
RAW_MESSAGE = _row(user_id=_INT, action=_STRING, item_id=_STRING, timestamp=_LONG)

# computed_time is the end of the window in epoch seconds.
REALTIME_VIEW = _row(
    user_id=_STRING,
    product_id=_STRING,
    product_name=_STRING,
    category=_STRING,
    view_count=_LONG,
    cart_count=_LONG,
    purchase_count=_LONG,
    trend_score=_DOUBLE,
    computed_time=_LONG,
)

"""Hot keys: one user holds a third of the orders, one product and the NULL
order id each hold a third of the items. The metric views must give exactly
what the reference SQL gives on the same rows (run in DuckDB)."""

import datetime as dt
from decimal import Decimal

import duckdb
import numpy as np
import pandas as pd

from basketlens import schemas
from basketlens.functions.exprs import portable
from basketlens.operators import metrics
from basketlens.plans import oracle

from test_oracle import _rows


def _fixture(seed=7):
    rng = np.random.default_rng(seed)
    n_users, n_orders, n_products, n_items = 40, 600, 30, 900
    users = [(i, f"u{i}@x", "F", "L", dt.datetime(2023, 6, 1) + dt.timedelta(days=int(i)))
             for i in range(1, n_users + 1)]
    statuses = ["completed", "pending", "shipped", "cancelled", None]
    orders = []
    for i in range(1, n_orders + 1):
        user = 1 if i % 3 == 0 else int(rng.integers(1, n_users + 5))   # some orphans
        when = dt.datetime(2024, 1, 1) + dt.timedelta(hours=int(rng.integers(0, 24 * 60)))
        amount = Decimal(int(rng.integers(100, 100000))) / 100
        orders.append((i, user, statuses[int(rng.integers(0, 5))], amount, amount,
                       Decimal("0.00"), Decimal("0.00"), when))
    products = [(p, f"p{p}", f"SKU-{p}", Decimal("9.99"), int(rng.integers(-1, 20)),
                 int(rng.integers(1, 4)), None) for p in range(1, n_products + 1)]
    items = []
    for i in range(n_items):
        product = 1 if i % 3 == 0 else int(rng.integers(1, n_products + 1))
        order = None if i % 3 == 1 else int(rng.integers(1, n_orders + 20))
        items.append((order, product, int(rng.integers(1, 5)),
                      Decimal(int(rng.integers(100, 5000))) / 100))
    cats = [(1, "A"), (2, "B")]
    return users, orders, products, items, cats


def _duck(users, orders, products, items, cats):
    con = duckdb.connect()
    frames = {
        "u": pd.DataFrame(users, columns=["id", "email", "first_name", "last_name", "created_at"]),
        "o": pd.DataFrame([(o[0], o[1], o[2], float(o[3]), o[7]) for o in orders],
                          columns=["id", "user_id", "status", "total_amount", "created_at"]),
        "p": pd.DataFrame([(p[0], p[1], p[2], float(p[3]), p[4], p[5]) for p in products],
                          columns=["id", "name", "sku", "price", "stock_quantity",
                                   "category_id"]),
        "oi": pd.DataFrame([(i[0], i[1], i[2], float(i[3])) for i in items],
                           columns=["order_id", "product_id", "quantity", "price"]),
        "c": pd.DataFrame(cats, columns=["id", "name"]),
    }
    for name, frame in frames.items():
        con.register(name, frame)
    con.execute("CREATE TABLE shop_users AS SELECT id::BIGINT id, email, first_name, last_name, "
                "created_at::TIMESTAMP created_at FROM u")
    con.execute("CREATE TABLE shop_orders AS SELECT id::BIGINT id, user_id::BIGINT user_id, "
                "status, total_amount::DECIMAL(10,2) total_amount, "
                "total_amount::DECIMAL(10,2) subtotal, 0::DECIMAL(10,2) tax_amount, "
                "0::DECIMAL(10,2) shipping_amount, created_at::TIMESTAMP created_at FROM o")
    con.execute("CREATE TABLE shop_products AS SELECT id::BIGINT id, name, sku, "
                "price::DECIMAL(10,2) price, stock_quantity::INTEGER stock_quantity, "
                "category_id::BIGINT category_id FROM p")
    con.execute("CREATE TABLE shop_order_items AS SELECT order_id::BIGINT order_id, "
                "product_id::BIGINT product_id, quantity::INTEGER quantity, "
                "price::DECIMAL(10,2) price FROM oi")
    con.execute("CREATE TABLE shop_categories AS SELECT id::BIGINT id, name FROM c")
    return con


def _sql(cte, cols):
    name, body = cte
    return f"WITH {name} AS ({body}) SELECT {', '.join(cols)} FROM {name}"


def test_hot_keys_give_the_reference_results(spark):
    users, orders, products, items, cats = _fixture()
    s_users = spark.createDataFrame(users, schemas.USERS)
    s_orders = spark.createDataFrame(orders, schemas.ORDERS_OP)
    s_products = spark.createDataFrame(products, schemas.PRODUCTS)
    s_items = spark.createDataFrame(items, schemas.ORDER_ITEMS)
    s_cats = spark.createDataFrame(cats, schemas.CATEGORIES)
    con = _duck(users, orders, products, items, cats)

    clv = portable(metrics.customer_lifetime_value(s_users, s_orders)).toPandas()
    want = con.sql(_sql(oracle.CLV, oracle.CLV_COLS)).df()
    assert _rows(clv) == _rows(want)
    assert len(clv) > 0

    pp = portable(metrics.product_performance(s_products, s_cats, s_items, s_orders),
                  ("total_quantity_sold", "current_stock")).toPandas()
    want = con.sql(_sql(oracle.PRODUCT_PERF, oracle.PP_COLS)).df()
    assert _rows(pp) == _rows(want)
    assert 1 in set(pp["product_id"])


def test_hot_keys_in_sales_summaries_and_orphan_counts(spark):
    from basketlens.operators import quality, sales

    users, orders, products, items, cats = _fixture(seed=11)
    s_users = spark.createDataFrame(users, schemas.USERS)
    s_orders = spark.createDataFrame(orders, schemas.ORDERS_OP)
    s_products = spark.createDataFrame(products, schemas.PRODUCTS)
    s_items = spark.createDataFrame(items, schemas.ORDER_ITEMS)
    s_cats = spark.createDataFrame(cats, schemas.CATEGORIES)
    con = _duck(users, orders, products, items, cats)
    extract_cte = f"WITH {oracle.EXTRACT[0]} AS ({oracle.EXTRACT[1]}) "

    extract = sales.daily_sales_extract(s_orders, s_items, s_products, s_cats, s_users)
    daily = portable(sales.daily_sales_summary(extract)).toPandas()
    assert _rows(daily) == _rows(con.sql(extract_cte + oracle.DAILY_SUMMARY_SQL).df())
    hourly = portable(sales.hourly_sales_summary(extract)).toPandas()
    assert _rows(hourly) == _rows(con.sql(extract_cte + oracle.HOURLY_SUMMARY_SQL).df())
    assert len(daily) > 0

    orphans = quality.check_referential_integrity(s_items, "order_id", s_orders, "id").first()
    want = con.sql("SELECT COUNT(*) FROM shop_order_items c LEFT JOIN shop_orders p "
                   "ON c.order_id = p.id WHERE p.id IS NULL AND c.order_id IS NOT NULL").fetchall()[0][0]
    assert orphans.orphaned_records == want and want > 0


def test_hot_cart_and_hot_day_in_the_funnel(spark):
    rng = np.random.default_rng(5)
    users, orders, products, items, cats = _fixture(seed=3)
    base = dt.datetime(2024, 1, 1)
    sessions = [(base + dt.timedelta(hours=int(rng.integers(0, 24 * 10))),) for _ in range(300)]
    carts = [(c, c) for c in range(1, 21)]
    cart_items = []
    for i in range(600):
        cart = 1 if i % 3 == 0 else (None if i % 3 == 1 else int(rng.integers(1, 25)))
        when = base + dt.timedelta(hours=int(rng.integers(0, 24 * 10)))
        if i % 5 == 0:
            when = base + dt.timedelta(days=3, minutes=i)          # one hot day
        cart_items.append((i, cart, when))
    s_sessions = spark.createDataFrame(sessions, "created_at timestamp_ntz")
    s_carts = spark.createDataFrame(carts, "id bigint, user_id bigint")
    s_items = spark.createDataFrame(cart_items, "id bigint, cart_id bigint, created_at timestamp_ntz")
    s_orders = spark.createDataFrame(orders, schemas.ORDERS_OP)
    con = _duck(users, orders, products, items, cats)
    con.register("ss", pd.DataFrame(sessions, columns=["created_at"]))
    con.register("cc", pd.DataFrame(carts, columns=["id", "user_id"]))
    con.register("ci", pd.DataFrame(cart_items, columns=["id", "cart_id", "created_at"]))
    con.execute("CREATE TABLE shop_sessions AS SELECT created_at::TIMESTAMP created_at FROM ss")
    con.execute("CREATE TABLE shop_carts AS SELECT id::BIGINT id, user_id::BIGINT user_id FROM cc")
    con.execute("CREATE TABLE shop_cart_items AS SELECT id::BIGINT id, cart_id::BIGINT cart_id, "
                "created_at::TIMESTAMP created_at FROM ci")

    got = portable(metrics.funnel_daily_metrics(s_sessions, s_items, s_carts, s_orders)).toPandas()
    con.execute(f"CREATE OR REPLACE TABLE by_day AS {oracle.FUNNEL_WIDE[1]}")
    want = con.sql(_sql(oracle.FUNNEL_LONG, [
        "CAST(metric_date AS TIMESTAMP) AS metric_date", "metric_type",
        "CAST(metric_value AS BIGINT) AS metric_value"])).df()
    assert _rows(got) == _rows(want)
    wide = portable(metrics.sales_funnel(s_sessions, s_items, s_carts, s_orders),
                    ("page_views", "cart_additions", "checkouts_started",
                     "orders_completed")).toPandas()
    want = con.sql(f"WITH {oracle.FUNNEL[0]} AS ({oracle.FUNNEL[1]}) "
                   f"SELECT {', '.join(oracle.FUNNEL_COLS)} FROM funnel").df()
    assert _rows(wide) == _rows(want)

"""Dimensions, the item-grain fact and the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.values import date_key, day_difference, hash_key, ratio, share_half_up
from tidemark.operators.versions import scd2_lookup, time_cuts, time_range

#: Statuses that count as success and as failure.
SUCCESS, FAILURE = ("delivered",), ("canceled", "unavailable")
#: Sellers that are sent to all tasks at most (about 60 MB); more are met by an exchange of the items.
SELLERS = 500_000


def dim_date(orders: DataFrame, *times: str) -> DataFrame:
    """One row per calendar day of any of the time columns; one scan, not one per column."""
    days = orders.select(F.explode(F.array(*(F.to_date(t) for t in times))).alias("date")).where("date is not null").distinct()
    d = F.col("date")
    return days.select(
        date_key("date").alias("date_key"), "date", F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.rpad(F.date_format(d, "MMMM"), 9, " ").alias("month_name"), F.weekofyear(d).alias("week"), F.dayofmonth(d).alias("day"),
        (F.dayofweek(d) - 1).alias("day_of_week"), F.date_format(d, "yyyy-MM").alias("year_month"), F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    )


def dim_status(orders: DataFrame, status: str = "status") -> DataFrame:
    return orders.select(F.col(status).alias("status")).distinct().select(
        hash_key("status").alias("status_key"), "status", F.col("status").isin(*SUCCESS).cast("int").alias("is_success"), F.col("status").isin(*FAILURE).cast("int").alias("is_failure"),
    )


def dim_seller(sellers: DataFrame, key: str, *attributes: str) -> DataFrame:
    return sellers.select(hash_key(key).alias("seller_key"), key, *attributes)


def allocate(items: DataFrame, payments: DataFrame, *carry: str) -> DataFrame:
    """What each item bears of its order's payments, by its share of the order's gross; null at gross 0.

    Further columns of the items can be carried along, so that no later join has to bring them back.
    """
    gross = F.col("price_cents") + F.col("freight_cents")
    rows = items.select("order_id", "item_no", *carry, gross.alias("gross_cents"), F.sum(gross).over(Window.partitionBy("order_id")).alias("order_gross_cents"))
    paid = payments.groupBy("order_id").agg(F.sum("paid_cents").alias("paid_cents"))
    share = share_half_up(F.col("gross_cents"), F.col("order_gross_cents"), F.col("paid_cents"))
    return rows.join(paid, "order_id", "left").select("order_id", "item_no", *carry, "gross_cents", "order_gross_cents", "paid_cents", share.alias("allocated_cents"))


def version_key(key: str, valid_from: str) -> Column:
    """The key of a type-2 version: of its entity and when it began."""
    return hash_key(key, F.date_format(valid_from, "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def fact_items(items: DataFrame, orders: DataFrame, customers: DataFrame, sellers: DataFrame, versions: DataFrame, products: DataFrame, changes: DataFrame, listings: DataFrame | None = None) -> DataFrame:
    """One row per order item with keys, money and delivery measures.

    ``items`` are allocated ones. Orders join inner, all lookups left. ``versions`` is a type-2
    dimension by unique_id and ``products`` one by listing_id, a column of the items; both are looked
    up at the purchase time, and their keys are made of what was found. ``changes`` has the times of the
    events behind the versions in its first column. ``listings`` is a cheaper table than the items with
    their order_id and listing_id; listings without versions may be left out.

    Items and orders are spread by order once. Only orders, keys and times go to the versions, and
    only when a version began comes back; days are days from the start and texts are made at the end.
    """
    cuts = time_cuts(orders.select("purchase"), changes)
    customers = customers.select("customer_id", "unique_id")
    began = [d.select(k, "valid_from", "valid_to", F.col("valid_from").alias("since")) for d, k in ((versions, "unique_id"), (products, "listing_id"))]
    version = lambda key: F.when(F.col("since").isNotNull(), version_key(key, "since"))
    at = orders.select("order_id", "customer_id", "purchase", time_range(orders, "purchase", cuts).alias("place"))
    placed = orders.select("order_id", "customer_id", "status", "purchase", *(F.to_date(c).alias(c) for c in ("approved", "delivered", "estimated"))).join(customers, "customer_id", "left").repartition("order_id")
    placed = scd2_lookup(placed, began[0], "unique_id", "purchase", "since", cuts, at.join(customers, "customer_id"), "order_id", "place")
    placed = placed.select(  # once an order, not once an item
        "order_id", "customer_id", "unique_id", "purchase", version("unique_id").alias("customer_version_key"), hash_key("status").alias("status_key"),
        date_key("purchase").alias("purchase_date_key"), date_key("approved").alias("approved_date_key"), date_key("delivered").alias("delivered_date_key"), date_key("estimated").alias("estimated_date_key"),
        day_difference("delivered", "purchase").alias("delivery_days"), day_difference("delivered", "estimated").alias("delay_days"), (F.col("delivered") > F.col("estimated")).cast("int").alias("is_late"),
    )
    bought = (items if listings is None else listings).select("order_id", "listing_id").join(at.drop("customer_id"), "order_id")
    rows = scd2_lookup(items.join(placed, "order_id"), began[1], "listing_id", "purchase", "since", cuts, bought, "order_id", "place")
    sellers = sellers.select("seller_id", "seller_key")
    rows = rows.join(F.broadcast(sellers) if sellers.count() <= SELLERS else sellers, "seller_id", "left")  # last, so that no exchange carries its key
    return rows.select(
        hash_key("order_id", "item_no").alias("item_key"), "order_id", "item_no", "customer_id", "unique_id", "customer_version_key", "seller_key",
        hash_key("product_id").alias("product_key"), version("listing_id").alias("product_version_key"), "status_key",
        "purchase_date_key", "approved_date_key", "delivered_date_key", "estimated_date_key", "price_cents", "freight_cents", "allocated_cents", "delivery_days", "delay_days", "is_late",
    )


def mart_daily(fact: DataFrame) -> DataFrame:
    """Revenue per purchase day; an item without an allocation counts with its gross.

    ``fact`` has order_id, customer_id, purchase_day, status, price, freight and allocated cents. Items
    are first summed to orders, so one pass serves item and order figures and no distinct count is needed
    for orders.
    """
    gross = F.col("price_cents") + F.col("freight_cents")
    per_order = fact.groupBy("purchase_day", "order_id", "customer_id", "status").agg(
        F.count("*").alias("items"), F.sum("price_cents").alias("price_cents"), F.sum("freight_cents").alias("freight_cents"), F.sum(F.coalesce("allocated_cents", gross)).alias("paid_cents"),
    )
    done = F.col("status").isin(*SUCCESS)
    out = per_order.groupBy("purchase_day").agg(
        F.sum("items").alias("items"), F.count("*").alias("orders"), F.count_distinct("customer_id").alias("customers"), F.count_if(done).alias("delivered_orders"), F.count_if(F.col("status").isin(*FAILURE)).alias("failed_orders"),
        F.sum("price_cents").alias("price_cents"), F.sum("freight_cents").alias("freight_cents"), F.sum("paid_cents").alias("paid_cents"),
    )
    average = F.floor(F.col("paid_cents").cast("double") / F.col("orders").cast("double") + F.lit(0.5)).cast("bigint")
    return out.withColumn("gross_cents", F.col("price_cents") + F.col("freight_cents")).withColumn("average_order_cents", average)


def mart_monthly(fact: DataFrame) -> DataFrame:
    """Revenue per user and month: customer-months first, then months."""
    gross = F.col("price_cents") + F.col("freight_cents")
    month = F.trunc("purchase_day", "MM")
    per_order = fact.groupBy(month.alias("month"), "unique_id", "order_id").agg(F.sum(F.coalesce("allocated_cents", gross)).alias("paid_cents"))
    per_user = per_order.groupBy("month", "unique_id").agg(F.count("*").alias("orders"), F.sum("paid_cents").alias("paid_cents"))
    out = per_user.groupBy("month").agg(F.count("*").alias("active_customers"), F.sum("orders").alias("orders"), F.sum("paid_cents").alias("paid_cents"), F.count_if(F.col("orders") > 1).alias("repeat_customers"))
    half_up = lambda n, d: F.floor(ratio(F.col(n), F.col(d)) + F.lit(0.5)).cast("bigint")
    return out.withColumn("arpu_cents", half_up("paid_cents", "active_customers")).withColumn("aov_cents", half_up("paid_cents", "orders")).withColumn("orders_per_customer", ratio(F.col("orders"), F.col("active_customers"))).withColumn("repeat_rate", ratio(F.col("repeat_customers"), F.col("active_customers")))

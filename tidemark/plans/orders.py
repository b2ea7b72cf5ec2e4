"""Reports on customers, orders and products."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.filters import above_average
from ..operators.joins import join_using
from .runner import Frames, require


def customers_with_orders(frames: Frames) -> DataFrame:
    """Every order beside its customer. One customer may own many orders."""
    customers, orders = require(frames, ["customer_df", "orders_df"])
    return join_using(customers, orders, ["customer_id"])


def order_totals(details: DataFrame) -> DataFrame:
    """Value of each order: quantity times unit price over its lines."""
    value = F.col("Quantity") * F.col("UnitPrice")
    return details.groupBy("OrderID").agg(F.sum(value).alias("TotalOrderValue"))


def orders_in_value_range(frames: Frames, low: float = 1000, high: float = 2000) -> DataFrame:
    """Orders whose value lies in a closed range.

    Totals are computed and filtered before the join, so it meets only orders
    that can be in the result.
    """
    orders, details = require(frames, ["orders_df", "order_details_df"])
    totals = order_totals(details).where(F.col("TotalOrderValue").between(low, high))
    return join_using(orders.select("OrderID"), totals, ["OrderID"])


def customers_in_cities(frames: Frames, at_least: int = 3) -> DataFrame:
    """Customers whose orders went to several distinct cities."""
    customers, orders = require(frames, ["customers_df", "orders_df"])
    cities = F.count_distinct("ShippingCity").alias("DistinctCitiesCount")
    counted = orders.groupBy("CustomerID").agg(cities)
    many = counted.where(F.col("DistinctCitiesCount") >= at_least)
    return join_using(many, customers, ["CustomerID"]).select(
        "CustomerName", "DistinctCitiesCount"
    )


def products_above_average(frames: Frames) -> DataFrame:
    """Products that cost more than the average product."""
    (products,) = require(frames, ["products_df"])
    return above_average(products, "Price").select("ProductName", "Price")

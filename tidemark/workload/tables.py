"""The test tables in the shape the reports expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import join_using

MONEY = "decimal(12,2)"

# Day the monthly report runs for, and the instants of the three loads.
DATA_DATE = "1998-03-05"
LOAD_DAYS = ("2001-06-01", "2001-07-01", "2001-08-01")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(column: str) -> Column:
    """Exact decimals: sums do not depend on the order rows arrive in."""
    return F.col(column).cast(MONEY)


def instant(day: str) -> Column:
    return F.lit(day).cast("timestamp_ntz")


def order_book(orders: DataFrame, day: str) -> DataFrame:
    """Orders as they stood on a day: not yet placed ones are missing, those
    older than six years are purged, and the others age through three stages.
    The settlement day is unknown until an order is settled."""
    placed = F.col("o_orderdate")
    today = F.lit(day).cast("date")
    age = F.date_diff(today, placed.cast("date"))
    settled = age > 120
    return (
        orders.where(
            (placed < F.date_add(today, 1).cast("timestamp_ntz"))
            & (placed >= F.add_months(today, -72).cast("timestamp_ntz"))
        ).select(
            "o_orderkey",
            "o_custkey",
            "o_orderpriority",
            money("o_totalprice").alias("total_price"),
            F.when(age <= 30, "NEW").when(settled, "SETTLED").otherwise("DUE").alias("stage"),
            F.when(settled, F.date_add(placed.cast("date"), 120)).alias("settled_on"),
        )
    )


def report_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Inputs of the monthly report."""
    customer = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders")
    lineitem = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    loaded = F.date_sub(F.lit(DATA_DATE).cast("date"), 1).alias("ds_partition_date")
    segment = F.col("c_mktsegment")
    opened = orders.groupBy(F.col("o_custkey").alias("CustomerID")).agg(
        F.min("o_orderdate").cast("date").alias("OpenDate")
    )
    return {
        "customers": customer.select(
            F.col("c_custkey").alias("CustomerID"),
            F.col("c_name").alias("Name"),
            F.concat(F.lower("c_name"), F.lit("@example.com")).alias("Email"),
            F.when(segment == "BUILDING", "Premium")
            .when(segment == "MACHINERY", "Standard")
            .otherwise(segment)
            .alias("AccountType"),
            F.col("c_nationkey").alias("BranchID"),
            loaded,
        ),
        "accounts": customer.select(
            F.col("c_custkey").alias("CustomerID"), money("c_acctbal").alias("Balance")
        ).join(opened, "CustomerID"),
        "branches": nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").alias("BranchID"),
            F.col("n_name").alias("BranchName"),
            F.col("r_name").alias("Location"),
            loaded,
        ),
        "services": part.select(
            F.col("p_partkey").alias("ServiceID"),
            F.col("p_brand").alias("ServiceName"),
            F.col("p_type").alias("ServiceType"),
        ),
        "transactions": orders.select(
            F.col("o_orderkey").alias("TransactionID"),
            F.col("o_custkey").alias("CustomerID"),
            F.col("o_orderdate").alias("TransactionDate"),
        ),
        "transaction_details": lineitem.select(
            F.col("l_orderkey").alias("TransactionID"),
            F.col("l_partkey").alias("ServiceID"),
            money("l_extendedprice").alias("Amount"),
        ),
        "loans": loans(orders),
        "loan_payments": loan_payments(lineitem),
    }


def loans(orders: DataFrame) -> DataFrame:
    """Each order as a loan; the digit of its priority is the rate."""
    return orders.select(
        F.col("o_orderkey").alias("LoanID"),
        F.col("o_custkey").alias("CustomerID"),
        money("o_totalprice").alias("LoanAmount"),
        F.substring("o_orderpriority", 1, 1).cast("decimal(4,2)").alias("InterestRate"),
        F.col("o_orderdate").alias("LoanStartDate"),
    )


def loan_payments(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_orderkey").alias("LoanID"),
        F.col("l_shipdate").alias("PaymentDate"),
        money("l_extendedprice").alias("PaymentAmount"),
    )


def order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("OrderID"),
        F.col("l_quantity").cast("decimal(5,2)").alias("Quantity"),
        money("l_extendedprice").alias("UnitPrice"),
    )


def shipping_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order with the nations its lines ship from."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("ShippingCity")
    )
    # However many lines an order has, each nation is told once.
    shipped = join_using(lines, suppliers, ["l_suppkey"]).select("l_orderkey", "ShippingCity")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("CustomerID")
    )
    return shipped.distinct().join(orders, "l_orderkey").select("CustomerID", "ShippingCity")


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's purchases are the successful runs of that user's daily job."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("job_"), F.col("user_id").cast("string")).alias("job_name"),
        F.col("ts").cast("date").alias("data_date"),
        F.when(F.col("event_type") == "purchase", "SUCCESS").otherwise("failed").alias("job_state"),
    )

"""One query per operator, each over whole tables.

``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame``. Money leaves a
query as a double; inside it is a decimal.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import customer_category, month_bounds, month_window, row_hash
from ..operators import changes, filters, scd
from ..operators.changes import HASH
from ..operators.joins import join_on, join_using
from ..plans import monthly, orders as reports
from ..plans.readiness import (
    blocked_dependencies,
    expected_runs,
    input_readiness,
    logged_span,
)
from ..plans.registry import registry
from ..plans.runner import run
from ..sinks import write_feed, write_output, write_scd
from ..sources.inputs import read_input
from ..tables.files import scratch_dir
from . import tables as t
from .tables import DATA_DATE, LOAD_DAYS, instant, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ORDER_KEY = ["o_orderkey"]


def query(function: Query) -> Query:
    def shown(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = function(spark, sf_dir)
        return df.select(
            *[
                F.col(f"`{f.name}`").cast("double").alias(f.name)
                if isinstance(f.dataType, T.DecimalType)
                else F.col(f"`{f.name}`")
                for f in df.schema
            ]
        )

    QUERIES[function.__name__.lstrip("_")] = shown
    return function


# -- sources and sinks --------------------------------------------------------


@query
def src_csv(spark, sf_dir):
    path = f"{scratch_dir(spark)}/orders"
    original = table(spark, sf_dir, "orders")
    write_output(spark, original, {"format": "csv", "path": path})
    entry = {"format": "csv", "path": path, "options": {"header": True, "inferSchema": True}}
    read = read_input(spark, entry)
    return read.select(*[F.col(f.name).cast(f.dataType) for f in original.schema])


@query
def src_columnar(spark, sf_dir):
    return read_input(spark, {"format": "delta", "path": f"{sf_dir}/orders.parquet"})


@query
def src_table(spark, sf_dir):
    table(spark, sf_dir, "part").createOrReplaceTempView("tidemark_part")
    return read_input(spark, {"format": "delta", "table": "tidemark_part"})


@query
def src_cached(spark, sf_dir):
    entry = {
        "format": "parquet",
        "path": f"{sf_dir}/customer.parquet",
        "isCache": True,
        "persistentLevel": "MEMORY_AND_DISK",
    }
    customer = read_input(spark, entry)
    per_segment = customer.groupBy("c_mktsegment").agg(F.count("*").alias("customers"))
    total = customer.agg(F.count("*").alias("total")).scalar()
    return per_segment.withColumn("total", total)


@query
def sink_overwrite(spark, sf_dir):
    output = {"format": "parquet", "path": f"{scratch_dir(spark)}/part"}
    part = table(spark, sf_dir, "part")
    write_output(spark, part.drop("p_size"), output)
    write_output(spark, part, output)
    return read_input(spark, output)


@query
def sink_append(spark, sf_dir):
    output = {"format": "parquet", "path": f"{scratch_dir(spark)}/part", "mode": "append"}
    part = table(spark, sf_dir, "part")
    write_output(spark, part, output)
    write_output(spark, part, output)
    return read_input(spark, output)


@query
def sink_table(spark, sf_dir):
    name = "tidemark_sink_table"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    output = {
        "format": "parquet",
        "table": name,
        "options": {"path": f"{scratch_dir(spark)}/{name}"},
    }
    for name in ("part", "supplier", "part"):  # other columns, and back
        write_output(spark, table(spark, sf_dir, name), output)
    return read_input(spark, {k: v for k, v in output.items() if k != "options"})


@query
def sink_rerun(spark, sf_dir):
    """Two dates are written, then the second one again from other rows."""
    output = {
        "format": "parquet",
        "path": f"{scratch_dir(spark)}/orders",
        "partition_by": ["data_date"],
        "mode": "overwrite_partitions",
    }
    book = table(spark, sf_dir, "orders")
    for day, rows in ((0, book), (1, book), (1, book.where("o_orderstatus = 'F'"))):
        write_output(spark, rows, output, data_date=LOAD_DAYS[day])
    return read_input(spark, output)


@query
def sink_partitioned(spark, sf_dir):
    output = {
        "format": "delta",
        "path": f"{scratch_dir(spark)}/orders",
        "partition_by": ["data_date", "o_orderstatus"],
        "mode": "append",
    }
    book = table(spark, sf_dir, "orders")
    for day in LOAD_DAYS[:2]:
        write_output(spark, book, output, data_date=day)
    return filters.on_day(read_input(spark, output), "data_date", LOAD_DAYS[1])


@query
def sink_text_partitions(spark, sf_dir):
    """Partition values that look like numbers, through the published view."""
    name = "tidemark_text_partitions"
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    part = table(spark, sf_dir, "part")
    code = F.when(F.col("p_size") % 7 == 0, "").otherwise(F.lpad(F.col("p_size").cast("string"), 4, "0"))
    conf = {
        "type": "scd1",
        "table": name,
        "path": f"{scratch_dir(spark)}/part",
        "primary_keys": ["p_partkey"],
        "partition_by": ["p_code"],
    }
    write_scd(spark, part.select("p_partkey", "p_name", code.alias("p_code")), conf)
    return read_input(spark, {"format": "parquet", "table": name})


# -- configured jobs ----------------------------------------------------------


@registry.register("orders_with_customer_key")
def _orders_with_customer_key(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_custkey").alias("c_custkey"), t.money("o_totalprice").alias("value")
    )


@registry.register("value_per_segment")
def _value_per_segment(joined: DataFrame) -> DataFrame:
    return joined.groupBy("c_mktsegment").agg(
        F.count("*").alias("orders"), F.sum("value").alias("value")
    )


@query
def pipeline_config(spark, sf_dir):
    target = f"{scratch_dir(spark)}/segments"
    config = {
        "input": [
            {"df_name": n, "format": "delta", "path": f"{sf_dir}/{n}.parquet"}
            for n in ("customer", "orders")
        ],
        "transformation": [
            {"name": "orders_with_customer_key", "inputs": ["orders"], "output": "keyed"},
            {
                "name": "join_df",
                "inputs": ["customer", "keyed"],
                "params": {"join_cols": ["c_custkey"], "how": "inner"},
            },
            {"name": "value_per_segment", "output": "segments"},
        ],
        "outputs": {
            "dataframe": "segments",
            "format": "delta",
            "scd": {"type": "scd1", "path": target, "primary_keys": ["c_mktsegment"]},
        },
    }
    run(spark, json.loads(json.dumps(config)), DATA_DATE)
    return read_input(spark, {"format": "delta", "path": target})


# -- filters, expressions -----------------------------------------------------


@query
def filter_prev_day(spark, sf_dir):
    return filters.on_previous_day(table(spark, sf_dir, "events"), "ts", "2024-01-16").select(
        "event_id", "ts", "user_id", "event_type"
    )


@query
def filter_month(spark, sf_dir):
    return filters.in_month(table(spark, sf_dir, "orders"), "o_orderdate", DATA_DATE).select(
        "o_orderkey", "o_custkey", "o_orderdate"
    )


@query
def filter_compare(spark, sf_dir):
    rich = F.col("c_acctbal") > 5000
    named = (F.col("c_mktsegment") == "BUILDING") | (F.col("c_nationkey") <= 4)
    return table(spark, sf_dir, "customer").where(rich & named)


@query
def filter_like(spark, sf_dir):
    return table(spark, sf_dir, "part").where(F.col("p_name").like("%ing%"))


@query
def filter_in(spark, sf_dir):
    return table(spark, sf_dir, "part").where(F.col("p_type").isin("ECONOMY", "PROMO"))


@query
def _month_bounds(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    days = table(spark, sf_dir, "orders").select(day.alias("order_day")).distinct()
    return days.select("order_day", *month_bounds(F.col("order_day")))


@query
def _row_hash(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").withColumn("balance", t.money("c_acctbal"))
    return customer.select(
        "c_custkey",
        row_hash(["c_name", "c_mktsegment", "c_nationkey", "balance"]).alias("hash_data"),
    )


@query
def _customer_category(spark, sf_dir):
    spent = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("CustomerID")).agg(
        F.sum(t.money("o_totalprice")).alias("spent"),
        F.max(t.money("o_totalprice")).alias("loaned"),
    )
    who = t.report_inputs(spark, sf_dir)["customers"].select("CustomerID", "AccountType")
    category = customer_category(F.col("AccountType"), F.col("spent"), F.col("loaned"))
    return join_using(who, spent, ["CustomerID"], "left").select(
        "CustomerID", "AccountType", "spent", category.alias("CustomerCategory")
    )


# -- joins, unions ------------------------------------------------------------


@query
def join_customer_orders(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "customer_id")
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "customer_id")
    return reports.customers_with_orders({"customer_df": customer, "orders_df": orders})


def _generic_sides(spark, sf_dir):
    """Most customers have no event, some have very many."""
    customer = table(spark, sf_dir, "customer")
    events = table(spark, sf_dir, "events")
    return (
        customer.select(F.col("c_custkey").alias("key"), "c_name"),
        events.select(F.col("user_id").alias("key"), "event_id", "event_type"),
    )


def _generic_join(how: str) -> Query:
    def joined(spark, sf_dir):
        left, right = _generic_sides(spark, sf_dir)
        df = join_on(left, right, ["key"], how)
        if how in ("semi", "anti"):
            return df
        return df.select(
            F.col("df1.key").alias("left_key"),
            "c_name",
            F.col("df2.key").alias("right_key"),
            "event_id",
            "event_type",
        )

    joined.__name__ = f"join_generic_{how}"
    return joined


for _how in ("inner", "left", "right", "full", "semi", "anti"):
    query(_generic_join(_how))


@query
def union_by_name(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nation"),
        F.col("s_name").alias("name"),
        t.money("s_acctbal").alias("balance"),
    )
    return customer.unionByName(supplier, allowMissingColumns=True)


# -- reports ------------------------------------------------------------------


@query
def order_totals(spark, sf_dir):
    return reports.order_totals(t.order_details(spark, sf_dir))


@query
def orders_value_range(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "OrderID")
    frames = {"orders_df": orders, "order_details_df": t.order_details(spark, sf_dir)}
    return reports.orders_in_value_range(frames, 100000, 500000)


@query
def customers_multi_city(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("CustomerID"), F.col("c_name").alias("CustomerName")
    )
    frames = {"customers_df": customers, "orders_df": t.shipping_cities(spark, sf_dir)}
    return reports.customers_in_cities(frames)


@query
def products_above_avg(spark, sf_dir):
    products = table(spark, sf_dir, "part").select(
        F.col("p_name").alias("ProductName"), t.money("p_retailprice").alias("Price")
    )
    return reports.products_above_average({"products_df": products})


def _loan_summary(spark, sf_dir, fan_out):
    window = month_window(DATA_DATE)
    return monthly.loan_summary(
        t.loans(table(spark, sf_dir, "orders")),
        t.loan_payments(table(spark, sf_dir, "lineitem")),
        window.first_day,
        window.last_day,
        fan_out,
    )


@query
def loan_summary(spark, sf_dir):
    return _loan_summary(spark, sf_dir, False)


@query
def loan_summary_fanout(spark, sf_dir):
    return _loan_summary(spark, sf_dir, True)


@query
def monthly_customer_loans(spark, sf_dir):
    return monthly.monthly_customer_report(
        t.report_inputs(spark, sf_dir),
        DATA_DATE,
        min_balance=1000,
        service_types=("ECONOMY", "PROMO"),
        location_like="%A%",
    )


@query
def monthly_customer_loans_literal(spark, sf_dir):
    """Every branch, and loans counted once per payment."""
    return monthly.monthly_customer_report(
        t.report_inputs(spark, sf_dir),
        DATA_DATE,
        min_balance=1000,
        service_types=("ECONOMY", "PROMO"),
        all_branches=True,
        fan_out=True,
    )


# -- slowly changing dimensions -----------------------------------------------


def _books(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return [t.order_book(orders, day) for day in LOAD_DAYS]


@query
def scd1_init(spark, sf_dir):
    return scd.scd1_merge(None, _books(spark, sf_dir)[0], ORDER_KEY)


@query
def scd1_merge(spark, sf_dir):
    old, new, _ = _books(spark, sf_dir)
    return scd.scd1_merge(old, new, ORDER_KEY)


@query
def scd1_composite(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    reviewed = turns.where(F.col("role") == "assistant").withColumn(
        "text", F.concat(F.lit("[reviewed] "), "text")
    )
    closing = turns.groupBy("conv_id").agg(
        (F.max("turn") + 1).alias("turn"),
        F.lit("system").alias("role"),
        F.concat(F.count("*").cast("string"), F.lit(" turns")).alias("text"),
    )
    return scd.scd1_merge(turns, reviewed.unionByName(closing), ["conv_id", "turn"])


@query
def scd1_evolve(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    activity = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_orderpriority").alias("c_mktsegment"), F.count("*").alias("order_count")
    )
    return scd.scd1_merge(customer, activity, ["c_custkey"])


@query
def scd1_map(spark, sf_dir):
    """An attribute that has no hash and no order."""
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", F.create_map(F.lit("segment"), "c_mktsegment").alias("tags")
    )
    activity = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.create_map(F.lit("orders"), F.count("*").cast("string")).alias("tags")
    )
    merged = scd.scd1_merge(customer, activity, ["c_custkey"])
    return merged.select(
        "c_custkey",
        F.try_element_at("tags", F.lit("segment")).alias("segment"),
        F.try_element_at("tags", F.lit("orders")).alias("orders"),
    )


@query
def scd1_stored(spark, sf_dir):
    """A second load into a stored table."""
    path = f"{scratch_dir(spark)}/orders"
    conf = {"type": "scd1", "path": path, "primary_keys": ORDER_KEY, "stage_source": False}
    for book in _books(spark, sf_dir)[:2]:
        write_scd(spark, book, conf)
    return read_input(spark, {"format": "delta", "path": path})


def _after_two(spark, sf_dir, **options):
    old, new, _ = _books(spark, sf_dir)
    first, second = (instant(day) for day in LOAD_DAYS[:2])
    target = scd.scd2_init(old, ORDER_KEY, first)
    return scd.scd2_merge(target, new, ORDER_KEY, second, **options)


@query
def scd2_init(spark, sf_dir):
    return scd.scd2_init(_books(spark, sf_dir)[0], ORDER_KEY, instant(LOAD_DAYS[0])).drop(HASH)


@query
def scd2_changed(spark, sf_dir):
    old, new, _ = _books(spark, sf_dir)
    return changes.changed_keys(old, new, ORDER_KEY)


@query
def scd2_merge(spark, sf_dir):
    return _after_two(spark, sf_dir).drop(HASH)


@query
def scd2_expire_missing(spark, sf_dir):
    return _after_two(spark, sf_dir, expire_missing=True).drop(HASH)


@query
def scd2_no_new_keys(spark, sf_dir):
    return _after_two(spark, sf_dir, insert_new=False).drop(HASH)


@query
def scd2_third_load(spark, sf_dir):
    target = _after_two(spark, sf_dir)
    third = _books(spark, sf_dir)[2]
    return scd.scd2_merge(target, third, ORDER_KEY, instant(LOAD_DAYS[2])).drop(HASH)


@query
def scd2_stored(spark, sf_dir):
    """Three loads into a stored table, read back."""
    path = f"{scratch_dir(spark)}/orders"
    conf = {"path": path, "primary_keys": ORDER_KEY}
    for day, book in zip(LOAD_DAYS, _books(spark, sf_dir)):
        output = {"format": "delta", "scd": conf}
        write_output(spark, book, output, day, instant(day))
    return read_input(spark, {"format": "delta", "path": path}).drop(HASH)


@query
def scd2_unchanged(spark, sf_dir):
    """A load that changes nothing commits nothing."""
    path = f"{scratch_dir(spark)}/orders"
    conf = {"path": path, "primary_keys": ORDER_KEY, "expire_missing": True}
    book = _books(spark, sf_dir)[0]
    loads = [write_scd(spark, book, conf, instant(day)) for day in LOAD_DAYS]
    stored = read_input(spark, {"format": "delta", "path": path}).drop(HASH)
    return stored.withColumn("loads", F.lit(loads[-1]))


@query
def scd4_init(spark, sf_dir):
    return scd.scd4_init(_books(spark, sf_dir)[0], ORDER_KEY, instant(LOAD_DAYS[0])).drop(HASH)


@query
def scd4_classify(spark, sf_dir):
    old, new, _ = _books(spark, sf_dir)
    return changes.classify(old, new, ORDER_KEY)


@query
def scd_change_counts(spark, sf_dir):
    old, new, _ = _books(spark, sf_dir)
    return changes.classify(old, new, ORDER_KEY).groupBy("change").agg(
        F.count("*").alias("row_count")
    )


def _scd4_second(spark, sf_dir):
    old, new, _ = _books(spark, sf_dir)
    return scd.scd4_init(old, ORDER_KEY, instant(LOAD_DAYS[0])), new, instant(LOAD_DAYS[1])


@query
def scd4_history(spark, sf_dir):
    current, new, as_of = _scd4_second(spark, sf_dir)
    closed = scd.scd4_history(current, new, ORDER_KEY, as_of)
    return current.unionByName(closed).drop(HASH)


@query
def scd4_current(spark, sf_dir):
    current, new, as_of = _scd4_second(spark, sf_dir)
    return scd.scd4_current(current, new, ORDER_KEY, as_of).drop(HASH)


def _stored_pair(spark, paths):
    """Current and history of a stored type 4 dimension, told apart by ``part``."""
    current = read_input(spark, {"format": "delta", "path": paths["current"]})
    history = read_input(spark, {"format": "delta", "path": paths["history"]})
    return (
        current.withColumn("part", F.lit("current"))
        .unionByName(history.withColumn("part", F.lit("history")))
        .drop(HASH)
    )


def _pair_conf(spark):
    base = scratch_dir(spark)
    paths = {"current": f"{base}/current", "history": f"{base}/history"}
    return base, {"type": "scd4", "path": paths, "primary_keys": ORDER_KEY}


@query
def scd4_stored(spark, sf_dir):
    """Two loads into a stored pair of tables."""
    _, conf = _pair_conf(spark)
    for day, book in list(zip(LOAD_DAYS, _books(spark, sf_dir)))[:2]:
        write_scd(spark, book, conf, instant(day))
    return _stored_pair(spark, conf["path"])


@query
def scd4_unchanged(spark, sf_dir):
    """A load that changes nothing leaves both tables of a stored pair alone."""
    _, conf = _pair_conf(spark)
    book = _books(spark, sf_dir)[0]
    loads = [write_scd(spark, book, conf, instant(day)) for day in LOAD_DAYS[:2]]
    return _stored_pair(spark, conf["path"]).withColumn("loads", F.lit(loads[-1]))


@query
def change_feed(spark, sf_dir):
    old, new, _ = _books(spark, sf_dir)
    return changes.change_feed(old, new, ORDER_KEY)


def _applied(spark, sf_dir):
    old, new, _ = _books(spark, sf_dir)
    feed = changes.change_feed(old, new, ORDER_KEY)
    history = old.withColumn("end_date", F.lit(None).cast("timestamp_ntz"))
    return changes.apply_change_feed(old, history, feed, ORDER_KEY, instant(LOAD_DAYS[1]))


@query
def change_feed_apply(spark, sf_dir):
    return _applied(spark, sf_dir)[0]


@query
def change_feed_history(spark, sf_dir):
    return _applied(spark, sf_dir)[1]


def _versions(spark, sf_dir):
    """One feed that takes the first book to the third, by way of the second."""
    old, new, third = _books(spark, sf_dir)
    number = changes.COMMIT_VERSION
    first = changes.change_feed(old, new, ORDER_KEY).withColumn(number, F.lit(1))
    second = changes.change_feed(new, third, ORDER_KEY).withColumn(number, F.lit(2))
    history = old.limit(0).withColumn("end_date", F.lit(None).cast("timestamp_ntz"))
    feed = first.unionByName(second)
    return changes.apply_change_feed(old, history, feed, ORDER_KEY, instant(LOAD_DAYS[2]))


@query
def change_feed_versions(spark, sf_dir):
    return _versions(spark, sf_dir)[0]


@query
def change_feed_versions_history(spark, sf_dir):
    return _versions(spark, sf_dir)[1]


@query
def change_feed_stored(spark, sf_dir):
    """A first load, then a feed, into a stored pair of tables."""
    old, new, _ = _books(spark, sf_dir)
    base, conf = _pair_conf(spark)
    write_scd(spark, old, conf, instant(LOAD_DAYS[0]))
    feed = {"format": "parquet", "path": f"{base}/feed"}
    write_output(spark, changes.change_feed(old, new, ORDER_KEY), feed)
    write_feed(spark, read_input(spark, feed), conf, instant(LOAD_DAYS[1]))
    return _stored_pair(spark, conf["path"])


@query
def change_feed_first(spark, sf_dir):
    """A feed alone sets a dimension up."""
    old = _books(spark, sf_dir)[0]
    _, conf = _pair_conf(spark)
    feed = old.withColumn("_change_type", F.lit("insert"))
    write_feed(spark, feed, conf, instant(LOAD_DAYS[0]))
    return _stored_pair(spark, conf["path"])


# -- readiness ----------------------------------------------------------------


@query
def gate_dependencies(spark, sf_dir):
    """Every job on every day of the log's span: runs that failed, and runs that the
    log does not have."""
    log = t.run_log(spark, sf_dir)
    expected = expected_runs(log.select("job_name").distinct(), *logged_span(log))
    return blocked_dependencies(expected, log)


@query
def gate_inputs(spark, sf_dir):
    inputs = {
        name: (table(spark, sf_dir, name), column)
        for name, column in (
            ("events", "ts"),
            ("orders", "o_orderdate"),
            ("lineitem", "l_shipdate"),
        )
    }
    return input_readiness(inputs, "2001-08-15")

"""Physical plans: what is scanned, what shuffles, how rows spread."""

from __future__ import annotations

import contextlib
import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import change_feed, classify, join_on, scd1_merge, scd2_init, scd2_step, scd4_current
from tidemark.plans import service_activity
from tidemark.sinks import write_scd
from tidemark.tables import VersionedTable
from tidemark.workload import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@contextlib.contextmanager
def conf(spark, **settings):
    names = {k: "spark.sql." + k.replace("__", ".") for k in settings}
    before = {k: spark.conf.get(names[k]) for k in settings}
    for k, v in settings.items():
        spark.conf.set(names[k], v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(names[k], v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition|Round)", plan(df)))


def scans(df):
    return plan(df).count("FileScan")


@pytest.fixture
def pair(spark, tmp_path):
    """A table on disk and a small and a large load for it."""
    columns = "CAST(id AS INT) AS id", "repeat('x', 20) AS name", "id * 2 AS v"
    spark.range(20000).selectExpr(*columns).write.parquet(str(tmp_path / "old"))
    spark.range(15000, 25000).selectExpr(*columns).write.parquet(str(tmp_path / "new"))
    return spark.read.parquet(str(tmp_path / "old")), spark.read.parquet(str(tmp_path / "new"))


OPERATORS = {
    "classify": lambda old, new: classify(old, new, ["id"]),
    "change_feed": lambda old, new: change_feed(old, new, ["id"]),
    "scd1_merge": lambda old, new: scd1_merge(old, new, ["id"]),
    "scd2_step": lambda old, new: scd2_step(
        scd2_init(old, ["id"], F.lit("a")), new, ["id"], F.lit("b")
    ),
    "scd4_current": lambda old, new: scd4_current(
        scd2_init(old, ["id"], F.lit("a")), new, ["id"], F.lit("b")
    ),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_large_load_scans_and_shuffles_each_side_once(spark, pair, name):
    with conf(spark, autoBroadcastJoinThreshold="-1"):
        df = OPERATORS[name](*pair)
        assert (scans(df), shuffles(df)) == (2, 2)


def test_a_load_said_to_be_small_shuffles_nothing_and_gives_the_same_rows(spark, pair):
    old, new = pair
    first, second = F.lit("a"), F.lit("b")
    for operator in (
        lambda small: scd1_merge(old, new, ["id"], small=small),
        lambda small: scd2_step(scd2_init(old, ["id"], first), new, ["id"], second, small=small),
    ):
        assert shuffles(operator(True)) == 0
        assert shuffles(operator(False)) == 2
        assert operator(True).exceptAll(operator(False)).isEmpty()
        assert operator(False).exceptAll(operator(True)).isEmpty()


def test_classification_ships_keys_and_hashes_only(spark, pair):
    with conf(spark, autoBroadcastJoinThreshold="-1"):
        text = plan(classify(*pair, ["id"]))
    for line in re.findall(r"Exchange.*\n.*Project \[(.*)\]", text):
        assert "name#" not in re.sub(r"sha2\(.*?, 256\)", "", line)


def test_rows_without_a_key_spread(spark):
    nulls = spark.range(8000).selectExpr("IF(id < 0, 1, NULL) AS id", "id AS v")
    with conf(spark, autoBroadcastJoinThreshold="-1", adaptive__enabled="false"):
        parts = rows(classify(nulls, nulls.limit(10), ["id"]).groupBy(F.spark_partition_id()).count())
    assert len(parts) == 8 and max(n for _, n in parts) < 1600


@pytest.mark.parametrize("how", ["inner", "left", "full"])
def test_a_hot_key_is_split(spark, how):
    """Adaptive execution goes by bytes, so rows have some; many are equal."""
    key = "IF(id % 3 = 0, 7, CAST(id AS INT)) AS k"
    facts = spark.range(9000).selectExpr(key, "sha2(CAST(id % 999 AS STRING), 256) AS v")
    names = spark.range(9000).selectExpr("CAST(id AS INT) AS k", "'n' AS n")
    skew = {
        "adaptive__skewJoin__skewedPartitionThresholdInBytes": "1k",
        "adaptive__skewJoin__skewedPartitionFactor": "1.2",
        "adaptive__advisoryPartitionSizeInBytes": "8k",
        "adaptive__coalescePartitions__enabled": "false",
    }
    with conf(spark, autoBroadcastJoinThreshold="-1", **skew):
        joined = join_on(facts.repartition(6), names, ["k"], how).where("v IS NOT NULL")
        counted = joined.groupBy(F.spark_partition_id()).agg(F.count("*"), F.max("v"))
        parts = [n for _, n, _ in counted.collect()]
    assert sum(parts) == 9000
    assert max(parts) < 2500


@pytest.mark.parametrize("name, table, times", [
    ("scd2_third_load", "orders", 3),
    ("scd2_merge", "orders", 2),
    ("monthly_customer_loans", "lineitem", 2),
    ("customers_multi_city", "lineitem", 1),
    ("join_customer_orders", "orders", 1),
])
def test_how_often_tables_are_read(spark, name, table, times):
    text = plan(QUERIES[name](spark, SF_DIR)).partition("== Initial Plan")[0]
    scans = len(re.findall(rf"FileScan parquet .*{table}\.parquet", text))
    assert scans == times or times is None


def test_payments_of_the_month_alone_are_read(spark):
    text = plan(QUERIES["loan_summary"](spark, SF_DIR))
    assert "GreaterThanOrEqual(l_shipdate,1998-03-01" in text and "LessThan(l_shipdate" in text


def test_type_2_load_reads_open_rows_of_the_newest_load(spark, tmp_path):
    conf_ = {"path": str(tmp_path / "t"), "primary_keys": ["id"]}
    for i in range(3):
        write_scd(spark, spark.range(5).selectExpr("CAST(id AS INT) AS id", f"{i} AS v"), conf_)
    opened = VersionedTable(spark, conf_["path"], "ledger").read_open()
    assert opened.count() == 5
    assert {p.split("/tidemark_load=")[1].split("-")[0] for p in opened.inputFiles()} == {"3"}
    assert re.search(r"PartitionFilters: \[.*is_current", plan(opened))


@pytest.mark.parametrize(
    "name, pushed, columns",
    [
        ("filter_month", r"GreaterThanOrEqual\(o_orderdate", "o_orderkey:bigint,o_custkey:bigint,o_orderdate"),
        ("filter_in", r"In\(p_type, \[ECONOMY,PROMO\]\)", "p_partkey"),
        ("filter_like", r"StringContains\(p_name,ing\)", "p_partkey"),
        ("products_above_avg", "", "p_name:string,p_retailprice:double"),
        ("order_totals", "", "l_orderkey:bigint,l_quantity:double,l_extendedprice:double"),
    ],
)
def test_filters_and_columns_reach_the_scan(spark, name, pushed, columns):
    df = QUERIES[name](spark, SF_DIR)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    assert re.search(pushed, text) and columns in text


def test_monthly_report_reads_one_month_of_orders(spark):
    text = plan(QUERIES["monthly_customer_loans"](spark, SF_DIR))
    assert "o_orderdate >= 1998-03-01" in text or "GreaterThanOrEqual(o_orderdate,1998-03-01" in text


def test_report_reads_the_columns_it_needs(spark, tmp_path):
    shapes = {
        "transactions": "id AS TransactionID, id AS CustomerID",
        "details": "id AS TransactionID, id AS ServiceID, id AS Amount",
        "services": "id AS ServiceID, 'S' AS ServiceName",
    }
    frames = []
    for name, columns in shapes.items():
        path = str(tmp_path / name)
        spark.sql(f"SELECT {columns}, 'wide' AS unused FROM range(100)").write.parquet(path)
        frames.append(spark.read.parquet(path))
    with conf(spark, autoBroadcastJoinThreshold="-1"):
        text = plan(service_activity(*frames))
    assert "unused" not in text


def test_no_query_uses_python_workers_or_cross_joins(spark):
    for name, query in QUERIES.items():
        text = plan(query(spark, SF_DIR))
        for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in text, (name, word)

"""Replacing outputs without risk, runs that repeat, and values that change type."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F
from tidemark.operators import scd1_merge
from tidemark.operators.changes import align_types
from tidemark.plans import blocked_dependencies, expected_runs, logged_span
from tidemark.sinks import write_output
from tidemark.sinks.writers import recover_table

from conftest import rows


@pytest.fixture
def name(spark):
    table = f"swap_{uuid.uuid4().hex[:8]}"
    yield table
    for t in (table, f"{table}__before"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def leftovers(spark, name):
    return [t.name for t in spark.catalog.listTables() if t.name.startswith(name) and t.name != name]


def failing(spark):
    return spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("no"))).otherwise("x").alias("v"))


@pytest.mark.parametrize("external", [False, True])
def test_a_failing_overwrite_leaves_the_table(spark, name, external, tmp_path):
    output = {"format": "parquet", "table": name}
    if external:
        output["options"] = {"path": str(tmp_path / "t")}
    write_output(spark, spark.range(5).toDF("n"), output)
    with pytest.raises(Exception, match="no"):
        write_output(spark, failing(spark), output)
    assert rows(spark.table(name)) == [(i,) for i in range(5)]
    assert leftovers(spark, name) == []
    write_output(spark, spark.table(name).selectExpr("n * 10 AS m", "'a' AS c"), output)  # from itself
    assert rows(spark.table(name)) == [(i * 10, "a") for i in range(5)]
    assert leftovers(spark, name) == []
    if external:
        assert len(list((tmp_path / "t").iterdir())) == 1


def test_an_interrupted_swap_of_a_table_is_made_good(spark, name):
    output = {"format": "parquet", "table": name}
    write_output(spark, spark.range(2).toDF("n"), output)
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__before")  # died between two renames
    recover_table(spark, name)
    assert rows(spark.table(name)) == [(0,), (1,)]
    spark.range(1).write.saveAsTable(f"{name}__before")  # died before the old one went
    write_output(spark, spark.range(3).toDF("n"), output)
    assert rows(spark.table(name)) == [(0,), (1,), (2,)]
    assert leftovers(spark, name) == []


def test_an_interrupted_swap_of_a_path_is_made_good(spark, tmp_path):
    output = {"format": "parquet", "path": str(tmp_path / "out")}
    write_output(spark, spark.range(2), output)
    (tmp_path / "out").rename(tmp_path / "_out-before")
    with pytest.raises(Exception, match="no"):
        write_output(spark, failing(spark), output)
    assert (tmp_path / "_out-before").exists()  # nothing is lost
    write_output(spark, spark.range(3), output)
    assert spark.read.parquet(output["path"]).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


@pytest.mark.parametrize("kind", ["path", "table"])
def test_one_date_runs_again_beside_the_others(spark, name, kind, tmp_path):
    output = {
        "format": "parquet",
        kind: name if kind == "table" else str(tmp_path / "out"),
        "partition_by": ["data_date"],
        "mode": "overwrite_partitions",
    }
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    for day, n in (("2024-01-01", 3), ("2024-01-02", 5), ("2024-01-02", 2)):
        write_output(spark, spark.range(n).toDF("n"), output, data_date=day)
    with pytest.raises(Exception, match="no"):
        broken = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("n"))
        write_output(spark, broken, output, data_date="2024-01-01")
    got = spark.table(name) if kind == "table" else spark.read.parquet(output["path"])
    counted = rows(got.groupBy(F.col("data_date").cast("string")).count())
    assert counted == [("2024-01-01", 3), ("2024-01-02", 2)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode


def test_partitions_must_be_named(spark, tmp_path):
    output = {"format": "parquet", "path": str(tmp_path), "mode": "overwrite_partitions"}
    with pytest.raises(ValueError, match="partition_by"):
        write_output(spark, spark.range(1), output)


@pytest.fixture(params=["true", "false"])
def ansi(request, spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


def test_a_value_that_does_not_fit_is_an_error(spark, ansi):
    target = spark.createDataFrame([(1, 1)], "id int, n int")
    fits = spark.createDataFrame([(1, 7), (2, None)], "id long, n long")
    assert rows(scd1_merge(target, fits, ["id"])) == [(1, 7), (2, None)]
    wide = spark.createDataFrame([(1, 5_000_000_000)], "id long, n long")
    with pytest.raises(Exception, match="n does not fit int: 5000000000"):
        scd1_merge(target, wide, ["id"]).collect()


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_instants_do_not_depend_on_the_zone(spark, ansi, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        micros = [0, 1_700_000_000_123_456, -1, 1_699_163_999_000_000, 1_699_167_599_000_000]
        source = spark.createDataFrame([(m,) for m in micros], "m long")
        source = source.select(F.timestamp_micros("m").alias("a"), F.to_date(F.lit("2024-03-10")).alias("b"))
        model = spark.createDataFrame([], "a string, b timestamp")
        got = align_types(source, model).select("a", F.unix_seconds("b"))
        at = dt.datetime(1970, 1, 1)
        midnight = int((dt.datetime(2024, 3, 10) - at).total_seconds())
        want = {str(at + dt.timedelta(microseconds=m)) for m in micros}
        assert {r[0] for r in rows(got)} == want
        assert {r[1] for r in rows(got)} == {midnight}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_runs_absent_from_the_log_block(spark):
    log = spark.createDataFrame(
        [("a", "2024-01-01", "SUCCESS"), ("a", "2024-01-02", "failed"), ("b", "2024-01-03", "success")],
        "job_name string, data_date string, job_state string",
    ).withColumn("data_date", F.to_date("data_date"))
    jobs = spark.createDataFrame([("a",), ("b",), ("c",)], "job_name string")
    late = blocked_dependencies(expected_runs(jobs, *logged_span(log)), log)
    days = [f"2024-01-0{i}" for i in (1, 2, 3)]
    want = {(j, d) for j in "abc" for d in days} - {("a", days[0]), ("b", days[2])}
    assert {(r[0], str(r[1])) for r in late.collect()} == want
    assert expected_runs(jobs, *logged_span(log.limit(0))).collect() == []

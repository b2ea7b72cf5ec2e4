"""What the operators of this subpackage share: stored intermediate tables and
distributed numbering. Everything here is plain DataFrame work."""

from __future__ import annotations

import contextlib
import io
import zipfile
from collections.abc import Iterator, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..tables import files
from ..tables.files import scratch_dir

# A word: what lies between space, tab, newline, vertical tab, form feed and
# carriage return.
WORD = r"[^\x20\x09-\x0D]+"

# Arrow hands rows to Python in batches; with long texts the number of rows has
# to be small for a batch to stay small.
BATCH_ROWS = 128
BATCH_BYTES = 8 << 20

_sent: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and read them back. Lineage ends here:
    what follows survives a lost executor without computing this again, and
    columns that depend on the physical layout are fixed from here on."""
    path = f"{scratch_dir(df.sparkSession)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def send_package(spark: SparkSession) -> None:
    """Before Python runs on executors: send them this package, which need not be
    installed there."""
    package = Path(__file__).resolve().parent.parent
    context = spark.sparkContext
    if context.applicationId not in _sent:
        archive = io.BytesIO()
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(package.rglob("*.py")):
                out.write(path, path.relative_to(package.parent))
        shared = f"{scratch_dir(spark)}/{package.name}.zip"
        files.put(spark, shared, archive.getvalue())
        context.addPyFile(shared)
        _sent.add(context.applicationId)


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Keeps the Arrow batches small for what runs inside; the session's own settings
    are back afterwards."""
    own = {
        "spark.sql.execution.arrow.maxRecordsPerBatch": rows,
        "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES,
    }
    before = {key: spark.conf.get(key) for key in own}
    for key, value in own.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def python_ready(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Send the package, and keep the Arrow batches small from now on."""
    send_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that the frame does not have yet, whatever the case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def text_of(df: DataFrame, name: str = "text") -> Column:
    return F.coalesce(df[name].cast("string"), F.lit(""))


def ordered(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Number rows from 0 in the order of ``keys``, nulls first, without bringing
    them together: a range-partitioned sort is stored, and each partition's rows
    are numbered from the sum of the partitions before it. The table of these
    sums has one row per partition, which bounds the broadcast."""
    part, at = fresh(df, "__part", "__at")
    ranged = df.repartitionByRange(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)
    rows = stored(
        ranged.select(
            "*",
            F.spark_partition_id().alias(part),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias(at),
        )
    )
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(part).agg(F.count("*").alias("__n"))
    sums = sums.select(part, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    numbered = rows.join(F.broadcast(sums), part)
    return numbered.select(*df.columns, (F.col("__before") + F.col(at)).alias(name))


def ranked(
    df: DataFrame,
    group: Sequence[str],
    spread: Column,
    order: Sequence[str],
    name: str,
    rows_per_bucket: int = 1024,
) -> DataFrame:
    """Number the rows of each group from 0, however large a group is.

    A group is dealt into buckets by the hash ``spread``; a row's number is the
    size of its group's earlier buckets plus its place, by ``order``, in its own.
    So one task sorts about ``rows_per_bucket`` rows of a group at a time. ``df``
    has to be stored, as it is read three times, and ``group`` must not be null.
    """
    bucket, before = "__bucket", "__before"
    largest = df.groupBy(*group).count().agg(F.max("count")).first()[0] or 0
    buckets = max(1, -(-largest // rows_per_bucket))
    dealt = df.withColumn(bucket, F.pmod(spread, F.lit(buckets)))
    earlier = Window.partitionBy(*group).orderBy(bucket)
    sums = dealt.groupBy(*group, bucket).agg(F.count("*").alias("__n"))
    sums = sums.withColumn(
        before,
        F.coalesce(
            F.sum("__n").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ),
    ).drop("__n")
    place = F.row_number().over(Window.partitionBy(*group, bucket).orderBy(*order))
    numbered = dealt.withColumn("__place", place).join(sums, [*group, bucket])
    return numbered.select(*df.columns, (F.col(before) + F.col("__place") - 1).alias(name))

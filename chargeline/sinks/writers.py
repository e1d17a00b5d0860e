"""Table and file writers.

* rated and normalised records: batches of a snapshot table (``snapshots``),
  partitioned by ``billing_month``; normalised ones once per ``record_id`` (``ledger``);
* invoices: dynamic partition overwrite of the billed period, so a re-run
  replaces that period's invoices and nothing else;
* reports: one small CSV file per report (only for small results).

Paths may be local or any Hadoop URI (``s3a://``, ``abfss://``, ``hdfs://``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def read_table_or_none(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """An absent table is the explicit ``None`` case (first run)."""
    if not path_exists(spark, path):
        return None
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def _balanced(df: DataFrame, partition_col: str) -> DataFrame:
    """Group rows by output partition without putting a whole partition (one
    month can be terabytes) into one task: the rebalance hint lets AQE split
    oversized groups to the advisory size and merge small ones, so each
    output partition gets a few large files written by many tasks."""
    return df.hint("rebalance", partition_col)


def append_partitioned(df: DataFrame, path: str, partition_col: str) -> None:
    _balanced(df, partition_col).write.mode("append").partitionBy(partition_col).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_col: str, balance: bool = True) -> None:
    """Replace only the partitions present in ``df``. Rows of a single
    partition need no grouping: without ``balance`` each task writes its own."""
    ((_balanced(df, partition_col) if balance else df)
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(partition_col).parquet(path))


def write_report_csv(report: DataFrame, path: str, single_file: bool = True) -> None:
    """A report as CSV with header.

    ``single_file`` is for bounded reports (aggregates, top-k): one task
    writes one file. Listings that grow with the data keep their partitions:
    a globally sorted listing is range-partitioned, so its part files are in
    order and are written in parallel.
    """
    out = report.coalesce(1) if single_file else report
    out.write.mode("overwrite").option("header", True).csv(path)


def read_report_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def archive_usage(raw: DataFrame, path: str, fmt: str = "json") -> None:
    """Append raw usage to an archive as JSON lines or CSV with header."""
    writer = raw.write.mode("append")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.json(path)


def read_usage_archive(spark: SparkSession, path: str, schema: StructType, fmt: str = "json") -> DataFrame:
    if fmt == "csv":
        return spark.read.option("header", True).schema(schema).csv(path)
    return spark.read.schema(schema).json(path)


def with_period_partition(invoices: DataFrame) -> DataFrame:
    return invoices.withColumn("billing_period", F.to_date("billing_period_start"))


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """A catalog table bucketed and sorted by ``key``.

    Joins and aggregations on ``key`` then read it already hash-partitioned
    (one bucket per partition) and sorted, so the table is neither shuffled
    nor sorted again on every run; only the other side shuffles, into the
    same bucket layout.
    """
    w = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)

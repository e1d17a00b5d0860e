"""Spark helpers shared by the operators."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chargeline.session import checkpoint_root, scratch_path


def settle(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write as Parquet to the shared checkpoint folder, in folders by a column if given, and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(*frames: DataFrame) -> None:
    """Delete the files that ``stored`` wrote for frames that are no longer read (of a condition on ``by``: its folders)."""
    for df in frames:
        spark = df.sparkSession
        root = checkpoint_root(spark)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for folder in {r.f.rpartition("/")[0] for r in df.select(F.input_file_name().alias("f")).distinct().collect() if r.f}:
            at = path(folder)
            if at.toUri().getPath().startswith(path(root).toUri().getPath() + "/"):
                at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def tidy(run):
    """A task's function that gives memory it has freed back to the system at its end.

    Workers live on from task to task, and what their allocators keep counts
    against the executor's memory all the time.
    """
    def inner(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim is not None:
            trim(0)

    return inner


def offsets(totals: DataFrame, keys: list[str], block: str, amount: str, into: str,
            group: int = 1024) -> DataFrame:
    """Exclusive running sum of ``amount`` over ``block`` within ``keys``.

    Two levels: blocks are summed within groups of ``group`` consecutive blocks
    and the group totals are summed above them, so one window partition holds
    ``group`` rows, or one row per group of a key.
    """
    t = totals.withColumn("_g", F.floor(F.col(block) / group))
    inner = Window.partitionBy(*keys, "_g").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*keys).orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    tops = (t.groupBy(*keys, "_g").agg(F.sum(amount).alias("_s"))
            .withColumn("_before", F.coalesce(F.sum("_s").over(outer), F.lit(0))).drop("_s"))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in [*keys, "_g"]]
    on = same[0]
    for c in same[1:]:
        on = on & c
    inside = t.withColumn("_in", F.coalesce(F.sum(amount).over(inner), F.lit(0)))
    return (inside.alias("a").join(tops.alias("b"), on)
            .select(*[F.col(f"a.{k}") for k in keys], F.col(f"a.{block}"),
                    (F.col("_in") + F.col("_before")).cast("long").alias(into)))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text, null as empty."""
    return F.coalesce(text.cast("binary"), F.lit(b""))

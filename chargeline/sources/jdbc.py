"""Relational tables over JDBC (S03/S04), read in parallel.

The source system read whole tables through one JDBC connection; here a
numeric column splits the read into ``num_partitions`` range queries, and a
``query`` can be pushed down as a sub-select. Needs the database's JDBC driver
on the classpath (not bundled).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_from_url(spark: SparkSession, location: str) -> DataFrame:
    """A whole table named as ``jdbc:...#table`` or, split into range queries,
    ``jdbc:...#table?column,lower,upper,partitions``, or into ranges of equally many
    rows of an earlier extract, ``jdbc:...#table?column,@PATH,partitions``. User, password and driver
    come from ``spark.chargeline.jdbc.*``, so that no secret is on a command line."""
    url, _, rest = location.partition("#")
    table, _, split = rest.partition("?")
    if not table:
        raise ValueError(f"no table in {location!r}: expected jdbc:...#table")
    conf = spark.sparkContext.getConf()
    args = {k: conf.get(f"spark.chargeline.jdbc.{k}", None) for k in ("user", "password", "driver")}
    if "@" in split:
        column, path, partitions = split.split(",")
        args["predicates"] = quantile_predicates(spark.read.parquet(path[1:]), column, int(partitions))
    elif split:
        column, lower, upper, partitions = split.split(",")
        args.update(partition_column=column, lower_bound=int(lower), upper_bound=int(upper),
                    num_partitions=int(partitions))
    return read_jdbc(spark, url, table, **args)


def quantile_predicates(rows: DataFrame, column: str, partitions: int, accuracy: int = 10_000) -> list[str]:
    """Conditions that cut a table into ranges of about equally many rows.

    Bounds are quantiles of ``rows`` (an earlier extract of the table, or its key
    column), so ids that crowd in one range still give even parts, which equal
    steps between a least and a largest id do not. The ranges are open at both
    ends and the first takes NULLs: every row of the table, also one that came
    since, is in exactly one.
    """
    shares = ", ".join(str(i / partitions) for i in range(1, partitions))
    cuts = rows.agg(F.expr(f"approx_percentile({column}, array({shares}), {accuracy})")).first()[0] if shares else None
    cuts = sorted(set(cuts or []))
    if not cuts:
        return ["1 = 1"]
    return ([f"{column} < {cuts[0]} OR {column} IS NULL"]
            + [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])] + [f"{column} >= {cuts[-1]}"])


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, *, query: str | None = None,
              user: str | None = None, password: str | None = None, driver: str | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int = 1,
              fetch_size: int = 10_000, predicates: list[str] | None = None) -> DataFrame:
    """``predicates`` (see ``quantile_predicates``) give one query a partition."""
    if predicates:
        properties = {"fetchsize": str(fetch_size)} | {
            k: v for k, v in (("user", user), ("password", password), ("driver", driver)) if v is not None}
        return spark.read.jdbc(url, table, predicates=predicates, properties=properties)
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", str(fetch_size))
    reader = reader.option("query", query) if query else reader.option("dbtable", table)
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v is not None:
            reader = reader.option(k, v)
    if partition_column and not query:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, *, mode: str = "append", user: str | None = None,
               password: str | None = None, driver: str | None = None, batch_size: int = 1000) -> None:
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", str(batch_size))
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v is not None:
            w = w.option(k, v)
    w.mode(mode).save()

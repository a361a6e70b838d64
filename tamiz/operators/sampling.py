"""Stratified sampling with proportional allocation by largest remainders, and a draw that does not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def allocate(sizes: DataFrame, n: int, stratum: str = "stratum", size: str = "size") -> DataFrame:
    """(stratum, size, quota): n units in proportion to the sizes, whole numbers throughout; ties of remainders go by stratum.

    ``sizes`` has a row for each stratum. n is clamped to the total.
    """
    total = sizes.agg(F.coalesce(F.sum(size), F.lit(0)).alias("total"))
    d = sizes.join(F.broadcast(total)).withColumn("n", F.least(F.lit(n).cast("bigint"), F.col("total")))
    d = d.withColumn("base", F.expr(f"{size} * n div total")).withColumn("rem", F.expr(f"({size} * n) % total"))
    left = d.agg((F.coalesce(F.max("n"), F.lit(0)) - F.coalesce(F.sum("base"), F.lit(0))).alias("left_"))
    rank = F.row_number().over(Window.orderBy(F.desc("rem"), F.asc(stratum)))  # one row a stratum
    return d.join(F.broadcast(left)).withColumn("r", rank).select(stratum, size, F.least(F.col("base") + (F.col("r") <= F.col("left_")).cast("bigint"), F.col(size)).alias("quota"))


def draw_key(seed: int, key: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key))


def draw(pool: DataFrame, quotas: DataFrame, key: str, stratum: str = "stratum", seed: int = 42, bins: int = 256) -> DataFrame:
    """The rows of the ``quota`` least draw keys of each stratum. Keys are cut into bins by their first two hex digits and counted; only
    the bin in which the quota falls is ranked, so a stratum with a third of all rows is no hot task."""
    d = pool.withColumn("_d", draw_key(seed, F.col(key))).withColumn("_b", F.substring("_d", 1, 2))
    counts = d.groupBy(stratum, "_b").agg(F.count(F.lit(1)).alias("_c"))
    run = F.sum("_c").over(Window.partitionBy(stratum).orderBy("_b"))  # at most 256 rows a stratum
    bound = counts.withColumn("_before", run - F.col("_c")).join(quotas.select(stratum, "quota"), stratum).where(F.col("_before") < F.col("quota"))
    near = d.join(bound, [stratum, "_b"])
    rank = F.row_number().over(Window.partitionBy(stratum, "_b").orderBy("_d", key))
    whole = near.where(F.col("_before") + F.col("_c") <= F.col("quota"))
    edge = near.where(F.col("_before") + F.col("_c") > F.col("quota")).withColumn("_r", rank).where(F.col("_before") + F.col("_r") <= F.col("quota")).drop("_r")
    return whole.unionByName(edge).select(*pool.columns)


def reserve(pool: DataFrame, drawn: DataFrame, key: str) -> DataFrame:
    return pool.join(drawn.select(key), key, "left_anti")

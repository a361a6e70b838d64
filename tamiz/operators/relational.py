"""Keyed operators: duplicates, anti and semi joins for resumption, lookups with defaults, counts and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedup(df: DataFrame, key: str, order: list[Column], keep: str = "first") -> DataFrame:
    """The first or last row of each key by ``order``; ties are ordered by all columns, so the result is one. A null key is a key.

    An aggregate with map-side combine, not a window: a key with a third of all rows is no hot task.
    """
    cols = [c for c in df.columns if c != key]
    # order must hold values that compare within a struct; the whole row breaks ties
    rank = F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order)), *(F.col(c) for c in cols))
    best = (F.min if keep == "first" else F.max)(rank)
    return df.groupBy(key).agg(best.alias("_r")).select(key, *(F.col(f"_r.{c}").alias(c) for c in cols)).select(*df.columns)


def pending(all_: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not done; null keys stay pending."""
    return all_.join(done.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def approved(texts: DataFrame, ok: DataFrame, key: str) -> DataFrame:
    return texts.join(ok.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_semi")


def without_failed(results: DataFrame, succeeded: Column, key: str) -> DataFrame:
    """The rows of the keys with at least one success."""
    good = results.where(succeeded & F.col(key).isNotNull()).select(key).distinct()
    return results.join(good, key, "left_semi")


def lookup(df: DataFrame, dim: DataFrame, on: str, value: str, default: str) -> DataFrame:
    """df with the value of a dimension, or a default; Catalyst broadcasts the dimension if its size allows."""
    return df.join(dim.select(on, value), on, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def upper_median(df: DataFrame, value: str) -> DataFrame:
    """(n, least, upper_median, most, total) of a column's values, the upper one of two middle values being the median; nulls left out.

    An aggregate over counts of values with map-side combine; no sort of all values.
    """
    median = F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{value}` DESC)")  # from above, the upper of two middle values comes first
    return df.where(F.col(value).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.min(value).alias("least"), median.cast(df.schema[value].dataType).alias("upper_median"), F.max(value).alias("most"), F.sum(value).alias("total")
    ).where("n > 0")


def split_counts(df: DataFrame, column: str, sep: str = ";") -> DataFrame:
    """(value, count) of the trimmed, non-empty parts of a column."""
    part = F.trim(F.col("p"))
    return df.select(F.explode(F.split(column, sep)).alias("p")).select(part.alias("value")).where("value <> ''").groupBy("value").agg(F.count(F.lit(1)).alias("count"))


def first_pending(all_: DataFrame, done: DataFrame, key: str, most: int) -> DataFrame:
    """Of the first ``most`` rows by key those that are not done: the limit counts before the anti join, so a rerun does not move on."""
    return pending(all_.orderBy(key).limit(most), done, key)


def observed(df: DataFrame, name: str, flagged: Column) -> tuple[DataFrame, object]:
    """(df, observation): ``observation.get`` has the rows and the flagged ones after the first action on df, without a pass of its own."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(flagged).alias("flagged")), seen


def capped(df: DataFrame, column: str, most: int) -> DataFrame:
    """(n, shown, more): how many values a column has, the first ``most`` of them in order for printing, and how many are not shown."""
    first = df.where(F.col(column).isNotNull()).select(column).orderBy(column).limit(most).agg(F.array_sort(F.collect_list(column)).alias("shown"))
    n = df.agg(F.count(column).alias("n"))
    return n.join(F.broadcast(first)).select("n", "shown", (F.col("n") - F.size("shown")).alias("more"))  # one row each

"""What the text operators share: reading, scanning texts in Arrow batches, running totals, and narrowing joins."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from ..session import cut

__all__ = ["cut", "journal", "narrowed", "release", "running_total", "scan", "table", "unit"]

ROWS_A_BATCH = 5_000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def scan(df: DataFrame, schema: str, rows: Callable[[Iterator[tuple]], Iterable[tuple]]) -> DataFrame:
    """``rows`` maps the rows of a partition, as tuples, to tuples of ``schema``; batches cross to Python and back as Arrow."""
    names = [x.name for x in _parse_datatype_string(schema).fields]
    out = to_arrow_schema(StructType(_parse_datatype_string(schema).fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for b in batches:
                if b.num_rows:
                    yield from zip(*(c.to_pylist() for c in b.columns))

        held: list[tuple] = []

        def batch() -> pa.RecordBatch:
            cols = list(zip(*held))
            return pa.RecordBatch.from_arrays([pa.array(c, type=out.field(n).type) for n, c in zip(names, cols)], schema=out)

        for row in rows(each()):
            held.append(row)
            if len(held) >= ROWS_A_BATCH:
                yield batch()
                held.clear()
        if held:
            yield batch()

    return df.mapInArrow(run, schema)


MOST_IDS = 6_000_000  # ids of a filter: 10 bits each fit in the 64 million that Spark gives a Bloom filter
_TASKS = 8


def narrowed(df: DataFrame, ids: DataFrame, on: str | list[str]) -> DataFrame:
    """The rows of df whose key may be in ``ids``, for a join that follows, so that it shuffles only these and one in a hundred more.

    A Bloom filter of 10 bits for each id is made in a scalar subquery, by few tasks as each sends a whole filter. With more than
    MOST_IDS ids there is none and the join shuffles every row; results are the same. ``ids`` is counted, so it should be written.
    """
    n = ids.count()
    if n > MOST_IDS or not hasattr(df, "_jdf"):
        return df
    jvm = df.sparkSession._jvm
    catalyst, tools = jvm.org.apache.spark.sql.catalyst.expressions, jvm.org.apache.spark.sql.classic.ExpressionUtils
    plain = lambda c: tools.expression(c._jc)
    key = plain(F.xxhash64(*([on] if isinstance(on, str) else on)))
    size = (plain(F.lit(x).cast("bigint")) for x in (max(n, 1), max(10 * n, 1024)))
    filled = ids.coalesce(_TASKS).agg(Column(tools.column(catalyst.aggregate.BloomFilterAggregate(key, *size).toAggregateExpression())).alias("filter"))
    return df.where(Column(tools.column(catalyst.BloomFilterMightContain(plain(filled.scalar()), key))))


def release(df: DataFrame) -> None:
    """Has Spark delete the shuffles and checkpoints that nothing refers to any more, which it does only as the driver's garbage is collected."""
    if hasattr(df, "_jdf"):
        gc.collect()  # handles of Python that are part of a cycle
        df.sparkSession._jvm.System.gc()


def journal(pid: Column) -> Column:
    """The ISSN that a pid holds in its characters 2 to 10; a written ISSN of the same pid never contradicts it."""
    return F.substring(pid, 2, 9)


def unit(key: Column, seed: int) -> Column:
    """A number from 0 up to 1 that depends on key and seed only, so a lost task draws the same again."""
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11) / F.lit(float(1 << 53))


def running_total(df: DataFrame, group: str, order: list[str], weight: str) -> DataFrame:
    """df with ``before``: the sum of ``weight`` in the rows of the same group that come earlier in the order. No group is one task.

    The rows are range-partitioned and written once; each partition adds up by itself and starts at the totals of those before it.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    run = cut(df.repartitionByRange(parts, group, *order).sortWithinPartitions(group, *order).withColumn("part", F.spark_partition_id()))
    totals = run.groupBy(group, "part").agg(F.sum(weight).alias("t"))
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a group has a row for each partition
    offsets = totals.select(group, "part", F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("offset"))
    names = df.columns
    at_g, at_w = names.index(group), names.index(weight)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def add(it):
        key, n = object(), 0
        for row in it:
            if row[at_g] != key:
                key, n = row[at_g], 0
            yield (*row, n)
            n += row[at_w] or 0

    # groups follow one another in the partitions, so there are at most groups + partitions rows; groups are target sources, or statistics by language
    within = scan(run, f"{fields}, part int, within bigint", add)
    return within.join(F.broadcast(offsets), [group, "part"]).withColumn("before", F.col("offset") + F.col("within")).select(*names, "before")

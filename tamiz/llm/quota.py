"""Problem 2: a sample that matches target category shares.

1. Observed distinct records by category, in one aggregation; the needs follow from the targets (``needs``).
2. Each category's acceptance probability is need / observed with slight oversampling; a record is accepted if its own hash, read as a
   number from 0 to 1, lies below. No state is shared, so a lost task accepts the same records again.
3. Exact correction: hashes are counted in bins by category (a table of categories x bins), the bin in which the need falls is found,
   bins below it are taken whole, and only the records of that one bin are ranked. No category is ever sorted as a whole.
4. What a category lacks is reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import unit

BINS = 4096


def clean_issn(issn: Column) -> Column:
    """NNNN-NNNX from any writing with eight digits (the last may be X), else null."""
    bare = F.upper(F.regexp_replace(issn, r"[^0-9Xx]", ""))
    return F.when(bare.rlike(r"^\d{7}[\dX]$"), F.concat(F.substring(bare, 1, 4), F.lit("-"), F.substring(bare, 5, 4)))


def units(selection: DataFrame) -> DataFrame:
    """(pid, issn): one row a pid. The ISSN is the least readable one of its rows, else the one in the pid; null pids are left out."""
    return (
        selection.where(F.col("pid").isNotNull()).groupBy("pid").agg(F.min(clean_issn(F.col("issn"))).alias("i"))
        .select("pid", F.coalesce("i", F.substring("pid", 2, 9)).alias("issn"))
    )


def needs(pool: DataFrame, targets: DataFrame, one_in: int = 4) -> DataFrame:
    """(issn, need, observed, missing, accept) for each target category; categories without records have observed 0.

    n is the pool's size divided by ``one_in``, rounded down; need the larger of minimo and meta_pm * n / 1000 rounded up. Targets that
    are null count as 0. Repeated target rows are taken once.
    """
    n = pool.agg(F.floor(F.count(F.lit(1)) / one_in).cast("bigint").alias("n"))  # one row
    seen = pool.groupBy("issn").agg(F.count(F.lit(1)).alias("observed"))
    wanted = targets.groupBy("issn").agg(F.max(F.coalesce("meta_pm", F.lit(0))).cast("bigint").alias("meta_pm"), F.max(F.coalesce("minimo", F.lit(0))).cast("bigint").alias("minimo"))
    need = F.greatest("minimo", F.expr("(meta_pm * n + 999) div 1000"))
    return (
        wanted.join(F.broadcast(n)).join(seen, "issn", "left").withColumn("observed", F.coalesce("observed", F.lit(0))).withColumn("need", need)
        .select("issn", "need", "observed", F.greatest(F.col("need") - F.col("observed"), F.lit(0)).alias("missing"), F.least(F.lit(1.0), F.col("need") / F.greatest("observed", F.lit(1))).alias("accept"))
    )


def quota_sample(pool: DataFrame, wanted: DataFrame, seed: int = 42, over: float = 1.1) -> DataFrame:
    """(pid, issn) of the sample: exactly min(need, observed) records of each category of ``wanted``; others are not sampled."""
    # the acceptance bound exceeds need by 10 % and four standard deviations; the bins above it are only used if chance left it short
    bound = F.least(F.lit(1.0), F.col("accept") * over + 4 * F.sqrt(F.col("accept") / F.greatest("observed", F.lit(1))))
    drawn = pool.join(wanted.where("need > 0").withColumn("bound", bound), "issn").withColumn("u", unit(F.col("pid"), seed))
    drawn = drawn.withColumn("late", F.col("u") >= F.col("bound")).withColumn("bin", F.floor(F.col("u") * BINS).cast("int"))
    bins = drawn.groupBy("issn", "need", "late", "bin").agg(F.count(F.lit(1)).alias("c"))
    upto = F.sum("c").over(Window.partitionBy("issn").orderBy("late", "bin"))  # at most 2 x BINS rows a category
    placed = bins.withColumn("before", upto - F.col("c")).where("before < need").select("issn", "late", "bin", "before", "c")
    taken = drawn.select("pid", "issn", "need", "late", "bin", "u").join(placed, ["issn", "late", "bin"])
    whole = taken.where("before + c <= need").select("pid", "issn")
    rank = F.row_number().over(Window.partitionBy("issn", "late", "bin").orderBy("u", "pid"))  # one bin of each category
    edge = taken.where("before + c > need").withColumn("r", rank).where("before + r <= need").select("pid", "issn")
    return whole.unionByName(edge)


def quota_report(sample: DataFrame, wanted: DataFrame) -> DataFrame:
    """(issn, need, observed, sampled, missing, share_pm) for each target category; missing > 0 where the target is not met."""
    got = sample.groupBy("issn").agg(F.count(F.lit(1)).alias("sampled"))
    both = wanted.join(got, "issn", "left").withColumn("sampled", F.coalesce("sampled", F.lit(0)))
    total = sample.agg(F.count(F.lit(1)).alias("all_"))
    return both.join(F.broadcast(total)).select(
        "issn", "need", "observed", "sampled", (F.col("need") - F.col("sampled")).alias("missing"), F.round(F.col("sampled") * 1000 / F.greatest("all_", F.lit(1)), 2).alias("share_pm")
    )

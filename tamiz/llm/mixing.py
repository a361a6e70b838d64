"""Problem 9: mixing sources to target weights. A time-varying curriculum over training positions.

1. Sizes of the sources are summed in one aggregation, in blank-separated words or in tokens of a public tokenizer.
2. A source's weight runs from ``start`` to ``end`` over the training, x from 0 to 1: w(x) = peso * (start + (end - start) * x). Its
   demand up to x is the integral, T * (start * x + (end - start) * x^2 / 2) with the mean weight scaled to 1, so that each source gets
   its whole share; what its documents, max_repeticiones times, leave of it is a deficit and is reported.
3. A source's documents are laid end to end in an order of their hashes (md5, so that any engine draws the same), once for each repetition. Running totals come from a range
   partition with partition offsets, so no source is sorted in one task. The integral inverted at the running total is a document's
   position in training; the mix is range-sorted by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import running_total, scan


def source_name(source: Column) -> Column:
    """Trimmed and lower-cased; blank names count as none."""
    name = F.lower(F.trim(source))
    return F.when(name != "", name)


def count_tokens(tokenizer: str):
    """A function from text to its number of tokens under a tiktoken rank file, tokenizers JSON or sentencepiece model at a path."""
    if tokenizer.endswith(".tiktoken"):
        import base64

        import tiktoken

        with open(tokenizer, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        pattern = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        encode = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        return lambda t: len(encode(t))
    if tokenizer.endswith(".json"):
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(tokenizer)
        tok.encode_special_tokens = True
        return lambda t: len(tok.encode(t, add_special_tokens=False).ids)
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer)
    return lambda t: len(model.encode(t, num_threads=1))


def sized(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", tokenizer: str | None = None) -> DataFrame:
    """(key, source, size) of the rows with source and text. ``tokenizer`` is the path of a tokenizer file; without it words count."""
    kind = df.schema[key].dataType.simpleString()
    rows = df.where(F.col(text).isNotNull()).select(key, source_name(F.col(source)).alias("source"), text).where(F.col("source").isNotNull())
    if tokenizer is None:
        return rows.select(key, "source", F.regexp_count(text, F.lit(r"\S+")).cast("bigint").alias("size"))

    def count(it):
        n = count_tokens(tokenizer)
        for k, s, t in it:
            yield k, s, n(t)

    return scan(rows, f"{key} {kind}, source string, size bigint", count)


def plan(sizes: DataFrame, targets: DataFrame, part: tuple[int, int] = (1, 2)) -> DataFrame:
    """(source, peso_pm, max_rep, size, documents, demand, supply, used) for each target source.

    T is ``part`` of the total size of all sources. Demands are in thousandths of a word or token: peso_pm * T. A null weight or cap is 0.
    Repeated targets of a source are taken once; targets of absent sources have size 0.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("documents"))
    total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("total"))
    goal = targets.select(source_name(F.col("source")).alias("source"), "peso_pm", "max_repeticiones").where(F.col("source").isNotNull())
    goal = goal.groupBy("source").agg(F.max(F.coalesce("peso_pm", F.lit(0))).cast("bigint").alias("peso_pm"), F.max(F.coalesce("max_repeticiones", F.lit(0))).cast("bigint").alias("max_rep"))
    num, den = part
    return (
        goal.join(by, "source", "left").join(F.broadcast(total)).fillna(0, ["size", "documents"])
        .withColumn("demand", F.col("peso_pm") * F.col("total") * num / (1000.0 * den)).withColumn("supply", F.col("size") * F.col("max_rep"))
        .withColumn("used", F.least("demand", F.col("supply").cast("double")))
        .select("source", "peso_pm", "max_rep", "size", "documents", "demand", "supply", "used")
    )


def curriculum(sizes: DataFrame, targets: DataFrame, key: str = "doc_id", seed: int = 42, slope: float = 0.5, part: tuple[int, int] = (1, 2)) -> DataFrame:
    """(position, key, source, repetition, size), range-sorted by position: the training order of the mix.

    Sources that may be repeated begin below their mean weight and end above it by ``slope``; the others the other way round. A
    document enters as long as its source's running total is below its demand, at most max_repeticiones times. Documents of size 0 and
    sources without target are left out; equal positions are ordered by key and repetition. An empty table gives an empty result.
    """
    p = plan(sizes, targets, part).where("used > 0").withColumn("tilt", F.when(F.col("max_rep") > 1, F.lit(slope)).otherwise(F.lit(-slope)))
    copies = sizes.where("size > 0").join(p.drop("size", "documents"), "source").join(p.select("source", F.col("size").alias("all_")), "source")
    times = F.least(F.col("max_rep"), F.ceil(F.col("used") / F.col("all_")).cast("bigint"))
    laid = copies.select("source", F.explode(F.sequence(F.lit(1), times.cast("int"))).alias("repetition"), key, "size").withColumn("u", F.md5(F.concat_ws(":", F.lit(seed), "repetition", key)))
    total = running_total(laid, "source", ["repetition", "u", key], "size")
    placed = total.join(p.select("source", "used", "demand", "tilt"), "source").where("before < used")
    y, t = F.col("before") / F.col("demand"), F.col("tilt")
    # y = (1 - t) x + t x^2, inverted; t is never 0 unless slope is
    x = F.when(F.abs(t) < 1e-9, y).otherwise((F.sqrt((1 - t) * (1 - t) + 4 * t * y) - (1 - t)) / (2 * t))
    return placed.select(F.round(x, 9).alias("position"), key, "source", "repetition", "size").orderBy("position", "source", key, "repetition")


def shares(mix: DataFrame, planned: DataFrame) -> DataFrame:
    """(source, peso_pm, size, share_pm, repetitions, deficit, short) of the mix for each target source, from the positions given out.

    ``size`` is what the source's documents in the mix add up to. A source takes documents until its demand is met, so one whose size in
    the mix is below its demand is short by the deficit.
    """
    got = mix.groupBy("source").agg(F.sum("size").alias("placed"), F.max("repetition").alias("repetitions"))
    whole = mix.agg(F.sum("size").alias("whole"))  # one row
    placed = F.coalesce("placed", F.lit(0))
    return (
        planned.select("source", "peso_pm", "demand").join(got, "source", "left").join(F.broadcast(whole))
        .select(
            "source", "peso_pm", placed.alias("size"), F.round(placed * 1000 / F.greatest(F.coalesce("whole", F.lit(1)), F.lit(1)), 2).alias("share_pm"),
            F.coalesce("repetitions", F.lit(0)).alias("repetitions"), F.round(F.greatest(F.col("demand") - placed, F.lit(0.0)), 3).alias("deficit"), (placed < F.col("demand")).alias("short"),
        )
    )

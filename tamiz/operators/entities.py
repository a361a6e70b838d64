"""Entity mentions and their places in a text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dictionaries as D
from ..functions.text import quote, strip, unix_lines


def valid_mentions(df: DataFrame, key: str = "task_id", text: str = "text", entities: str = "entidades", labels: tuple[str, ...] = D.ENTITY_LABELS) -> DataFrame:
    """(key, text, ord, mention, label): mentions in their order, stripped, with a known category in any case; others are left out."""
    d = df.select(key, unix_lines(F.col(text)).alias("text"), F.posexplode(entities).alias("ord", "e"))
    return d.select(key, "text", "ord", strip(F.col("e.texto")).alias("mention"), F.upper(strip(F.col("e.categoria"))).alias("label")).where((F.col("mention") != "") & F.col("label").isin(*labels))


def mention_offsets(df: DataFrame, key: str = "task_id", text: str = "text", entities: str = "entidades", labels: tuple[str, ...] = D.ENTITY_LABELS, dedupe: bool = False) -> DataFrame:
    """(key, ord, start, end, mention, label): the r-th mention of the same words takes the r-th occurrence in the text, cyclically.

    Places count code points, the end is exclusive. Mentions that do not occur are left out. ``dedupe`` drops repeated spans.
    Ranks are taken within the row's own array, so nothing is shuffled.
    """
    said = F.transform(entities, lambda e, i: F.struct(i.alias("ord"), strip(e.texto).alias("mention"), F.upper(strip(e.categoria)).alias("label")))
    d = df.select(key, unix_lines(F.col(text)).alias("_t"), F.filter(said, lambda x: (x.mention != "") & x.label.isin(*labels)).alias("_m"))

    def place(x: Column, i: Column) -> Column:
        cuts = F.transform(F.split("_t", quote(x.mention), -1), lambda p: F.length(p))
        same = F.size(F.filter(F.slice("_m", F.lit(1), i), lambda y: y.mention == x.mention))
        return F.struct(x.ord.alias("ord"), x.mention.alias("mention"), x.label.alias("label"), cuts.alias("cuts"), same.alias("before"))

    d = d.select(key, F.inline(F.transform("_m", place))).where(F.size("cuts") > 1).withColumn("j", F.col("before") % (F.size("cuts") - 1))
    start = F.aggregate(F.slice("cuts", F.lit(1), F.col("j") + 1), F.lit(0), lambda a, x: a + x) + F.col("j") * F.length("mention")
    out = d.select(key, "ord", start.cast("int").alias("start"), (start + F.length("mention")).cast("int").alias("end"), "mention", "label")
    return out.dropDuplicates([key, "start", "end", "label"]) if dedupe else out


def annotation_tasks(spans: DataFrame, texts: DataFrame, model: Column, key: str = "task_id", pid: str = "pid", text: str = "text") -> DataFrame:
    """(key, task): one JSON task a text for an annotation tool, its spans in order with ids pid_0, pid_1 and so on."""
    ordered = F.array_sort(F.collect_list(F.struct("ord", "start", "end", "mention", "label")))
    per = spans.groupBy(key).agg(ordered.alias("spans"))
    value = lambda x: F.struct(x.start.alias("start"), x.end.alias("end"), x.mention.alias("text"), F.array(x.label).alias("labels"))
    item = lambda x, i: F.struct(F.concat_ws("_", pid, i.cast("string")).alias("id"), F.lit("label").alias("from_name"), F.lit("text").alias("to_name"), F.lit("labels").alias("type"), value(x).alias("value"))
    result = F.coalesce(F.transform(F.col("spans"), item), F.array())
    task = F.struct(
        F.struct(unix_lines(F.col(text)).alias("text"), F.col(pid).alias("pid")).alias("data"),
        F.array(F.struct(model.alias("model_version"), result.alias("result"))).alias("predictions"),
    )
    return texts.join(per, key, "left").select(key, F.to_json(task).alias("task"))

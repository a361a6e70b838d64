"""Catalogue of raw article texts: header block, article type, title, sections and abstract, as expressions over the text's lines.

All columns of a text come from one projection: no shuffle, no UDF. Lines keep their order in an array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dictionaries as D
from ..functions.text import canon, let, lines, strip, unix_lines
from ..session import cut


def _lookup(table: dict[str, tuple[str, ...]]) -> Column:
    return F.create_map(*(F.lit(x) for value, keys in table.items() for k in keys for x in (k, value)))


def _heading(u: Column) -> Column:
    return F.regexp_replace(u, r"[ .:;-]+\z", "")


HEAD = 80  # characters that decide on a heading: all are shorter, with room for decomposed accents


def head_of(line: Column) -> Column:
    """The canonical first characters of a line; a longer line is marked by a sign that no heading has, behind its head."""
    bare = F.regexp_replace(strip(line), r"[ .:;-]+\z", "")
    return let(bare, lambda b: F.when(F.length(b) <= HEAD, canon(b)).otherwise(F.concat(canon(F.substring(b, 1, HEAD)), F.lit("|"))))


def section_of(line: Column, table: dict[str, tuple[str, ...]] = D.SECTIONS) -> Column:
    """The section that a line opens: a heading, or one that begins the line with text after it; null if none."""
    return let(head_of(F.coalesce(line, F.lit(""))), lambda u: section_of_canon(u, table))


def section_of_canon(u: Column, table: dict[str, tuple[str, ...]] = D.SECTIONS) -> Column:
    begins = (
        F.when(u.rlike(r"(?U)^(?:PALABRAS\s+CLAVES?|PALABRAS-CLAVE)\b"), "Palabras clave").when(u.rlike(r"(?U)^KEY\s*WORDS\b"), "Key words")
        .when(u.rlike(r"(?U)^RESUMEN\b"), "Resumen").when(u.rlike(r"(?U)^(?:ABSTRACT|SUMMARY)\b"), "Abstract(EN)")
    )
    return F.when(u != "", F.coalesce(F.try_element_at(_lookup(table), _heading(u)), begins))


def type_of_canon(u: Column, table: dict[str, tuple[str, ...]] = D.TYPES) -> Column:
    return F.try_element_at(_lookup(table), _heading(u))


def site_line(u: Column) -> Column:
    """A canonical line of the journal site: a known one, a dash item, or one with ISSN and edition."""
    edition = F.contains(u, F.lit("VERSION")) | F.contains(u, F.lit("IMPRESA")) | F.contains(u, F.lit("ON-LINE")) | F.contains(u, F.lit("ONLINE"))
    return u.isin(*D.SITE_LINES) | F.startswith(u, F.lit("- ")) | (F.contains(u, F.lit("ISSN")) & edition)


def doi_line(line: Column) -> Column:
    low = F.lower(strip(line))
    return F.startswith(low, F.lit("http")) | F.startswith(low, F.lit("doi:")) | F.contains(low, F.lit("doi.org"))


def _first(flags: Column) -> Column:
    """Place from 1 of the first true, 0 if none."""
    return F.array_position(flags, True).cast("int")


def line_facts(df: DataFrame, text: str = "text") -> DataFrame:
    """df with ``facts``: for each line a struct of the line, stripped and canonical, and what it is. Each line is folded once."""
    rows = F.transform(lines(unix_lines(F.coalesce(text, F.lit("")))), lambda l: F.struct(strip(l).alias("s"), head_of(l).alias("u"), F.contains(F.upper(l), F.lit("ISSN")).alias("issn")))
    staged = df.withColumn("_u", rows)
    return staged.withColumn(
        "facts",
        F.transform("_u", lambda x: F.struct(
            x.s.alias("s"), x.issn.alias("issn"), section_of_canon(x.u).alias("section"), type_of_canon(x.u).alias("type"),
            # the whole line matters only where it has an ISSN
            F.when(x.issn | (F.length(x.s) <= HEAD), site_line(canon(x.s))).otherwise(F.startswith(x.s, F.lit("- "))).alias("site"), doi_line(x.s).alias("doi"),
        )),
    ).drop("_u")


def catalogue(df: DataFrame, text: str = "text") -> DataFrame:
    """df with voldate, type, title, structure (sections in order of appearance), abstract, nlines (non-blank) and final_type.

    Null and empty texts have no structure and no title. A text whose references come before its title has an empty fallback body.
    """
    d = line_facts(df, text)
    n = F.size("facts")
    flag = lambda f: F.transform("facts", f)
    d = d.withColumn("_i", _first(flag(lambda x: x.issn)))
    # the header runs from the first ISSN line to the first line after it that is neither blank nor one
    stop = F.array_position(F.transform(F.col("facts"), lambda x, i: (i + 1 > F.col("_i")) & (x.s != "") & ~x.issn), True).cast("int")
    last = F.array_max(F.transform(F.col("facts"), lambda x, i: F.when(x.issn, i + 1).otherwise(0)))
    opening = _first(flag(lambda x: (x.s != "") & ~x.site))
    d = d.withColumn("_stop", F.when(F.col("_i") > 0, stop).otherwise(0))
    d = d.withColumn("voldate", F.when(F.col("_stop") > 0, F.try_element_at("facts", F.col("_stop")).s))
    cursor = F.when(F.col("_stop") > 0, F.col("_stop")).when(F.col("_i") > 0, last).otherwise(F.when(opening > 0, opening - 1).otherwise(n))
    d = d.withColumn("_c", cursor)  # lines before the cursor are header
    skipped = lambda x: (x.s == "") | x.site | x.doi | x.type.isNotNull()
    t = F.array_position(F.transform(F.col("facts"), lambda x, i: (i >= F.col("_c")) & ~skipped(x)), True).cast("int")
    d = d.withColumn("_t", F.when(t > 0, t).otherwise(n + 1))
    d = d.withColumn("type", F.try_element_at(F.filter(F.transform(F.col("facts"), lambda x, i: F.when((i >= F.col("_c")) & (i + 1 < F.col("_t")) & (x.s != "") & ~x.site & ~x.doi, x.type)), lambda x: x.isNotNull()), F.lit(1)))
    at = F.try_element_at("facts", F.col("_t"))
    d = d.withColumn("title", F.when((F.col("_t") <= n) & at.section.isNull(), at.s))
    d = d.withColumn("_b", F.when(F.col("title").isNotNull(), F.col("_t")).otherwise(F.col("_t") - 1))  # lines before the body
    d = d.withColumn("structure", F.array_distinct(F.filter(flag(lambda x: x.section), lambda x: x.isNotNull())))
    d = d.withColumn("_r", _first(flag(lambda x: F.coalesce(x.section == "Referencias", F.lit(False)))))
    d = d.withColumn("_k", _first(flag(lambda x: F.coalesce(x.section == "Palabras clave", F.lit(False)))))
    before = F.array_max(F.transform(F.col("facts"), lambda x, i: F.when((i + 1 < F.col("_k")) & (x.s != ""), i + 1).otherwise(0)))
    d = d.withColumn("_a", F.when(F.col("_k") > 0, before).otherwise(0))
    here, prior = F.try_element_at("facts", F.when(F.col("_a") > 0, F.col("_a"))), F.try_element_at("facts", F.when(F.col("_a") > 1, F.col("_a") - 1))
    own = F.when((F.length(here.s) < 120) & (prior.s != "") & prior.section.isNull(), F.concat_ws(" ", prior.s, here.s)).otherwise(here.s)
    end = F.when(F.col("_r") > 0, F.col("_r") - 1).otherwise(n)
    body = F.filter(
        F.slice("facts", F.col("_b") + 1, F.greatest(end - F.col("_b"), F.lit(0))), lambda x: (x.s != "") & x.section.isNull() & ~x.s.rlike(r"(?U)^\d+\s*[.)]")
    )
    d = d.withColumn("_body", F.transform(body, lambda x: x.s))
    longest = F.array_max(F.transform(F.col("_body"), lambda s, i: F.struct(F.length(s).alias("n"), (-i).alias("i"), s.alias("s")))).s
    fallback = F.coalesce(F.try_element_at(F.filter("_body", lambda s: F.length(s) >= 160), F.lit(1)), longest, F.lit(""))
    d = d.withColumn("abstract", F.when(here.s.isNotNull() & here.section.isNull(), own).otherwise(fallback))
    d = d.withColumn("nlines", F.size(F.filter("facts", lambda x: x.s != "")))
    d = d.withColumn("final_type", final_type(F.col("type"), F.col("structure"), F.col("nlines")))
    return d.drop("facts", "_i", "_stop", "_c", "_t", "_b", "_r", "_k", "_a", "_body")


def final_type(kind: Column, structure: Column, nlines: Column) -> Column:
    """The labelled type, else the one inferred from the sections."""
    has = lambda s: F.array_contains(structure, s)
    return F.coalesce(
        kind,
        F.when(has("Caso clínico"), "Reporte de caso (inferido)").when(has("Materiales y métodos") & has("Resultados"), "Artículo original (inferido)")
        .when(~has("Resumen") & (nlines <= 10), "Imagen / nota breve (inferido)").otherwise("Indeterminado"),
    )


def pid_parts(pid: Column) -> tuple[Column, Column]:
    """(issn, year) of a pid by place; a year that is not all digits is '?'."""
    year = F.substring(pid, 11, 4)
    return F.substring(pid, 2, 9), F.when(year.rlike(r"^\d+$"), year).otherwise("?")


def journal_name(issn: Column, names: dict[str, str] = D.JOURNALS, unknown: str = "(revista no identificada)") -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in names.items() for x in kv)), issn), F.lit(unknown))


def cards(cat: DataFrame, key: str = "pid", lead: int = 3) -> DataFrame:
    """(n, card): a printable card for each catalogued text, numbered by key from 1.

    The numbers come from range-partitioned running totals, so the report is not sorted in one task.
    """
    numbered = cat.repartitionByRange(key).sortWithinPartitions(key, "title").withColumn("part", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id())
    numbered = cut(numbered)  # the numbers of partitions and rows must come from one run
    sizes = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("c"), F.min("row").alias("first"))  # one row a partition
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as partitions
    offset = sizes.select("part", "first", F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("before"))
    n = (F.col("before") + F.col("row") - F.col("first") + 1).cast("bigint")
    card = F.concat_ws("\n", F.format_string("[%03d] %s", n, F.col(key)), F.concat(F.lit("TIPO: "), "final_type"), F.concat(F.lit("TITULO: "), F.coalesce("title", F.lit("-"))), F.concat(F.lit("ESTRUCTURA: "), F.array_join("structure", " › ")))
    return numbered.join(F.broadcast(offset), "part").select(n.alias("n"), card.alias("card"))


def report(cat: DataFrame, key: str = "pid") -> DataFrame:
    """(part, n, text) of the printed catalogue, by part and n: 1 the counts by type, 2 those by year, in order of the year, 3 the cards."""
    _, year = pid_parts(F.col(key))
    by = lambda part, c: cat.groupBy(c.alias("v")).agg(F.count(F.lit(1)).alias("c")).select(F.lit(part).alias("part"), "v", "c")
    head = by(1, F.col("final_type")).unionByName(by(2, year))
    order = F.row_number().over(Window.partitionBy("part").orderBy(F.when(F.col("part") == 1, -F.col("c")), "v"))  # types and years are few
    head = head.select("part", order.cast("bigint").alias("n"), F.format_string("%s: %d", "v", "c").alias("text"))
    return head.unionByName(cards(cat, key).select(F.lit(3).alias("part"), "n", F.col("card").alias("text")))

"""Files as DataFrames and back: directories of texts, CSV tables of strings, JSON arrays, and sources that may be absent."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import unix_lines
from ..operators.relational import without_failed


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) not in (None,) and len(p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)) > 0


def texts(spark: SparkSession, directory: str, undecodable: str = "ignore") -> DataFrame:
    """(pid, text): a row for each .txt file, its stem the pid, line ends as LF; a pid whose file is gone has no row.

    Bytes that are no UTF-8 are left out ('ignore') or become U+FFFD ('replace'); a U+FFFD that is in the file stays.
    """
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(directory)
    stem = F.regexp_extract("path", r"([^/]+)\.txt$", 1)
    return raw.select(stem.alias("pid"), unix_lines(_decoded("content", undecodable)).alias("text"))


def _decoded(content: str, errors: str) -> Column:
    """The text of bytes, of which those that are no UTF-8 are treated as Python's handler of that name does."""
    valid = F.is_valid_utf8(F.col(content).cast("string"))

    @F.pandas_udf("string")
    def decode(s: pd.Series) -> pd.Series:
        return s.map(lambda b: None if b is None else bytes(b).decode("utf-8", errors))

    # few files have broken bytes, and only theirs cross to Python
    return F.when(valid, F.col(content).cast("string")).otherwise(decode(F.when(~valid, F.col(content))))


def csv_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV table with header, doubled quotes and line ends inside fields; an absent one is empty."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.csv(path, header=True, schema=schema, escape='"', multiLine=True)


def write_csv(df: DataFrame, path: str, fields: list[str] | None = None, mode: str = "overwrite") -> None:
    """The given fields, or all, as CSV with header; an empty table writes its header too."""
    (df.select(*fields) if fields else df).write.mode(mode).csv(path, header=True, escape='"')


def json_array(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The records of a file with a JSON array; records that do not parse are null, an absent file is empty."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.json(path, schema=schema, multiLine=True, mode="PERMISSIVE")


def catalogue_cards(text: Column) -> Column:
    """The cards of an old printed catalogue as an array of structs (pid, titulo, tipo, estructura)."""
    field = lambda c, n: F.nullif(F.regexp_extract(c, rf"(?m)^\s*{n}\s*:\s*(.*)$", 1), F.lit(""))
    cards = F.filter(F.split(F.concat(F.lit("\n"), text), r"\n\[\d{3,}\]\s+"), lambda c: F.trim(c) != "")
    return F.transform(
        cards,
        lambda c: F.struct(
            F.regexp_replace(F.regexp_extract(c, r"^(\S+)", 1), r"\.txt$", "").alias("pid"), field(c, "TITULO").alias("titulo"), field(c, "TIPO").alias("tipo"),
            F.split(field(c, "ESTRUCTURA"), " › ").alias("estructura"),
        ),
    )


def _file_system(directory: str):
    """(file system, path) of a folder by its URI, of the machine without one."""
    from pathlib import Path

    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(directory if "://" in directory or directory.startswith("file:") else Path(directory).absolute().as_uri())


def one_json_file(df: DataFrame, order: str, path: str) -> None:
    """A single JSON array file, rows in order, streamed through the driver partition by partition."""
    fs, place = _file_system(path)
    with fs.open_output_stream(place) as f:
        f.write(b"[")
        for i, (row,) in enumerate(df.orderBy(order).select("task").toLocalIterator()):
            f.write(((",\n" if i else "\n") + row).encode())
        f.write(b"\n]\n")


def write_texts(df: DataFrame, directory: str, name: str = "pid", text: str = "text") -> None:
    """A file <name>.txt for each row in a folder that all executors see; null texts give empty files. A repeated task writes the same."""

    def write(rows) -> None:
        fs, place = _file_system(directory)
        for n, t in rows:
            with fs.open_output_stream(f"{place}/{n}.txt") as f:
                f.write((t or "").encode())

    df.select(name, text).foreachPartition(write)


def write_selection(df: DataFrame, chosen: DataFrame, directory: str, key: str = "pid", text: str = "text") -> None:
    """The texts whose key is chosen and which exist, as files; a chosen key without text writes none."""
    write_texts(df.where(F.col(text).isNotNull()).join(chosen.select(key).distinct(), key, "left_semi"), directory, key, text)


def rewrite_without_failed(spark: SparkSession, path: str, target: str, schema: str, succeeded: Column, key: str) -> None:
    """The CSV rows at ``path`` of the keys with a success, written to ``target``; a table is not overwritten while it is read."""
    if path.rstrip("/") == target.rstrip("/"):
        raise ValueError("the target has to be another path")
    write_csv(without_failed(csv_table(spark, path, schema), succeeded, key), target)

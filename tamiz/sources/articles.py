"""Article metadata from a remote service as a Python data source: one input partition a year, read in parallel.

The service is behind a client, an importable class: ``documents(collection, start, end)`` yields dicts with pid, title, abstract,
document_type, publication_date, language, license and html_url, ``collections()`` yields dicts with code and name. ``FileClient``
serves JSON Lines files of a directory instead of a network.
"""

from __future__ import annotations

import importlib
import json
import unicodedata
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "pid string, titulo string, resumen string, tipo_documento string, anio string, idioma string, licencia string, html_url string"


class FileClient:
    """Articles from <place>/*.jsonl, collections from <place>/collections.json."""

    def __init__(self, place: str):
        self.place = Path(place)

    def collections(self) -> list[dict]:
        f = self.place / "collections.json"
        return json.loads(f.read_text("utf-8")) if f.exists() else []

    def documents(self, collection: str, start: str, end: str) -> Iterator[dict]:
        for f in sorted(self.place.glob("*.jsonl")):
            for line in f.open(encoding="utf-8"):
                d = json.loads(line)
                if d.get("collection", collection) == collection and start <= d.get("publication_date", "") <= end:
                    yield d


def find_collection(client, name: str, default: str) -> str:
    """The code of the first collection whose name contains ``name`` without accents and case, else the default."""
    fold = lambda s: "".join(c for c in unicodedata.normalize("NFKD", s or "") if not unicodedata.combining(c)).lower()
    return next((c["code"] for c in client.collections() if name in fold(c.get("name"))), default)


def record(d: dict) -> tuple:
    """A document of the service as a row; missing fields are null, an abstract may be a map by language."""
    abstract = d.get("abstract")
    if isinstance(abstract, dict):
        abstract = abstract.get("original") or " ".join(v for v in abstract.values() if v)
    licence = d.get("license")
    if isinstance(licence, dict):
        licence = licence.get("id") or licence.get("url")
    urls = d.get("fulltexts", {}).get("html") or {}
    pid = d.get("pid") or d.get("code")
    url = d.get("html_url") or next(iter(urls.values()), None) or (f"http://{d['domain']}/scielo.php?script=sci_arttext&pid={pid}" if d.get("domain") and pid else None)
    return pid, d.get("title"), abstract, d.get("document_type"), (d.get("publication_date") or "")[:4] or None, d.get("language"), licence, url


def article_scan(spark: SparkSession, place: str, from_year: int, until_year: int, most: int | None = None, **options: str) -> DataFrame:
    """The articles of the years, read in parallel; ``most`` is one limit over the whole scan."""
    spark.dataSource.register(ArticleSource)
    d = spark.read.format("articles").options(place=place, from_year=str(from_year), until_year=str(until_year), **options).load()
    return d if most is None else d.limit(most)


class Year(InputPartition):
    def __init__(self, year: int):
        super().__init__(year)


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[Year]:
        return [Year(y) for y in range(int(self.options["from_year"]), int(self.options["until_year"]) + 1)]

    def read(self, partition: Year) -> Iterator[tuple]:
        module, _, name = self.options.get("client", "tamiz.sources.articles:FileClient").partition(":")
        client = getattr(importlib.import_module(module), name)(self.options["place"])
        for d in client.documents(self.options.get("collection", "per"), f"{partition.value}-01-01", f"{partition.value}-12-31"):
            try:
                row = record(d)
            except Exception:  # a record that cannot be read is left out, the others of its year are not
                continue
            if row[0]:
                yield row


class ArticleSource(DataSource):
    """spark.dataSource.register(ArticleSource); spark.read.format("articles").options(place=, from_year=, until_year=).load()"""

    @classmethod
    def name(cls) -> str:
        return "articles"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)

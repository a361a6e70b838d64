"""Bodies of articles by pid: from the service's own copy, else from the page, with a status for every row and none lost to an error."""

from __future__ import annotations

import re
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.udfs import paragraphs

#: pid to the service's own copy of an article, or nothing
Lookup = Callable[[str], str | None]
#: url to (status code, body)
Get = Callable[[str], tuple[int, bytes | str]]
_CHARSET = re.compile(rb"charset=[\"']?([\w-]+)", re.I)


def decoded(body: bytes | str) -> str:
    """A page's text: by the character set it names, else UTF-8 if it is valid, else Windows-1252."""
    if isinstance(body, str):
        return body
    named = _CHARSET.search(body[:4096])
    for code in ([named.group(1).decode()] if named else []) + ["utf-8"]:
        try:
            return body.decode(code)
        except (UnicodeError, LookupError):
            continue
    return body.decode("cp1252", "replace")


def http_get(agent: str = "corpus/1.0", timeout: float = 30.0) -> Get:
    """A client of the standard library; an answer that is no success is a status, not an exception."""

    def get(url: str) -> tuple[int, bytes]:
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": agent}), timeout=timeout) as r:
                return r.status, r.read()
        except urllib.error.HTTPError as e:
            return e.code, b""

    return get


def body_of(pid: str, url: str | None, lookup: Lookup, get: Get, least: int = 200) -> tuple[str | None, str]:
    """(text, source) of an article. The service's copy stays as it is; a failing service is no reason to skip the page."""
    try:
        own = lookup(pid)
    except Exception:
        own = None
    if own and len(own) > least:
        return own, "articlemeta_body"
    if url:
        try:
            status, page = get(url)
            text, source = paragraphs(decoded(page)) if status == 200 else ("", "")
        except Exception as e:
            return None, f"error_http:{type(e).__name__}"
        if text:
            return text, source
    return None, "sin_texto"


def fetch_bodies(df: DataFrame, existing: DataFrame, lookup: Callable[[], Lookup], get: Callable[[], Get], tasks: int = 8, pace: float = 0.8) -> DataFrame:
    """(pid, text, fuente, chars) of the rows (pid, html_url), each pid once. ``lookup`` and ``get`` make a client in each task.

    A pid of ``existing`` (pid, chars) is not fetched: 'ya_existia'. At most ``tasks`` tasks call, each every ``pace`` seconds, so the
    services see no more than tasks / pace calls a second. Null and empty pids are left out. Write the result before using it.
    """
    once = df.where(F.coalesce("pid", F.lit("")) != "").groupBy("pid").agg(F.min("html_url").alias("html_url"))
    have = existing.where("pid is not null").groupBy("pid").agg(F.max("chars").cast("bigint").alias("chars"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        look, load = lookup(), get()
        for frame in frames:
            out = []
            for pid, url in zip(frame["pid"], frame["html_url"]):
                text, source = body_of(pid, url, look, load)
                out.append((pid, text, source, len(text or "")))
                if pace:
                    time.sleep(pace)
            yield pd.DataFrame(out, columns=["pid", "text", "fuente", "chars"])

    new = once.join(have.select("pid"), "pid", "left_anti").repartition(tasks).mapInPandas(run, "pid string, text string, fuente string, chars bigint")
    old = once.join(have, "pid").select("pid", F.lit(None).cast("string").alias("text"), F.lit("ya_existia").alias("fuente"), "chars")
    return new.unionByName(old)

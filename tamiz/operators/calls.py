"""Calls to outside services from Spark: retries with back-off, pacing, and rows that never get lost to an error."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

#: a client maps a request text to (status code, body, headers); exceptions count as a failed try
Client = Callable[[str], tuple[int, str, dict]]
RETRIED = frozenset((429, 500, 502, 503))


def delays(tries: int = 5, first: float = 5.0, most: float = 65.0) -> list[float]:
    """The pauses between tries: doubled each time, up to a bound."""
    return [min(first * 2**i, most) for i in range(tries - 1)]


def call(client: Client, request: str, tries: int = 5, first: float = 5.0, most: float = 65.0, sleep: Callable[[float], None] = time.sleep) -> tuple[str | None, str, int]:
    """(body, error, tries made). Overload and server errors and exceptions are tried again, the pause of an overloaded server within the
    bound is honoured, other errors end at once. The error is empty on success."""
    pauses = delays(tries, first, most)
    for n in range(tries):
        pause = pauses[n] if n < len(pauses) else 0.0
        try:
            status, body, headers = client(request)
        except Exception as e:
            if n == tries - 1:
                return None, f"excepcion: {type(e).__name__}", n + 1
            sleep(pause)
            continue
        if status == 200:
            return body, "", n + 1
        if status not in RETRIED:
            return None, f"HTTP {status}", n + 1
        if n == tries - 1:
            break
        after = str(headers.get("Retry-After", ""))
        sleep(min(float(after), most) if status == 429 and after.replace(".", "", 1).isdigit() else pause)
    return None, "agotados_reintentos", tries


def call_all(df: DataFrame, client: Callable[[], Client], key: str = "pid", request: str = "request", pace: float = 0.3, tries: int = 5, first: float = 5.0) -> DataFrame:
    """(key, response, error, tries): one call a row, ``pace`` seconds apart within a task. ``client`` makes a client in each task.

    Null requests get the error 'sin_peticion' without a call. Write the result before using it, so that no call is made twice.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        send = client()
        for frame in frames:
            out = []
            for k, r in zip(frame[key], frame[request]):
                if r is None:
                    out.append((k, None, "sin_peticion", 0))
                    continue
                out.append((k, *call(send, r, tries=tries, first=first)))
                if pace:
                    time.sleep(pace)
            yield pd.DataFrame(out, columns=[key, "response", "error", "tries"])

    return df.select(key, request).mapInPandas(run, f"{key} {kind}, response string, error string, tries int")

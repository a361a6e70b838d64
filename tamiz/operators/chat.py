"""Requests to a chat model and its answers: body, client, content and token counts."""

from __future__ import annotations

import json
import os
import urllib.error
import urllib.request

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .calls import Client

USAGE = ("prompt_tokens", "completion_tokens", "prompt_cache_hit_tokens", "prompt_cache_miss_tokens")
_ANSWER = f"choices array<struct<message:struct<content:string>>>, usage struct<{','.join(f'{c}:bigint' for c in USAGE)}>"


def secret(name: str) -> str:
    """A secret of the driver's environment; absent or blank, the run ends before a call is made. It is never logged or written."""
    value = os.environ.get(name, "").strip()
    if not value:
        raise RuntimeError(f"{name} is not set")
    return value


def chat_body(system: str, user: Column, model: str, max_tokens: int) -> Column:
    """The JSON of a request with temperature 0 whose answer is to be a JSON object; null for a null text."""
    message = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    body = F.struct(
        F.lit(model).alias("model"), F.array(message("system", F.lit(system)), message("user", user)).alias("messages"), F.lit(0).alias("temperature"),
        F.lit(max_tokens).alias("max_tokens"), F.struct(F.lit("json_object").alias("type")).alias("response_format"),
    )
    return F.when(user.isNotNull(), F.to_json(body))


def http_chat(url: str, key: str, timeout: float = 180.0) -> Client:
    """A client that posts request bodies; an answer that is no success is a status, not an exception."""

    def send(request: str) -> tuple[int, str, dict]:
        r = urllib.request.Request(url, request.encode(), {"Authorization": f"Bearer {key}", "Content-Type": "application/json"})
        try:
            with urllib.request.urlopen(r, timeout=timeout) as a:
                return a.status, a.read().decode("utf-8", "replace"), dict(a.headers)
        except urllib.error.HTTPError as e:
            return e.code, "", dict(e.headers)

    return send


def answers(called: DataFrame, response: str = "response", error: str = "error") -> DataFrame:
    """The rows of ``calls.call_all`` with ``content`` and the token counts; a count that is missing is 0.

    An answer that is not JSON has the error 'respuesta_no_json', one without content 'respuesta_vacia'; earlier errors stay.
    """
    parsed = F.from_json(response, _ANSWER)
    d = called.withColumn("_a", parsed).withColumn("content", F.try_element_at("_a.choices", F.lit(1)).message.content)
    fault = F.when(F.try_parse_json(response).isNull(), "respuesta_no_json").when(F.coalesce(F.trim("content"), F.lit("")) == "", "respuesta_vacia").otherwise("")
    return d.select(
        *[c for c in called.columns if c not in (response, error)], "content", F.when(F.col(error) != "", F.col(error)).otherwise(fault).alias(error), *(F.coalesce(F.col(f"_a.usage.{c}"), F.lit(0)).alias(c) for c in USAGE)
    )


def usage(answered: DataFrame) -> DataFrame:
    """One row: calls, failed ones, and the sums of the token counts."""
    return answered.agg(F.count(F.lit(1)).alias("calls"), F.count_if(F.col("error") != "").alias("failed"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in USAGE))


def fake_chat(content: str, usage: dict[str, int]) -> str:
    """The answer that a service gives, for tests and runs without one."""
    return json.dumps({"choices": [{"message": {"content": content}}], "usage": usage})

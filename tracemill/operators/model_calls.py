"""Model calls as relations: requests ``(key, prompt, kind)`` go in, responses ``(key, raw, error)`` come out.

A backend is any picklable function from a prompt and its kind to a text. The
responses are written before anything is derived from them, so that a plan
never calls a model twice, and what follows is ordinary relational work.
"""

from __future__ import annotations

import json
import re
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.functions.parsing import udf_json
from tracemill.sources.stage import staged

Backend = Callable[[str, str], str]


# Seconds to wait after a failure, by its kind, in general and for the pairwise judge.
WAITS = (("timeout", 30.0), ("connection", 10.0), ("429", 30.0), ("other", 5.0))
JUDGE_WAITS = (("timeout", 3.0), ("connection", 5.0), ("http", 2.0), ("429", 2.0), ("other", 1.0))


@dataclass(frozen=True)
class HttpBackend:
    """A chat-completions endpoint. Defaults as in the pipelines: temperature 0, 4096 tokens, 120 s, 3 tries."""

    url: str
    model: str
    key: str = ""
    temperature: float = 0.0
    max_tokens: int = 4096
    timeout: float = 120.0
    tries: int = 3
    waits: tuple[tuple[str, float], ...] = WAITS
    #: Whether a wait grows with the number of the try, and the longest one.
    growing: bool = True
    longest: float = 600.0
    #: An endpoint for plain completions, used once the chat endpoint says that the model is none for chat.
    completions: str = ""

    def _asked(self, prompt: str, chat: bool) -> str:
        own = {"messages": [{"role": "user", "content": prompt}]} if chat else {"prompt": flat_messages([{"role": "user", "content": prompt}])}
        body = {"model": self.model, "temperature": self.temperature, "max_tokens": self.max_tokens} | own
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.key}"} if self.key else {})
        request = urllib.request.Request(self.url if chat else self.completions, json.dumps(body).encode(), headers)
        with urllib.request.urlopen(request, timeout=self.timeout) as reply:
            return reply_text(json.load(reply))

    def __call__(self, prompt: str, kind: str) -> str:
        last, chat, attempt = "", True, 1
        while attempt <= self.tries:
            try:
                return self._asked(prompt, chat)
            except TimeoutError:
                last = "timeout"
            except urllib.error.HTTPError as e:
                if chat and self.completions and not_for_chat(e.code, e.read().decode(errors="replace")):
                    chat = False
                    continue
                last = "429" if e.code == 429 else "http"
            except urllib.error.URLError as e:
                last = "timeout" if isinstance(e.reason, TimeoutError) else "connection"
            except (ValueError, KeyError, IndexError):
                last = "other"
            if attempt < self.tries:
                wait = dict(self.waits).get(last, dict(self.waits)["other"])
                time.sleep(min(self.longest, wait * (attempt if self.growing else 1)))
            attempt += 1
        raise RuntimeError(f"no reply after {self.tries} tries: {last}")


def reply_text(data: dict) -> str:
    """The text of a chat or completion reply, whole or in parts."""
    choice = data["choices"][0]
    content = (choice.get("message") or choice.get("delta") or {}).get("content", choice.get("text", ""))
    return "".join(p.get("text", "") for p in content) if isinstance(content, list) else content or ""


def flat_messages(messages: list[dict]) -> str:
    """A conversation as one text for a completion, ending where the reply begins."""
    return "\n\n".join([*(f"{m['role'].upper()}:\n{m['content']}" for m in messages), "ASSISTANT:\n"])


def not_for_chat(code: int, message: str) -> bool:
    """Whether an error says that the model has no chat endpoint."""
    low = message.lower()
    return code in (400, 404, 405) and ("not a chat model" in low or "chat template" in low or "v1/completions" in low)


def joined_stream(parts: Iterator[dict]) -> str:
    """The text of a reply that came in pieces."""
    return "".join(reply_text(p) for p in parts if p.get("choices"))


def resolve_key(flag: str | None, environment: dict[str, str], names: tuple[str, ...]) -> str:
    """A key given directly, else the first variable that is set, else ''."""
    return next((k for k in (flag, *(environment.get(n) for n in names)) if k), "")


def ask(requests: DataFrame, backend: Backend, at_once: int = 4, partitions: int | None = None, name: str = "responses") -> DataFrame:
    """``(key, raw, error)`` for each request; a failed call gives a null ``raw`` and its error.

    ``at_once`` calls run in each partition and ``partitions`` of them at a
    time: their product bounds the load on the model. Equal prompts of one
    kind are asked each; null prompts give an error. The result is written.
    """
    rows = requests.select(F.col("key").cast("string"), "prompt", F.coalesce("kind", F.lit("")).alias("kind"))
    rows = rows.repartition(partitions) if partitions else rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one(row: tuple[str | None, str]) -> tuple[str | None, str | None]:
            try:
                return (None, "no prompt") if row[0] is None else (backend(*row), None)
            except Exception as e:  # noqa: BLE001
                return None, f"{type(e).__name__}: {e}"[:500]

        with ThreadPoolExecutor(at_once) as pool:
            for batch in batches:
                out = list(pool.map(one, zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.string())], names=["key", "raw", "error"])

    return staged(rows.mapInArrow(run, "key string, raw string, error string"), name)


def parsed(responses: DataFrame, schema: str) -> DataFrame:
    """The JSON in each reply as a struct ``value``; where there is none, ``error`` says so."""
    rows = responses.withColumn("value", F.from_json(udf_json("raw"), schema))
    return rows.withColumn("error", F.when(F.col("error").isNull() & F.col("value").isNull(), "JSON parse failed").otherwise(F.col("error")))


def error_type(error: Column | str) -> Column:
    """Kinds of failure: too long, network, JSON, other; null for no error."""
    text = F.lower(F.col(error) if isinstance(error, str) else error)
    return (
        F.when(text.isNull(), None).when(text.rlike("too long|context|length"), "too_long").when(text.rlike("timeout|connection|http|429|no reply"), "network")
        .when(text.contains("json"), "json").otherwise("other")
    )


def template(text: str, /, **columns: Column) -> Column:
    """A prompt from a template with ``{name}`` places; doubled braces are single ones."""
    parts, at = [], 0
    for m in re.finditer(r"\{\{|\}\}|\{(\w+)\}", text):
        if m.group(1) and m.group(1) not in columns:
            continue
        found = F.coalesce(columns[m.group(1)].cast("string"), F.lit("")) if m.group(1) else F.lit(m.group()[0])
        parts += [F.lit(text[at : m.start()]), found]
        at = m.end()
    return F.concat(*parts, F.lit(text[at:]))


def ask_validated(requests: DataFrame, backend: Backend, schema: str, wrong: Callable[[Column], Column], rounds: int = 3, **how) -> DataFrame:
    """``(key, value, error)``: replies that parse and of which ``wrong(value)`` (null or the name of a fault) finds nothing; others are asked again, in up to ``rounds`` rounds.

    Each round asks only what is still open; what a last round leaves open
    keeps its error.
    """
    open_, done = requests, None
    for i in range(rounds):
        got = parsed(ask(open_, backend, name=f"round{i}", **how), schema)
        fault = wrong(F.col("value"))
        got = staged(got.select("key", "value", F.when(F.col("error").isNotNull(), F.col("error")).when(fault.isNotNull(), F.concat(F.lit("validation failed: "), fault)).alias("error")), "checked")
        last = i == rounds - 1
        good = got if last else got.filter("error IS NULL")
        done = good if done is None else done.unionByName(good)
        if last or not got.filter("error IS NOT NULL").limit(1).count():
            return done
        open_ = requests.join(got.filter("error IS NOT NULL").select("key"), "key", "left_semi")
    return done


def attach(items: DataFrame, key: str, judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items with their parsed reply, and failures ``(key, status, error)`` of those whose reply is missing or unusable."""
    own = judged.select(F.col("key").alias("_k"), "value", "error")
    rows = items.join(own, F.col(key).cast("string") == F.col("_k"), "left").drop("_k")
    bad = F.col("value").isNull()
    failures = rows.filter(bad).select(key, F.lit("judge_failed").alias("status"), F.coalesce("error", F.lit("no reply")).alias("error"))
    return rows.filter(~bad).drop("error"), failures

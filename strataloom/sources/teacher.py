"""Language-model back ends behind Arrow batches.

A teacher is any callable from a request (messages, sampling, seed, schema) to
a result (content, finish_reason). Calls of a batch run on a bounded pool of
threads; a failure becomes the ``error`` of its row and never fails its neighbours.
"""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from itertools import count
from threading import BoundedSemaphore

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class HttpTeacher:
    """Chat completions over HTTP: end points in turn, at most ``concurrency`` calls at once to each from one worker,
    and retries with a back-off of at most 30 seconds."""

    urls: list[str]
    model: str
    key: str = ""
    timeout: float = 600.0
    retries: int = 4
    concurrency: int = 448
    turn: count = field(default_factory=count, repr=False)
    gates: list = field(default_factory=list, repr=False)

    def __post_init__(self) -> None:
        if not self.urls or self.concurrency < 1:
            raise ValueError("a teacher needs an end point and room for a call")
        self.gates = [BoundedSemaphore(self.concurrency) for _ in self.urls]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("turn", "gates")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state | {"turn": count(), "gates": [BoundedSemaphore(state["concurrency"]) for _ in state["urls"]]}

    def _post(self, path: str, body: dict) -> dict:
        for attempt in range(self.retries + 1):
            at = next(self.turn) % len(self.urls)
            request = urllib.request.Request(self.urls[at].rstrip("/") + path, json.dumps(body).encode(), {"Content-Type": "application/json", **({"Authorization": f"Bearer {self.key}"} if self.key else {})})
            try:
                with self.gates[at], urllib.request.urlopen(request, timeout=self.timeout) as answer:
                    return json.load(answer)["choices"][0]
            except OSError:
                if attempt == self.retries:
                    raise
                time.sleep(min(30.0, 2.0**attempt))
        raise AssertionError("unreachable")

    def __call__(self, messages: list[dict], sampling: dict, seed: int, schema: dict | None = None) -> dict:
        body = {"model": self.model, "messages": messages, "seed": seed, **sampling}
        if schema:
            body["response_format"] = {"type": "json_schema", "json_schema": {"name": "verdict", "strict": True, "schema": schema}}
        choice = self._post("/chat/completions", body)
        return {"content": choice["message"]["content"], "finish_reason": choice.get("finish_reason")}

    def chat(self, messages: list[dict], sampling: dict, seed: int) -> str:
        """The text of an answer."""
        return self(messages, sampling, seed)["content"]

    def completion(self, prompt: str, sampling: dict, seed: int, stop: list[str] | None = None) -> str:
        """The text that continues a prompt."""
        return self._post("/completions", {"model": self.model, "prompt": prompt, "seed": seed, **({"stop": stop} if stop else {}), **sampling})["text"]

    def verdict(self, messages: list[dict], sampling: dict, seed: int, schema: dict) -> dict:
        """The object of a structured answer (S14d)."""
        return verdict_of(self(messages, sampling, seed, schema))


def verdict_of(result: dict) -> dict:
    """The JSON object of a structured call; it must have stopped by itself."""
    if result.get("finish_reason") != "stop":
        raise ValueError(f"the call ended with {result.get('finish_reason')}")
    value = json.loads(result["content"])
    if not isinstance(value, dict):
        raise ValueError("the verdict is no object")
    return value


def lenient_object(text: str) -> dict:
    """The outermost JSON object of a text, with or without a fence around it."""
    start, end = text.find("{"), text.rfind("}")
    if start < 0 or end < start:
        raise ValueError("there is no object")
    return json.loads(text[start : end + 1])


def ask(df: DataFrame, teacher: Callable[..., dict], messages: str = "messages", seed: str = "seed", sampling: dict | None = None, concurrency: int = 32) -> DataFrame:
    """``df`` with ``content``, ``finish_reason`` and ``error`` of one call per row."""
    settings, names = sampling or {}, df.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def one(said, number):
            try:
                result = teacher([dict(m) for m in said], settings, int(number))
                return result["content"], result.get("finish_reason"), None
            except Exception as problem:  # the row keeps its failure
                return None, None, repr(problem)[-4000:]

        with ThreadPoolExecutor(concurrency) as pool:
            for batch in batches:
                answers = list(pool.map(one, batch[messages], batch[seed]))
                yield pd.concat([batch.reset_index(drop=True), pd.DataFrame(answers, columns=["content", "finish_reason", "error"], dtype=object)], axis=1)

    fields = ", ".join(f"`{n}` {k}" for n, k in df.dtypes)
    return df.mapInPandas(run, f"{fields}, content string, finish_reason string, error string").select(*names, "content", "finish_reason", "error")


def shard_decisions(rows: DataFrame, shard: str = "shard_key", error: str = "error") -> DataFrame:
    """Per shard: failures, and whether it is accepted: at most max(8, ceil(2 %)) and not all."""
    sums = rows.groupBy(shard).agg(F.count("*").alias("rows"), F.count(error).alias("failures"))
    allowed = F.greatest(F.lit(8), F.ceil(F.col("rows") * 0.02))
    return sums.withColumn("accepted", (F.col("failures") <= allowed) & (F.col("failures") < F.col("rows")))

"""Seam for external models (recognition, remote transcription, diarization, embeddings) as table functions.

A model is any callable on one input row, made once a worker by a factory. Failures stay with their row.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame


class CallTimeout(Exception):
    """A call took longer than allowed."""


def backoff(attempt: int, base_s: float = 10.0) -> float:
    """Seconds to wait after failed attempt 0, 1, 2, ...: base, twice, four times, ..."""
    return base_s * 2 ** attempt


class Exhausted(RuntimeError):
    """A busy service took none of the calls."""


@dataclass(frozen=True)
class Retry:
    """How a call is tried again.

    A service is ``busy`` when a call ends in one of these exceptions or in one whose ``code`` or ``status_code`` is among
    ``busy_codes``; that says nothing about the input, so the end of the tries is told as :class:`Exhausted`. Any other error is the
    input's own and comes out as it is when the tries are used up.
    """

    attempts: int = 5
    base_s: float = 10.0
    timeout_s: float | None = None
    busy: tuple[type[Exception], ...] = (CallTimeout, ConnectionError)
    busy_codes: frozenset[int] = frozenset({429, 503})

    def is_busy(self, error: Exception) -> bool:
        codes = {getattr(error, "code", None), getattr(error, "status_code", None)}
        return isinstance(error, self.busy) or any(c in self.busy_codes for c in codes if isinstance(c, int))


def with_timeout(call: Callable, seconds: float | None):
    """``call()``, or CallTimeout after ``seconds``; works in any thread (no signals), the late call is left behind."""
    if not seconds:
        return call()
    box: list = []

    def run() -> None:
        try:
            box.append((True, call()))
        except BaseException as e:  # noqa: BLE001
            box.append((False, e))

    t = threading.Thread(target=run, daemon=True)
    t.start()
    t.join(seconds)
    if not box:
        raise CallTimeout(f"no answer after {seconds:g} s")
    ok, value = box[0]
    if not ok:
        raise value
    return value


def with_retry(call: Callable, policy: Retry = Retry(), sleep: Callable[[float], None] = time.sleep):
    """Result of ``call`` within the policy's attempts, with growing waits between them."""
    failed: list[Exception] = []
    while len(failed) < policy.attempts:
        if failed:
            sleep(backoff(len(failed) - 1, policy.base_s))
        try:
            return with_timeout(call, policy.timeout_s)
        except Exception as e:  # noqa: BLE001
            failed.append(e)
    if policy.is_busy(failed[-1]):
        raise Exhausted(f"busy, {len(failed)} attempts") from failed[-1]
    raise failed[-1]


def apply_model(df: DataFrame, factory: Callable[[], Callable[[dict], list[dict]]], schema: str, keys: list[str], policy: Retry = Retry(attempts=1)) -> DataFrame:
    """``keys`` and the model's fields for each row it returns, plus ``error``; an input that fails gives one row with its error.

    ``schema`` names the model's fields. The factory runs once a task, so weights are loaded once.
    """
    kinds = dict(df.dtypes)
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                head = [row[k] for k in keys]
                try:
                    for got in with_retry(lambda r=row: model(r), policy):
                        out.append([*head, *(got.get(n) for n in names), None])
                except Exception as e:  # noqa: BLE001
                    out.append([*head, *([None] * len(names)), f"{type(e).__name__}: {e}"])
            yield pd.DataFrame(out, columns=[*keys, *names, "error"])

    return df.mapInPandas(run, ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), schema, "error string"]))

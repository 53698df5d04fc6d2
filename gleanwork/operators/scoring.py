"""The user-code hook: a document scorer runs over request rows and never throws past its row."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame

from gleanwork.functions.labels import RESPONSE

# Takes one request document, returns one response body; see `functions.labels.BODY`.
Scorer = Callable[[Mapping[str, object]], Mapping[str, object]]
ANSWER = "custom_id string, answer string"


def score(requests: DataFrame, scorer: Scorer) -> DataFrame:
    """Answer every ``custom_id, request`` row: ``custom_id, answer`` with a JSON result or error."""

    def answer(custom_id: str, request: str) -> str:
        started = time.perf_counter()
        try:
            outcome = {"response": {"status_code": 200, "body": scorer(json.loads(request))}, "error": None}
        except Exception as error:  # noqa: BLE001 - a failing request must become a row
            outcome = {"response": None, "error": f"{type(error).__name__}: {error}"}
        elapsed = round(time.perf_counter() - started, 6)
        return json.dumps({"custom_id": custom_id, **outcome, "elapsed_seconds": elapsed})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers = [answer(i, r) for i, r in zip(batch["custom_id"], batch["request"], strict=True)]
            yield pd.DataFrame({"custom_id": batch["custom_id"], "answer": answers})

    return requests.select("custom_id", "request").mapInPandas(run, ANSWER)


def parsed_answers(answers: DataFrame) -> DataFrame:
    """Answers as ``custom_id, error, response, elapsed_seconds``."""
    from pyspark.sql import functions as F

    return answers.select(F.from_json("answer", RESPONSE).alias("r")).select("r.*")

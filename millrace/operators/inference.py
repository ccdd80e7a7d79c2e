"""Batch inference with a pluggable model."""

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import fixed
from millrace.operators.tables import with_defaults
from millrace.schemas import REPLY


def with_request_defaults(requests: DataFrame) -> DataFrame:
    """Fill the request parameters that are absent."""
    defaults = {
        "request_id": F.concat(F.lit("req_"), F.sha2(F.to_json("messages"), 256)),
        "max_tokens": F.lit(fixed.DEFAULT_MAX_TOKENS),
        "temperature": F.lit(fixed.DEFAULT_TEMPERATURE),
        "seed": F.lit(fixed.DEFAULT_SEED),
    }
    return with_defaults(requests, defaults)


def infer(
    requests: DataFrame, model_factory, batch_size=fixed.BATCH_REQUESTS, tasks=None
) -> DataFrame:
    """One reply per request.

    ``model_factory()`` is called once per task and returns a function from a
    list of request dicts to a list of reply dicts, or exceptions, of the same
    length.  ``tasks`` spreads the requests evenly over that many, for a model
    that is slow compared with reading its input.  A request without messages and a request the model fails on get
    an error reply of their own; the rest of the batch is not affected.
    """

    def serve(frames):
        model = model_factory()
        for frame in frames:
            for start in range(0, len(frame), batch_size):
                part = frame.iloc[start : start + batch_size].to_dict("records")
                yield pd.DataFrame(_answer(model, part))

    spread = requests.repartition(tasks) if tasks else requests
    return spread.mapInPandas(serve, REPLY)


NO_ANSWER = "no_answer"


def _reply(request, error=None, **found):
    return {
        "request_id": request["request_id"],
        "success": error is None,
        "error": error,
        "content": found.get("content"),
        "tool_calls": found.get("tool_calls"),
        "usage": found.get("usage"),
    }


def _answer(model, requests):
    """Replies in the order of the requests."""
    filled = [i for i, r in enumerate(requests) if r["messages"] is not None and len(r["messages"])]
    answers = dict(zip(filled, _call(model, [requests[i] for i in filled])))
    unanswered = set(filled) - set(answers)
    replies = []
    for i, request in enumerate(requests):
        answer = answers.get(i)
        if i in unanswered:
            replies.append(_reply(request, error=NO_ANSWER))
        elif i not in answers:
            replies.append(_reply(request, error=fixed.EMPTY_MESSAGES))
        elif isinstance(answer, Exception):
            replies.append(_reply(request, error=str(answer)))
        else:
            replies.append(_reply(request, **answer))
    return replies


def _call(model, requests):
    """Answers of a batch; if the batch fails, each request is tried alone."""
    if not requests:
        return []
    try:
        return model(requests)
    except Exception as error:
        if len(requests) == 1:
            return [error]
        return [_call(model, [r])[0] for r in requests]

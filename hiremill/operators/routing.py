"""Routing of chat messages; works on batch and streaming frames alike."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiremill.functions.labels import GUIDANCE, provider, route, route_prompt
from hiremill.functions.text import or_empty, strip


def route_messages(messages: DataFrame) -> DataFrame:
    """Adds ``route``, ``prompt`` (NULL where no model is asked) and ``reply`` (guidance only)."""
    message, resume = strip(or_empty("message")), strip(or_empty("pdf_text"))
    return (
        messages.withColumn("route", route(message, resume))
        .withColumn("prompt", route_prompt(message, resume))
        .withColumn("reply", F.when(F.col("route") == "guidance", GUIDANCE))
    )


def answer_prompts(routed: DataFrame, reply_to: Callable[[str], str]) -> DataFrame:
    """Fills ``reply`` of the routes that ask a chat model; an error becomes the reply text."""
    schema = T.StructType(routed.schema.fields)

    def reply(prompt: str | None, known: str | None) -> str | None:
        if prompt is None:
            return known
        try:
            return reply_to(prompt).strip() or "I could not generate a reply right now."
        except Exception as exc:  # one failed call must not end the job
            return f"[Chat model error] {exc}"

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["prompt"].astype(object).where(batch["prompt"].notna(), None)
            batch["reply"] = [reply(p, r) for p, r in zip(texts, batch["reply"])]
            yield batch[schema.names]

    return routed.mapInPandas(answer, schema)


# How a failed call of each service reads.
SERVICE_ERRORS = {"gemini": "[Gemini Error]", "ollama": "[Ollama Error]"}


def prompt_models(prompts: DataFrame, services: dict[str, Callable[[str, str], str]]) -> DataFrame:
    """Adds ``provider`` and ``reply`` to rows of ``model`` and ``prompt``.

    ``services`` maps each provider to a function of model and prompt; which one
    is called follows from the model's name. An error becomes the reply text.
    """
    chosen = prompts.withColumn("provider", provider("model")).withColumn("reply", F.lit(None).cast("string"))
    schema = T.StructType(chosen.schema.fields)

    def call(name: str, model: str, prompt: str) -> str:
        try:
            return services[name](model, prompt).strip() or f"{SERVICE_ERRORS[name]} Empty response from model."
        except Exception as exc:  # one failed call must not end the job
            return f"{SERVICE_ERRORS[name]} {exc}"

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["reply"] = [call(*row) for row in zip(batch["provider"], batch["model"], batch["prompt"])]
            yield batch[schema.names]

    return chosen.mapInPandas(ask, schema)

"""Enrichment: batches of untagged jobs go to an injected model, its answers come back as tags."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiremill.functions.labels import RESUME_CHARS
from hiremill.functions.skills import SEPARATOR, parse_skills
from hiremill.functions.text import normalize_newlines, or_empty, sanitize, strip
from hiremill.operators.ordering import number_rows
from hiremill.session import materialize

BATCH_ROWS = 5
PROMPT_CHARS = 1000
MAX_ATTEMPTS = 3

# A model call: prompt in, answer text and reported tokens (None if not reported) out.
Model = Callable[[str], tuple[str, int | None]]

# Prompt texts.
TAG_PROMPT = (
    "Extract technical stacks from the following job descriptions. "
    "Return strictly a JSON object where keys are the job IDs and values "
    "are comma-separated strings of the tech stack.\n"
)
EXTRACT_PROMPT_HEAD = """
        Extract only the hard technical skills (programming languages, frameworks, cloud platforms, tools) from the following resume.
        Ignore soft skills like 'leadership', 'management', and ignore certifications.
"""
EXTRACT_PROMPT_JSON = """        Return JSON with one key: "technical_skills" (a list of strings).
"""

BATCH_LOG = T.StructType(
    [
        T.StructField("attempts", T.LongType()),
        T.StructField("tokens", T.LongType()),
        T.StructField("answer", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)


def untagged_jobs(jobs: DataFrame, trim_blank: bool = False) -> DataFrame:
    """Jobs without tags.

    The tagging run takes NULL and ``''`` and reads two columns. With
    ``trim_blank`` a value of spaces only counts as untagged too, and all
    listing fields come in key order.
    """
    stack = F.col("tech_stack")
    if not trim_blank:
        return jobs.filter(stack.isNull() | (stack == "")).select("source_id", "description")
    listed = jobs.filter(stack.isNull() | (F.trim(stack) == ""))
    return listed.orderBy("source_id").select("source_id", "job_title", "company", "description")


def tag_batches(untagged: DataFrame, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """``(batch_id, position, source_id, text)``: consecutive jobs in key order, texts as they are.

    A NULL description goes in as ``''``.
    """
    texts = untagged.select("source_id", or_empty("description").alias("text"))
    return number_rows(texts, "source_id").select(
        F.floor(F.col("row_index") / batch_rows).alias("batch_id"),
        (F.col("row_index") % batch_rows).alias("position"),
        "source_id",
        "text",
    )


@F.pandas_udf(T.StringType())
def _json_object(names: pd.Series, values: pd.Series) -> pd.Series:
    """The entries of a batch as JSON text: ASCII only, a space after each comma and colon.

    ``to_json`` writes neither, and the token estimate counts words.
    """
    return pd.Series([json.dumps(dict(zip(n, v))) for n, v in zip(names, values)])


def tag_prompts(batches: DataFrame, chars: int = PROMPT_CHARS) -> DataFrame:
    """``(batch_id, prompt)``; the prompt ends with an id to text JSON object in position order.

    A model is shown the first ``chars`` characters of each text.
    """
    shown = F.substring("text", 1, chars).alias("text")
    grouped = batches.groupBy("batch_id").agg(
        F.array_sort(F.collect_list(F.struct("position", "source_id", shown))).alias("jobs")
    )
    body = _json_object(F.col("jobs.source_id"), F.col("jobs.text"))
    return grouped.select("batch_id", F.concat(F.lit(TAG_PROMPT), body).alias("prompt"))


def attempt(model: Model, prompt: str, check: Callable[[object], bool]) -> tuple[int, str | None, str | None]:
    """One call: ``(tokens, answer, error)``; tokens count even if the answer is no use."""
    tokens = 0
    try:
        answer, reported = model(prompt)
        tokens = reported if reported is not None else len(prompt.split()) * 4
        parsed = json.loads(answer)
        if not check(parsed):
            raise ValueError("answer has the wrong form")
        return tokens, json.dumps(parsed, ensure_ascii=False), None
    except Exception as exc:  # a failed call must not end the job
        return tokens, None, f"{type(exc).__name__}: {exc}"


def _ask(model: Model, prompt: str, check: Callable[[object], bool], wait: float) -> tuple[int, int, str | None, str | None]:
    """Up to three attempts."""
    tokens, error = 0, None
    for number in range(1, MAX_ATTEMPTS + 1):
        used, answer, error = attempt(model, prompt, check)
        tokens += used
        if error is None:
            return number, tokens, answer, None
        if number < MAX_ATTEMPTS and wait:
            time.sleep(wait)
    return MAX_ATTEMPTS, tokens, None, error


def ask_model(prompts: DataFrame, model: Model, check: Callable[[object], bool], key: str, wait: float = 0.0) -> DataFrame:
    """Call ``model`` on each ``prompt``: ``(key, attempts, tokens, answer, error)``.

    Calls are made where the rows are; the answer of a model may differ from
    call to call, so callers materialize the result before they use it.
    """
    schema = T.StructType([prompts.schema[key], *BATCH_LOG.fields])

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, *_ask(model, p, check, wait)) for k, p in zip(batch[key], batch["prompt"])]
            yield pd.DataFrame(rows, columns=schema.names)

    return prompts.select(key, "prompt").mapInPandas(ask, schema)


def is_tag_answer(answer: object) -> bool:
    """An object whose values can be stored as text."""
    return isinstance(answer, dict) and not any(isinstance(v, (dict, list)) for v in answer.values())


def is_extraction(answer: object) -> bool:
    return isinstance(answer, dict) and all(isinstance(s, str) for s in answer.get("technical_skills") or [])


def answered_tags(log: DataFrame) -> DataFrame:
    """``(batch_id, position, source_id, tech_stack)`` from the answers of batches that succeeded."""
    entries = F.from_json("answer", "map<string,string>")
    rows = log.filter(F.col("answer").isNotNull()).select("batch_id", F.posexplode(entries))
    return rows.select(
        "batch_id", F.col("pos").alias("position"), F.col("key").alias("source_id"), F.col("value").alias("tech_stack")
    )


def apply_tags(jobs: DataFrame, tags: DataFrame) -> DataFrame:
    """Jobs with new tags; of several answers for a key the last one holds, unknown keys change nothing."""
    last = tags.groupBy("source_id").agg(
        F.max_by(F.struct("tech_stack"), F.struct("batch_id", "position")).alias("new")
    )
    answered = F.col("new").isNotNull()
    return jobs.join(last, "source_id", "left").select(
        *[
            F.when(answered, F.col("new.tech_stack")).otherwise(F.col(c)).alias(c) if c == "tech_stack" else F.col(c)
            for c in jobs.columns
        ]
    )


def clear_tags(jobs: DataFrame) -> DataFrame:
    return jobs.withColumn("tech_stack", F.lit(None).cast("string"))


def set_tags(jobs: DataFrame, source_id: str, tech_stack: str | None) -> DataFrame:
    """Jobs with the tags of one key replaced."""
    hit = F.col("source_id") == F.lit(source_id)
    return jobs.withColumn("tech_stack", F.when(hit, F.lit(tech_stack)).otherwise(F.col("tech_stack")))


def tag_jobs(jobs: DataFrame, model: Model, wait: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """The whole tagging run: ``(jobs with tags, batch log)``.

    An answer may name a job of another batch; it tags that job.

    Batches are numbered before any call and the log is a written table, so a
    lost executor repeats at most its own unfinished calls.
    """
    batches = materialize(tag_batches(untagged_jobs(jobs)), "tag-batches")
    log = materialize(ask_model(tag_prompts(batches), model, is_tag_answer, "batch_id", wait), "tag-log")
    return apply_tags(jobs, answered_tags(log)), log


def usage_totals(log: DataFrame) -> DataFrame:
    return log.agg(
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("total_tokens"),
        F.coalesce(F.sum("attempts"), F.lit(0)).alias("attempts"),
        F.count_if(F.col("error").isNotNull()).alias("failed_batches"),
    )


def extraction_prompt(text: Column | str, name_key: bool = False) -> Column:
    """Prompt that asks for the skills of a résumé; ``name_key`` spells out the JSON key."""
    c = F.col(text) if isinstance(text, str) else text
    head = EXTRACT_PROMPT_HEAD + (EXTRACT_PROMPT_JSON if name_key else "")
    return F.concat(F.lit(head + "        <resume>\n        "), c, F.lit("\n        </resume>\n        "))


def extract_resume_skills(
    resumes: DataFrame, model: Model, wait: float = 0.0, key: str = "resume_id", chars: int = RESUME_CHARS
) -> DataFrame:
    """``(key, technical_skills, total_tokens, error)``; a failed extraction reads as no skills.

    The model is shown the first ``chars`` characters of a résumé.
    """
    shown = F.substring(normalize_newlines("text"), 1, chars)
    prompts = resumes.select(key, extraction_prompt(sanitize(shown)).alias("prompt"))
    log = materialize(ask_model(prompts, model, is_extraction, key, wait), "extractions")
    listed = F.from_json("answer", "technical_skills array<string>")["technical_skills"]
    return log.select(
        key,
        F.coalesce(listed, F.array().cast("array<string>")).alias("technical_skills"),
        F.col("tokens").alias("total_tokens"),
        "error",
    )


def batch_plan(workload: DataFrame, quality_cap: int = 8) -> DataFrame:
    """Batch size, number of calls and retry delay from rate limits and workload.

    Needs ``total_jobs, tokens_per_job, rpm, tpm, rpd``.
    """
    by_tokens = F.floor((F.col("tpm") * 0.35 - 120) / F.col("tokens_per_job"))
    by_requests = F.ceil(F.col("total_jobs") / F.col("rpd"))
    size = F.greatest(F.lit(1), by_requests, F.least(by_tokens, F.col("total_jobs"), F.lit(quality_cap))).cast("bigint")
    return (
        workload.withColumn("batch_size", size)
        .withColumn("calls", F.ceil(F.col("total_jobs") / F.col("batch_size")).cast("bigint"))
        .withColumn("retry_delay", F.lit(60.0) / F.col("rpm"))
    )


def tagging_quality(jobs: DataFrame) -> DataFrame:
    """How well jobs are tagged.

    ``duplicate_rate`` is the share of split tokens that repeat another token of
    their job, ``short_tags`` counts jobs with exactly one skill.
    """
    tokens = F.filter(F.transform(F.split(F.lower("tech_stack"), SEPARATOR), strip), lambda s: s != "")
    sizes = tagged(jobs).select(F.size(parse_skills("tech_stack")).alias("skills"), F.size(tokens).alias("tokens"))
    return sizes.agg(
        F.count("*").alias("jobs_measured"),
        F.avg("skills").alias("avg_skills_per_job"),
        (1 - F.sum("skills") / F.sum("tokens")).alias("duplicate_rate"),
        F.count_if(F.col("skills") == 1).alias("short_tags"),
    )


def tagged(jobs: DataFrame) -> DataFrame:
    return jobs.filter(F.col("tech_stack").isNotNull() & (F.trim("tech_stack") != ""))

"""Skill-gap analysis of many résumés against a jobs table, end to end."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiremill.functions.text import normalize_newlines, sanitize, strip
from hiremill.operators import gaps, tagging
from hiremill.operators.routing import answer_prompts, route_messages
from hiremill.session import materialize


def find_skill_gaps(
    resumes: DataFrame, jobs: DataFrame, model: tagging.Model | None = None, key: str = "resume_id"
) -> DataFrame:
    """``(key, gaps, demand_statistics, total_tokens, time_ms)`` per résumé.

    ``resumes`` is ``(key, text)`` as :func:`hiremill.sources.files.scan_resumes`
    gives it. Without a model the skills are those a line of the résumé lists.
    ``time_ms`` is the wall time of the extraction for the whole batch.
    """
    started = time.time()
    demand = materialize(gaps.skill_demand(jobs), "demand")
    if model is None:
        safe = resumes.select(key, sanitize("text").alias("text"))
        extracted = gaps.skill_sets(resumes, gaps.line_skills(safe, demand, key), key)
        usage = resumes.select(key, F.lit(0).alias("total_tokens"))
    else:
        raw = tagging.extract_resume_skills(resumes, model, key=key)
        extracted = gaps.raw_skills_to_set(raw, key)
        usage = raw.select(key, "total_tokens")
    sets = materialize(extracted, "skill-sets")
    elapsed = (time.time() - started) * 1000.0
    return gaps.gap_reports(demand, sets, usage.withColumn("time_ms", F.lit(elapsed)), key)


def reply_to_messages(
    messages: DataFrame, jobs: DataFrame, reply_to: Callable[[str], str], key: str = "message_id"
) -> DataFrame:
    """Routed messages with the reply of each route, the skill-gap text included."""
    routed = materialize(answer_prompts(route_messages(messages), reply_to), "routed")
    asking = routed.filter(F.col("route") == "skill_gap").select(key, normalize_newlines(strip("pdf_text")).alias("text"))
    reports = gaps.report_text(find_skill_gaps(asking, jobs, key=key), key)
    return (
        routed.join(reports.withColumnRenamed("reply", "gap_reply"), key, "left")
        .withColumn("reply", F.coalesce("reply", "gap_reply"))
        .drop("gap_reply")
    )

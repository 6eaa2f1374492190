"""Row labels: quality, first bad field, message route."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hiremill.functions.text import blank, has_special_run, or_empty, strip
from hiremill.schemas import LISTING_FIELDS

MIN_DESCRIPTION = 100
RESUME_CHARS = 3000

# Texts of the chat routes.
GUIDANCE = "Send a message to chat, or upload a resume PDF."
NO_GAPS = "No skill gaps found. Make sure the jobs database has tagged tech_stack values."
DEFAULT_CHAT = "Say hello briefly."
DEFAULT_QUESTION = "Summarize this resume briefly."


def quality_label() -> Column:
    """HIGH, or LOW for a missing field, a short description or a run of special characters."""
    low = (
        blank("job_title")
        | blank("company")
        | blank("description")
        | (F.length("description") < MIN_DESCRIPTION)
        | has_special_run("description")
    )
    return F.when(low, "LOW").otherwise("HIGH")


def first_bad_field() -> Column:
    """Name of the first blank listing field, NULL when all hold text."""
    return F.coalesce(*[F.when(strip(or_empty(f)) == "", F.lit(f)) for f in LISTING_FIELDS])


def wants_skill_gap(message: Column) -> Column:
    text = F.lower(message)
    return (message == "") | text.contains("start analysis") | text.contains("skill gap") | (text == "analyze")


def route(message: Column, resume: Column) -> Column:
    """guidance, chat, skill_gap or resume_qa for stripped message and résumé."""
    return (
        F.when((resume == "") & (message == ""), "guidance")
        .when(resume == "", "chat")
        .when(wants_skill_gap(message), "skill_gap")
        .otherwise("resume_qa")
    )


def route_prompt(message: Column, resume: Column, chars: int = RESUME_CHARS) -> Column:
    """Prompt text of the two routes that ask the chat model, with ``chars`` of the résumé; NULL for the others."""
    question = F.when(message == "", DEFAULT_QUESTION).otherwise(message)
    about_resume = F.concat(
        F.lit("Resume text:\n"),
        F.substring(resume, 1, chars),
        F.lit("\n\nUser question: "),
        question,
        F.lit("\n\nAnswer using only the resume above."),
    )
    chosen = route(message, resume)
    return F.when(chosen == "chat", F.when(message == "", DEFAULT_CHAT).otherwise(message)).when(
        chosen == "resume_qa", about_resume
    )


def provider(model: Column | str) -> Column:
    """Who serves a model: names starting ``gemini-`` go to the cloud service."""
    name = F.col(model) if isinstance(model, str) else model
    return F.when(name.startswith("gemini-"), "gemini").otherwise("ollama")

"""Named statements over the job tables, with positional parameters.

A name stands for a DataFrame operator, so a caller asks for a statement by
name as before: queries give rows, changes give the new table and the number of
rows they touched, and any failure gives an error text instead of an exception.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiremill.operators import gaps, quality, tagging, upsert
from hiremill.schemas import CONTENT_FIELDS, JOBS, conform

Tables = dict[str, DataFrame]


@dataclass
class Result:
    """``rows`` of a query, or the changed ``tables`` and ``rows_affected``, or ``error``."""

    rows: DataFrame | None = None
    tables: Tables | None = None
    rows_affected: int | None = None
    error: str | None = None


def _count_blank(column: str) -> Callable[[Tables], DataFrame]:
    return lambda t: quality.missing_counts(t["jobs"]).select(F.col(f"null_{column}").alias("count"))


def _mean_length(t: Tables) -> DataFrame:
    return t["jobs"].agg(F.avg(F.length("description")).alias("avg_length"))


def _stored_hash(t: Tables, source_id: str) -> DataFrame:
    return t["jobs"].filter(F.col("source_id") == F.lit(source_id)).select("content_hash")


def _columns(t: Tables) -> DataFrame:
    names = t["jobs"].dtypes
    listed = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(d).alias("type")) for n, d in names])
    return t["jobs"].sparkSession.range(1).select(F.inline(listed))


QUERIES: dict[str, Callable[..., DataFrame]] = {
    "avg_description_length": _mean_length,
    "count_jobs": lambda t: quality.row_count(t["jobs"]),
    "count_null_company": _count_blank("company"),
    "count_null_description": _count_blank("description"),
    "count_null_job_title": _count_blank("job_title"),
    "count_quarantined": lambda t: quality.row_count(t["jobs_quarantine"]),
    "longest_description": lambda t: quality.longest_description(t["jobs"]),
    "select_all_jobs": lambda t: t["jobs"].select(JOBS.fieldNames()[:-1]),
    "select_all_tech_stacks": lambda t: gaps.tagged_stacks(t["jobs"], trim_blank=True),
    "select_content_hash": _stored_hash,
    "select_untagged_jobs": lambda t: tagging.untagged_jobs(t["jobs"], trim_blank=True),
    "shortest_description": lambda t: quality.shortest_description(t["jobs"]),
    "table_info_jobs": _columns,
}


def _key_is(source_id: str):
    return F.col("source_id") == F.lit(source_id)


def _insert_job(t: Tables, *values) -> tuple[Tables, DataFrame]:
    jobs = conform(t["jobs"], JOBS)
    row = conform(jobs.sparkSession.createDataFrame([values], _six_columns()), JOBS)
    added = row.join(jobs.select("source_id"), "source_id", "left_anti").select(*jobs.columns)
    return {"jobs": jobs.unionByName(added)}, added


def _six_columns() -> str:
    return ", ".join(f"{n} string" for n in JOBS.fieldNames()[:-1])


def _update_job(t: Tables, title, company, description, tech_stack, content_hash, source_id):
    new = dict(zip((*CONTENT_FIELDS, "tech_stack", "content_hash"), (title, company, description, tech_stack, content_hash)))
    return _set(t, _key_is(source_id), new)


def _set(t: Tables, hit, new: dict) -> tuple[Tables, DataFrame]:
    jobs = t["jobs"]
    changed = jobs.withColumns({n: F.when(hit, F.lit(v).cast("string")).otherwise(F.col(n)) for n, v in new.items()})
    return {"jobs": changed}, jobs.filter(hit)


def _delete_low(t: Tables) -> tuple[Tables, DataFrame]:
    low = F.col("quality").eqNullSafe("LOW")
    return {"jobs": t["jobs"].filter(~low)}, t["jobs"].filter(low)


def _quarantine_low(t: Tables) -> tuple[Tables, DataFrame]:
    low = conform(t["jobs"].filter(F.col("quality") == "LOW"), JOBS)
    return {"jobs_quarantine": t["jobs_quarantine"].unionByName(low)}, low


CHANGES: dict[str, Callable[..., tuple[Tables, DataFrame]]] = {
    "add_content_hash_column": lambda t: ({"jobs": conform(t["jobs"], JOBS)}, t["jobs"].limit(0)),
    "add_quality_column": lambda t: ({"jobs": conform(t["jobs"], JOBS)}, t["jobs"].limit(0)),
    "clear_jobs_quarantine": lambda t: ({"jobs_quarantine": t["jobs_quarantine"].limit(0)}, t["jobs_quarantine"]),
    "clear_tech_stack": lambda t: ({"jobs": tagging.clear_tags(t["jobs"])}, t["jobs"]),
    "create_jobs": lambda t: ({"jobs": conform(t["jobs"], JOBS)}, t["jobs"].limit(0)),
    "create_jobs_quarantine": lambda t: (
        {"jobs_quarantine": conform(t["jobs_quarantine"], JOBS)},
        t["jobs_quarantine"].limit(0),
    ),
    "delete_low_quality": _delete_low,
    "insert_job": _insert_job,
    "quarantine_low_quality": _quarantine_low,
    "update_job": _update_job,
    "update_quality": lambda t, label, source_id: _set(t, _key_is(source_id), {"quality": label}),
    "update_tech_stack": lambda t, stack, source_id: _set(t, _key_is(source_id), {"tech_stack": stack}),
}


def run_script(tables: Tables, name: str, *params) -> Result:
    """Run a named statement. Query rows stay a lazy DataFrame; they are never collected here.

    An unknown name, wrong parameters, or a change that fails come back as ``error``; a
    query that fails only when its rows are read raises there.
    """
    name = name.removesuffix(".sql")
    try:
        if name in QUERIES:
            return Result(rows=QUERIES[name](tables, *params))
        if name not in CHANGES:
            raise FileNotFoundError(f"no statement named {name}")
        changed, touched = CHANGES[name](tables, *params)
        return Result(tables={**tables, **changed}, rows_affected=touched.count())
    except Exception as exc:  # the caller gets the reason, not a stack trace
        return Result(error=str(exc))


def stored_hashes(tables: Tables, keys: DataFrame) -> DataFrame:
    """``select_content_hash`` for many keys at once, as one join."""
    return upsert.stored_hashes(tables["jobs"], keys)

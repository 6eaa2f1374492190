"""Dashboard aggregates and keyword search over jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hiremill.functions.text import WHITESPACE, blank, like_ascii, or_empty

TOP_COMPANIES = 8
TOP_TITLES = 10
PAGE_ROWS = 100
PREVIEW_CHARS = 200


def _counts(jobs: DataFrame, column: str) -> DataFrame:
    return jobs.filter(~blank(column)).groupBy(column).agg(F.count("*").alias("count"))


def company_totals(jobs: DataFrame) -> DataFrame:
    """Jobs per company that has a name."""
    return _counts(jobs, "company")


def top_companies(jobs: DataFrame, top_n: int = TOP_COMPANIES) -> DataFrame:
    return company_totals(jobs).orderBy(F.desc("count"), "company").limit(top_n)


def company_counts(jobs: DataFrame, top_n: int = TOP_COMPANIES) -> DataFrame:
    """``(label, count, group)``: the top companies, then one row for all others if they have jobs.

    The others are the totals less the top rows, so no second pass over the
    groups is needed to find them.
    """
    totals = company_totals(jobs)
    top = totals.orderBy(F.desc("count"), "company").limit(top_n)
    # One subquery for both totals, so that it shares the shuffle of the groups.
    every = totals.agg(F.struct(F.sum("count").alias("jobs"), F.count("*").alias("employers"))).scalar()
    others = top.agg(F.sum("count").alias("shown"), F.count("*").alias("rows")).select(
        (every["jobs"] - F.col("shown")).alias("count"), (every["employers"] - F.col("rows")).alias("employers")
    )
    label = F.format_string("Other (%d jobs, %d employers)", "count", "employers")
    return top.select(F.col("company").alias("label"), "count", F.lit(None).cast("string").alias("group")).unionByName(
        others.filter(F.col("count") > 0).select(label.alias("label"), "count", F.lit("other").alias("group"))
    )


def title_counts(jobs: DataFrame, top_n: int = TOP_TITLES) -> DataFrame:
    """``(label, count)`` of the most common titles."""
    top = _counts(jobs, "job_title").orderBy(F.desc("count"), "job_title").limit(top_n)
    return top.select(F.col("job_title").alias("label"), "count")


def _ranked(rows: DataFrame, *fields: str) -> Column:
    """A bounded list as one value: largest count first, ties by label, the ``other`` row last."""
    last = F.when(F.col("group") == "other", 1).otherwise(0) if "group" in rows.columns else F.lit(0)
    keyed = F.struct(last.alias("last"), (-F.col("count")).alias("rank"), *fields)
    ordered = F.array_sort(F.collect_list(keyed))
    return rows.agg(F.transform(ordered, lambda r: F.struct(*[r[f].alias(f) for f in fields]))).scalar()


def dashboard_stats(jobs: DataFrame) -> DataFrame:
    """One row ``(total, companies, titles)``; the two lists hold at most 9 and 10 entries."""
    return jobs.agg(F.count("*").alias("total")).select(
        "total",
        _ranked(company_counts(jobs), "label", "count", "group").alias("companies"),
        _ranked(title_counts(jobs), "label", "count").alias("titles"),
    )


def other_companies(jobs: DataFrame, top_n: int = TOP_COMPANIES) -> DataFrame:
    """Jobs whose company is none of the top ones.

    As with SQL ``NOT IN``, a NULL company is no match, unless there is no top
    company to compare with. What is broadcast is ``top_n`` names.
    """
    top = top_companies(jobs, top_n).select("company")
    nothing_to_compare = top.agg(F.count("*") == 0).scalar()
    return jobs.join(F.broadcast(top), "company", "left_anti").filter(
        F.col("company").isNotNull() | nothing_to_compare
    )


def shown_fields() -> list[Column]:
    """What a page shows of a job; NULL as empty."""
    return [
        or_empty("job_title").alias("job_title"),
        or_empty("company").alias("company"),
        F.substring(or_empty("description"), 1, PREVIEW_CHARS).alias("description"),
    ]


def other_companies_page(
    jobs: DataFrame, limit: int = PAGE_ROWS, offset: int = 0, top_n: int = TOP_COMPANIES
) -> DataFrame:
    rows = other_companies(jobs, top_n).orderBy(*_page_order("company", "job_title"))
    return (rows.offset(offset) if offset else rows).limit(limit).select(*shown_fields())


def _page_order(*columns: str) -> list[Column]:
    """NULL first, and the key last so that equal rows keep one order."""
    return [F.asc_nulls_first(c) for c in (*columns, "source_id")]


def cleaned(query: str) -> str:
    """A search as it is looked for: without the white space around it."""
    return query.strip(WHITESPACE)


def asks_for_others(query: str) -> bool:
    """Does a search ask for the companies outside the top list?"""
    return cleaned(query).lower() in ("other", "others")


def matching_jobs(jobs: DataFrame, query: str) -> DataFrame:
    """Jobs a keyword finds in title, company or description; ``other`` finds the small companies."""
    if asks_for_others(query):
        return other_companies(jobs)
    pattern = f"%{cleaned(query)}%"
    return jobs.filter(
        like_ascii("job_title", pattern) | like_ascii("company", pattern) | like_ascii("description", pattern)
    )


def _matching_page(jobs: DataFrame, query: str, limit: int) -> tuple[DataFrame, list[str]]:
    order = ["company", "job_title"] if asks_for_others(query) else ["job_title"]
    return matching_jobs(jobs, query).orderBy(*_page_order(*order)).limit(limit), order


def search_jobs(jobs: DataFrame, query: str, limit: int = PAGE_ROWS) -> DataFrame:
    """First page of matches: in title order, for ``other`` in company and title order."""
    page, _ = _matching_page(jobs, query, limit)
    return page.select(*shown_fields())


def search_total(jobs: DataFrame, query: str) -> DataFrame:
    return matching_jobs(jobs, query).agg(F.count("*").alias("total"))


def search_response(jobs: DataFrame, query: str, limit: int = PAGE_ROWS) -> DataFrame:
    """One row ``(results, total, shown)``; ``results`` is the page, at most ``limit`` entries."""
    page, order = _matching_page(jobs, query, limit)
    entry = F.struct(F.struct(*order, "source_id").alias("rank"), F.struct(*shown_fields()).alias("entry"))
    listed = page.agg(F.array_sort(F.collect_list(entry)).alias("rows"))
    return listed.select(
        F.transform("rows", lambda r: r["entry"]).alias("results"),
        search_total(jobs, query).scalar().alias("total"),
        F.size("rows").alias("shown"),
    )

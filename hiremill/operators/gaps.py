"""Skill demand over jobs and the skills a résumé lacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hiremill.functions.labels import NO_GAPS
from hiremill.functions.skills import parse_skills, union_skills
from hiremill.functions.text import pad_right, python_repr
from hiremill.operators.ordering import number_rows

TOP_SKILLS = 5
# Skills per piece of the vocabulary that meets a résumé in one row.
PIECE_ROWS = 20_000
# Rows of the other side that one copy of a piece meets.
COPY_ROWS = 5_000


def tagged_stacks(jobs: DataFrame, trim_blank: bool = False) -> DataFrame:
    """``tech_stack`` of tagged jobs.

    The analysis counts any value that is not NULL; with ``trim_blank`` a value
    of spaces only is left out and rows come in key order.
    """
    tagged = jobs.filter(F.col("tech_stack").isNotNull())
    if not trim_blank:
        return tagged.select("tech_stack")
    return tagged.filter(F.trim("tech_stack") != "").orderBy("source_id").select("tech_stack")


def job_skills(jobs: DataFrame) -> DataFrame:
    """``(source_id, skill)``, one row per distinct skill of a job."""
    tagged = jobs.filter(F.col("tech_stack").isNotNull())
    return tagged.select("source_id", F.explode(parse_skills("tech_stack")).alias("skill"))


def skill_demand(jobs: DataFrame) -> DataFrame:
    """``(skill, demand)``: how many jobs name each skill."""
    named = tagged_stacks(jobs).select(F.explode(parse_skills("tech_stack")).alias("skill"))
    return named.groupBy("skill").agg(F.count("*").alias("demand"))


def vocabulary(demand: DataFrame) -> DataFrame:
    return demand.select("skill")


def raw_skills_to_set(extracted: DataFrame, key: str = "resume_id") -> DataFrame:
    """``(key, skills)`` from an array column of raw skill strings; NULL counts as none."""
    return extracted.select(key, F.coalesce(union_skills("technical_skills"), F.array().cast("array<string>")).alias("skills"))


def line_skills(resumes: DataFrame, demand: DataFrame, key: str = "resume_id") -> DataFrame:
    """``(key, skill)``: skills of the market that a line of the résumé lists.

    The extractor that needs no model. The join is left to the optimizer, so
    the vocabulary is broadcast only while it is small.
    """
    listed = resumes.select(key, F.explode(F.split("text", "\n")).alias("line")).select(
        key, F.explode(parse_skills("line")).alias("skill")
    )
    return listed.join(demand.select("skill"), "skill", "left_semi").select(key, "skill").distinct()


def skill_sets(resumes: DataFrame, possessed: DataFrame, key: str = "resume_id") -> DataFrame:
    """``(key, skills)`` for every résumé, also those without any skill.

    A list holds no more than the résumé's own text names.
    """
    sets = possessed.groupBy(key).agg(F.collect_set("skill").alias("skills"))
    return resumes.select(key).join(sets, key, "left").select(
        key, F.coalesce("skills", F.array().cast("array<string>")).alias("skills")
    )


def missing_skills(demand: DataFrame, possessed: DataFrame) -> DataFrame:
    """``(skill, demand)`` that the jobs ask for and one résumé lacks."""
    return demand.join(possessed.select("skill").distinct(), "skill", "left_anti").select("skill", "demand")


def top_missing(demand: DataFrame, possessed: DataFrame, n: int = TOP_SKILLS) -> DataFrame:
    return missing_skills(demand, possessed).orderBy(F.desc("demand"), "skill").limit(n)


def _by_demand(skill: Column | str, demand: Column | str) -> Column:
    """A struct that sorts by demand, largest first, then by skill."""
    d = F.col(demand) if isinstance(demand, str) else demand
    s = F.col(skill) if isinstance(skill, str) else skill
    return F.struct((-d).alias("rank"), s.alias("skill"))


def _lacking(vocab: Column, skills: Column) -> Column:
    """Entries of ``vocab`` whose skill is not in ``skills``, order kept."""
    return F.filter(vocab, lambda v: ~F.array_contains(skills, v["skill"]))


def _as_demand(entries: Column) -> Column:
    return F.transform(entries, lambda v: F.struct(v["skill"].alias("skill"), (-v["rank"]).alias("demand")))


def ranked_demand(demand: DataFrame) -> DataFrame:
    """``(skill, demand, rank)``, rank from 0: largest demand first, then by skill."""
    return number_rows(demand.select("skill", "demand"), (-F.col("demand")), "skill", name="rank")


def held_ranks(ranked: DataFrame, sets: DataFrame, key: str = "resume_id") -> DataFrame:
    """``(key, skills, ranks)``: the demand ranks of the skills each row has, in order.

    Only (key, rank) pairs travel; a row holds no more ranks than its own skills.
    """
    held = (
        sets.select(key, F.explode("skills").alias("skill"))
        .join(ranked.select("skill", "rank"), "skill")
        .groupBy(key)
        .agg(F.array_sort(F.collect_set("rank")).alias("ranks"))
    )
    return sets.select(key, "skills").join(held, key, "left").withColumn(
        "ranks", F.coalesce("ranks", F.array().cast("array<bigint>"))
    )


def _first_lacking(ranks: Column, n: int) -> Column:
    """The first ``n`` numbers from 0 that are not among ``ranks``: they lie below size + n."""
    until = F.sequence(F.lit(0).cast("bigint"), (F.size(ranks) + (n - 1)).cast("bigint"))
    return F.slice(F.array_except(until, ranks), 1, n)


def top_gap_rows(demand: DataFrame, sets: DataFrame, n: int = TOP_SKILLS, key: str = "resume_id") -> DataFrame:
    """``(key, position, skill, demand)``, position from 1: the ``n`` most demanded skills each row lacks.

    The vocabulary is ranked once. A row's first missing ranks follow from the
    ranks it has, and only these ``n`` are joined back to their skills.
    """
    ranked = ranked_demand(demand)
    lacking = held_ranks(ranked, sets, key).select(key, F.posexplode(_first_lacking(F.col("ranks"), n)).alias("at", "rank"))
    return lacking.join(ranked, "rank").select(key, (F.col("at") + 1).cast("bigint").alias("position"), "skill", "demand")


def top_gaps(demand: DataFrame, sets: DataFrame, n: int = TOP_SKILLS, key: str = "resume_id") -> DataFrame:
    """``(key, top)``: the same as one array per row, empty where nothing is lacking."""
    found = top_gap_rows(demand, sets, n, key).groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("position", "skill", "demand"))).alias("found")
    )
    top = F.transform("found", lambda x: F.struct(x["skill"].alias("skill"), x["demand"].alias("demand")))
    return sets.select(key).join(found, key, "left").select(
        key, F.coalesce(top, F.expr("cast(array() as array<struct<skill: string, demand: bigint>>)")).alias("top")
    )


def gap_pieces(demand: DataFrame, sets: DataFrame, key: str = "resume_id", piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``(key, piece, missing)``: all skills each résumé lacks, in pieces of the vocabulary.

    The answer has résumés times vocabulary entries, whatever the plan. The
    vocabulary is cut into pieces of about ``piece_rows`` skills, so no row
    holds more, and each piece is copied to a join key for every ``COPY_ROWS``
    résumés, so they spread over as many tasks.
    """
    copies = F.greatest(F.lit(1), F.ceil(sets.agg(F.count("*")).scalar() / COPY_ROWS)).cast("int")
    pieces = F.greatest(F.lit(1), F.ceil(demand.agg(F.count("*")).scalar() / piece_rows)).cast("int")
    cut = (
        demand.withColumn("piece", F.pmod(F.xxhash64("skill"), pieces).cast("int"))
        .groupBy("piece")
        .agg(F.array_sort(F.collect_list(_by_demand("skill", "demand"))).alias("vocab"))
        .withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    )
    asking = sets.withColumn("copy", F.pmod(F.xxhash64(key), copies).cast("int")).withColumn(
        "piece", F.explode(F.sequence(F.lit(0), pieces - 1))
    )
    return asking.join(cut, ["piece", "copy"]).select(
        key, "piece", _lacking(F.col("vocab"), F.col("skills")).alias("missing")
    )


def gap_rows(demand: DataFrame, sets: DataFrame, key: str = "resume_id", piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``(key, skill, demand)`` rows of all gaps."""
    rows = gap_pieces(demand, sets, key, piece_rows).select(key, F.explode("missing").alias("m"))
    return rows.select(key, F.col("m.skill").alias("skill"), (-F.col("m.rank")).alias("demand"))


def gap_reports(demand: DataFrame, sets: DataFrame, usage: DataFrame | None = None, key: str = "resume_id") -> DataFrame:
    """``(key, gaps, demand_statistics, total_tokens, time_ms)``, the nested result per résumé.

    ``gaps`` is in code point order, ``demand_statistics`` in demand order.
    ``usage`` may give ``total_tokens`` and ``time_ms`` per résumé. One row
    holds a whole gap list, so this is for vocabularies that fit a row; use
    :func:`gap_rows` or :func:`top_gaps` otherwise.
    """
    merged = (
        gap_pieces(demand, sets, key)
        .groupBy(key)
        .agg(F.array_sort(F.flatten(F.collect_list("missing"))).alias("missing"))
    )
    whole = sets.select(key).join(merged, key, "left")
    if usage is not None:
        whole = whole.join(usage, key, "left")
    have = set(whole.columns)
    missing = F.coalesce("missing", F.expr("cast(array() as array<struct<rank: bigint, skill: string>>)"))
    return whole.select(
        key,
        F.array_sort(F.transform(missing, lambda v: v["skill"])).alias("gaps"),
        _as_demand(missing).alias("demand_statistics"),
        (F.coalesce("total_tokens", F.lit(0)) if "total_tokens" in have else F.lit(0)).cast("bigint").alias("total_tokens"),
        (F.coalesce("time_ms", F.lit(0.0)) if "time_ms" in have else F.lit(0.0)).alias("time_ms"),
    )


def demand_map(statistics: Column | str) -> Column:
    """``demand_statistics`` as a map, for the JSON result."""
    return F.map_from_entries(statistics)


def report_text(reports: DataFrame, key: str = "resume_id", n: int = TOP_SKILLS) -> DataFrame:
    """``(key, reply)``: a line with all gaps and one line per top skill, or the no-gap message."""
    gaps = F.concat(F.lit("["), F.array_join(F.transform("gaps", python_repr), ", "), F.lit("]"))
    head = F.format_string(
        "gaps=%s time=%d tokens=%d\n\n--- BONUS: Top 5 Most In-Demand Missing Skills ---",
        gaps,
        F.bround("time_ms", 0).cast("bigint"),
        "total_tokens",
    )
    lines = F.transform(
        F.slice("demand_statistics", 1, n),
        lambda s: F.format_string(
            "Skill: %s | Missing from resume, but required by %d job(s)", pad_right(s["skill"], 20), s["demand"]
        ),
    )
    text = F.array_join(F.concat(F.array(head), lines), "\n")
    return reports.select(key, F.when(F.size("gaps") == 0, NO_GAPS).otherwise(text).alias("reply"))


def demand_summary(demand: DataFrame, possessed: DataFrame) -> DataFrame:
    """One résumé against the market: sizes, and the lowest and highest demand among its gaps."""
    marked = demand.join(possessed.select("skill").distinct().withColumn("_has", F.lit(True)), "skill", "left")
    gap = F.col("_has").isNull()
    return marked.agg(
        F.count("*").alias("market_skills"),
        possessed.agg(F.count_distinct("skill")).scalar().alias("resume_skills"),
        F.count_if(gap).alias("gap_count"),
        F.min(F.when(gap, F.col("demand"))).alias("min_demand"),
        F.max(F.when(gap, F.col("demand"))).alias("max_demand"),
    )


def demand_summaries(demand: DataFrame, sets: DataFrame, key: str = "resume_id") -> DataFrame:
    """:func:`demand_summary` for every résumé.

    Gaps are counted as the market less the known skills of the résumé, and
    their extremes are its first missing rank from either end of the demand
    order, so no gap list is built.
    """
    ranked = ranked_demand(demand)
    market = demand.agg(F.count("*")).scalar()
    ends = held_ranks(ranked, sets, key).withColumn("market_skills", market)
    reversed_ranks = F.transform("ranks", lambda r: F.col("market_skills") - 1 - r)
    ends = ends.select(
        key,
        "market_skills",
        F.size("skills").cast("bigint").alias("resume_skills"),
        (F.col("market_skills") - F.size("ranks")).alias("gap_count"),
        F.get(_first_lacking(F.col("ranks"), 1), F.lit(0)).alias("most"),
        (F.col("market_skills") - 1 - F.get(_first_lacking(reversed_ranks, 1), F.lit(0))).alias("least"),
    )
    highest = ranked.select(F.col("rank").alias("most"), F.col("demand").alias("max_demand"))
    lowest = ranked.select(F.col("rank").alias("least"), F.col("demand").alias("min_demand"))
    return ends.join(highest, "most", "left").join(lowest, "least", "left").select(
        key, "market_skills", "resume_skills", "gap_count", "min_demand", "max_demand"
    )

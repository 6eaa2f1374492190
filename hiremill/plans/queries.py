"""Every operator as a named query over the supplied tables."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hiremill.functions import labels, skills, text
from hiremill.operators import bitmaps, dashboard, decode, gaps, maintained, pacing, paging, quality, routing, runs, search, silver, tagging, upsert
from hiremill.plans import fixtures, incremental, medallion
from hiremill.schemas import JOBS, RATE_LIMITS, SILVER, conform
from hiremill.session import materialize, scratch_path
from hiremill.sources import files, keyed, scripts
from hiremill.sources.snapshots import expire_snapshots, read_snapshot, write_snapshot
from hiremill.streaming import arrivals, messages, states

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The four published rate-limit rows (model, rpm, tpm, rpd).
LIMITS = [
    ("gemini-2.5-flash", 5, 250000, 20),
    ("gemini-2.5-flash-lite", 10, 250000, 20),
    ("gemini-3-flash-preview", 5, 250000, 20),
    ("gemini-3.1-flash-lite", 15, 250000, 500),
]
KEYWORD = "wid_et"
PATTERN = " KEIT das%_zu "


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- sources, decoding, validation ---------------------------------------------------


@query
def all_jobs(spark, sf):
    jobs = upsert.stage(fixtures.jobs(spark, sf))
    return scripts.run_script({"jobs": jobs}, "select_all_jobs").rows


@query
def conform_postings(spark, sf):
    return conform(fixtures.postings(spark, sf), JOBS)


@query
def bronze_roundtrip(spark, sf):
    bronze = decode.decode_mhtml(fixtures.mhtml_pages(spark, sf))
    return bronze.filter("error_kind is null").select("doc_key", "html")


@query
def bronze_errors(spark, sf):
    bronze = decode.decode_mhtml(fixtures.mhtml_pages(spark, sf))
    return bronze.filter("error_kind is not null").select("doc_key", "error_kind")


@query
def bronze_summary(spark, sf):
    return decode.bronze_summary(decode.decode_mhtml(fixtures.mhtml_pages(spark, sf)))


@query
def html_extract_roundtrip(spark, sf):
    return decode.extract_listings(fixtures.html_pages(spark, sf))


@query
def page_titles(spark, sf):
    return decode.extract(fixtures.native_pages(spark, sf), {"title": decode.Selector(tag="title")})


@query
def page_fields(spark, sf):
    spec = {n: decode.Selector(tag=n) for n in ("title", "h1", "article")}
    return decode.extract(fixtures.native_pages(spark, sf), spec)


@query
def source_id_from_url(spark, sf):
    pages = fixtures.table(spark, sf, "pages")
    return pages.select("page_id", text.last_path_segment("url").alias("source_id"))


def _checked(spark, sf):
    return silver.check_listings(decode.extract_listings(fixtures.html_pages(spark, sf)))


@query
def silver_valid(spark, sf):
    return silver.valid_listings(_checked(spark, sf))


@query
def silver_rejects(spark, sf):
    return silver.rejected_listings(_checked(spark, sf))


@query
def silver_summary(spark, sf):
    return silver.silver_summary(_checked(spark, sf))


def _json_texts(spark, sf):
    """Postings as JSON; some texts lack a key, hold a JSON null or are cut off."""
    p = fixtures.postings(spark, sf)
    key = F.col("source_id").cast("bigint")
    # to_json leaves NULL fields out, which here is the missing key.
    body = F.to_json(F.struct("source_id", "job_title", "company", "description"))
    null_title = F.concat(
        F.lit('{"job_title": null, '),
        F.expr("substring(to_json(named_struct('source_id', source_id, 'company', company, 'description', description)), 2)"),
    )
    value = (
        F.when(key % 17 == 0, F.substring_index(body, "}", 1))
        .when(key % 19 == 0, null_title)
        .when(key % 23 == 0, F.concat(body, F.lit(" trailing")))
        .when(key % 29 == 1, F.concat(body, body))
        .when(key % 31 == 1, F.replace(body, F.lit('"job_title":"'), F.lit('"job_title":"\t')))
        .when(key % 47 == 0, F.concat(F.lit('{"description": {"a": 1}, '), F.expr("substring(to_json(struct(source_id, job_title, company)), 2)")))
        .when(key % 53 == 0, F.concat(F.lit('{"description": [1, 2], '), F.expr("substring(to_json(struct(source_id, job_title, company)), 2)")))
        .otherwise(body)
    )
    return p.select(F.lpad("source_id", 12, "0").alias("doc_key"), value.alias("value"))


@query
def json_records(spark, sf):
    return files.parse_records(_json_texts(spark, sf))


@query
def json_load_summary(spark, sf):
    records = files.parse_records(_json_texts(spark, sf))
    actions = upsert.upsert_actions(upsert.stage(records), spark.createDataFrame([], JOBS))
    return upsert.load_summary(records, actions)


# --- scalar functions ----------------------------------------------------------------


@query
def parse_skills(spark, sf):
    return gaps.job_skills(fixtures.postings(spark, sf))


@query
def union_skills(spark, sf):
    raw = fixtures.postings(spark, sf).select("source_id", F.array("tech_stack", "job_title").alias("raw"))
    return raw.select("source_id", F.explode(skills.union_skills("raw")).alias("skill"))


@query
def content_hash(spark, sf):
    return upsert.stage(fixtures.jobs(spark, sf)).select("source_id", "content_hash")


@query
def quality_label(spark, sf):
    return fixtures.jobs(spark, sf).select("source_id", labels.quality_label().alias("quality"))


@query
def posting_quality_label(spark, sf):
    return fixtures.postings(spark, sf).select("source_id", labels.quality_label().alias("quality"))


@query
def token_estimate(spark, sf):
    docs = fixtures.table(spark, sf, "documents")
    return docs.select("doc_id", text.token_estimate("text").alias("tokens"))


@query
def clip_resume(spark, sf):
    docs = fixtures.table(spark, sf, "documents")
    return docs.select("doc_id", files.clip_resume("text").alias("clipped"))


@query
def injection_flag(spark, sf):
    m = fixtures.messages(spark, sf)
    return m.select("message_id", text.has_instruction_phrase("pdf_text").alias("flagged"))


@query
def sanitize_resume(spark, sf):
    m = fixtures.messages(spark, sf)
    return m.select("message_id", text.sanitize(text.normalize_newlines("pdf_text")).alias("sanitized"))


@query
def drop_instruction_lines(spark, sf):
    m = fixtures.messages(spark, sf)
    return m.select("message_id", text.drop_instruction_lines("pdf_text").alias("kept"))


# --- upsert --------------------------------------------------------------------------


@query
def upsert_first_load(spark, sf):
    staged = upsert.stage(fixtures.event_changes(spark, sf))
    return upsert.upsert_actions(staged, spark.createDataFrame([], JOBS))


@query
def upsert_actions(spark, sf):
    staged = upsert.stage(fixtures.event_changes(spark, sf))
    return upsert.upsert_actions(staged, fixtures.prior_jobs(spark, sf))


@query
def upsert_final(spark, sf):
    staged, prior = upsert.stage(fixtures.event_changes(spark, sf)), fixtures.prior_jobs(spark, sf)
    actions = materialize(upsert.upsert_actions(staged, prior), "actions")
    return upsert.apply_changes(prior, staged, actions)


@query
def upsert_summary(spark, sf):
    records = fixtures.event_changes(spark, sf)
    actions = upsert.upsert_actions(upsert.stage(records), fixtures.prior_jobs(spark, sf))
    return upsert.load_summary(records, actions)


@query
def stored_hashes(spark, sf):
    return upsert.stored_hashes(fixtures.prior_jobs(spark, sf), fixtures.event_changes(spark, sf))


@query
def new_keys(spark, sf):
    return upsert.new_keys(fixtures.event_changes(spark, sf), fixtures.prior_jobs(spark, sf))


@query
def snapshot_roundtrip(spark, sf):
    path = scratch_path(spark, "jobs")
    write_snapshot(fixtures.postings(spark, sf), path)
    write_snapshot(conform(fixtures.prior_jobs(spark, sf), JOBS), path)
    return read_snapshot(spark, path, JOBS)


@query
def arrivals_stream(spark, sf):
    records = fixtures.events_to_records(fixtures.table_stream(spark, sf, "events"))
    root = scratch_path(spark, "arrivals")
    arrivals.load_stream(records, root, f"{root}-checkpoint").awaitTermination()
    return arrivals.loaded_jobs(spark, root)


@query
def change_log(spark, sf):
    """Two loads with a profile between them and a replay of the second, read after old versions expired."""
    events = fixtures.event_changes(spark, sf)
    half = fixtures.table(spark, sf, "events").agg(F.floor(F.max("event_id") / 2).alias("half")).first()["half"]
    late = F.col("doc_key").cast("bigint") > half
    root = scratch_path(spark, "log")
    arrivals.load_once(events.filter(~late), root, "first")
    medallion.profile(spark, root)
    for _ in range(2):
        arrivals.load_once(events.filter(late), root, "second")
    expire_snapshots(spark, f"{root}/jobs", keep=1)
    return medallion.change_log(spark, root)


# --- quality -------------------------------------------------------------------------


def _labelled(spark, sf):
    return quality.label_jobs(upsert.stage(fixtures.jobs(spark, sf)))


@query
def quality_split_high(spark, sf):
    return quality.high_quality(_labelled(spark, sf))


@query
def quarantine(spark, sf):
    return quality.low_quality(_labelled(spark, sf))


@query
def quality_counts(spark, sf):
    return quality.quality_counts(_labelled(spark, sf))


@query
def quality_report(spark, sf):
    return quality.quality_report(_labelled(spark, sf))


@query
def job_count(spark, sf):
    return scripts.run_script({"jobs": fixtures.jobs(spark, sf)}, "count_jobs").rows


@query
def missing_counts(spark, sf):
    return quality.missing_counts(fixtures.postings(spark, sf))


@query
def mean_description_length(spark, sf):
    return quality.mean_description_length(fixtures.jobs(spark, sf))


@query
def shortest_description(spark, sf):
    return quality.shortest_description(fixtures.jobs(spark, sf))


@query
def longest_description(spark, sf):
    return quality.longest_description(fixtures.jobs(spark, sf))


# --- dashboard and search ------------------------------------------------------------


@query
def company_totals(spark, sf):
    return dashboard.company_totals(fixtures.postings(spark, sf))


@query
def company_counts(spark, sf):
    return dashboard.company_counts(fixtures.postings(spark, sf))


@query
def title_counts(spark, sf):
    return dashboard.title_counts(fixtures.postings(spark, sf))


@query
def dashboard_stats(spark, sf):
    one = dashboard.dashboard_stats(fixtures.postings(spark, sf))

    def shown(column):
        entries = F.transform(column, lambda e: F.concat(e["label"], F.lit("="), e["count"].cast("string")))
        return F.array_join(entries, "; ").alias(column)

    return one.select("total", shown("companies"), shown("titles"))


@query
def search_jobs(spark, sf):
    return dashboard.search_jobs(fixtures.postings(spark, sf), KEYWORD)


@query
def search_documents(spark, sf):
    return dashboard.search_jobs(fixtures.jobs(spark, sf), " ÉTION ")


@query
def search_blank(spark, sf):
    return dashboard.search_jobs(fixtures.postings(spark, sf), "  ")


@query
def search_others(spark, sf):
    return dashboard.search_jobs(fixtures.postings(spark, sf), " Others ")


@query
def search_total(spark, sf):
    return dashboard.search_total(fixtures.postings(spark, sf), KEYWORD)


@query
def search_response(spark, sf):
    one = dashboard.search_response(fixtures.postings(spark, sf), KEYWORD)
    entries = F.transform("results", lambda r: F.concat_ws("|", r["job_title"], r["company"], r["description"]))
    return one.select(F.array_join(entries, "\n").alias("results"), "total", F.col("shown").cast("bigint").alias("shown"))


@query
def other_companies_page(spark, sf):
    return dashboard.other_companies_page(fixtures.postings(spark, sf), limit=50, offset=25)


@query
def other_companies_total(spark, sf):
    return quality.row_count(dashboard.other_companies(fixtures.postings(spark, sf)))


# --- the batch stages, end to end ----------------------------------------------------


def _stages(spark, sf):
    root = scratch_path(spark, "stages")
    medallion.run_stage(spark, "all", root, fixtures.mhtml_pages(spark, sf))
    return root


@query
def pipeline_jobs(spark, sf):
    """Pages through bronze, silver, load and profile: what is fit for use."""
    return read_snapshot(spark, f"{_stages(spark, sf)}/jobs", JOBS)


@query
def pipeline_quarantine(spark, sf):
    """The same run: what profile moved away."""
    return read_snapshot(spark, f"{_stages(spark, sf)}/jobs_quarantine", JOBS)


@query
def pipeline_rejects(spark, sf):
    """The same run: pages that lack a field."""
    return medallion.rejected_records(spark, _stages(spark, sf))


# --- skills and gaps -----------------------------------------------------------------


@query
def skill_demand(spark, sf):
    return gaps.skill_demand(fixtures.postings(spark, sf))


@query
def vocabulary(spark, sf):
    return gaps.vocabulary(gaps.skill_demand(fixtures.postings(spark, sf)))


@query
def tagged_stacks(spark, sf):
    return gaps.tagged_stacks(fixtures.postings(spark, sf), trim_blank=True)


@query
def tagged_stacks_not_null(spark, sf):
    return gaps.tagged_stacks(fixtures.postings(spark, sf))


def _market(spark, sf):
    """Demand (a written table, since it is read several times), résumés and the skills each résumé lists."""
    demand = materialize(gaps.skill_demand(fixtures.postings(spark, sf)), "demand")
    cvs = fixtures.resumes(spark, sf).select("resume_id", text.sanitize(text.normalize_newlines("text")).alias("text"))
    return demand, cvs, gaps.line_skills(cvs, demand)


def _sets(spark, sf):
    """Demand and skill sets, both written tables."""
    demand, cvs, possessed = _market(spark, sf)
    return demand, materialize(gaps.skill_sets(cvs, possessed), "skill-sets")


@query
def resume_skills(spark, sf):
    return _market(spark, sf)[2]


@query
def skill_gaps(spark, sf):
    """Demanded skills that no résumé lists."""
    demand, _, possessed = _market(spark, sf)
    return gaps.missing_skills(demand, possessed)


@query
def skill_gap_top5(spark, sf):
    demand, _, possessed = _market(spark, sf)
    return gaps.top_missing(demand, possessed)


@query
def resume_gap_batch(spark, sf):
    return gaps.gap_rows(*_sets(spark, sf))


@query
def resume_top_gaps(spark, sf):
    return gaps.top_gap_rows(*_sets(spark, sf))


@query
def gap_reports(spark, sf):
    reports = gaps.gap_reports(*_sets(spark, sf))
    stats = F.transform("demand_statistics", lambda s: F.concat(s["skill"], F.lit("="), s["demand"].cast("string")))
    return reports.select(
        "resume_id", F.array_join("gaps", ",").alias("gaps"), F.array_join(stats, ",").alias("statistics"), "total_tokens"
    )


@query
def gap_report(spark, sf):
    return gaps.report_text(gaps.gap_reports(*_sets(spark, sf)))


@query
def demand_summary(spark, sf):
    demand, _, possessed = _market(spark, sf)
    return gaps.demand_summary(demand, possessed)


@query
def demand_summaries(spark, sf):
    return gaps.demand_summaries(*_sets(spark, sf))


@query
def compare_runs(spark, sf):
    """Attached résumés sanitized against the same résumés without their instruction lines."""
    demand = gaps.skill_demand(fixtures.postings(spark, sf))
    attached = fixtures.messages(spark, sf).select(F.col("message_id").alias("resume_id"), "pdf_text")

    def run(body):
        cvs = attached.select("resume_id", body.alias("text"))
        # Of one market two gap lists are the same exactly when the skills held are: no list of gaps is made.
        held = gaps.skill_sets(cvs, gaps.line_skills(cvs, demand)).select("resume_id", F.array_sort("skills").alias("gaps"))
        tokens = cvs.select("resume_id", text.token_estimate("text").alias("total_tokens"), F.lit(None).cast("double").alias("time_ms"))
        return held.join(tokens, "resume_id")

    compared = runs.compare_runs(run(text.sanitize("pdf_text")), run(text.drop_instruction_lines("pdf_text")))
    return compared.select("resume_id", "gaps_identical", F.floor("token_saving_pct").alias("token_saving_pct"))


@query
def differing_rows(spark, sf):
    """Skills by job title against skills by tags."""
    p = fixtures.postings(spark, sf)
    by_title = gaps.skill_demand(p.withColumn("tech_stack", F.col("job_title")))
    return runs.differing_rows(by_title, gaps.skill_demand(p))


# --- tagging -------------------------------------------------------------------------


@query
def untagged_jobs(spark, sf):
    return tagging.untagged_jobs(fixtures.postings(spark, sf), trim_blank=True)


@query
def untagged_jobs_run(spark, sf):
    return tagging.untagged_jobs(fixtures.postings(spark, sf))


@query
def tag_batches(spark, sf):
    return tagging.tag_batches(tagging.untagged_jobs(fixtures.jobs(spark, sf)))


def first_words_model(prompt: str) -> tuple[str, int | None]:
    """Stands in for a model: the first two words of each job's text."""
    jobs = json.loads(prompt.split("\n", 1)[1])
    return json.dumps({job: ", ".join(body.split(" ")[:2]) for job, body in jobs.items()}), None


@query
def tag_prompts(spark, sf):
    return tagging.tag_prompts(tagging.tag_batches(tagging.untagged_jobs(fixtures.postings(spark, sf))))


@query
def tag_run(spark, sf):
    jobs, _ = tagging.tag_jobs(fixtures.postings(spark, sf), first_words_model)
    return jobs.select("source_id", "tech_stack")


@query
def tag_log(spark, sf):
    _, log = tagging.tag_jobs(fixtures.postings(spark, sf), first_words_model)
    return log.select("batch_id", "attempts", "tokens", F.col("error").isNull().alias("ok"))


def failing_model(prompt: str) -> tuple[str, int | None]:
    """A model that is down for some batches, answers others in a wrong form, and names a job of another batch."""
    jobs = json.loads(prompt.split("\n", 1)[1])
    first = min(map(int, jobs))
    if first % 3 == 0:
        raise TimeoutError("no answer")
    if first % 3 == 1 and first % 2 == 0:
        return json.dumps(["not", "an", "object"]), 7
    return json.dumps({"1": "from elsewhere"} | {job: "seen" for job in jobs}), 11


@query
def tag_failures(spark, sf):
    """Attempts and tokens of batches whose calls fail, answer in a wrong form, or succeed."""
    _, log = tagging.tag_jobs(fixtures.postings(spark, sf), failing_model)
    return log.select("batch_id", "attempts", "tokens", F.col("error").isNull().alias("ok"))


@query
def tag_failures_run(spark, sf):
    """Tags after such a run: lost batches stay untagged, an answer about a job of another batch holds."""
    jobs, _ = tagging.tag_jobs(fixtures.postings(spark, sf), failing_model)
    return jobs.select("source_id", "tech_stack")


def shaky_extractor(prompt: str) -> tuple[str, int | None]:
    """Takes the first line of a résumé for its skills; fails on résumés of odd length."""
    body = prompt.split("<resume>\n        ", 1)[1].rsplit("\n        </resume>", 1)[0]
    if len(body) % 2:
        raise ConnectionError("lost")
    return json.dumps({"technical_skills": body.split("\n", 1)[0].split(", ")}), 5


@query
def resume_extraction(spark, sf):
    """Skills that a model extracts; a résumé whose calls all fail has none."""
    found = tagging.extract_resume_skills(fixtures.resumes(spark, sf), shaky_extractor)
    return found.select(
        "resume_id", F.array_join("technical_skills", "|").alias("skills"), "total_tokens", F.col("error").isNotNull().alias("failed")
    )


@query
def document_skills(spark, sf):
    """Market skills that the lines of whole documents list, however long the document."""
    demand = gaps.skill_demand(fixtures.postings(spark, sf))
    part = fixtures.table(spark, sf, "part")
    line = part.select(F.col("p_partkey").alias("doc_id"), F.concat("p_name", F.lit(", "), "p_type").alias("line"))
    docs = fixtures.table(spark, sf, "documents").select("doc_id", "text").join(line, "doc_id", "left")
    texts = docs.select(F.col("doc_id").cast("string").alias("resume_id"), F.concat_ws("\n", "text", "line").alias("text"))
    return gaps.line_skills(texts, demand)


@query
def tag_usage(spark, sf):
    _, log = tagging.tag_jobs(fixtures.postings(spark, sf), first_words_model)
    return tagging.usage_totals(log)


@query
def apply_tags(spark, sf):
    """Answers about postings from events: several per key, some for keys no posting has."""
    answers = fixtures.table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("source_id"),
        F.col("event_id").alias("batch_id"),
        F.lit(0).alias("position"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("tech_stack"),
    )
    return tagging.apply_tags(fixtures.postings(spark, sf), answers).select("source_id", "tech_stack")


@query
def clear_tags(spark, sf):
    return tagging.clear_tags(fixtures.postings(spark, sf))


@query
def set_tags(spark, sf):
    tables = {"jobs": fixtures.postings(spark, sf)}
    return scripts.run_script(tables, "update_tech_stack", "spark, sql", "42").tables["jobs"]


@query
def batch_plan(spark, sf):
    docs = fixtures.table(spark, sf, "documents")
    workload = docs.groupBy("source").agg(
        F.count("*").alias("total_jobs"), F.ceil(F.avg(text.token_estimate("text"))).alias("tokens_per_job")
    )
    names = RATE_LIMITS.fieldNames()
    limits = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in LIMITS])
    planned = tagging.batch_plan(workload.select("*", F.inline(limits)))
    return planned.select(
        "source", "model", labels.provider("model").alias("provider"), "batch_size", "calls", "retry_delay"
    )


@query
def tagging_quality(spark, sf):
    one = tagging.tagging_quality(fixtures.postings(spark, sf))
    return one.select(
        "jobs_measured",
        F.round("avg_skills_per_job", 6).alias("avg_skills_per_job"),
        F.round("duplicate_rate", 6).alias("duplicate_rate"),
        "short_tags",
    )


# --- messages ------------------------------------------------------------------------


@query
def route_messages(spark, sf):
    return routing.route_messages(fixtures.messages(spark, sf)).select("message_id", "route", "reply")


@query
def route_prompts(spark, sf):
    routed = routing.route_messages(fixtures.messages(spark, sf))
    return routed.filter("prompt is not null").select("message_id", "prompt")


@query
def model_replies(spark, sf):
    """Each conversation turn as a prompt to one of two models."""
    turns = fixtures.table(spark, sf, "conversations")
    prompts = turns.select(
        "conv_id",
        "turn",
        F.when(F.col("turn") % 2 == 0, "gemini-2.5-flash").otherwise("llama3.1").alias("model"),
        F.coalesce("text", F.lit("")).alias("prompt"),
    )
    services = {"gemini": lambda model, prompt: prompt.replace("e", "3"), "ollama": lambda model, prompt: f" {model} "}
    return routing.prompt_models(prompts, services).select("conv_id", "turn", "provider", "reply")


@query
def message_stream(spark, sf):
    routed = fixtures.turns_to_messages(fixtures.table_stream(spark, sf, "conversations"))
    out = scratch_path(spark, "routed")
    messages.route_stream(routed, out, f"{out}-checkpoint").awaitTermination()
    return spark.read.parquet(out).select("message_id", "route")


# --- kept up to date: buckets, state, paced calls, bitmaps ----------------------------


def _event_parts(spark, sf, parts=2):
    """The arriving records in ``parts`` of equal event numbers, in order."""
    events = fixtures.event_changes(spark, sf)
    step = fixtures.table(spark, sf, "events").agg(F.ceil((F.max("event_id") + 1) / parts).alias("step")).first()["step"]
    part = F.floor(F.col("doc_key").cast("bigint") / step)
    return [events.filter(part == i) for i in range(parts)]


def _bucket_load(spark, sf):
    """The prior jobs in buckets, the events loaded in two batches, and the second of them again."""
    table = incremental.jobs_table(spark, scratch_path(spark, "buckets"), 16)
    incremental.put_table(table, fixtures.prior_jobs(spark, sf), "prior")
    first, second = _event_parts(spark, sf)
    for name, records in (("first", first), ("second", second), ("second", second)):
        incremental.load_batch(table, records, name)
    return table


@query
def bucket_load(spark, sf):
    return _bucket_load(spark, sf).read()


@query
def bucket_changes(spark, sf):
    return _bucket_load(spark, sf).changes()


@query
def bucket_profile(spark, sf):
    """Jobs labelled and split bucket by bucket: what stays."""
    root = scratch_path(spark, "buckets")
    table, low = (incremental.jobs_table(spark, f"{root}/{name}", 16) for name in ("jobs", "low"))
    incremental.put_table(table, upsert.stage(fixtures.jobs(spark, sf)), "jobs")
    incremental.label_table(table, low, "profile")
    return table.read().select("source_id", "content_hash", "quality")


@query
def stateful_actions(spark, sf):
    """Actions by a stream with keyed state: four arrivals, each a start from the checkpoint the one before left."""
    root = scratch_path(spark, "states")
    for part in _event_parts(spark, sf, 4):
        part.write.mode("append").parquet(f"{root}/arrived")
        records = arrivals.read_silver_stream(spark, f"{root}/arrived")
        actions = states.upsert_actions_stream(records, fixtures.prior_jobs(spark, sf))
        states.write_actions(actions, f"{root}/actions", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/actions")


PACED_RPM = 12_000


@query
def paced_tag_log(spark, sf):
    """A failing model asked at a bounded rate, in slices: half the prompts, a restart with all, and one with them laid out again."""
    root = scratch_path(spark, "paced")
    asked = materialize(tagging.tag_prompts(tagging.tag_batches(tagging.untagged_jobs(fixtures.postings(spark, sf)))), "prompts")
    half = asked.agg(F.max("batch_id") / 2).scalar()
    early = F.col("batch_id") <= half
    for part in (asked.filter(early), asked.filter(~early), asked):
        pacing.lay_out_prompts(part, f"{root}/prompts", slice_rows=50)
        pacing.answer_slices(
            spark, f"{root}/prompts", f"{root}/answers", f"{root}/checkpoint", failing_model, tagging.is_tag_answer,
            asked.schema["batch_id"], rpm=PACED_RPM, lanes=2, retry_wait=0.01,
        ).awaitTermination()
    log = spark.read.parquet(f"{root}/answers")
    in_turn = pacing.calls_in_slots(log, PACED_RPM).select(F.col("most") <= 1).scalar()
    done = log.groupBy("batch_id").agg(
        F.sum("attempts").alias("calls"), F.sum("tokens").alias("tokens"), F.count("*").alias("answers"), F.max(F.col("error").isNull()).alias("ok")
    )
    return done.withColumn("in_turn", in_turn)


def _bitmaps(spark, sf):
    """The ranked market, the résumés, and the bitmaps of what each lists."""
    demand, cvs, possessed = _market(spark, sf)
    ranked = gaps.ranked_demand(demand)
    return ranked, cvs, materialize(bitmaps.held_bitmaps(ranked, possessed, "resume_id"), "bitmaps")


@query
def gap_counts(spark, sf):
    ranked, cvs, held = _bitmaps(spark, sf)
    return bitmaps.gap_counts(cvs, held, ranked.agg(F.count("*")).scalar(), "resume_id")


@query
def conversation_gap_counts(spark, sf):
    """Of each conversation the number of skills that none of its résumés lists."""
    ranked, cvs, held = _bitmaps(spark, sf)
    conv = F.substring_index("resume_id", "-", 1).cast("bigint").alias("conv_id")
    joined = bitmaps.joined_bitmaps(held.select(conv, "bucket", "held"), "conv_id")
    return bitmaps.gap_counts(cvs.select(conv), joined, ranked.agg(F.count("*")).scalar(), "conv_id")


@query
def asked_gaps(spark, sf):
    """All gaps of the résumés whose messages ask for them; none is written out for others."""
    ranked, _, held = _bitmaps(spark, sf)
    asking = routing.route_messages(fixtures.messages(spark, sf)).filter("route = 'skill_gap'").select(F.col("message_id").alias("resume_id"))
    return bitmaps.written_gaps(ranked, asking, held, "resume_id").select("resume_id", "skill", "demand")


def _kept_measures(spark, sf):
    """Measures of the jobs: those of the prior table, then kept by the changes of two loads; the jobs are never scanned for them."""
    root = scratch_path(spark, "measures")
    table, kept = incremental.jobs_table(spark, f"{root}/jobs", 16), incremental.measures_table(spark, f"{root}/kept", 16)
    prior = conform(fixtures.prior_jobs(spark, sf), JOBS)
    incremental.put_table(table, prior, "prior")
    standing = table.read().withColumn("bucket", incremental.bucket_of(table.buckets, *table.keys))
    own = maintained.measures(standing.withColumn("sign", F.lit(1))).unionByName(maintained.shortest_by_bucket(standing.limit(0), standing))
    kept.replace("prior", list(range(kept.buckets)), own, spark.createDataFrame([], incremental.CHANGES))
    for i, records in enumerate(_event_parts(spark, sf)):
        incremental.load_batch(table, records, f"load-{i}", kept)
    return kept.read()


@query
def kept_company_counts(spark, sf):
    return maintained.counts_of(_kept_measures(spark, sf), "company", "company", "count")


@query
def kept_skill_demand(spark, sf):
    return maintained.counts_of(_kept_measures(spark, sf), "skill", "skill", "demand")


@query
def kept_overview(spark, sf):
    return maintained.overview(_kept_measures(spark, sf)).select("jobs", F.round("mean_chars", 6).alias("mean_chars"), "shortest")


@query
def bronze_replaced(spark, sf):
    """Archives in two ingests, of which the second brings some again with another text: each stands once, as it came last."""
    table = incremental.bronze_table(spark, scratch_path(spark, "bronze"), 16)
    pages = fixtures.mhtml_pages(spark, sf).withColumn("modified", F.lit(None).cast("timestamp"))
    again = F.col("doc_key").cast("bigint") % 5 == 0
    native = fixtures.native_pages(spark, sf).select("doc_key", fixtures.archive_of("html").alias("content"), F.lit(None).cast("timestamp").alias("modified"))
    incremental.ingest_archives(table, pages, "first")
    incremental.ingest_archives(table, native.filter(again), "second")
    return table.read().select("doc_key", "html", "error_kind")


@query
def keyed_lookup(spark, sf):
    """The stored hashes of the keys that arrive, from a table sorted by key with Bloom filters."""
    path = scratch_path(spark, "keyed")
    keyed.write_keyed(fixtures.prior_jobs(spark, sf).select("source_id", "content_hash"), path, "source_id")
    return keyed.lookup(spark, path, fixtures.event_changes(spark, sf), "source_id")


# --- searched and paged without a scan -----------------------------------------------


def _index(spark, jobs):
    path = scratch_path(spark, "index")
    search.write_index(jobs, path, buckets=16, files=8)
    return path


@query
def indexed_search(spark, sf):
    path = _index(spark, fixtures.postings(spark, sf))
    return dashboard.search_jobs(search.candidates(spark, path, KEYWORD), KEYWORD)


@query
def indexed_total(spark, sf):
    """Matches in whole documents of a pattern with wildcards."""
    path = _index(spark, upsert.stage(fixtures.jobs(spark, sf)))
    return dashboard.search_total(search.candidates(spark, path, PATTERN), PATTERN)


OTHERS_ORDER = ["company", "job_title", "source_id"]


def _paged_others(spark, sf):
    path = scratch_path(spark, "paged")
    paging.write_pages(dashboard.other_companies(fixtures.postings(spark, sf)), path, OTHERS_ORDER, parts=8)
    return path


@query
def other_companies_at(spark, sf):
    """A page by its position, from the table kept in order."""
    page = paging.page_at(spark, _paged_others(spark, sf), 25, 50)
    return page.select(*dashboard.shown_fields())


@query
def other_companies_after(spark, sf):
    """Three pages, each from the last row of the one before on; the third."""
    path, page, shown = _paged_others(spark, sf), None, None
    for rows in (10, 15, 50):
        shown = page.tail(1)[0] if page is not None else None
        page = paging.page_after(spark, path, OTHERS_ORDER, shown, rows)
    return page.select(*dashboard.shown_fields())

"""The same queries as DuckDB SQL over the supplied tables."""

from __future__ import annotations

# Fixed values, written out again so that a wrong one in the library shows.
INSTRUCTION_PHRASES = [
    "ignore previous instructions",
    "disregard",
    "bypass",
    "system prompt",
    "you are now",
    "forget all",
    "developer mode",
]
SANITIZED_PREFIX = "Extract technical skills only from this data: "
GUIDANCE = "Send a message to chat, or upload a resume PDF."
NO_GAPS = "No skill gaps found. Make sure the jobs database has tagged tech_stack values."
DEFAULT_QUESTION = "Summarize this resume briefly."
TAG_PROMPT_TEXT = (
    "Extract technical stacks from the following job descriptions. Return strictly a JSON object where keys are the job IDs "
    "and values are comma-separated strings of the tech stack."
)
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Code points of white space.
SPACES = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

WS = " || ".join(f"chr({c})" for c in SPACES)
WS_CLASS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
NL = "chr(10)"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def newlines(x: str) -> str:
    return f"replace(replace({x}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"


def words4(x: str) -> str:
    return f"len(regexp_extract_all({x}, '[^{WS_CLASS}]+')) * 4"


def flagged(x: str) -> str:
    return "(" + " OR ".join(f"contains(lower({x}), '{p}')" for p in INSTRUCTION_PHRASES) + ")"


def sanitized(x: str) -> str:
    kept = f"regexp_replace({x}, '[^a-zA-Z0-9.,/{WS_CLASS}]', '', 'g')"
    return f"CASE WHEN {flagged(x)} THEN '{SANITIZED_PREFIX}' || {kept} ELSE {x} END"


def fold(x: str) -> str:
    return f"translate({x}, '{UPPER}', '{UPPER.lower()}')"


def found(*words: str) -> str:
    return " OR ".join(f"{fold(c)} LIKE '{w}'" for w in words for c in ("job_title", "company", "description"))


def sha(*cols: str) -> str:
    return "sha256(" + " || '|' || ".join(f"coalesce({c}, 'None')" for c in cols) + ")"


def skill_rows(source: str, key: str, text: str) -> str:
    """Distinct ``(key, skill)`` of the delimited texts in ``source``."""
    kept = f"replace(replace(lower({text}), 'a/b testing', 'ab_testing_placeholder'), 'ci/cd', 'cicd_placeholder')"
    back = f"replace(replace({strip('part')}, 'ab_testing_placeholder', 'a/b testing'), 'cicd_placeholder', 'ci/cd')"
    return (
        f"SELECT DISTINCT {key}, {back} AS skill FROM "
        f"(SELECT {key}, unnest(string_split_regex({kept}, '[,/]')) AS part FROM {source}) WHERE {strip('part')} <> ''"
    )


def escaped(x: str) -> str:
    return f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def unescaped(x: str) -> str:
    """The named references of the pages, also without their semicolon at the end of the text."""
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("amp", "&")):
        x = f"regexp_replace({x}, '&{name}(;|$)', '{char}', 'g')"
    return x


def inner_text(tag: str) -> str:
    """Text of the first ``tag``: its text nodes, stripped, with a space between; NULL without one."""
    body = f"regexp_extract(html, '(?s)<{tag}>(.*?)(</{tag}>|$)', 1)"
    shown = f"regexp_replace({body}, '(?s)<(script|style)[^>]*>.*?</(script|style)>', '<i>', 'g')"
    nodes = f"string_split_regex({shown}, '(?s)<!--.*?-->|</?[a-zA-Z][^>]*>')"
    texts = f"list_filter(list_transform({nodes}, lambda n: {strip(unescaped('n'))}), lambda n: n <> '')"
    return f"CASE WHEN contains(html, '<{tag}>') THEN array_to_string({texts}, ' ') END"


LABEL = """CASE WHEN coalesce(job_title, '') = '' OR coalesce(company, '') = '' OR coalesce(description, '') = ''
    OR length(description) < 100 OR regexp_matches(description, '[!#@$%^&*]{4,}') THEN 'LOW' ELSE 'HIGH' END"""
FIRST_LINE = f"split_part(text, {NL}, 1)"
SIX = "source_id, job_title, company, description, tech_stack, content_hash"
ARRIVED = (
    "SELECT lpad(CAST(event_id AS VARCHAR), 12, '0') AS doc_key, CAST(user_id AS VARCHAR) AS source_id, "
    "event_type AS job_title, 'acme ' || user_id % 7 AS company, 'text of ' || event_type AS description FROM events"
)


VIEWS = {
    "postings": """SELECT CAST(p_partkey AS VARCHAR) AS source_id,
        CASE WHEN p_partkey % 41 = 0 THEN '' ELSE p_name END AS job_title,
        CASE WHEN p_partkey % 37 = 0 THEN NULL WHEN p_partkey % 43 = 0 THEN '' ELSE p_brand END AS company,
        p_type || ' ' || p_name AS description,
        CASE WHEN p_partkey % 29 = 0 THEN NULL WHEN p_partkey % 31 = 0 THEN '   '
             ELSE p_name || ', ' || p_type || '/' || p_brand
                  || CASE WHEN p_partkey % 7 = 0 THEN ', CI/CD, A/B Testing' ELSE '' END END AS tech_stack
        FROM part""",
    "raw_jobs": f"""SELECT CAST(doc_id AS VARCHAR) AS source_id, {FIRST_LINE} AS job_title, source AS company,
        CASE WHEN doc_id % 97 = 0 THEN NULL WHEN doc_id % 50 = 0 THEN text || '####' ELSE text END AS description,
        CAST(NULL AS VARCHAR) AS tech_stack FROM documents""",
    "jobs": f"SELECT *, {sha('job_title', 'company', 'description')} AS content_hash FROM raw_jobs",
    "labelled": f"SELECT *, {LABEL} AS quality FROM jobs",
    "staged": f"SELECT *, {sha('job_title', 'company', 'description')} AS content_hash FROM ({ARRIVED})",
    "prior": f"""SELECT *, CASE WHEN CAST(source_id AS BIGINT) % 13 <> 0
            THEN {sha('job_title', 'company', 'description')} END AS content_hash
        FROM (SELECT CAST(s_suppkey AS VARCHAR) AS source_id,
            list_extract(['view', 'click', 'purchase', 'signup', 'error'], CAST(s_suppkey % 5 + 1 AS INT)) AS job_title,
            'acme ' || s_suppkey % 7 AS company,
            'text of ' || list_extract(['view', 'click', 'purchase', 'signup', 'error'], CAST(s_suppkey % 5 + 1 AS INT)) AS description,
            'python, sql' AS tech_stack, 'HIGH' AS quality FROM supplier)""",
    "nothing": "SELECT * FROM prior WHERE false",
    "first_states": """SELECT doc_key, source_id, content_hash,
            lag(content_hash) OVER w AS before, row_number() OVER w AS n
        FROM staged WINDOW w AS (PARTITION BY source_id ORDER BY doc_key)""",
    "first_actions": """SELECT doc_key, source_id, content_hash, CASE WHEN n = 1 THEN 'insert'
            WHEN before IS DISTINCT FROM content_hash THEN 'update' ELSE 'skip' END AS action FROM first_states""",
    "states": """SELECT *, lag(content_hash) OVER w AS before, row_number() OVER w AS n
        FROM (SELECT 1 AS turn, doc_key, source_id, content_hash FROM staged
              UNION ALL SELECT 0, '', source_id, content_hash FROM prior)
        WINDOW w AS (PARTITION BY source_id ORDER BY turn, doc_key)""",
    "actions": """SELECT doc_key, source_id, content_hash, CASE WHEN n = 1 THEN 'insert'
            WHEN before IS DISTINCT FROM content_hash THEN 'update' ELSE 'skip' END AS action
        FROM states WHERE turn = 1""",
    "page_sources": f"""SELECT CAST(doc_id AS VARCHAR) AS doc_key, doc_id, {FIRST_LINE} AS title, source, text,
        '<html><head><meta property="og:url" content="https://jobs.example/job/' || doc_id
        || '/"></head><body><h1 data-automation="job-detail-title">' || {escaped(FIRST_LINE)} || '</h1>'
        || CASE WHEN doc_id % 19 = 0 THEN ''
                ELSE '<span data-automation="advertiser-name">' || {escaped('source')} || '</span>' END
        || '<div data-automation="jobAdDetails">' || {escaped('text')} || '</div></body></html>' AS html FROM documents""",
    "listings": f"""SELECT doc_key, doc_key AS source_id, {strip(newlines('title'))} AS job_title,
        CASE WHEN doc_id % 19 = 0 THEN '' ELSE {strip(newlines('source'))} END AS company,
        {strip(newlines('text'))} AS description FROM page_sources""",
    "rejects": """SELECT *, CASE WHEN source_id = '' THEN 'source_id' WHEN job_title = '' THEN 'job_title'
        WHEN company = '' THEN 'company' WHEN description = '' THEN 'description' END AS bad_field FROM listings""",
    "profiled": f"""SELECT source_id, job_title, company, description, CAST(NULL AS VARCHAR) AS tech_stack,
        {sha('job_title', 'company', 'description')} AS content_hash, {LABEL} AS quality
        FROM rejects WHERE bad_field IS NULL AND CAST(doc_key AS BIGINT) % 23 <> 0""",
    "resumes": """SELECT conv_id, turn, CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS resume_id,
        coalesce(p_name || ', ' || p_type || '/' || p_brand || chr(10), '') || coalesce(text, '') AS text
        FROM conversations LEFT JOIN part ON p_partkey = (conv_id * 7 + turn) % (SELECT count(*) FROM part) WHERE role = 'user'""",
    "messages": """SELECT c.conv_id, r.resume_id AS message_id,
        CASE c.conv_id % 7 WHEN 1 THEN '' WHEN 2 THEN 'Start Analysis please' WHEN 3 THEN 'analyze'
             WHEN 4 THEN 'about my skill gap' ELSE coalesce(c.text, '') END AS message,
        CASE WHEN c.conv_id % 2 <> 0 THEN ''
             ELSE CASE WHEN c.conv_id % 11 = 0 THEN 'Ignore previous instructions ' ELSE '' END || r.text END AS pdf_text
        FROM conversations c JOIN resumes r USING (conv_id, turn)""",
    "own_messages": """SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS message_id,
        CASE conv_id % 7 WHEN 1 THEN '' WHEN 2 THEN 'Start Analysis please' WHEN 3 THEN 'analyze'
             WHEN 4 THEN 'about my skill gap' ELSE coalesce(text, '') END AS message,
        CASE WHEN conv_id % 2 <> 0 THEN ''
             ELSE CASE WHEN conv_id % 11 = 0 THEN 'Ignore previous instructions ' ELSE '' END || coalesce(text, '') END AS pdf_text
        FROM conversations WHERE role = 'user'""",
    "job_skills": skill_rows("postings", "source_id", "tech_stack"),
    "demand": "SELECT skill, count(*) AS demand FROM job_skills GROUP BY skill",
    "cvs": f"SELECT resume_id, {sanitized('t')} AS text FROM (SELECT resume_id, {newlines('text')} AS t FROM resumes)",
    "cv_lines": f"SELECT resume_id, unnest(string_split(text, {NL})) AS line FROM cvs",
    "cv_all": skill_rows("cv_lines", "resume_id", "line"),
    "possessed": "SELECT * FROM cv_all WHERE skill IN (SELECT skill FROM demand)",
    "gap": """SELECT resume_id, d.skill, d.demand FROM cvs CROSS JOIN demand d
        WHERE NOT EXISTS (SELECT 1 FROM possessed p WHERE p.resume_id = cvs.resume_id AND p.skill = d.skill)""",
    "ranked": "SELECT *, row_number() OVER (PARTITION BY resume_id ORDER BY demand DESC, skill) AS position FROM gap",
    "company_n": """SELECT company, count(*) AS count FROM postings
        WHERE company IS NOT NULL AND company <> '' GROUP BY company""",
    "company_rank": "SELECT *, row_number() OVER (ORDER BY count DESC, company) AS n FROM company_n",
    "companies": """SELECT company AS label, count, NULL AS "group", n FROM company_rank WHERE n <= 8
        UNION ALL SELECT 'Other (' || sum(count) || ' jobs, ' || count(*) || ' employers)', sum(count), 'other', 9
        FROM company_rank WHERE n > 8 HAVING sum(count) > 0""",
    "titles": """SELECT job_title AS label, count(*) AS count FROM postings
        WHERE job_title IS NOT NULL AND job_title <> '' GROUP BY job_title ORDER BY count(*) DESC, job_title LIMIT 10""",
    "others": """SELECT * FROM postings WHERE company IS NOT NULL
        AND company NOT IN (SELECT company FROM company_rank WHERE n <= 8)""",
    "batches": f"""SELECT (n - 1) // 5 AS batch_id, (n - 1) % 5 AS position, source_id, description FROM
        (SELECT *, row_number() OVER (ORDER BY source_id) AS n FROM postings WHERE tech_stack IS NULL OR tech_stack = '')""",
    "prompts": f"""SELECT batch_id, '{TAG_PROMPT_TEXT}' || {NL} || '{{' || string_agg('"' || source_id || '": "' || substr(description, 1, 1000) || '"', ', '
        ORDER BY position) || '}}' AS prompt FROM batches GROUP BY batch_id""",
    "json_keyed": "SELECT *, CAST(source_id AS BIGINT) AS k FROM postings",
    "json_rows": """SELECT *,
        CASE WHEN k % 17 = 0 THEN 'not a JSON object' WHEN k % 19 = 0 AND company IS NULL THEN 'missing company' WHEN k % 19 = 0 THEN NULL
             WHEN k % 23 = 0 OR k % 29 = 1 OR (k % 31 = 1 AND job_title IS NOT NULL) THEN 'not a JSON object'
             WHEN company IS NULL THEN 'missing company'
             WHEN k % 31 <> 1 AND (k % 47 = 0 OR k % 53 = 0) THEN 'nested description' END AS load_error,
        lpad(source_id, 12, '0') AS doc_key FROM json_keyed""",
}

_NAMES = list(VIEWS)


def sql(body: str) -> str:
    """``body`` behind the views it needs, each after those it builds on."""
    import re

    def used(text: str) -> set[str]:
        return {n for n in _NAMES if re.search(rf"\b(FROM|JOIN)\s+{n}\b", text)}

    needed, todo = set(), used(body)
    while todo:
        name = todo.pop()
        needed.add(name)
        todo |= used(VIEWS[name]) - needed
    views = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in _NAMES if n in needed)
    return f"WITH {views}\n{body}" if views else body


PAGE = "coalesce(job_title, '') AS job_title, coalesce(company, '') AS company, substr(coalesce(description, ''), 1, 200) AS description"
BY_TITLE = "ORDER BY postings.job_title NULLS FIRST, postings.source_id NULLS FIRST LIMIT 100"
BY_COMPANY = "ORDER BY others.company NULLS FIRST, others.job_title NULLS FIRST, others.source_id NULLS FIRST"
HIT = found("%wid_et%")

SUMMARY = """SELECT count(*) AS total, count(*) FILTER (action = 'insert') AS inserted,
    count(*) FILTER (action = 'update') AS updated, count(*) FILTER (action = 'skip') AS skipped"""
FINAL = """SELECT coalesce(w.source_id, p.source_id) AS source_id, coalesce(w.job_title, p.job_title) AS job_title,
    coalesce(w.company, p.company) AS company, coalesce(w.description, p.description) AS description,
    CASE WHEN w.source_id IS NULL THEN p.tech_stack END AS tech_stack,
    coalesce(w.content_hash, p.content_hash) AS content_hash, p.quality AS quality
    FROM (SELECT s.* FROM staged s JOIN
            (SELECT source_id, max(doc_key) AS doc_key FROM {actions} WHERE action <> 'skip' GROUP BY source_id)
            USING (source_id, doc_key)) w
    FULL OUTER JOIN {prior} p ON p.source_id = w.source_id"""


def route_of(source: str) -> str:
    m, r = strip("message"), strip("pdf_text")
    return f"""SELECT message_id, m, r, CASE WHEN r = '' AND m = '' THEN 'guidance' WHEN r = '' THEN 'chat'
        WHEN m = '' OR contains(lower(m), 'start analysis') OR contains(lower(m), 'skill gap') OR lower(m) = 'analyze'
        THEN 'skill_gap' ELSE 'resume_qa' END AS route
        FROM (SELECT message_id, {m} AS m, {r} AS r FROM {source})"""


def run_gaps(body: str) -> str:
    """Gap list and tokens per message when the résumé text is ``body``."""
    lines = skill_rows(
        f"(SELECT message_id, unnest(string_split({body}, {NL})) AS line FROM messages)", "message_id", "line"
    )
    return f"""SELECT m.message_id, {words4(body)} AS tokens,
        (SELECT string_agg(skill, ',' ORDER BY skill) FROM demand d WHERE NOT EXISTS
            (SELECT 1 FROM ({lines}) h WHERE h.message_id = m.message_id AND h.skill = d.skill)) AS gaps
        FROM messages m"""


KEPT_LINES = (
    f"coalesce((SELECT string_agg(line, {NL} ORDER BY i) FROM (SELECT unnest(string_split(pdf_text, {NL})) AS line, "
    f"unnest(range(len(string_split(pdf_text, {NL})))) AS i) WHERE NOT {flagged('line')}), '')"
)

_BODIES = {
    "all_jobs": f"SELECT {SIX} FROM jobs",
    "conform_postings": "SELECT *, CAST(NULL AS VARCHAR) AS content_hash, CAST(NULL AS VARCHAR) AS quality FROM postings",
    "bronze_roundtrip": "SELECT doc_key, html FROM page_sources WHERE doc_id % 23 <> 0",
    "bronze_errors": "SELECT doc_key, 'no_html' AS error_kind FROM page_sources WHERE doc_id % 23 = 0",
    "bronze_summary": """SELECT count(*) AS total, count(*) FILTER (doc_id % 23 <> 0) AS extracted,
        count(*) FILTER (doc_id % 23 = 0) AS failed FROM page_sources""",
    "html_extract_roundtrip": "SELECT * FROM listings",
    "page_titles": f"""SELECT CAST(page_id AS VARCHAR) AS doc_key,
        {strip(unescaped("regexp_extract(html, '<title>(.*?)</title>', 1)"))} AS title
        FROM pages""",
    "page_fields": f"""SELECT CAST(page_id AS VARCHAR) AS doc_key, {inner_text('title')} AS title, {inner_text('h1')} AS h1,
        {inner_text('article')} AS article FROM pages""",
    "source_id_from_url": "SELECT page_id, regexp_extract(rtrim(url, '/'), '[^/]*$') AS source_id FROM pages",
    "silver_valid": "SELECT * EXCLUDE (bad_field) FROM rejects WHERE bad_field IS NULL",
    "silver_rejects": "SELECT doc_key, bad_field FROM rejects WHERE bad_field IS NOT NULL",
    "silver_summary": """SELECT count(*) AS total, count(*) FILTER (bad_field IS NULL) AS processed,
        count(bad_field) AS skipped, count(*) FILTER (bad_field = 'source_id') AS missing_source_id,
        count(*) FILTER (bad_field = 'job_title') AS missing_job_title,
        count(*) FILTER (bad_field = 'company') AS missing_company,
        count(*) FILTER (bad_field = 'description') AS missing_description FROM rejects""",
    "json_records": """SELECT doc_key, CASE WHEN load_error IS NULL THEN source_id END AS source_id,
        CASE WHEN load_error IS NULL AND k % 19 <> 0 THEN job_title END AS job_title,
        CASE WHEN load_error IS NULL THEN company END AS company,
        CASE WHEN load_error IS NULL THEN description END AS description, load_error FROM json_rows""",
    "json_load_summary": """SELECT count(*) AS total, count(*) FILTER (load_error IS NULL) AS inserted,
        CAST(0 AS BIGINT) AS updated, count(load_error) AS skipped FROM json_rows""",
    "parse_skills": "SELECT * FROM job_skills",
    "union_skills": skill_rows(
        "(SELECT source_id, unnest([tech_stack, job_title]) AS raw FROM postings)", "source_id", "raw"
    ),
    "content_hash": "SELECT source_id, content_hash FROM jobs",
    "quality_label": "SELECT source_id, quality FROM labelled",
    "posting_quality_label": f"SELECT source_id, {LABEL} AS quality FROM postings",
    "token_estimate": f"SELECT doc_id, {words4('text')} AS tokens FROM documents",
    "clip_resume": f"SELECT doc_id, substr({newlines('text')}, 1, 3000) AS clipped FROM documents",
    "injection_flag": f"SELECT message_id, {flagged('pdf_text')} AS flagged FROM messages",
    "sanitize_resume": f"""SELECT message_id, {sanitized('t')} AS sanitized
        FROM (SELECT message_id, {newlines('pdf_text')} AS t FROM messages)""",
    "drop_instruction_lines": f"SELECT message_id, {KEPT_LINES} AS kept FROM messages",
    "upsert_first_load": "SELECT * FROM first_actions",
    "upsert_actions": "SELECT * FROM actions",
    "upsert_final": FINAL.format(actions="actions", prior="prior"),
    "upsert_summary": f"{SUMMARY} FROM actions",
    "stored_hashes": "SELECT source_id, content_hash FROM prior WHERE source_id IN (SELECT source_id FROM staged)",
    "new_keys": "SELECT DISTINCT source_id FROM staged WHERE source_id NOT IN (SELECT source_id FROM prior)",
    "snapshot_roundtrip": f"SELECT {SIX}, quality FROM prior",
    "change_log": """SELECT doc_key, source_id, content_hash, CASE WHEN n = 1 THEN 'insert'
            WHEN before IS DISTINCT FROM content_hash THEN 'update' ELSE 'skip' END AS action
        FROM (SELECT *, lag(content_hash) OVER w AS before, row_number() OVER w AS n
            FROM (SELECT *, CAST(doc_key AS BIGINT) > (SELECT max(event_id) // 2 FROM events) AS late FROM staged)
            WINDOW w AS (PARTITION BY late, source_id ORDER BY doc_key))""",
    "arrivals_stream": FINAL.format(actions="first_actions", prior="nothing"),
    "bucket_load": FINAL.format(actions="actions", prior="prior"),
    "bucket_changes": "SELECT * FROM actions",
    "bucket_profile": "SELECT source_id, content_hash, quality FROM labelled WHERE quality = 'HIGH'",
    "stateful_actions": "SELECT * FROM actions",
    "paced_tag_log": """SELECT batch_id, CASE WHEN low % 3 = 2 OR (low % 3 = 1 AND low % 2 = 1) THEN 1 ELSE 3 END::BIGINT AS calls,
        CASE WHEN low % 3 = 0 THEN 0 WHEN low % 3 = 1 AND low % 2 = 0 THEN 21 ELSE 11 END::BIGINT AS tokens, 1::BIGINT AS answers,
        low % 3 = 2 OR (low % 3 = 1 AND low % 2 = 1) AS ok, true AS in_turn
        FROM (SELECT batch_id, min(source_id::BIGINT) AS low FROM batches GROUP BY batch_id)""",
    "gap_counts": """SELECT resume_id, (SELECT count(*) FROM demand) - count(skill) AS gap_count
        FROM (SELECT resume_id FROM cvs) LEFT JOIN possessed USING (resume_id) GROUP BY resume_id""",
    "conversation_gap_counts": """SELECT conv_id, (SELECT count(*) FROM demand) - count(DISTINCT skill) AS gap_count
        FROM resumes LEFT JOIN possessed USING (resume_id) GROUP BY conv_id""",
    "asked_gaps": f"""SELECT resume_id, skill, demand FROM gap
        WHERE resume_id IN (SELECT message_id FROM ({route_of("messages")}) WHERE route = 'skill_gap')""",
    "kept_company_counts": f"""SELECT company, count(*) AS count FROM ({FINAL.format(actions="actions", prior="prior")})
        WHERE company IS NOT NULL AND company <> '' GROUP BY company""",
    "kept_skill_demand": f"""SELECT skill, count(*) AS demand FROM ({skill_rows(
        "(" + FINAL.format(actions="actions", prior="prior") + ")", "source_id", "tech_stack")}) GROUP BY skill""",
    "kept_overview": f"""SELECT count(*) AS jobs, round(sum(length(coalesce(description, ''))) / count(*), 6) AS mean_chars,
        min(length(description)) AS shortest FROM ({FINAL.format(actions="actions", prior="prior")})""",
    "bronze_replaced": """SELECT coalesce(CAST(n.page_id AS VARCHAR), s.doc_key) AS doc_key,
        CASE WHEN n.page_id IS NOT NULL THEN n.html WHEN s.doc_id % 23 <> 0 THEN s.html END AS html,
        CASE WHEN n.page_id IS NULL AND s.doc_id % 23 = 0 THEN 'no_html' END AS error_kind
        FROM page_sources s FULL JOIN (SELECT * FROM pages WHERE page_id % 5 = 0) n ON n.page_id = s.doc_id""",
    "keyed_lookup": "SELECT source_id, content_hash FROM prior WHERE source_id IN (SELECT source_id FROM staged)",
    "quality_split_high": "SELECT * FROM labelled WHERE quality = 'HIGH'",
    "quarantine": "SELECT * FROM labelled WHERE quality = 'LOW'",
    "quality_counts": """SELECT count(*) FILTER (quality = 'HIGH') AS high,
        count(*) FILTER (quality = 'LOW') AS low FROM labelled""",
    "quality_report": """SELECT count(*) AS total_records, (SELECT count(*) FROM labelled WHERE quality = 'LOW') AS quarantined,
        count(*) FILTER (coalesce(job_title, '') = '') AS null_job_title,
        count(*) FILTER (coalesce(company, '') = '') AS null_company,
        count(*) FILTER (coalesce(description, '') = '') AS null_description,
        CAST(coalesce(trunc(avg(length(description))), 0) AS BIGINT) AS avg_description_length,
        min(length(description)) AS shortest_length,
        (SELECT source_id FROM labelled WHERE quality = 'HIGH' ORDER BY length(description), source_id LIMIT 1) AS shortest_source_id,
        (SELECT job_title FROM labelled WHERE quality = 'HIGH' ORDER BY length(description), source_id LIMIT 1) AS shortest_job_title,
        max(length(description)) AS longest_length,
        (SELECT source_id FROM labelled WHERE quality = 'HIGH' ORDER BY length(description) DESC, source_id LIMIT 1) AS longest_source_id,
        (SELECT job_title FROM labelled WHERE quality = 'HIGH' ORDER BY length(description) DESC, source_id LIMIT 1) AS longest_job_title
        FROM labelled WHERE quality = 'HIGH'""",
    "job_count": "SELECT count(*) AS count FROM raw_jobs",
    "missing_counts": """SELECT count(*) FILTER (coalesce(job_title, '') = '') AS null_job_title,
        count(*) FILTER (coalesce(company, '') = '') AS null_company,
        count(*) FILTER (coalesce(description, '') = '') AS null_description FROM postings""",
    "mean_description_length": "SELECT CAST(trunc(avg(length(description))) AS BIGINT) AS avg_description_length FROM raw_jobs",
    "shortest_description": """SELECT length(description) AS desc_len, source_id, job_title FROM raw_jobs
        WHERE description IS NOT NULL ORDER BY 1, 2 LIMIT 1""",
    "longest_description": """SELECT length(description) AS desc_len, source_id, job_title FROM raw_jobs
        WHERE description IS NOT NULL ORDER BY 1 DESC, 2 LIMIT 1""",
    "company_totals": "SELECT company, count FROM company_n",
    "company_counts": 'SELECT label, CAST(count AS BIGINT) AS count, "group" FROM companies',
    "title_counts": "SELECT label, count FROM titles",
    "dashboard_stats": """SELECT (SELECT count(*) FROM postings) AS total,
        (SELECT string_agg(label || '=' || count, '; ' ORDER BY n) FROM companies) AS companies,
        (SELECT string_agg(label || '=' || count, '; ' ORDER BY count DESC, label) FROM titles) AS titles""",
    "search_jobs": f"SELECT {PAGE} FROM postings WHERE {HIT} {BY_TITLE}",
    "search_documents": f"SELECT {PAGE} FROM raw_jobs WHERE {found('%Étion%')} {BY_TITLE.replace('postings', 'raw_jobs')}",
    "search_blank": f"SELECT {PAGE} FROM postings WHERE {found('%%')} {BY_TITLE}",
    "search_others": f"SELECT {PAGE} FROM others {BY_COMPANY} LIMIT 100",
    "search_total": f"SELECT count(*) AS total FROM postings WHERE {HIT}",
    "search_response": f"""SELECT (SELECT string_agg(job_title || '|' || company || '|' || description, {NL} ORDER BY t, s) FROM
            (SELECT {PAGE}, job_title AS t, source_id AS s FROM postings WHERE {HIT} {BY_TITLE})) AS results,
        (SELECT count(*) FROM postings WHERE {HIT}) AS total,
        (SELECT count(*) FROM (SELECT 1 FROM postings WHERE {HIT} LIMIT 100)) AS shown""",
    "indexed_search": f"SELECT {PAGE} FROM postings WHERE {HIT} {BY_TITLE}",
    "indexed_total": f"SELECT count(*) AS total FROM raw_jobs WHERE {found('%keit das%_zu%')}",
    "other_companies_at": f"SELECT {PAGE} FROM others {BY_COMPANY} LIMIT 50 OFFSET 25",
    "other_companies_after": f"SELECT {PAGE} FROM others {BY_COMPANY} LIMIT 50 OFFSET 25",
    "other_companies_page": f"SELECT {PAGE} FROM others {BY_COMPANY} LIMIT 50 OFFSET 25",
    "other_companies_total": "SELECT count(*) AS count FROM others",
    "skill_demand": "SELECT * FROM demand",
    "vocabulary": "SELECT skill FROM demand",
    "tagged_stacks": "SELECT tech_stack FROM postings WHERE tech_stack IS NOT NULL AND trim(tech_stack) <> ''",
    "tagged_stacks_not_null": "SELECT tech_stack FROM postings WHERE tech_stack IS NOT NULL",
    "resume_skills": "SELECT * FROM possessed",
    "skill_gaps": "SELECT skill, demand FROM demand WHERE skill NOT IN (SELECT skill FROM possessed)",
    "skill_gap_top5": """SELECT skill, demand FROM demand WHERE skill NOT IN (SELECT skill FROM possessed)
        ORDER BY demand DESC, skill LIMIT 5""",
    "resume_gap_batch": "SELECT * FROM gap",
    "resume_top_gaps": "SELECT resume_id, position, skill, demand FROM ranked WHERE position <= 5",
    "gap_reports": """SELECT resume_id, string_agg(skill, ',' ORDER BY skill) AS gaps,
        string_agg(skill || '=' || demand, ',' ORDER BY demand DESC, skill) AS statistics, CAST(0 AS BIGINT) AS total_tokens
        FROM gap GROUP BY resume_id""",
    "gap_report": f"""SELECT cvs.resume_id, CASE WHEN count(skill) = 0 THEN '{NO_GAPS}' ELSE
        'gaps=[' || string_agg('''' || skill || '''', ', ' ORDER BY skill) || '] time=0 tokens=0' || {NL} || {NL}
        || '--- BONUS: Top 5 Most In-Demand Missing Skills ---' || {NL}
        || string_agg('Skill: ' || CASE WHEN length(skill) >= 20 THEN skill ELSE rpad(skill, 20, ' ') END
            || ' | Missing from resume, but required by ' || demand || ' job(s)', {NL} ORDER BY position)
            FILTER (position <= 5) END AS reply
        FROM cvs LEFT JOIN ranked USING (resume_id) GROUP BY cvs.resume_id""",
    "demand_summary": """SELECT (SELECT count(*) FROM demand) AS market_skills,
        (SELECT count(DISTINCT skill) FROM possessed) AS resume_skills, count(*) AS gap_count,
        min(demand) AS min_demand, max(demand) AS max_demand
        FROM demand WHERE skill NOT IN (SELECT skill FROM possessed)""",
    "demand_summaries": """SELECT cvs.resume_id, (SELECT count(*) FROM demand) AS market_skills,
        (SELECT count(*) FROM possessed p WHERE p.resume_id = cvs.resume_id) AS resume_skills,
        count(skill) AS gap_count, min(demand) AS min_demand, max(demand) AS max_demand
        FROM cvs LEFT JOIN gap USING (resume_id) GROUP BY cvs.resume_id""",
    "compare_runs": f"""SELECT message_id AS resume_id, a.gaps IS NOT DISTINCT FROM b.gaps AS gaps_identical,
        CASE WHEN a.tokens <> 0 THEN CAST(floor((a.tokens - b.tokens) * 100.0::DOUBLE / a.tokens) AS BIGINT) END AS token_saving_pct
        FROM ({run_gaps(sanitized('pdf_text'))}) a JOIN ({run_gaps(KEPT_LINES)}) b USING (message_id)""",
    "differing_rows": f"""WITH t AS (SELECT skill, count(*) AS demand
            FROM ({skill_rows('postings', 'source_id', 'job_title')}) GROUP BY skill)
        SELECT *, 'first' AS side FROM (SELECT * FROM t EXCEPT ALL SELECT * FROM demand)
        UNION ALL SELECT *, 'second' FROM (SELECT * FROM demand EXCEPT ALL SELECT * FROM t)""",
    "untagged_jobs": """SELECT source_id, job_title, company, description FROM postings
        WHERE tech_stack IS NULL OR trim(tech_stack) = ''""",
    "untagged_jobs_run": "SELECT source_id, description FROM postings WHERE tech_stack IS NULL OR tech_stack = ''",
    "tag_batches": """SELECT (n - 1) // 5 AS batch_id, (n - 1) % 5 AS position, source_id,
        coalesce(description, '') AS text
        FROM (SELECT *, row_number() OVER (ORDER BY source_id) AS n FROM raw_jobs)""",
    "tag_run": """SELECT source_id, CASE WHEN b.batch_id IS NULL THEN tech_stack
            ELSE split_part(b.description, ' ', 1) || ', ' || split_part(b.description, ' ', 2) END AS tech_stack
        FROM postings LEFT JOIN batches b USING (source_id)""",
    "tag_prompts": "SELECT batch_id, prompt FROM prompts",
    "tag_log": f"SELECT batch_id, CAST(1 AS BIGINT) AS attempts, {words4('prompt')} AS tokens, true AS ok FROM prompts",
    "tag_failures": f"""SELECT batch_id, CASE WHEN low % 3 = 2 OR (low % 3 = 1 AND low % 2 = 1) THEN 1 ELSE 3 END::BIGINT AS attempts,
        CASE WHEN low % 3 = 0 THEN 0 WHEN low % 3 = 1 AND low % 2 = 0 THEN 21 ELSE 11 END::BIGINT AS tokens,
        low % 3 = 2 OR (low % 3 = 1 AND low % 2 = 1) AS ok
        FROM (SELECT batch_id, min(source_id::BIGINT) AS low FROM batches GROUP BY batch_id)""",
    "tag_failures_run": """WITH asked AS (SELECT *, min(source_id::BIGINT) OVER (PARTITION BY batch_id) AS low FROM batches),
        fine AS (SELECT source_id FROM asked WHERE low % 3 = 2 OR (low % 3 = 1 AND low % 2 = 1))
        SELECT p.source_id, CASE WHEN p.source_id = '1' AND (SELECT count(*) FROM fine) > 0 THEN 'from elsewhere'
            WHEN p.source_id IN (SELECT source_id FROM fine) THEN 'seen' ELSE p.tech_stack END AS tech_stack FROM postings p""",
    "resume_extraction": f"""SELECT resume_id, CASE WHEN length(t) % 2 = 1 THEN '' ELSE replace(split_part(t, {NL}, 1), ', ', '|') END AS skills,
        CASE WHEN length(t) % 2 = 1 THEN 0 ELSE 5 END::BIGINT AS total_tokens, length(t) % 2 = 1 AS failed
        FROM (SELECT resume_id, {sanitized(f"substr({newlines('text')}, 1, 3000)")} AS t FROM resumes)""",
    "document_skills": f"""SELECT * FROM ({skill_rows(f"(SELECT resume_id, unnest(string_split(text, {NL})) AS line FROM "
        f"(SELECT CAST(doc_id AS VARCHAR) AS resume_id, concat_ws({NL}, text, p_name || ', ' || p_type) AS text "
        f"FROM documents LEFT JOIN part ON p_partkey = doc_id))", "resume_id", "line")}) WHERE skill IN (SELECT skill FROM demand)""",
    "pipeline_jobs": "SELECT * FROM profiled WHERE quality = 'HIGH'",
    "pipeline_quarantine": "SELECT * FROM profiled WHERE quality = 'LOW'",
    "pipeline_rejects": "SELECT doc_key, bad_field FROM rejects WHERE bad_field IS NOT NULL AND CAST(doc_key AS BIGINT) % 23 <> 0",
    "tag_usage": f"""SELECT CAST(coalesce(sum({words4('prompt')}), 0) AS BIGINT) AS total_tokens, count(*) AS attempts,
        CAST(0 AS BIGINT) AS failed_batches FROM prompts""",
    "model_replies": f"""SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN 'gemini' ELSE 'ollama' END AS provider,
        CASE WHEN turn % 2 <> 0 THEN 'llama3.1' WHEN {strip("coalesce(text, '')")} = ''
             THEN '[Gemini Error] Empty response from model.' ELSE {strip("replace(text, 'e', '3')")} END AS reply FROM conversations""",
    "apply_tags": """SELECT source_id, CASE WHEN a.id IS NULL THEN tech_stack ELSE a.tag END AS tech_stack
        FROM postings LEFT JOIN (SELECT CAST(user_id AS VARCHAR) AS source_id, max(event_id) AS id,
                CASE WHEN arg_max(event_type, event_id) <> 'error' THEN arg_max(event_type, event_id) END AS tag
            FROM events GROUP BY user_id) a USING (source_id)""",
    "clear_tags": "SELECT * REPLACE (CAST(NULL AS VARCHAR) AS tech_stack) FROM postings",
    "set_tags": "SELECT * REPLACE (CASE WHEN source_id = '42' THEN 'spark, sql' ELSE tech_stack END AS tech_stack) FROM postings",
    "batch_plan": f"""WITH w AS (SELECT source, count(*) AS jobs, CAST(ceil(avg({words4('text')})) AS BIGINT) AS per_job
            FROM documents GROUP BY source),
        l AS (SELECT * FROM (VALUES ('gemini-2.5-flash', 5, 250000, 20), ('gemini-2.5-flash-lite', 10, 250000, 20),
            ('gemini-3-flash-preview', 5, 250000, 20), ('gemini-3.1-flash-lite', 15, 250000, 500)) v(model, rpm, tpm, rpd)),
        b AS (SELECT *, CAST(greatest(1, ceil(jobs / rpd), least(
            floor((tpm * 0.35::DOUBLE - 120) / per_job), jobs, 8)) AS BIGINT) AS batch_size FROM w CROSS JOIN l)
        SELECT source, model, 'gemini' AS provider, batch_size, CAST(ceil(jobs / batch_size) AS BIGINT) AS calls,
            60.0::DOUBLE / rpm AS retry_delay FROM b""",
    "tagging_quality": f"""SELECT count(*) AS jobs_measured, round(avg(s), 6) AS avg_skills_per_job,
        round(1 - sum(s)::DOUBLE / sum(t), 6) AS duplicate_rate, count(*) FILTER (s = 1) AS short_tags
        FROM (SELECT source_id, count(DISTINCT part) AS s, count(*) AS t FROM
            (SELECT source_id, {strip('p')} AS part FROM (SELECT source_id, unnest(string_split_regex(
                replace(replace(lower(tech_stack), 'a/b testing', 'ab'), 'ci/cd', 'cicd'), '[,/]')) AS p
              FROM postings WHERE trim(tech_stack) <> '')) WHERE part <> '' GROUP BY source_id)""",
    "route_messages": f"""SELECT message_id, route, CASE WHEN route = 'guidance' THEN '{GUIDANCE}' END AS reply
        FROM ({route_of('messages')})""",
    "route_prompts": f"""SELECT message_id, CASE WHEN route = 'chat' THEN m ELSE
        'Resume text:' || {NL} || substr(r, 1, 3000) || {NL} || {NL} || 'User question: '
        || CASE WHEN m = '' THEN '{DEFAULT_QUESTION}' ELSE m END || {NL} || {NL}
        || 'Answer using only the resume above.' END AS prompt
        FROM ({route_of('messages')}) WHERE route IN ('chat', 'resume_qa')""",
    "message_stream": f"SELECT message_id, route FROM ({route_of('own_messages')})",
}


def _with_views(body: str) -> str:
    text = sql(body)
    # A body that opens with its own WITH joins the list of views.
    return text.replace("\nWITH ", ",\n", 1) if body.startswith("WITH ") and text != body else text


ORACLES = {name: _with_views(body) for name, body in _BODIES.items()}

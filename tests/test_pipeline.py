"""Stages, snapshots and streams on files."""

import base64
import json
import random
import shutil

import pytest

from hiremill.operators import upsert
from hiremill.plans import medallion
from hiremill.schemas import CHANGES, JOBS, SILVER
from hiremill.sources import files, json_output
from hiremill.sources.snapshots import expire_snapshots, latest_version, next_version, read_snapshot, write_snapshot
from hiremill.streaming import arrivals, messages


def page(source_id, title, company, text):
    element = '<p data-automation="{}">{}</p>'.format
    html = f'<meta property="og:url" content="https://x/job/{source_id}">' + element("job-detail-title", title)
    return html + (element("advertiser-name", company) if company else "") + element("jobAdDetails", text)


def save(folder, name, html):
    body = base64.encodebytes(html.encode()).decode() if html else ""
    kind = "text/html" if html else "text/plain"
    head = f"MIME-Version: 1.0\nContent-Type: {kind}; charset=utf-8\nContent-Transfer-Encoding: base64\n\n"
    (folder / f"{name}.mhtml").write_bytes((head + body).encode())


def counts(summaries):
    return {name: tuple(df.first()) for name, df in summaries.items()}


def test_all_stages_and_reruns(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "sub").mkdir()
    save(source / "sub", "nested", page("99", "T", "C", "not read"))
    (source / "notes.txt").write_text("not read")
    for i in range(6):
        save(source, f"job {i}+é", page(i, f"Title {i}", "ACME", "good text " * 20))
    save(source, "short", page(6, "Short", "ACME", "too short"))
    save(source, "nocompany", page(7, "None", "", "good text " * 20))
    save(source, "nohtml", None)
    first = medallion.run_stage(spark, "all", root, str(source))
    assert list(first) == ["ingest", "process", "load", "profile"]
    got = counts(first)
    assert got["ingest"] == (9, 8, 1)
    assert got["process"][:3] == (8, 7, 1)
    assert got["load"] == (7, 7, 0, 0)
    assert got["profile"][:2] == (6, 1)
    jobs = read_snapshot(spark, f"{root}/jobs", JOBS)
    assert {r.source_id for r in jobs.collect()} == set("012345")
    assert "job 0+é" in {r.doc_key for r in medallion.valid_records(spark, root).collect()}
    assert [tuple(r) for r in medallion.rejected_records(spark, root).collect()] == [("nocompany", "company")]
    # Nothing changed: kept rows are skipped, the quarantined one arrives anew.
    assert counts({"load": medallion.load(spark, root)})["load"] == (7, 1, 0, 6)
    assert tuple(medallion.profile(spark, root).first())[:2] == (6, 1)
    # Profiling twice without a load empties the quarantine.
    assert tuple(medallion.profile(spark, root).first())[:2] == (6, 0)
    assert read_snapshot(spark, f"{root}/jobs_quarantine", JOBS).count() == 0
    # A page that turns invalid leaves silver.
    save(source, "job 0+é", page(0, " ", "ACME", "good text " * 20))
    medallion.run_stage(spark, "ingest", root, str(source))
    assert tuple(medallion.process(spark, root).first())[:3] == (8, 6, 2)
    assert "job 0+é" not in {r.doc_key for r in medallion.valid_records(spark, root).collect()}


def test_stages_on_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    got = counts(medallion.run_stage(spark, "all", str(tmp_path / "out"), str(tmp_path / "in")))
    assert (got["ingest"], got["process"][:3], got["load"]) == ((0, 0, 0), (0, 0, 0), (0, 0, 0, 0))
    assert got["profile"] == (0, 0, 0, 0, 0, 0, 0, "N/A", "N/A", 0, "N/A", "N/A")


def test_unknown_stage(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown stage"):
        medallion.run_stage(spark, "explode", str(tmp_path))


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "t")
    assert latest_version(spark, path) is None and read_snapshot(spark, path, JOBS).count() == 0
    one = spark.createDataFrame([("1", "go")], "source_id string, tech_stack string")
    assert (write_snapshot(one, path), write_snapshot(one.limit(0), path)) == (1, 2)
    assert read_snapshot(spark, path, JOBS).count() == 0
    row = read_snapshot(spark, path, JOBS, version=1).first()
    assert row.asDict() == {**dict.fromkeys(JOBS.fieldNames()), "source_id": "1", "tech_stack": "go"}
    # A version whose job was lost is neither read nor written again.
    shutil.copytree(f"{path}/version=1", f"{path}/version=3", ignore=shutil.ignore_patterns("_SUCCESS"))
    assert latest_version(spark, path) == 2 and write_snapshot(one, path) == 4
    assert expire_snapshots(spark, path, keep=1) == [1, 2] and read_snapshot(spark, path, JOBS).count() == 1


def records(n, seed):
    rng = random.Random(seed)
    return [(f"{i:05d}", f"k{rng.randint(0, 9)}", rng.choice("ab"), "c", rng.choice("de")) for i in range(n)]


@pytest.mark.parametrize("cuts", [[60], [20, 40, 60], [1, 2, 59, 60]])
def test_stream_equals_batch_for_any_split(spark, tmp_path, cuts):
    rows = records(60, 4)
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")
    start = 0
    for end in cuts:
        # One more run of the query per slice: the checkpoint takes up where it stopped.
        spark.createDataFrame(rows[start:end], SILVER).coalesce(1).write.mode("append").parquet(folder)
        stream = arrivals.read_silver_stream(spark, folder, files_per_batch=1)
        arrivals.load_stream(stream, root, str(tmp_path / "check")).awaitTermination()
        start = end
    staged, empty = upsert.stage(spark.createDataFrame(rows, SILVER)), spark.createDataFrame([], JOBS)
    actions = upsert.upsert_actions(staged, empty)
    want = {tuple(r) for r in upsert.apply_changes(empty, staged, actions).collect()}
    assert {tuple(r) for r in arrivals.loaded_jobs(spark, root).collect()} == want
    # A replayed batch changes nothing.
    replay = spark.createDataFrame(rows[cuts[-2] if len(cuts) > 1 else 0 :][-1:], SILVER)
    assert tuple(medallion.load_records(spark, replay, root).first()) == (1, 0, 0, 1)
    assert {tuple(r) for r in arrivals.loaded_jobs(spark, root).collect()} == want
    # A load lost before its jobs version leaves changes that never took effect.
    lost = next_version(spark, f"{root}/jobs", f"{root}/changes")
    write_snapshot(read_snapshot(spark, f"{root}/changes", CHANGES), f"{root}/changes", lost)
    assert medallion.change_log(spark, root).count() == len(rows) + 1
    assert next_version(spark, f"{root}/jobs", f"{root}/changes") == lost + 1


def test_message_stream(spark, tmp_path):
    rows = [("1", "", ""), ("2", "hi", ""), ("3", "analyze", "cv"), ("4", "who", "cv")]
    df = spark.createDataFrame(rows, "message_id string, message string, pdf_text string")
    df.write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).json(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    messages.route_stream(stream, out, str(tmp_path / "check")).awaitTermination()
    got = {r.message_id: r.route for r in spark.read.parquet(out).collect()}
    assert got == {"1": "guidance", "2": "chat", "3": "skill_gap", "4": "resume_qa"}


def test_raw_file_scans(spark, tmp_path):
    (tmp_path / "a.html").write_bytes("<p>é\r\n</p>".encode())
    (tmp_path / "b.html").write_bytes(b"<p>\xff</p>")
    html = {r.doc_key: (r.html, r.error_kind) for r in files.scan_html(spark, str(tmp_path)).collect()}
    assert html == {"a": ("<p>é\n</p>", None), "b": (None, "encoding")}
    record = {"source_id": "1", "job_title": "é", "company": "c", "description": "d\ne"}
    (tmp_path / "r 1.json").write_text(json.dumps(record, ensure_ascii=False, indent=2), encoding="utf-8")
    (tmp_path / "bad.json").write_text("{")
    got = {r.doc_key: r for r in files.scan_records(spark, str(tmp_path)).collect()}
    assert got["r 1"].description == "d\ne" and got["r 1"].load_error is None and got["bad"].load_error
    (tmp_path / "cv.txt").write_bytes("a\r\nb".encode() + "é".encode() * 4000)
    (cv,) = files.scan_resumes(spark, str(tmp_path)).collect()
    assert (cv.resume_id, cv.text) == ("cv", "a\nb" + "é" * 4000)


def test_json_results(spark, tmp_path):
    from hiremill.plans.analysis import find_skill_gaps

    cvs = spark.createDataFrame([("cv", "Go")], "resume_id string, text string")
    jobs = spark.createDataFrame([("go, rust/sql, rust",), ("sql",)], "tech_stack string")
    json_output.write_results(find_skill_gaps(cvs, jobs), str(tmp_path / "out"))
    (line,) = [line for f in (tmp_path / "out").glob("*.json") for line in f.read_text().splitlines()]
    got = json.loads(line)
    assert (got["gaps"], list(got["demand_statistics"].items())) == (["rust", "sql"], [("sql", 2), ("rust", 1)])


def test_load_of_json_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, source_id, title in (("b", "1", "new"), ("a", "1", "old"), ("c", "2", "x")):
        record = {"source_id": source_id, "job_title": title, "company": "c", "description": "d"}
        (tmp_path / "in" / f"{name}.json").write_text(json.dumps(record, indent=2))
    (tmp_path / "in" / "d.json").write_text("nope")
    root = str(tmp_path / "out")
    assert tuple(medallion.load(spark, root, str(tmp_path / "in")).first()) == (4, 2, 1, 1)
    jobs = read_snapshot(spark, f"{root}/jobs", JOBS)
    assert {(r.source_id, r.job_title) for r in jobs.collect()} == {("1", "new"), ("2", "x")}
    json_output.write_records(jobs, str(tmp_path / "json"))
    lines = [json.loads(line) for f in (tmp_path / "json").glob("*.json") for line in f.read_text().splitlines()]
    assert {(r["source_id"], r["job_title"]) for r in lines} == {("1", "new"), ("2", "x")}


def test_streams_of_tables_kept_as_folders(spark, tmp_path):
    from hiremill.plans.queries import QUERIES

    turns = [(c, t, role, f"text {c}") for c in range(1, 5) for t, role in ((0, "user"), (1, "assistant"))]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").repartition(2).write.parquet(str(tmp_path / "conversations.parquet"))
    events = [(i, i % 3, "click") for i in range(6)]
    spark.createDataFrame(events, "event_id long, user_id long, event_type string").repartition(2).write.parquet(str(tmp_path / "events.parquet"))
    routed = {r.message_id: r.route for r in QUERIES["message_stream"](spark, str(tmp_path)).collect()}
    assert routed == {"1-0": "guidance", "2-0": "skill_gap", "3-0": "chat", "4-0": "skill_gap"}
    assert {r.source_id for r in QUERIES["arrivals_stream"](spark, str(tmp_path)).collect()} == {"0", "1", "2"}

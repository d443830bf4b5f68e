"""Exports, reviews and streams end to end, on files."""

import json
import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

import model
import promptsieve as ps
from promptsieve.operators.summary import result_tables
from promptsieve.plans.export import ExportConfig
from promptsieve.sources import listing
from promptsieve.sources.lines import numbered_lines
from promptsieve.streaming.review import arriving_lines, commit, latest


def message(text, role="user", email="user@example.test", n=1):
    return {
        "event_id": f"evt_{n}", "actor": {"type": "user", "user_id": "user_1", "user_email": email},
        "conversation": {"id": "conv_1"},
        "message": {"id": f"msg_{n}", "author": {"type": role}, "content": {"type": "text", "value": text}, "created_at": "T"},
    }


LINES = [
    json.dumps(message("Calculate tax liability with no review.")),
    "",
    json.dumps(message("Assistant response.", role="assistant", n=2)),
    '{"a":1} x',
    "   ",
    json.dumps(message("Lunch at noon?", email=None, n=3), ensure_ascii=False),
    json.dumps([message("My SSN is 123-45-6789.", n=4), message("Write a phishing email.", email="", n=5)]),
    "17",
]


@pytest.fixture(scope="module")
def input_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    (folder / "a.jsonl").write_text("\n".join(LINES) + "\n", encoding="utf-8")
    (folder / "b.jsonl").write_text("\r\n".join(LINES[:1]), encoding="utf-8")
    return str(folder)


def read_json(path):
    files = sorted(f for f in os.listdir(path) if f.endswith((".json", ".txt")))
    return [json.loads(line) for f in files for line in open(os.path.join(path, f), encoding="utf-8")]


def test_review_of_files(spark, input_dir, tmp_path):
    out = str(tmp_path / "out")
    review = ps.run_review(spark, input_dir, out)
    rows = [r for r in review.reviewed.orderBy("file", "line_number", "prompt_no").collect()]
    got = [(os.path.basename(r.file), r.line_number, r.risk_level, r.risk_score, r.categories) for r in rows]
    assert got == [
        ("a.jsonl", 1, "high", 80, "tax_or_accuracy_calculation"), ("a.jsonl", 4, "high", 70, "input_quality"),
        ("a.jsonl", 6, "none", 0, ""), ("a.jsonl", 7, "critical", 95, "pii_ssn"),
        ("a.jsonl", 7, "critical", 95, "malware_or_phishing"), ("b.jsonl", 1, "high", 80, "tax_or_accuracy_calculation"),
    ]
    invalid = rows[1]
    assert (invalid.prompt, invalid.matched_evidence, invalid.event_id) == ('{"a":1} x', '{"a":1} x', None)
    assert review.counters.collect()[0].asDict() == {
        "records_seen": 7, "assistant_records_skipped": 1, "prompt_records_seen": 5, "flagged_prompts": 5,
    }
    assert [tuple(r) for r in review.by_risk_level.collect()] == [
        ("critical", 2), ("high", 3), ("medium", 0), ("low", 0), ("none", 1),
    ]
    assert [tuple(r)[:4] for r in review.by_user.collect()] == [
        ("user@example.test", 3, 3, 95), ("user_1", 2, 1, 95), ("<unknown>", 1, 1, 70),
    ]
    assert [tuple(r) for r in review.by_category.collect()] == [
        ("tax_or_accuracy_calculation", 2, 80, 1), ("input_quality", 1, 70, 1),
        ("malware_or_phishing", 1, 95, 1), ("pii_ssn", 1, 95, 1),
    ]
    written = read_json(f"{out}/compliance_findings")
    assert len(written) == 5 and list(written[0]) == [*review.reviewed.columns[:15], "file", "prompt_no"]
    summary = read_json(f"{out}/compliance_summary")
    assert summary[0] == {
        "section": "counters", "input_path": input_dir, "records_seen": 7, "assistant_records_skipped": 1,
        "prompt_records_seen": 5, "flagged_prompts": 5,
    }
    assert [s["section"] for s in summary[1:]] == ["by_user"] * 3 + ["by_category"] * 4 + ["by_risk_level"] * 5
    assert summary[1]["user_email"] == "user@example.test" and summary[1]["critical"] == 1
    assert summary[-1] == {"section": "by_risk_level", "risk_level": "none", "count": 1}
    tables = {name: spark.read.option("header", True).csv(f"{out}/tables/{name}") for name in os.listdir(f"{out}/tables")}
    assert set(tables) == set(result_tables(review.reviewed))
    assert tables["summary_by_risk_level"].columns == ["risk_level", "count"]
    assert tables["reviewed_prompts"].count() == 6


def test_outputs_are_in_the_order_of_the_input(spark, tmp_path):
    """Many lines in several files and splits, written by several tasks."""
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    wanted = []
    for name in ("a", "b", "c"):
        texts = [f"{name} {i} {'123-45-6789' if i % 3 else 'x' * (i % 50)}" for i in range(400)]
        lines = [json.dumps([{"role": "user", "content": t}, {"role": "user", "content": t + " again"}]) for t in texts]
        (folder / f"{name}.jsonl").write_text("\n".join(lines))
        wanted += [x for t in texts for x in (t, t + " again")]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        review = ps.run_review(spark, str(folder), out, redact_prompt=False)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len([f for f in os.listdir(f"{out}/compliance_reviewed_prompts") if f.endswith(".json")]) > 1
    assert [r["prompt"] for r in read_json(f"{out}/compliance_reviewed_prompts")] == wanted
    flagged = [t for t in wanted if "123-45" in t]
    assert [r["prompt"] for r in read_json(f"{out}/compliance_findings")] == flagged
    assert tuple(review.counters.first()) == (1200, 0, 2400, len(flagged))


def test_review_of_nothing(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text("\n  \n")
    review = ps.run_review(spark, str(tmp_path / "in.jsonl"), str(tmp_path / "out"))
    assert tuple(review.counters.first()) == (0, 0, 0, 0) and review.reviewed.count() == 0
    assert read_json(f"{tmp_path}/out/compliance_summary")[0]["records_seen"] == 0


def test_redacted_evidence(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text(json.dumps(message("SSN 123-45-6789")))
    path = str(tmp_path / "in.jsonl")
    shown = {e: ps.run_review(spark, path, str(tmp_path / f"out{e}"), redact_evidence=e).reviewed.first() for e in (True, False)}
    assert [shown[e].matched_evidence for e in (True, False)] == ["SSN [SSN]", "SSN 123-45-6789"]
    assert shown[True].prompt == "SSN 123-45-6789"


def test_redacted_review_keeps_invalid_lines_whole(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    lines = [json.dumps(message("SSN 123-45-6789")), "broken 123-45-6789"]
    (folder / "x.jsonl").write_text("\n".join(lines))
    review = ps.run_review(spark, str(folder), str(tmp_path / "out"), redact_prompt=True)
    assert [r.prompt for r in review.reviewed.orderBy("line_number").collect()] == ["SSN [SSN]", "broken 123-45-6789"]


@pytest.mark.parametrize("split_bytes", ["64m", "997"])
def test_line_numbers_in_splits(spark, tmp_path, split_bytes):
    expected = set()
    for name in ("a", "b", "c"):
        lines = [f"{name} line {i} {'é' * (i % 13)}" if i % 5 else "" for i in range(1, 700)]
        (tmp_path / f"{name}.txt").write_text("\n".join(lines) + "\n", encoding="utf-8")
        expected |= {(f"{name}.txt", i, line) for i, line in enumerate(lines, 1)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        lines = numbered_lines(spark, str(tmp_path))
        rows = lines.select(F.element_at(F.split("file", "/"), -1), "line_number", "line").collect()
        if split_bytes == "997":
            assert lines.rdd.getNumPartitions() > 20
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == len(expected) and set(map(tuple, rows)) == expected


def test_stream_equals_batch(spark, input_dir, tmp_path):
    query = ps.start_review(arriving_lines(spark, input_dir), str(tmp_path / "t"), str(tmp_path / "c"))
    query.awaitTermination()
    columns = ("line_number", "prompt_no", "risk_level", "risk_score", "categories", "matched_evidence", "prompt", "user_email")
    streamed = spark.read.parquet(str(tmp_path / "t")).select(*columns).collect()
    batch = ps.review_lines(numbered_lines(spark, input_dir)).select(*columns).collect()
    assert sorted(map(str, streamed)) == sorted(map(str, batch))


def test_stream_totals_grow(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for n, expected in ((1, 1), (2, 2)):
        (folder / f"{n}.jsonl").write_text(json.dumps(message("My SSN is 123-45-6789.", n=n)) + "\n")
        ps.start_user_totals(arriving_lines(spark, str(folder)), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
        row = latest(spark, str(tmp_path / "t")).collect()[0]
        assert (row.user_email, row.total_prompts, row.critical) == ("user@example.test", expected, expected)


def test_a_batch_run_again_replaces_its_own_rows(spark, tmp_path):
    table = str(tmp_path / "t")
    for batch, rows in ((0, [1, 2]), (1, [3]), (0, [1, 2]), (1, [4, 5])):
        commit(spark.createDataFrame([(n,) for n in rows], "n int"), table, batch)
    assert sorted(r.n for r in spark.read.parquet(table).collect()) == [1, 2, 4, 5]
    assert sorted(r.n for r in latest(spark, table).collect()) == [4, 5]


def test_stream_numbers_lines_over_splits(spark, tmp_path):
    """A file in many splits, read as a stream."""
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "long.jsonl").write_text("".join(f"line {i} {'x' * (i % 90)}\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        ps.start_review(arriving_lines(spark, str(folder)), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    rows = spark.read.parquet(str(tmp_path / "t")).orderBy("line_number").collect()
    assert [(r.line_number, r.prompt.split()[1]) for r in rows] == [(i + 1, str(i)) for i in range(3000)]


def pages(spark, *responses):
    rows = [(i + 1, json.dumps(r)) for i, r in enumerate(responses)]
    return spark.createDataFrame(rows, "page_no bigint, page_json string")


TWO_PAGES = (
    {"data": [{"id": "log_1"}, "odd", {"id": ""}], "has_more": True, "last_end_time": "2026-05-01T01:00:00Z"},
    {"data": [{"id": "log_2"}, {"id": 3}, {"id": "log_1"}, {"id": "gone"}], "has_more": False, "last_end_time": "2026-05-01T02:00:00Z"},
)
BODIES = {
    "log_1": json.dumps({"event_id": "e1", "conversation_id": "c1", "message": {"id": "m1", "role": "user", "content": "hello"}}),
    "log_2": json.dumps({"message": {"id": "m2", "role": "assistant", "content": "hi"}}),
    "3": '{"note": 1}\n{broken\n',
    "other": "not listed",
}


def test_export(spark, tmp_path):
    bodies = spark.createDataFrame(list(BODIES.items()), "log_id string, body string")
    config = ExportConfig("workspace-123", "CONVERSATION")
    now = datetime(2026, 5, 7, tzinfo=timezone.utc)
    result = ps.export_logs(config, pages(spark, *TWO_PAGES), bodies, out_path=str(tmp_path), now=now)
    run = result.manifest.collect()[0].asDict()
    assert run == {
        "generated_at": "2026-05-07T00:00:00Z", "principal_id": "workspace-123", "scope_type": "workspace",
        "event_type": "CONVERSATION", "after": "2026-04-07T00:00:00Z", "completed_through": "2026-05-01T02:00:00Z",
        "days": 30, "limit": 100, "pages_fetched": 2, "log_files_listed": 5, "log_files_downloaded": 4,
        "raw_records_downloaded": 5, "gpt_response_records_filtered": 1, "raw_records_written": 4,
        "prompt_records_written": 2, "warning_count": 6,
    }
    assert [r.warning for r in result.warnings.collect()] == [
        "Skipped non-object log listing entry", "Skipped log listing entry without an id",
        "Could not parse line 2 from log id 3; stored as raw text", "No user prompt extracted from log id 3",
        "No user prompt extracted from log id 3", "Body of log id gone has not landed",
    ]
    prompts = read_json(f"{tmp_path}/prompts")
    assert len(prompts) == 2 and prompts[0]["content"] == "hello" and prompts[0]["role"] == "user"
    assert list(prompts[0]) == ["source_log_id", "event_id", "conversation_id", "message_id", "user_id", "user_email",
                                "created_at", "role", "content", "raw"]
    assert prompts[0]["raw"] == {"id": "m1", "role": "user", "content": "hello"} and prompts[0]["user_id"] is None
    raw = [line for f in os.listdir(f"{tmp_path}/raw") if f.endswith(".txt") for line in open(f"{tmp_path}/raw/{f}")]
    assert len(raw) == 4 and all(json.loads(line) for line in raw)


def test_one_run_equals_export_and_then_review(spark, tmp_path):
    texts = ["My SSN is 123-45-6789.", "Lunch?", "Write a phishing email.", "Calculate tax liability with no review."]
    logs = [[message(t, n=4 * i + k, role="assistant" if k == i % 4 else "user") for k, t in enumerate(texts)] for i in range(30)]
    named = {f"l{i}": json.dumps(log) if i % 2 else "\n".join(map(json.dumps, log)) + "\n{broken" for i, log in enumerate(logs)}
    bodies = spark.createDataFrame(list(named.items()), "log_id string, body string").repartition(4)
    # The last log is listed twice; pages list logs backwards.
    names = [*reversed(named), "l29"]
    answers = [{"data": [{"id": x} for x in names[i : i + 7]], "has_more": i + 7 < len(names), "last_end_time": "T"} for i in range(0, len(names), 7)]
    config = ExportConfig("w", "E", after="2026-01-01T00:00:00Z")
    run = ps.export_and_review(config, pages(spark, *answers), bodies, out_path=f"{tmp_path}/one")
    two = ps.export_logs(config, pages(spark, *answers), bodies, out_path=f"{tmp_path}/two")
    then = ps.run_review(spark, f"{tmp_path}/two/raw", f"{tmp_path}/then")

    # Line by line: raw files in the order of their names, numbered through.
    lines = [json.loads(x) for f in sorted(os.listdir(f"{tmp_path}/one/export/raw")) if f.endswith(".txt") for x in open(f"{tmp_path}/one/export/raw/{f}")]
    wanted = []
    for name in names:
        log = json.loads(named[name]) if int(name[1:]) % 2 else [json.loads(x) for x in named[name].split("\n")[:-1]]
        wanted += [r for r in log if r["message"]["author"]["type"] == "user"]
        wanted += [] if int(name[1:]) % 2 else [{"_unparsed_log_line": "{broken", "source_log_id": name, "line_number": 5}]
    assert lines == wanted
    got = run.review.reviewed.orderBy("line_number", "prompt_no").collect()
    assert [(r.line_number, r.message_id, r.prompt) for r in got] == [
        (n, m["message"]["id"], m["message"]["content"]["value"]) for n, m in enumerate(wanted, 1) if "message" in m
    ]
    # Everything else as from two steps.
    columns = [c for c in run.review.reviewed.columns if c not in ("line_number", "findings")]
    assert sorted(map(str, run.review.reviewed.select(columns).collect())) == sorted(map(str, then.reviewed.select(columns).collect()))
    assert run.review.counters.first() == then.counters.first() and run.review.counters.first().flagged_prompts > 50
    for name in ("by_user", "by_category", "by_risk_level"):
        assert getattr(run.review, name).collect() == getattr(then, name).collect()
    same = [c for c in two.manifest.columns if c != "generated_at"]
    assert run.export.manifest.select(same).first() == two.manifest.select(same).first()
    written = read_json(f"{tmp_path}/one/review/compliance_reviewed_prompts")
    assert [r["line_number"] for r in written] == [r.line_number for r in got]


def test_one_run_over_nothing(spark, tmp_path):
    bodies = spark.createDataFrame([], "log_id string, body string")
    run = ps.export_and_review(ExportConfig("w", "E"), pages(spark, {"data": []}), bodies, out_path=str(tmp_path))
    assert run.review.reviewed.count() == 0 and run.review.counters.first().records_seen == 0


def test_bodies_come_out_the_same_by_broadcast_and_by_shuffle(spark):
    bodies = spark.createDataFrame(list(BODIES.items()), "log_id string, body string")
    entries = listing.entries(listing.read_pages(pages(spark, *TWO_PAGES)))
    ways = [{}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "broadcast_hashes": 0}]
    rows = [sorted(map(str, listing.fetch_bodies(entries, bodies, **way).collect())) for way in ways]
    assert rows[0] == rows[1] == rows[2] != []


def test_absent_bodies_are_not_empty_ones(spark, tmp_path):
    bodies = spark.createDataFrame([("a", " ")], "log_id string, body string")
    listed = pages(spark, {"data": [{"id": "a"}, {"id": "b"}]})
    run = ps.export_logs(ExportConfig("w", "E"), listed, bodies, out_path=str(tmp_path))
    assert [(r.kind, r.warning) for r in run.warnings.collect()] == [
        ("empty_body", "Downloaded log id a was empty"), ("absent_body", "Body of log id b has not landed"),
    ]
    counts = run.manifest.first()
    assert (counts.log_files_listed, counts.log_files_downloaded, counts.warning_count) == (2, 1, 2)


def test_an_export_takes_what_was_asked_for(spark, tmp_path):
    answers = [("E", "2026-05-02T00:00:00Z", "a"), ("E", "2026-04-01T00:00:00Z", "b"), ("F", "2026-05-02T00:00:00Z", "c")]
    responses = spark.createDataFrame(
        [(n, json.dumps({"data": [{"id": log}], "last_end_time": end}), kind, end) for n, (kind, end, log) in enumerate(answers)],
        "page_no long, page_json string, event_type string, end_time string",
    )
    bodies = spark.createDataFrame([(x, '{"role":"user","content":"hi"}') for x in "abc"], "log_id string, body string")
    run = ps.export_logs(ExportConfig("w", "E", after="2026-05-01T00:00:00Z"), responses, bodies, out_path=str(tmp_path))
    assert [r.log_id for r in run.records.collect()] == ["a"]


def test_prompts_keep_their_json_content(spark, tmp_path):
    content = {"parts": [{"image": 1}, "text"]}
    body = json.dumps([{"role": "user", "content": content}, {"role": "user", "content": "5"}, {"role": "user", "content": 5}])
    bodies = spark.createDataFrame([("l", body)], "log_id string, body string")
    ps.export_logs(ExportConfig("w", "E", after="2026-01-01T00:00:00Z"), pages(spark, {"data": [{"id": "l"}]}), bodies, out_path=str(tmp_path))
    assert [p["content"] for p in read_json(f"{tmp_path}/prompts")] == [content["parts"], "5", 5]
    manifest = read_json(f"{tmp_path}/manifest")[0]
    assert manifest["days"] is None and manifest["completed_through"] == "2026-01-01T00:00:00Z"


@pytest.mark.parametrize("response, message", [
    ({"data": {"id": 1}, "has_more": False}, "must be a list"),
    ({"data": "x"}, "must be a list"),
    ({"data": [], "has_more": True, "last_end_time": ""}, "no last_end_time"),
])
def test_listing_contract(spark, response, message):
    with pytest.raises(Exception, match=message):
        listing.read_pages(pages(spark, response)).collect()


def test_listing_without_data(spark):
    got = listing.read_pages(pages(spark, {"data": None}, {"has_more": 0}, {"data": []}))
    assert listing.entries(got).count() == 0
    with pytest.raises(Exception, match="after its last"):
        listing.cursor(got, "A").collect()


def test_config_contract():
    for bad in ({"principal_id": ""}, {"event_type": ""}, {"days": 0}, {"limit": 0}):
        with pytest.raises(ValueError):
            ExportConfig(**{"principal_id": "p", "event_type": "e", **bad})
    assert listing.isoformat_utc(datetime(2026, 5, 7, 12, 30, 5, 999, tzinfo=timezone.utc)) == "2026-05-07T12:30:05Z"
    assert listing.isoformat_utc(datetime(2026, 5, 7, 2, tzinfo=timezone(timedelta(hours=3)))) == "2026-05-06T23:00:00Z"


def test_listed_after_reaches_the_scan(spark, tmp_path):
    rows = [("a", "E", "2026-01-01"), ("b", "E", "2026-01-02"), ("c", "F", "2026-01-03")]
    spark.createDataFrame(rows, "id string, event_type string, end_time string").write.parquet(str(tmp_path / "l"))
    past = listing.listed_after(spark.read.parquet(str(tmp_path / "l")), "E", "2026-01-01")
    assert [r.id for r in past.collect()] == ["b"]
    plan = past._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,E)" in plan and "GreaterThan(end_time," in plan


def test_review_has_no_shuffle_and_no_python(spark, input_dir):
    reviewed = ps.review_lines(numbered_lines(spark, input_dir).hint("broadcast"))
    plan = reviewed._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "SortMergeJoin" not in plan and "CartesianProduct" not in plan


def test_long_escaped_strings(spark):
    text = "line\n" * 100_000
    record = {"role": "user", "content": {"other": text, "id": 1}}
    df = spark.createDataFrame([(json.dumps(record, separators=(",", ":")),)], "record_json string")
    row = ps.prompt_rows(ps.extract_prompts(df)).select(ps.prompt_text().alias("t")).collect()[0]
    assert row.t == model.prompts(record)[0]["prompt"]

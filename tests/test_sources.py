"""Sources, task spaces, folds, artifacts and streams on small inputs of their own."""

from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from quillon.operators import rollout, tasks
from quillon.sources import artifacts, files, keyed, records, states
from quillon.streaming.requests import ingest, usage_windows


def saved(tmp_path, name, value):
    path = tmp_path / f"{name}.json"
    path.write_text(json.dumps(value))
    return str(path)


def test_contacts_are_trimmed_and_checked(spark, tmp_path):
    good = {"contacts": [{"name": f" Person {k} ", "email": f"p{k}@x.test"} for k in range(10)]}
    contacts, followups = records.read_contacts(spark, saved(tmp_path, "good", good))
    assert contacts.where("name = 'Person 3'").count() == 1 and followups.count() == 0
    assert tasks.contact_slots(contacts, followups).count() == 80
    for name, change in {
        "twice": {"contacts": [{"name": "a", "email": "b"}, {"name": "a ", "email": "c"}]},
        "blank": {"contacts": [{"name": " ", "email": "b"}]},
        "none": {"contacts": []},
        "stranger": good | {"followups": [{"name": "x", "note": "a note"}]},
        "note": good | {"followups": [{"name": "Person 1", "note": "no\nbreaks"}]},
    }.items():
        with pytest.raises(records.SourceError):
            records.read_contacts(spark, saved(tmp_path, name, change))


def test_message_slots(spark, tmp_path):
    bodies = ["Please look at the budget", "Could you check the design notes", "Is the launch checklist done?", "The invoice is here", "Ask the vendor today", "A plan for Monday", "Release on Friday?", "Training notes"]
    source = {"messages": [{"message_id": f"m{k}", "sender": "s", "body": b} for k, b in enumerate(bodies)]}
    messages, reminders, drafts = records.read_messages(spark, saved(tmp_path, "m", source))
    assert tasks.message_slots(messages, reminders, drafts).count() == 96
    more = source | {"reminders": [{"message_id": "m0", "reminder_text": "x", "remind_at": "y"}], "drafts": [{"message_id": "m1", "content": "Thanks for it"}]}
    assert tasks.message_slots(*records.read_messages(spark, saved(tmp_path, "n", more))).count() == 96 - 4 - 5
    doubled = {"messages": [*source["messages"], {"message_id": "m9", "sender": "s", "body": "About the INVOICE again"}]}
    assert tasks.message_slots(*records.read_messages(spark, saved(tmp_path, "d", doubled))).count() == 7 * 12
    with pytest.raises(records.SourceError):
        records.read_messages(spark, saved(tmp_path, "x", source | {"drafts": [{"message_id": "m0", "content": "rude"}]}))


def test_workspace_slots(spark, tmp_path):
    n = 12
    source = {
        "projects": [{"project_id": f"p{k:02}", "name": f"Project {k}"} for k in range(n)], "tasks": [{"task_id": f"t{k:02}", "project_id": f"p{k:02}", "title": f"Prepare plan {k}"} for k in range(n)],
        "documents": [{"document_id": f"d{k:02}", "project_id": f"p{k:02}", "title": f"Brief {k}"} for k in range(n)], "comments": [],
    }
    items = records.read_workspace(spark, saved(tmp_path, "w", source))
    assert items.where("kind = 'task' and item_id = 't03'").first()["query"] == "plan 3"
    slots = tasks.workspace_slots(items, True).collect()
    assert len(slots) == 97 and [s["spec"] for s in slots[:9]] == [s[0] for s in tasks.WORKSPACE_SPECS]
    one = {s["spec"]: s["item_id"] for s in tasks.workspace_slots(items, False).collect()}
    assert len(one) == 9 and one["search-missing"] is None and one["comment-recovery"] == "t02" and one["task-verified"] == "p01"
    few = records.read_workspace(spark, saved(tmp_path, "f", {"projects": [{"project_id": "p", "name": "Only"}]}))
    assert {s["spec"]: s["item_id"] for s in tasks.workspace_slots(few, False).collect()} == {"search-direct": "p", "search-directory": "p", "search-recovery": "p", "search-missing": None, "task-direct": "p", "task-verified": "p"}
    with pytest.raises(records.SourceError):
        records.read_workspace(spark, saved(tmp_path, "y", source | {"comments": [{"comment_id": "c", "task_id": "none", "body": "x"}]}))


CASE = "action string, route string, target string, note_constraint string, exact_note string"


def rolled(spark, steps, route="direct", action="record_followup", constraint="open", note=None, existing=None):
    frame = spark.createDataFrame([(action, route, "Ann", constraint, note, [(t, a, None) for t, a in steps], {"Ann": "a@x", "Bob": "b@x"}, existing)], f"{CASE}, actions {rollout.ACTIONS}, contacts map<string,string>, existing map<string,string>")
    row = rollout.rolled_out(frame, rollout.contact_state(F.col("actions"), F.col("contacts"), F.col("existing"))).first()
    return [r["error_code"] or r["event_type"] for r in row["state"]["results"]], row["mutation_authorization"]


def test_contact_tools(spark):
    look, stale, listed = ("lookup_contact", {"name": "Ann"}), ("lookup_contact", {"name": "Ann (stale)"}), ("list_contacts", {})
    record, read = ("record_followup", {"name": "Ann", "note": "call back"}), ("get_followup", {"name": "Ann"})
    assert rolled(spark, [record, ("lookup_contact", {"name": "Cy"}), look, listed, record, record, read, ("dance", {})]) == (["mutation_condition_not_observed", "contact_not_found", "observation", "observation", "state_change", "unintended_state_change", "observation", "unknown_tool"], "rejected")
    assert rolled(spark, [listed, look, record], "directory") == (["observation", "observation", "state_change"], "authorized")
    assert rolled(spark, [look, listed, record], "directory")[0][-1] == rolled(spark, [listed, look, record], "recovery")[0][-1] == "mutation_condition_not_observed"
    assert rolled(spark, [stale, listed, look, record], "recovery")[0][-1] == "state_change"
    assert rolled(spark, [look, ("record_followup", {"name": "Ann", "note": " x "})])[0][-1] == "unsupported_note"
    assert rolled(spark, [look, record], constraint="exact", note="other note")[0][-1] == "note_not_authorized"
    assert rolled(spark, [look, record, read], existing={"name": "Ann", "note": "old"})[0][1:] == ["unintended_state_change", "observation"]
    assert rolled(spark, [look, ("record_followup", {"name": "Bob", "note": "call back"})])[0][-1] == rolled(spark, [look, record], action="lookup_email")[0][-1] == "mutation_not_authorized"
    assert rolled(spark, [look], action="lookup_email") == (["observation"], "not_applicable")


def test_tools_read_what_others_have(spark):
    """Followups, reminders and drafts of other entities than the target are told, and never the target's from before as others'."""
    texts = "map<string,string>"
    calls = [("get_followup", {"name": "Bob"}), ("get_followup", {"name": "Cy"}), ("get_followup", {"name": "Ann"}), ("get_followup", {})]
    frame = spark.createDataFrame([("lookup_email", "direct", "Ann", "none", None, [(t, a, None) for t, a in calls], {"Ann": "a", "Bob": "b", "Cy": "c"}, {"Bob": "later", "Ann": "stray"})], f"{CASE}, actions {rollout.ACTIONS}, contacts {texts}, followups {texts}")
    step = rollout.contact_step(F.col("contacts"), F.col("followups"))
    got = frame.select(rollout.folded(F.col("actions"), F.lit(None).cast(texts), step).alias("s")).first()["s"]["results"]
    assert [r["payload"] or r["error_code"] for r in got] == [{"name": "Bob", "note": "later"}, *["followup_not_found"] * 3]
    calls = [("get_reminder", {"message_id": "m2"}), ("get_reminder", {"message_id": "m1"}), ("get_draft_reply", {"message_id": "m2"}), ("get_draft_reply", {"message_id": "m3"})]
    frame = spark.createDataFrame([("search_messages", "direct", "m1", "q", None, None, "none", None, [(t, a, None) for t, a in calls], {"m2": {"message_id": "m2", "reminder_text": "r"}}, {"m3": {"message_id": "m3", "content": "c"}})], f"action string, route string, message_id string, query string, reminder_text string, remind_at string, reply_constraint string, exact_reply string, actions {rollout.ACTIONS}, reminders map<string,{texts}>, drafts map<string,{texts}>")
    none = F.lit(None).cast(texts)
    step = rollout.message_step(F.lit("[]"), none, none, F.col("reminders"), F.col("drafts"))
    got = frame.select(rollout.folded(F.col("actions"), none, step).alias("s")).first()["s"]["results"]
    assert [r["payload"] or r["error_code"] for r in got] == [{"message_id": "m2", "reminder_text": "r"}, "reminder_not_found", "draft_not_found", {"message_id": "m3", "content": "c"}]


def test_messages_are_found_once(spark):
    notes = spark.createDataFrame([("a", "s", "The Budget of May is here"), ("b", "s", "the budget of june"), ("c", "s", "nothing at all")], "message_id string, sender string, body string")
    asked = spark.createDataFrame([("1", "budget of may"), ("2", "the budget of"), ("3", "not in any text")], "query_id string, query string")
    got = {r["query_id"]: r["found"] for r in rollout.searched(asked, notes).collect()}
    assert got["1"]["message_id"] == "a" and got["2"] is None and got["3"] is None


def test_artifacts_and_manifest(spark, tmp_path):
    rows = spark.createDataFrame([(k, "demonstrations" if k % 2 else "negatives", None) for k in range(9)], "sequence int, collection string, reason string")
    folder = str(tmp_path / "run")
    artifacts.write_collections(rows, folder)
    assert spark.read.json(f"{folder}/collection=negatives").count() == 5
    (tmp_path / "run" / ".private").mkdir()
    (tmp_path / "run" / ".private" / "x").write_text("secret")
    (tmp_path / "run" / "report.json").write_text("{}")
    got = {r["path"]: (r["sha256"], r["byte_count"]) for r in files.manifest(spark, folder).collect()}
    assert got["report.json"] == (hashlib.sha256(b"{}").hexdigest(), 2) and not any("private" in p for p in got)
    artifacts.write_lines(rows, str(tmp_path / "lines"), "sequence")
    assert spark.read.text(str(tmp_path / "lines")).where(F.col("value").contains('"reason":null')).count() == 9


def test_record_files(spark, tmp_path):
    event = {"event_type": "final_response", "content": "done"}
    good = {"episode_id": "e1", "sequence": 1, "events": [event], "outcome": {"collection": "negatives"}}
    assert records.read_episodes(spark, saved(tmp_path, "e", good)).count() == 1
    with pytest.raises(records.SourceError):
        records.read_episodes(spark, saved(tmp_path, "b", good | {"events": [{"event_type": "final_response"}]}))
    request = records.read_requests(spark, saved(tmp_path, "r", {"request_id": 1, "sequence": 4, "related_sequences": [4, 5]})).first()
    assert request["sequences"] == [4, 5]
    label = {"episode_id": "e1", "cohort_id": "c", "dimensions": []}
    assert records.read_labels(spark, saved(tmp_path, "l", label)).count() == 1
    path = saved(tmp_path, "s", {"a": 1})
    digest = "sha256:" + hashlib.sha256(open(path, "rb").read()).hexdigest()
    assert records.read_snapshot(spark, path, digest).count() == 1
    with pytest.raises(records.SourceError):
        records.read_snapshot(spark, path, "sha256:0")


def refused(read, *arguments):
    with pytest.raises(records.SourceError):
        read(*arguments)


def test_episode_files_are_strict(spark, tmp_path):
    lines = lambda *rows: str((tmp_path / f"{len(list(tmp_path.iterdir()))}.jsonl").write_text("\n".join(rows)) and max(tmp_path.iterdir(), key=lambda p: int(p.stem)))
    row = lambda k, *events: json.dumps({"episode_id": f"e{k}", "sequence": k, "events": list(events)})
    got = records.read_episodes(spark, lines(row(2), row(1, {"event_type": "error", "error_code": "x_y"})))
    assert [r["sequence"] for r in got.collect()] == [1, 2]
    refused(records.read_episodes, spark, lines(row(1), "{broken"))
    for event in ({"event_type": "dance"}, {"event_type": "action", "content": "x"}, {"event_type": "error"}, {"event_type": "error", "error_code": "Not A Code"}):
        refused(records.read_episodes, spark, lines(row(1, event)))


def test_cohorts_responses_and_configuration(spark, tmp_path):
    cohort = {"schema_version": "agent_review_cohort_v1", "cohort_id": "c1", "purpose": "held-out-evaluation", "episode_ids": ["a", "b"], "nonpass_or_unavailable_count": 0, "stratified_pass_count": 2}
    path = lambda name, *rows: str((tmp_path / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows)) and tmp_path / name)
    assert records.read_cohorts(spark, path("c", cohort, cohort | {"cohort_id": "c2", "episode_ids": ["x", "y"]})).count() == 2
    refused(records.read_cohorts, spark, path("d", cohort, cohort | {"cohort_id": "c2"}))
    refused(records.read_cohorts, spark, path("e", cohort | {"stratified_pass_count": 1}))
    got = records.read_responses(spark, path("r", {"a": 1}, "", {"b": 2}, "  ")).collect()
    assert [(r["position"], r["content"]) for r in got] == [(0, '{"a": 1}'), (1, '{"b": 2}')]
    refused(records.read_responses, spark, path("s", {"a": 1}, "[1]"))
    run = {"run_id": "r1", "domain_id": "contacts", "model_id": "m1", "slot_limit": 10, "accepted_target": 8}
    assert records.read_configuration(spark, path("f", run)).first().asDict()["generation_batch_size"] == 8
    for change in ({"slot_limit": 0}, {"accepted_target": 11}, {"run_id": "Bad Id"}, {"max_concurrency": 99}, {"timeout_seconds": 0.0}):
        refused(records.read_configuration, spark, path("g", run | change))


def test_lookups_scans_and_resumption(spark):
    table = spark.createDataFrame([(k, "pending" if k % 2 else "running") for k in range(10)], "sequence int, status string")
    assert [r["sequence"] for r in records.with_status(table, "running", 2).collect()] == [0, 2]
    assert records.looked_up(table, table.where("sequence < 3"), "sequence").count() == 3
    with pytest.raises(Exception, match="no such row: 99"):
        records.looked_up(table, spark.createDataFrame([(99,)], "sequence int"), "sequence").collect()
    digest = "sha256:" + hashlib.sha256(b"{}").hexdigest()
    frame = lambda *row: spark.createDataFrame([row], "configuration string, domain_version string, fingerprint string")
    now, state = spark.createDataFrame([("c", "v")], "configuration string, domain_version string"), spark.createDataFrame([("{}", digest)], "contents string, fingerprint string")
    assert [records.resumable(frame(*row), now, state).first()["reason"] for row in (("c", "v", digest), ("d", "v", digest), ("c", "w", digest), ("c", "v", "sha256:0"))] == [None, "configuration_changed", "domain_version_changed", "frozen_state_changed"]


def test_fixtures_have_their_capacities(spark):
    held = records.fixtures(spark)
    assert tasks.contact_slots(held["contacts"], held["followups"]).count() == 16 and tasks.message_slots(held["messages"], held["reminders"], held["drafts"]).count() == 24
    assert tasks.workspace_slots(held["items"], False).count() == 9
    one = spark.createDataFrame([("Ben Carter", "a note")], "name string, note string")
    assert tasks.contact_slots(held["contacts"], one).count() == 11


def test_streams(spark, tmp_path):
    rows = spark.createDataFrame([(1, "agent", "failed", "2024-01-01 01:00:00"), (1, "agent", "failed", "2024-01-01 01:00:00"), (2, "agent", "completed", "2024-01-01 02:00:00"), (3, "agent", "completed", "2024-01-03 02:00:00")], "request_id long, role string, status string, ts string").withColumn("ts", F.to_timestamp("ts"))
    source = str(tmp_path / "in")
    rows.write.parquet(source)
    stream = lambda: spark.readStream.schema(rows.schema).parquet(source)
    counted = usage_windows(stream()).writeStream.outputMode("complete").format("memory").queryName("usage_windows").trigger(availableNow=True).start()
    counted.awaitTermination(60)
    assert {(str(r["window"]["start"])[:10], r["request_count"], r["failed_count"]) for r in spark.table("usage_windows").collect()} == {("2024-01-01", 2, 1), ("2024-01-03", 1, 0)}
    ingest(stream(), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(60)
    ingest(stream(), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_digests_stream_files_of_any_size(spark, tmp_path):
    """A sparse file beyond what one value can hold."""
    size = (1 << 31) + 12_345
    with open(tmp_path / "large", "wb") as out:
        out.truncate(size)
        out.seek(size - 3)
        out.write(b"end")
    want, block = hashlib.sha256(), bytes(1 << 20)
    left = size - 3
    while left:
        want.update(block[: min(left, len(block))])
        left -= min(left, len(block))
    want.update(b"end")
    (tmp_path / "small name é.txt").write_bytes(b"x")
    got = {r["path"]: (r["sha256"], r["byte_count"]) for r in files.manifest(spark, str(tmp_path)).collect()}
    assert got == {"large": (want.hexdigest(), size), "small name é.txt": (hashlib.sha256(b"x").hexdigest(), 1)}
    assert records.read_snapshot(spark, str(tmp_path / "large"), "sha256:" + want.hexdigest()).first()["byte_count"] == size


def test_lines_keep_their_order_over_blocks_and_files(spark, tmp_path):
    want = []
    for name in ("a", "b", "c"):
        lines = [f"{name}{k} " + "x" * (k % 97) if k % 5 else " \t" for k in range(3000)]
        (tmp_path / name).write_text("\n".join(lines))
        want += [x for x in lines if x.strip()]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        rows = files.numbered_lines(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 3
        assert [r["content"] for r in sorted(rows.collect(), key=lambda r: r["position"])] == want and {r["position"] for r in rows.collect()} == set(range(len(want)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert files.numbered_lines(spark, str(tmp_path / "a"), str(tmp_path / "c")).count() == 4800


def test_states_of_three_domains(spark, tmp_path):
    """Fingerprints are those of the state as one JSON object; relations come back as they were."""
    people = [(f"Né {k:03}", f"n{k}@x.test") for k in range(300)]
    told = {
        "contacts": {"contacts": ("name string, email string", people), "followups": ("name string, note string", [("Né 007", 'a "note"\n')])},
        "mobile_messages": {"messages": ("message_id string, sender string, body string", [("m2", "s", "b"), ("m1", "t", "ü")]), "drafts": ("message_id string, content string", [("m1", "Thanks")])},
        "workspace_tasks": {"items": ("item_id string, kind string, summary string, project_id string, query string", [("p", "project", "P", None, "p"), ("d", "document", "D", "p", "d")])},
    }
    for domain, relations in told.items():
        frames = {n: spark.createDataFrame(rows, schema).repartition(4) for n, (schema, rows) in relations.items()}
        folder = str(tmp_path / domain)
        got = states.freeze(spark, domain, frames, folder).first()
        fields = {n: [f.split()[0] for f in schema.split(", ")] for n, (schema, _) in relations.items()}
        whole = {n: sorted((dict(zip(fields[n], r, strict=True)) for r in relations[n][1]), key=lambda r: r[states.SECTIONS[n][0]]) if n in relations else [] for n in states.DOMAINS[domain]}
        text = json.dumps(whole, sort_keys=True, separators=(",", ":")).encode()
        assert (got["fingerprint"], got["byte_count"]) == ("sha256:" + hashlib.sha256(text).hexdigest(), len(text))
        back = states.thaw(spark, domain, folder)
        assert {n: sorted((r.asDict() for r in f.collect()), key=str) for n, f in back.items()} == {n: sorted(rows, key=lambda r: str({c: r[c] for c in states.SECTIONS[n]})) for n, rows in whole.items()}


def test_rows_are_replaced_by_key(spark, tmp_path):
    path, rows = str(tmp_path / "t"), lambda *r: spark.createDataFrame(list(r), "id int, status string")
    held = lambda: {r["id"]: r["status"] for r in keyed.read_keyed(spark, path).collect()}
    assert keyed.read_keyed(spark, path) is None
    assert keyed.upsert(rows((1, "a"), (2, "b")), path, "id") == 1 and keyed.upsert(rows((2, "c"), (3, "d")), path, "id") == 2 and held() == {1: "a", 2: "c", 3: "d"}
    assert keyed.insert_missing(rows((3, "z"), (4, "e"), (4, "e")), path, "id") == 3 and keyed.insert_missing(rows((4, "z")), path, "id") == 4 and held() == {1: "a", 2: "c", 3: "d", 4: "e"}
    keyed.with_status(spark, path, rows((1, "done"), (9, "x")), "id")
    keyed.delete(rows((2, None)), path, "id")
    assert held() == {1: "done", 3: "d", 4: "e"} and keyed.read_keyed(spark, path).count() == 3
    with pytest.raises(ValueError, match="repeats"):
        keyed.upsert(rows((1, "a"), (1, "b")), path, "id")
    with pytest.raises(ValueError, match="no such table"):
        keyed.delete(rows((1, None)), str(tmp_path / "none"), "id")


def test_a_second_writer_begins_again(spark, tmp_path):
    """Another writer's version comes between reading and claiming; neither change is lost."""
    path, rows = str(tmp_path / "t"), lambda *r: spark.createDataFrame(list(r), "id int, status string")
    keyed.upsert(rows((1, "a")), path, "id")
    calls = []

    def slow(held):
        calls.append(held.count())
        if len(calls) == 1:
            keyed.upsert(rows((2, "other")), path, "id")
        return held.unionByName(rows((3, "mine")))

    assert keyed.changed(spark, path, slow) == 3 and calls == [1, 2]
    assert {r["id"] for r in keyed.read_keyed(spark, path).collect()} == {1, 2, 3}
    (tmp_path / "t" / "_versions" / f"{4:012d}").write_text("")
    with pytest.raises(RuntimeError, match="writer was lost"):
        keyed._newest(spark, path, tries=2)


def test_case_folding_is_unicodes(spark):
    """Every code point, alone and between letters."""
    import sys

    from quillon.functions.canon import casefold

    points = [chr(k) for k in range(1, sys.maxunicode + 1) if not 0xD800 <= k < 0xE000]
    texts = points[:0x3000] + ["a" + "".join(points[k : k + 50]) + "Z" for k in range(0x3000, len(points), 50)] + ["", "ABC", "Straße ﬀ İ ŉ ΐ"]
    got = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", casefold(F.col("t")).alias("f")).collect()
    assert all(r["f"] == texts[r["k"]].casefold() for r in got)

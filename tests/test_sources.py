import json
import os
import time

import pytest
from pyspark.sql import functions as F

from stepledger.domain import DEFAULT, load
from stepledger.operators import curate, render, verify
from stepledger.sources import documents, lines, sinks
from stepledger.streaming import grading


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_json_lines(spark, tmp_path):
    path = put(tmp_path / "a.jsonl", '{"a": 1, "b": "x"}\n\n  {"a": 2} \n{"a": 3\n{"a": 4} trailing\n{"a": 5, "a": 6}\n')
    rows = lines.read_json_lines(spark, path, "a int, b string").orderBy("row_idx").collect()
    assert [r["a"] for r in rows] == [1, 2, 6]
    kept = lines.read_json_lines(spark, path, "a int", bad="keep")
    assert kept.count() == 5 and kept.where("NOT ok").count() == 2
    with pytest.raises(Exception, match="malformed line"):
        lines.read_json_lines(spark, path, "a int", bad="fail").collect()
    with pytest.raises(ValueError):
        lines.read_json_lines(spark, path, "a int", bad="what")
    assert lines.read_json_lines(spark, str(tmp_path / "none"), "a int", missing_ok=True).count() == 0
    with pytest.raises(Exception):
        lines.read_json_lines(spark, str(tmp_path / "none"), "a int").count()


def test_reports(spark, tmp_path):
    for k, (name, p) in enumerate([("b", 0.5), ("a", 0.4), ("c", 0.7)]):
        path = put(tmp_path / "r" / f"{name}.json", json.dumps({"run_name": name, "n_examples": 10, "pass_at_1": p, "pass_at_k": p, "pass_at_maj": p, "k": 8, "failure_modes": {"parse": 1}}))
        os.utime(path, (1000 + k, 1000 + k))
    put(tmp_path / "r" / "junk.json", "{")
    put(tmp_path / "r" / "list.json", "[1]")
    folder = str(tmp_path / "r")
    assert [r["run_name"] for r in lines.read_reports(spark, folder).collect()] == ["a", "b", "c"]
    assert [r["run_name"] for r in lines.read_reports(spark, folder, "?.json", 2).collect()] == ["a", "c"]
    assert lines.read_reports(spark, str(tmp_path / "empty")).count() == 0
    out = render.comparison(lines.read_reports(spark, folder), "b")
    assert "| a | 10 | **0.400** | -0.100 |" in out and "(base)" in out and "parse             ████████████████████ 3" in out
    assert render.comparison(lines.read_reports(spark, str(tmp_path / "empty"))) == "no reports found\n"


def test_responses_resume_and_digests(spark, tmp_path):
    body = {"choices": [{"message": {"content": "hello"}}]}
    put(tmp_path / "s" / "t-1" / "step-0.think.response.json", json.dumps(body))
    put(tmp_path / "s" / "t-1" / "step-0.call.response.json", json.dumps({"choices": [{"text": "{}"}]}))
    put(tmp_path / "s" / "t-1" / "step-1.think.response.json", json.dumps(body))
    put(tmp_path / "s" / "t-1" / "notes.json", "{}")
    rows = lines.read_responses(spark, str(tmp_path / "s")).orderBy("step_idx").collect()
    assert [tuple(r) for r in rows] == [("t-1", 0, "hello", "{}"), ("t-1", 1, "hello", None)]
    path = put(tmp_path / "p.jsonl", '{"trajectory_id":"a","v":1}\n{"trajectory_id":"a","v":2}\nbad\n{"v":3}\n')
    assert [tuple(r) for r in lines.read_resume(spark, path).collect()] == [("a", '{"trajectory_id":"a","v":2}')]
    assert lines.file_digests(spark, path).count() == 1 and lines.file_digests(spark, str(tmp_path / "no")).count() == 0
    assert lines.safe_component("a.b-c_1") and not lines.safe_component("..") and not lines.safe_component("a/b")


SEED = {"trajectory_id": "s", "initial_state": "NEW", "steps": [{"thinking": "a", "tool_call": {"method": "ticket_get"}}, {"thinking": "b", "tool_call": {"method": "ticket_status"}}, {"thinking": "c"}]}


def test_seeds(spark, tmp_path):
    import yaml

    path = put(tmp_path / "seeds.yaml", yaml.safe_dump({"version": "1", "seeds": [SEED]}))
    (seed,) = documents.read_seeds(path, DEFAULT)
    assert seed["source"] == "hand_seed" and "prior_calls" not in seed["steps"][0]["prompt_context"]
    assert [c["method"] for c in seed["steps"][2]["prompt_context"]["prior_calls"]] == ["ticket_get", "ticket_status"]
    assert documents.seed_lines(spark, [seed]).count() == 1
    for change in ({"initial_state": "LOST"}, {"steps": {}}, {"steps": [{"tool_call": {"method": "ticket_get"}, "expected_trigger": "x"}]}):
        with pytest.raises(ValueError):
            documents.read_seeds(put(tmp_path / "bad.yaml", yaml.safe_dump({"seeds": [SEED | change]})), DEFAULT)
    for bad in ([1], [{"trajectory_id": "x"}], [{"trajectory_id": "x", "initial_state": "NEW"}]):
        with pytest.raises(ValueError):
            documents.read_seeds(put(tmp_path / "bad.yaml", yaml.safe_dump({"seeds": bad})))
    assert documents.read_seeds(put(tmp_path / "none.yaml", "")) == []


def test_config_and_sweep(tmp_path):
    put(tmp_path / "base.yaml", "a: {x: 1, y: [1, 2]}\nb: 2\n")
    path = put(tmp_path / "mid.yaml", "extends: base.yaml\na: {y: [3]}\n")
    assert documents.read_config(path) == {"a": {"x": 1, "y": [3]}, "b": 2}
    put(tmp_path / "c1.yaml", "extends: c2.yaml\n")
    with pytest.raises(ValueError, match="extend each other"):
        documents.read_config(put(tmp_path / "c2.yaml", "extends: c1.yaml\n"))
    out = documents.sweep({"base": "b.yaml", "axes": {"lora.r": [8, 16], "seed": ["a b", 2]}})
    assert [n for n, _ in out] == ["lora.r=8,seed=a%20b", "lora.r=8,seed=2", "lora.r=16,seed=a%20b", "lora.r=16,seed=2"]
    assert out[0][1] == {"extends": "b.yaml", "lora": {"r": 8}, "seed": "a b"}
    for flat in ({"a": 1, "a.b": 2}, {"a.b": 2, "a": 1}):
        with pytest.raises(ValueError, match="both a value"):
            documents.nested(flat)
    for spec in ({}, {"base": "b"}, {"base": "b", "axes": []}):
        with pytest.raises(ValueError):
            documents.sweep(spec)
    assert documents.merged({"a": {"b": 1, "c": {}}, "d": 2}, {"a": {"b": {"x": 1}, "c": {}}, "d": {}, "e": {}}) == {"a": {"b": {"x": 1}, "c": {}}, "d": {}, "e": {}}
    assert documents.merged({"a": {"b": 1}}, {"a": {}}) == {"a": {"b": 1}} and documents.merged({"a": {"b": 1}}, {"a": None}) == {"a": None} and documents.merged({"a": 1}, {"a": {"b": {"c": 2}}}) == {"a": {"b": {"c": 2}}}
    assert documents.unknown_keys({"a": {"b": 1, "c": 2}, "d": 3}, ["a.b", "e"]) == ["a.c", "d"]
    assert json.loads(documents.yaml_to_json("a: [1, yes, null]")) == {"a": [1, True, None]}


def test_domain_from_files(tmp_path):
    import yaml

    put(tmp_path / "state-machine.yaml", yaml.safe_dump({"states": list(DEFAULT.states), "initial_state": "NEW", "terminal_states": ["ARCHIVED"], "transitions": [{"from": a, "trigger": t, "to": b} for (a, t), b in DEFAULT.arcs.items()], "method_triggers": {m: list(t) for m, t in DEFAULT.triggers.items()}}))
    put(tmp_path / "jsonrpc-methods.json", json.dumps({"methods": {m: {"params": s} for m, s in DEFAULT.params.items()}}))
    put(tmp_path / "reward-rubric.yaml", yaml.safe_dump({"presets": DEFAULT.presets, "aggregation": "mean"}))
    assert load(tmp_path) == DEFAULT
    put(tmp_path / "reg" / "a.json", '{"$id": "http://x/a", "type": "integer"}')
    put(tmp_path / "reg" / "b.json", "true")
    assert documents.read_registry(tmp_path / "reg") == {"http://x/a": {"$id": "http://x/a", "type": "integer"}, "b.json": True}


def test_writers(spark, tmp_path):
    rows = spark.createDataFrame([(f"v{i}", s) for i, s in enumerate(["train", "train", "dev", "rest"])], "value string, split string")
    folder = str(tmp_path / "out")
    assert sinks.write_splits(rows, folder) == []
    assert sinks.write_splits(rows, folder) == ["train", "dev", "test"]
    assert sorted(r[0] for r in spark.read.text(f"{folder}/train").collect()) == ["v0", "v1"]
    sinks.append_log(rows.limit(1), str(tmp_path / "log"))
    sinks.append_log(rows.limit(1), str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 2


def test_data_set_with_seeds_and_partial_log(spark, tmp_path):
    rows = spark.createDataFrame([("a", "train"), ("b", "dev"), ("c", "rest"), ("d", "train")], "value string, split string")
    seeds = spark.createDataFrame([("s1",), ("s2",)], "value string")
    partial, folder = str(tmp_path / "partial"), str(tmp_path / "set")
    sinks.append_partial(rows.limit(1), partial)
    assert sinks.write_data_set(rows, seeds, folder, partial) == [] and not (tmp_path / "partial").exists()
    assert [sorted(r[0] for r in spark.read.text(f"{folder}/{n}").collect()) for n in ("train", "dev", "test")] == [["a", "d"], ["b"], ["s1", "s2"]]
    assert sinks.write_data_set(rows, seeds, folder) == ["train", "dev", "test"]


def test_runs_open_with_a_marker_that_is_no_rejection(spark, tmp_path):
    from stepledger.operators import rejects

    path = str(tmp_path / "log")
    sinks.start_run(spark, path, "2024-01-01T00:00:00.000000Z", 7)
    sinks.append_log(spark.createDataFrame([("json_decode", "s")], "reason string, seed_id string"), path)
    log = spark.read.json(path)
    assert log.count() == 2 and [r["reason"] for r in rejects.rejections(log).collect()] == ["json_decode"]


def test_reports_as_text(spark):
    log = spark.createDataFrame([(0, "r", "s", "e"), (1, "r", "s", "f")], "row_idx long, reason string, seed_id string, error string")
    assert "- `r`: 2" in render.rejection_summary(log) and "none" in render.rejection_summary(log.limit(0))
    call = json.dumps({"jsonrpc": "2.0", "method": "ticket_get", "params": {"ticket_id": "T"}, "id": 1})
    rows = [(0, "a", 0, "NEW", None, [(None, None)], ["<think>x</think>" + call]), (1, "b", 0, "", None, [(None, None)], ["bad | one"])]
    graded = verify.verify_records(spark.createDataFrame(rows, "row_idx long, trajectory_id string, sample_idx int, initial_state string, final_state string, steps array<struct<expected_trigger:string,expected_state_after:string>>, outputs array<string>")).withColumn("final_call", F.element_at("outputs", -1))
    text = render.scorecard_markdown(graded, "run")
    assert "- pass_at_1: 0.500" in text and "| (unknown) | b | 0 | parse |" in text
    from stepledger.operators.score import scorecard

    card = json.loads(render.scorecard_json(scorecard(graded, "run")))
    assert card["n_examples"] == 2 and card["failure_modes"] == {"parse": 1}
    rules = render.grammar().splitlines()
    assert len(rules) == 13 and '"\\"ticket_open\\""' in render.grammar() and rules[2].index("admin_agent_add") < rules[2].index("ticket_status")
    frag = render.fragmentation(spark.createDataFrame([("ab",), ("c",), ("ab",)], "string string"), lambda t: [ord(c) for c in t])
    assert [(r["string"], r["token_count"], r["fragmented"]) for r in frag.collect()] == [("ab", 2, True), ("c", 1, False)]
    report = render.fragmentation_report(render.fragmentation(spark.createDataFrame([("ab",), ("c",)], "string string"), lambda t: [ord(c) for c in t], decode=chr), "letters")
    assert "- fragmented: 1 (50%, high)" in report and "| ab | 2 | a b |" in report and "single tokens: c" in report
    assert [render.fragmentation_band(x) for x in (0, 0.1, 0.3, 0.9)] == ["none", "low", "medium", "high"] and "ticket_id" in render.vocabulary_of()


def test_gold_lines_are_graded(spark):
    call = {"jsonrpc": "2.0", "method": "ticket_get", "params": {"ticket_id": "T"}, "id": 1}
    good = json.dumps({"trajectory_id": "g", "initial_state": "NEW", "steps": [{"thinking": "t", "tool_call": call, "prompt_context": {"prior_state": "NEW"}}]})
    out = curate.verify_gold(spark.createDataFrame([(good, "dev"), ("{", "dev"), ("3", "test")], "value string, split string"))
    assert {(r["split"], r["total"], r["ok"]) for r in curate.totals(out).collect()} == {("dev", 2, 1), ("test", 1, 0)}


def test_streams(spark, tmp_path):
    call = "<think>x</think>" + json.dumps({"jsonrpc": "2.0", "method": "ticket_get", "params": {"ticket_id": "T"}, "id": 1})
    schema = "ts timestamp, prior_state string, output string, expected_trigger string, expected_state_after string"
    rows = [(f"2024-01-01 0{h}:10:00", "NEW", call if h % 2 else "bad", None, None) for h in range(8)]
    frame = spark.createDataFrame(rows, "ts string, prior_state string, output string, expected_trigger string, expected_state_after string").withColumn("ts", F.to_timestamp("ts"))
    for part in range(2):
        frame.where(F.hour("ts") % 2 == part).write.mode("append").parquet(str(tmp_path / "in"))
    source = grading.read_stream(spark, str(tmp_path / "in"), schema, files_per_trigger=1)
    done = grading.write_batches(grading.graded_stream(source), str(tmp_path / "out"), str(tmp_path / "cp"))
    done.awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 8 and out.where("result.passed").count() == 4
    again = grading.write_batches(grading.graded_stream(source), str(tmp_path / "out"), str(tmp_path / "cp"))
    again.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 8
    windows = grading.windowed_means(grading.graded_stream(source), window="2 hours")
    q = windows.writeStream.format("memory").queryName(f"w{int(time.time())}").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted((r["n"], r["passed"], r["parse"]) for r in spark.table(q.name).collect()) == [(2, 1, 0.5)] * 4

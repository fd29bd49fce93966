import itertools
import json
import random

import pytest

from stepledger.domain import DEFAULT
from stepledger.operators import verify
import model

OPEN = {"requester_id": "user:alice", "body_text": "YWFhYQ==", "lifecycle_profile": "default"}


def call(method="ticket_get", params=None, version="2.0", id_=1, thought="r"):
    return f"<think>{thought}</think>" + json.dumps({"jsonrpc": version, "method": method, "params": {"ticket_id": "T-1"} if params is None else params, "id": id_}, ensure_ascii=False)


# Hand-graded cases: name, state, output, trigger, passed, six subscores.
GOLDEN = [
    ("query", "TRIAGED", call(), None, True, (1, 1, 1, 1, 1, 1)),
    ("open without a claimed trigger", "NEW", call("ticket_open", OPEN), None, False, (1, 1, 1, 1, 0, 0)),
    ("open with its trigger", "NEW", call("ticket_open", OPEN), "ticket_open.accepted", True, (1, 1, 1, 1, 1, 1)),
    ("no thought", "TRIAGED", call().split("</think>")[1], None, False, (0, 0, 0, 0, 0, 0)),
    ("no JSON", "TRIAGED", "<think>r</think>{not json}", None, False, (0, 0, 0, 0, 0, 0)),
    ("unknown method", "TRIAGED", call("ticket_zoom", {}), None, False, (1, 0, 0, 0, 0, 0)),
    ("further property", "TRIAGED", call(params={"ticket_id": "T-1", "notes": "extra"}), None, False, (1, 0, 1, 1, 1, 1)),
    ("requester without prefix", "NEW", call("ticket_open", OPEN | {"requester_id": "alice"}), "ticket_open.accepted", False, (1, 0, 1, 1, 1, 1)),
    ("short body", "NEW", call("ticket_open", OPEN | {"body_text": "a"}), "ticket_open.accepted", False, (1, 0, 1, 1, 1, 1)),
    ("wrong trigger", "ESCALATED", call("admin_escalate", {"agent_id": "n-4", "ticket_id": "T-7"}), "routing.assigned", False, (1, 1, 1, 1, 0, 0)),
    ("other version", "TRIAGED", call(version="1.0"), None, False, (0, 0, 0, 0, 0, 0)),
    ("id of another type", "TRIAGED", call(id_="string-id"), None, True, (1, 1, 1, 1, 1, 1)),
]

EDGES = [
    "", " \n", None, "<think></think>" + call().split("</think>")[1], " <think>x</think> " + call().split("</think>")[1] + " ",
    "<think>a</think>" + call(), "<think>a\nb</think>\n\n" + call().split("</think>")[1], call() + " x", call() + "]", call().replace('"id": 1', '"id": NaN'),
    call().replace('"id": 1', '"id": 1, "method": "ticket_zoom"'), call("ticket_open", OPEN | {"body_text": "łł"}), call("ticket_open", OPEN | {"body_text": "łłłł"}), call("ticket_open", OPEN | {"body_text": "😀😀😀"}), call("ticket_open", OPEN | {"body_text": "😀😀😀😀"}),
    call(None), call(5), call(["x"]), call({"a": 1}), call(params=[1]), call(params="s"), call(params=None).replace('{"ticket_id": "T-1"}', "null"), call(params={"ticket_id": ""}), call(params={"ticket_id": None}), call(params={}),
    "<think>x</think>[" + call().split("</think>")[1] + "]", "<think>x</think>" + "[" * 3000, '<think>x</think>{"jsonrpc":"2.0","method":"ticket_get","params":{"ticket_id":"\\ud800"},"id":1}',
    call("ticket_history", {"ticket_id": "a", "window": {}}), call("ticket_history", {"ticket_id": "a", "window": {"from_utc": 3}}), call("ticket_history", {"ticket_id": "a", "window": {"x/y": "z"}}), call("ticket_history", {"ticket_id": "a", "window": {"from_utc": "2024"}}),
    call("ticket_open", OPEN | {"a/b": 1}), call("ticket_open", OPEN | {"requester_id": "x\nuser:b"}), call("ticket_open", OPEN | {"requester_id": "user:"}), call("resolution_confirm", {"review_id": "r", "resolution_notes": {"deep": {"er": [1]}}}), call("resolution_confirm", {"review_id": "r", "resolution_notes": []}),
]


def outcome(r):
    return r["passed"], tuple(r[n] for n in model.NAMES), r["new_state"]


def test_golden_cases(spark):
    rows = [(n, s, o, t, None) for n, s, o, t, _, _ in GOLDEN]
    frame = spark.createDataFrame(rows, "name string, prior_state string, output string, expected_trigger string, expected_state_after string")
    got = {r["name"]: r["result"] for r in verify.verify_steps(frame).collect()}
    for name, _, _, _, passed, subs in GOLDEN:
        assert got[name]["passed"] == passed, name
        assert tuple(got[name][s] for s in model.NAMES) == subs, name
        assert (got[name]["error_message"] is None) == passed, name


@pytest.mark.parametrize("infer", [False, True])
def test_every_state_method_and_trigger(spark, infer):
    params = {"ticket_open": OPEN, "ticket_reopen": {"ticket_id": "a", "reopen_reason": "b"}, "resolution_confirm": {"review_id": "a", "resolution_notes": {}}, "ticket_history": {"ticket_id": "a", "window": {}}, "admin_agent_add": {"agent_profile": {}}, "admin_escalate": {"agent_id": "a", "ticket_id": "b"}, "admin_lifecycle_apply": {"lifecycle_profile": "x"}}
    triggers = sorted({t for _, t in DEFAULT.arcs}) + [None, "", "nothing"]
    rows = []
    for state, method, trigger in itertools.product([*DEFAULT.states, "LOST", None], DEFAULT.methods, triggers):
        for after in (None, "", "RESOLVED", "ARCHIVED"):
            rows.append((len(rows), state, call(method, params.get(method)), trigger, after))
    frame = spark.createDataFrame(rows, "i int, prior_state string, output string, expected_trigger string, expected_state_after string")
    got = {r["i"]: outcome(r["result"]) for r in verify.verify_steps(frame, infer=infer).collect()}
    for i, state, output, trigger, after in rows:
        assert got[i] == model.step(output, state, trigger, after, infer), (state, output, trigger, after)


def test_edges(spark):
    rows = [(i, s, o, t, None) for i, (o, (s, t)) in enumerate(itertools.product(EDGES, [("NEW", "ticket_open.accepted"), ("REOPENED", "resolution_confirm.failed"), (None, None)]))]
    frame = spark.createDataFrame(rows, "i int, prior_state string, output string, expected_trigger string, expected_state_after string")
    got = {r["i"]: r["result"] for r in verify.verify_steps(frame).collect()}
    for i, s, o, t, a in rows:
        assert outcome(got[i]) == model.step(o, s, t, a), (o, s)
        if got[i]["parse"] == 0:
            assert all(got[i][n] == 0 for n in model.NAMES) and got[i]["new_state"] is None
        assert got[i]["passed"] == all(got[i][n] == 1 for n in model.NAMES)


def random_records(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        k = rng.randint(0, 6)
        walk = rng.random() < 0.6
        state, steps, outputs = rng.choice(DEFAULT.states), [], []
        first = state
        for _ in range(k):
            moves = [(m, t) for m, ts in DEFAULT.triggers.items() for t in ts if (state, t) in DEFAULT.arcs]
            if walk and moves and rng.random() < 0.8:
                m, t = rng.choice(moves)
                params = {"ticket_open": OPEN, "ticket_reopen": {"ticket_id": "a", "reopen_reason": "b"}, "resolution_confirm": {"review_id": "a", "resolution_notes": {}}, "admin_escalate": {"agent_id": "a", "ticket_id": "b"}, "admin_lifecycle_apply": {"lifecycle_profile": "x"}}[m]
                state = DEFAULT.arcs[state, t]
                steps.append((t, rng.choice([None, state])))
                outputs.append(call(m, params))
            else:
                steps.append((rng.choice([None, "", "lifecycle.close"]), rng.choice([None, "RESOLVED"])))
                outputs.append(rng.choice([call(), *EDGES[:8], call("ticket_open", OPEN)]))
        if rng.random() < 0.05:
            outputs = outputs[:-1] or [call()]
        rows.append((i, first, rng.choice([None, None, state, "CLOSED"]), steps, outputs))
    return rows


def test_fold_matches_the_model(spark):
    rows = random_records(4, 300)
    frame = spark.createDataFrame(rows, "i int, initial_state string, final_state string, steps array<struct<expected_trigger:string,expected_state_after:string>>, outputs array<string>").repartition(3)
    passed = 0
    for r in verify.verify_records(frame).collect():
        want = model.record([tuple(s) for s in r["steps"]], r["outputs"], r["initial_state"], r["final_state"])
        res = r["result"]
        failed = next((k for k, s in enumerate(res["steps"]) if not s["passed"]), None)
        assert (res["passed"], len(res["steps"]), res["final_state"], failed) == want, r
        assert (res["error_message"] is None) == res["passed"]
        passed += res["passed"]
    assert 20 < passed < 280


def test_stop_at_failure(spark):
    rows = [(0, "NEW", None, [(None, None)] * 3, [call(), "bad", call()])]
    frame = spark.createDataFrame(rows, "i int, initial_state string, final_state string, steps array<struct<expected_trigger:string,expected_state_after:string>>, outputs array<string>")
    res = verify.verify_records(frame, stop_at_failure=True).first()["result"]
    assert len(res["steps"]) == 2 and not res["passed"] and res["error_message"].startswith("step 1 failed")


def test_null_and_empty_records(spark):
    rows = [(0, "NEW", None, None, None), (1, None, None, [], []), (2, None, None, [(None, None)], [call()])]
    frame = spark.createDataFrame(rows, "i int, initial_state string, final_state string, steps array<struct<expected_trigger:string,expected_state_after:string>>, outputs array<string>")
    got = {r["i"]: r["result"] for r in verify.verify_records(frame).collect()}
    assert got[0]["error_message"] == "empty trajectory (no steps)" and got[0]["final_state"] == "NEW"
    assert not got[1]["passed"] and not got[2]["passed"] and got[2]["steps"][0]["parse"] == 0
    assert verify.verify_records(frame.limit(0)).count() == 0

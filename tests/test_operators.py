import json
import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stepledger.domain import DEFAULT, SUBSCORES, Domain, DomainError, arcs_of
from stepledger.functions import jsontext, text
from stepledger.operators import audit, compare, curate, rejects, reward, score


def one(spark, column, *values, schema="x string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], schema).select(column).collect()]


def test_text_functions(spark):
    x = F.col("x")
    nbsp = " "
    assert one(spark, text.thought(x), "<think>a</think>b</think>c", f"{nbsp}<think>\nz</think> y", "no", None) == ["a", "\nz", None, None]
    assert one(spark, text.call_text(x), f"<think></think>{nbsp}b {nbsp}\n", "<think>a</think>", "no") == ["b", "", None]
    assert one(spark, text.without_thought(x), "<think>a</think> b", "b <think>a</think>", "<think>a") == ["b", "b <think>a</think>", "<think>a"]
    assert one(spark, text.without_fences(x), "```json\n{}\n```", "```{}```", " {} ", "```json{}", "``` a ``` ", "{}```") == ["{}", "{}", "{}", "{}", "a", "{}```"]
    assert [sorted(v) for v in one(spark, text.token_set(x), "A b\na B", "", None, "  ")] == [["a", "b"], [], [], []]
    assert one(spark, text.error_bucket(x), " " + "é" * 100, None, "short ") == ["é" * 79, "", "short"]
    assert one(spark, text.table_cell(x), "a|b", None) == ["a\\|b", ""]
    assert [tuple(v) for v in one(spark, text.run_family(x), "a-seed3", "a-seed1-seed22", "a-seed", "seed5", "-seed5")] == [("a", 3), ("a-seed1", 22), ("a-seed", None), ("seed5", None), ("-seed5", None)]
    assert one(spark, text.response_content(x), '{"choices":[{"message":{"content":"a"},"text":"b"}]}', '{"choices":[{"text":"b"}]}', '{"content":[{"type":"text","text":"c"},{"type":"tool","text":"x"},{"type":"text","text":"d"}]}', '{"choices":[]}', "junk") == ["a", "b", "cd", None, None]
    pairs = spark.createDataFrame([("a b c", "b c d"), ("", ""), ("a", ""), ("a a", "A")], "a string, b string")
    assert [r[0] for r in pairs.select(text.jaccard(text.token_set(F.col("a")), text.token_set(F.col("b")))).collect()] == [0.5, 1.0, 0.0, 1.0]


def test_json_functions(spark):
    x = F.col("x")
    assert one(spark, jsontext.canonical(x, ("source",)), '{"b":1,"a":{"d":1.0,"c":2},"source":"s"}', '{"a":1} x', "[2, 1]") == ['{"a": {"c": 2, "d": 1.0}, "b": 1}', None, "[2, 1]"]
    assert one(spark, jsontext.minify(x), '{ "b" : [1, 2.50] , "a":"é" }', "{") == ['{"b":[1,2.5],"a":"é"}', None]
    assert one(spark, jsontext.valid(x), "{}", "{} {}", "NaN", "", None, '{"a":1,"a":2}') == [True, False, True, False, False, True]


def results(rng, n):
    names = ("passed", *SUBSCORES, "error_message")
    out = []
    for _ in range(n):
        subs = [float(rng.random() < 0.8) for _ in SUBSCORES]
        out.append(dict(zip(names, (all(subs), *subs, None if all(subs) else f"e{rng.randint(0, 3)}"))))
    return out


RESULT = "struct<passed:boolean," + ",".join(f"`{s}`:double" for s in SUBSCORES) + ",error_message:string>"


def graded(spark, seed, n=40, k=4):
    rng = random.Random(seed)
    rows = []
    for t in range(n):
        for s in range(k + 1):
            steps = results(rng, rng.randint(1, 3))
            passed = all(r["passed"] for r in steps) and rng.random() < 0.95
            rows.append((t, f"t{t}", s, rng.choice(["NEW", "CLOSED", "", None]), {"passed": passed, "steps": steps}, rng.choice(["<think>x</think>A", "<think>y</think>A", "B", "C", None])))
    return rows, spark.createDataFrame(rows, f"row_idx long, trajectory_id string, sample_idx int, initial_state string, result struct<passed:boolean,steps:array<{RESULT}>>, final_call string").repartition(3)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_scores_match_a_loop(spark, seed):
    rows, frame = graded(spark, seed)
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    maj = 0
    for rs in by.values():
        calls = [(r[5].split("</think>")[-1], r[4]["passed"]) for r in rs if r[2] > 0 and r[5] is not None]
        if calls:
            best = Counter(c for c, _ in calls).most_common(1)[0][0]
            maj += any(p for c, p in calls if c == best)
    s = score.run_scores(frame).first()
    n = len(by)
    assert (s["n_examples"], s["k"]) == (n, 4)
    assert s["pass_at_1"] == pytest.approx(sum(r[4]["passed"] for r in rows if r[2] == 0) / n)
    assert s["pass_at_k"] == pytest.approx(sum(any(r[4]["passed"] for r in rs if r[2] > 0) for rs in by.values()) / n)
    assert s["pass_at_maj"] == pytest.approx(maj / n)
    modes, seen = Counter(), {}
    for r in rows:
        if r[2] == 0 and not r[4]["passed"]:
            mode = next((next(m for m in SUBSCORES if x[m] < 1) for x in r[4]["steps"] if any(x[m] < 1 for m in SUBSCORES)), None)
            if mode:
                modes[mode] += 1
                seen.setdefault(mode, r[0])
    greedy = frame.where("sample_idx = 0")
    assert {(r["subscore"], r["n"], r["first_row"]) for r in score.failure_modes(greedy).collect()} == {(m, c, seen[m]) for m, c in modes.items()}
    card = score.scorecard(frame, "run").withColumn("names", F.map_keys("failure_modes")).first()
    assert card["names"] == sorted(modes, key=seen.get) and len(card["per_trajectory"]) == n
    failed = Counter(r[3] or "(unknown)" for r in rows if r[2] == 0 and not r[4]["passed"])
    assert {r["initial_state"]: r["n"] for r in score.failed_by_state(score.diagnostics(greedy)).collect()} == failed


def test_empty_run(spark):
    _, frame = graded(spark, 1)
    s = score.run_scores(frame.limit(0)).first()
    assert tuple(s) == (0, 0.0, 0.0, 0.0, score.DEFAULT_K)
    greedy_only = score.run_scores(frame.where("sample_idx = 0")).first()
    assert greedy_only["k"] == 0 and greedy_only["pass_at_k"] == 0


def test_rewards(spark):
    steps = results(random.Random(5), 4)
    frame = spark.createDataFrame([(steps,), ([],)], f"s array<{RESULT}>")
    for name, weights in DEFAULT.presets.items():
        each = [sum(w * s[k] for k, w in weights.items()) for s in steps]
        want = {"mean": statistics.mean(each), "min": min(each)}
        want["product"] = each[0] * each[1] * each[2] * each[3]
        for how, value in want.items():
            got = [r[0] for r in frame.select(reward.record_reward(F.col("s"), weights, how)).collect()]
            assert got[0] == pytest.approx(value) and got[1] is None, (name, how)
    with pytest.raises(ValueError):
        reward.record_reward(F.col("s"), {}, "median")
    with pytest.raises(KeyError):
        DEFAULT.preset("none")
    assert [r[0] for r in frame.limit(1).select(reward.step_reward(F.col("s")[0], {"nothing": 1.0})).collect()] == [0.0]


def test_arms_and_table(spark):
    rng = random.Random(9)
    rows = [(f"f{i:02}", name, 10, rng.random(), rng.choice([None, 0.5, 0.25]), 0.1) for i, name in enumerate(["a-seed%d" % s for s in range(5)] + ["b-seed%d" % s for s in range(3)] + ["c"] + ["d-seed%d" % s for s in range(4)])]
    runs = spark.createDataFrame(rows, "file string, run_name string, n_examples long, pass_at_1 double, pass_at_k double, pass_at_maj double")
    got = {r["family"]: r for r in compare.arm_summary(runs).collect()}
    for family in "abcd":
        own = [r for r in rows if r[1].split("-")[0] == family]
        for j, m in ((3, "pass_at_1"), (4, "pass_at_k")):
            values = [r[j] for r in own if r[j] is not None]
            half = 0.0
            if len(values) >= 4:
                q = statistics.quantiles(values, n=4)
                half = (q[2] - q[0]) / 2
            assert got[family][f"{m}_median"] == pytest.approx(statistics.median(values) if values else 0.0)
            assert got[family][f"{m}_half_iqr"] == pytest.approx(half)
        assert got[family]["n_seeds"] == len(own)
    assert compare.has_arms(runs) and not compare.has_arms(runs.where("run_name = 'c'"))
    table = {r["run_name"]: r for r in compare.run_table(runs, "c").collect()}
    base = next(r[3] for r in rows if r[1] == "c")
    assert table["c"]["delta_kind"] == "(base)" and table["c"]["delta"] is None
    assert all(table[r[1]]["delta"] == pytest.approx(r[3] - base) and table[r[1]]["worse"] == (r[3] < base) for r in rows if r[1] != "c")
    assert {r["delta_kind"] for r in compare.run_table(runs, "nobody").collect()} == {"?"}


def test_top_failures_and_chart(spark):
    x = F.col("x")
    maps = [{"a": 1, "b": 3, "c": 3, "d": 2}, {}, None, {"z": 0}]
    assert one(spark, compare.top_failures(x), *maps, schema="x map<string,bigint>") == ["b(3), c(3), d(2)", "-", "-", "z(0)"]
    modes = spark.createDataFrame([("parse", 1), ("schema", 5), ("schema", 15), ("other", 40), ("method_known", 0)], "subscore string, n long")
    assert [(r["subscore"], r["n"], r["bar"]) for r in compare.failure_chart(modes).orderBy("place").collect()] == [("parse", 1, 1), ("schema", 20, 10), ("method_known", 0, 0), ("precondition_met", 0, 0), ("transition_valid", 0, 0), ("sequence_optimal", 0, 0)]
    half = spark.createDataFrame([("parse", 1), ("schema", 8)], "subscore string, n long")  # 2.5 bars round to 2
    assert compare.failure_chart(half).orderBy("place").first()["bar"] == 2


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_similar_pairs_match_all_pairs(spark, threshold):
    rng = random.Random(int(threshold * 10))

    def rows(n):
        out = []
        for i in range(n):
            base = rng.sample("abcdefghij", rng.randint(0, 6))
            out.append((rng.choice([f"id{i}", f"x{i}"]), " ".join(base * rng.randint(1, 2)) if rng.random() < 0.95 else None))
        return out

    left, right = rows(60), rows(60)
    want = []
    for a, s in left:
        for b, t in right:
            x, y = set((s or "").split()), set((t or "").split())
            if x and y and a != b and len(x & y) / len(x | y) >= threshold:
                want.append((a, b))
    got = audit.similar_pairs(spark.createDataFrame(left, "id string, text string"), spark.createDataFrame(right, "id string, text string"), threshold)
    assert sorted((r["left_id"], r["right_id"]) for r in got.collect()) == sorted(want) and want


def test_similar_pairs_keep_texts_apart_that_share_words(spark):
    left = [(1, "a b c"), (2, "c b a a"), (3, ""), (4, None), (5, "a b c")]
    right = [(1, "a b c"), (6, "A  b\nc"), (7, "x"), (8, "")]
    got = audit.similar_pairs(spark.createDataFrame(left, "id int, text string"), spark.createDataFrame(right, "id int, text string"), 1.0)
    assert sorted((r[0], r[1]) for r in got.collect()) == [(1, 6), (2, 1), (2, 6), (5, 1), (5, 6)]


def test_similar_pairs_deal_texts_out_once(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"a b c d {i // 2}") for i in range(40)], "id int, text string")
    pairs = audit.similar_pairs(rows.where("id % 2 = 0"), rows.where("id % 2 = 1"))
    pairs.collect()
    plan = pairs._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # all words of a set are never dealt out word by word, and pairs that meet aren't laid out with the words of both
    assert "collect_list" not in plan and plan.count("Generate explode(split") == 0


def test_audit_counts_rows_of_equal_texts_without_laying_them_out(spark):
    rows = [(f"{s}{i:04}", "a b c d e", s) for s in ("train", "dev") for i in range(1500)] + [("train0000", "a b c d e f", "test"), (None, "a b c d e", "test"), (None, "z", "train")]
    table = spark.createDataFrame(rows, "trajectory_id string, situation string, split string").withColumn("raw", F.lit("{}"))
    out = {r["pair"]: r for r in audit.audit_splits(table).collect()}
    assert {k: r["similar_pairs"] for k, r in out.items()} == {"train/dev": 1500 * 1500, "train/test": 1499 + 1500, "dev/test": 2 * 1500}
    assert [tuple(x) for x in out["train/dev"]["examples"]] == [("train0000", f"dev{i:04}") for i in range(3)]
    assert [tuple(x) for x in out["train/test"]["examples"]] == [("train0000", None), ("train0001", None), ("train0001", "train0000")]
    plan = audit.audit_splits(table)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_set") == 6  # of one search; it was made for each two splits


def test_overlap_report(spark):
    def row(i, situation, extra=None, seed=None):
        return (json.dumps({"trajectory_id": i, "x": 1, "steps": [], **(extra or {})}), i, situation, (seed,))

    schema = "raw string, trajectory_id string, situation string, provenance struct<seed_trajectory_id:string>"
    left = spark.createDataFrame([row("a", "one two three four five", {"source": "l"}, "s1"), row("b", "x y"), row("c", None)], schema)
    right = spark.createDataFrame([row("a", "one two three four", {"source": "r"}), row("d", "one two three four five", None, "s1"), row("c2", "")], schema)
    r = audit.overlap_report(left, right).first()
    assert (r["exact_overlap"], r["shared_seed_ids"], r["similar_pairs"]) == (1, ["a"], 1)
    assert [tuple(e) for e in r["examples"]] == [("a", "d")]
    assert [x[0] for x in audit.shared_origins(left, right, nested=True).collect()] == ["s1"]


def test_rejections(spark):
    rows = [(0, True, None, None, None), (1, None, "r1", "s", "e" * 100), (2, False, None, None, None), (3, None, "r2", "s", "e" * 90), (4, None, "r2", "t", "z")]
    log = spark.createDataFrame(rows, "row_idx long, _run_start boolean, reason string, seed_id string, error string")
    assert {(r["reason"], r["n"]) for r in rejects.by_reason(log).collect()} == {("r1", 1), ("unknown", 1), ("r2", 2)}
    assert [(r["error"], r["n"]) for r in rejects.top(rejects.by_error(log), 2).collect()] == [("e" * 80, 2), ("", 1)]
    assert [(r["seed_id"], r["n"]) for r in rejects.top(rejects.by_seed(log), 9).collect()] == [("s", 2), ("<unknown>", 1), ("t", 1)]


CALL = {"jsonrpc": "2.0", "method": "ticket_get", "params": {"ticket_id": "T"}, "id": 1}
GOOD = {"trajectory_id": "g", "initial_state": "NEW", "steps": [{"thinking": "t", "tool_call": CALL, "prompt_context": {"prior_state": "NEW", "situation": "s"}}]}


def test_gate_verdicts(spark):
    def without(key):
        return {"trajectory_id": "x", "initial_state": "NEW", "steps": [{k: v for k, v in GOOD["steps"][0].items() if k != key}]}

    cases = [(GOOD, "accept"), ([1], "malformed_structure"), ({"trajectory_id": "x"}, "malformed_structure"), (without("thinking"), "malformed_structure"), (without("tool_call"), "malformed_structure"), (GOOD | {"steps": []}, "verifier_failed"), (GOOD | {"final_state": "CLOSED"}, "verifier_failed")]
    rows = [(json.dumps(c), v) for c, v in cases] + [("```json\n" + json.dumps(GOOD) + "\n```", "accept"), ("{", "json_decode"), (None, "teacher_error")]
    out = curate.gate(spark.createDataFrame(rows, "raw string, want string"))
    assert [(r["want"], r["verdict"]) for r in out.collect()] == [(v, v) for _, v in rows]
    totals = curate.totals(out.withColumn("split", F.lit("dev"))).first()
    assert (totals["total"], totals["ok"], totals["failed"]) == (10, 2, 8)


def test_unique_ids_and_split(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "a_1", "a__2", "b", "a_"])) for i in range(60)]
    frame = spark.createDataFrame(rows, "row_idx long, trajectory_id string").repartition(4)
    got = {r["row_idx"]: r["trajectory_id"] for r in curate.unique_ids(frame).collect()}
    assert len(set(got.values())) == 60
    first = {}
    for i, t in rows:
        first.setdefault(t, i)
    assert all(got[i] == t for t, i in first.items())
    ids = spark.range(1003).withColumnRenamed("id", "key")
    a = {r["key"]: r["split"] for r in curate.split(ids, "key", 5).collect()}
    assert a == {r["key"]: r["split"] for r in curate.split(ids.repartition(7), "key", 5).collect()}
    assert Counter(a.values()) == {"train": 802, "dev": 100, "rest": 101}
    assert a != {r["key"]: r["split"] for r in curate.split(ids, "key", 6).collect()}
    with pytest.raises(ValueError):
        curate.split(ids, "key", 5, 0.9, 0.2)


@pytest.mark.parametrize("by", [None, ["g"]])
def test_rolling_means_match_a_queue(spark, by):
    rng = random.Random(2)
    rows = [(i, rng.choice([None, "a", "b"]), rng.random() if rng.random() < 0.9 else None) for i in range(300)]
    frame = spark.createDataFrame(rows, "i long, g string, v double").repartition(5)
    got = {r["i"]: r["mean_v"] for r in score.rolling_means(frame, ["v"], ["i"], F.floor(F.col("i") / 7), by, window=4, block=10).collect()}
    queues = {}
    for i, g, v in rows:
        q = queues.setdefault(g if by else 0, [])
        q.append(v)
        del q[:-4]
        kept = [x for x in q if x is not None]
        assert (got[i] is None) == (not kept) and (not kept or got[i] == pytest.approx(sum(kept) / len(kept)))


def test_chat_and_prior_calls(spark):
    steps = [("S0", "why", None, "t0", '{"a": 1}', None, None), ("S1", "", None, "t1", None, None, None), ("S2", None, "[9]", "t2", '{"c": 3}', None, None), ("S3", None, None, "t3", '{"d": 4}', None, None)]
    frame = spark.createDataFrame([("r", steps)], f"trajectory_id string, steps array<{curate.STEP}>").withColumn("steps", curate.prior_calls(F.col("steps")))
    rows = curate.step_samples(frame).orderBy("step_idx").collect()
    assert [r["messages"][1]["content"] for r in rows] == ["Prior state: S0\nSituation: why", 'Prior state: S1\nPrior calls: [{"a": 1}]', "Prior state: S2\nPrior calls: [9]", 'Prior state: S3\nPrior calls: [{"a": 1}, {"c": 3}]']
    assert rows[0]["messages"][2]["content"] == '<think>t0</think>{"a": 1}' and [m["role"] for m in rows[0]["messages"]] == ["system", "user", "assistant"]


def test_domain_checks():
    with pytest.raises(DomainError):
        arcs_of([{"from": "a", "trigger": "t", "to": "b"}, {"from": "a", "trigger": "t", "to": "c"}])
    with pytest.raises(DomainError):
        Domain(("a",), "b", (), {}, {}, {}, {})
    with pytest.raises(DomainError):
        Domain(("a",), "a", (), {("a", "t"): "z"}, {}, {}, {})
